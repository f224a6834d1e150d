"""SQL over the same tables that gives the same rows as each query."""

_TEXT_LINES = "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"

_WORDS = f"""
SELECT unnest(CASE WHEN value <> '' AND rtrim(value, ' ') = '' THEN []
                   ELSE string_split(rtrim(value, ' '), ' ') END) AS word
FROM ({_TEXT_LINES})
"""

_CENTS = "CAST(round(value * 100) AS BIGINT)"


def _windows(size_s: int, slide_s: int, keys: str, where: str = "TRUE") -> str:
    """Counts per key and sliding window, by copying each row into its windows."""
    first = f"(floor(epoch_us(ts) / {slide_s * 1_000_000}.0) + 1) * {slide_s}"
    keyed = f"{keys}, " if keys else ""
    steps = -(-size_s // slide_s)
    return f"""
    SELECT {keyed}make_timestamp(end_s * 1000000) AS window_end, count(*) AS cnt
    FROM (SELECT {keyed}ts, CAST({first} AS BIGINT) + k * {slide_s} - {slide_s} AS start_s,
                 CAST({first} AS BIGINT) - {slide_s} - k * {slide_s} + {size_s} AS end_s
          FROM (SELECT * FROM events WHERE {where}) e, generate_series(0, {steps - 1}) g(k))
    WHERE ts < make_timestamp(end_s * 1000000)
      AND ts >= make_timestamp((end_s - {size_s}) * 1000000)
    GROUP BY ALL
    """


def _top3(size_s: int, slide_s: int, keys: str, source: str = "events") -> str:
    counts = _windows(size_s, slide_s, keys).replace("FROM events", f"FROM {source}")
    return f"""
    SELECT window_end, rk, {keys}, cnt FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {keys}) AS rk
      FROM ({counts}))
    WHERE rk <= 3
    """


def _sessions(key: str, gap: str) -> str:
    return f"""
    SELECT {key}, min(ts) AS window_start, max(ts) + INTERVAL '{gap}' AS window_end,
           count(*) AS cnt
    FROM (SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY ts) AS n
          FROM (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY {key} ORDER BY ts)
                                         + INTERVAL '{gap}' THEN 0 ELSE 1 END AS opens
                FROM events))
    GROUP BY {key}, n
    """


def _rising(key: str, hold: str) -> str:
    """A state machine over the rows of each key, one row per step."""
    return f"""
    WITH RECURSIVE numbered AS (
      SELECT {key} AS k, ts, value, row_number() OVER (PARTITION BY {key} ORDER BY ts) AS n
      FROM events
    ), steps AS (
      SELECT k, n, ts, value,
             CASE WHEN value > 0 THEN ts + INTERVAL '{hold}' END AS due,
             CAST(NULL AS TIMESTAMP) AS deadline, CAST(NULL AS DOUBLE) AS level
      FROM numbered WHERE n = 1
      UNION ALL
      SELECT r.k, r.n, r.ts, r.value,
             CASE WHEN r.value <= s.value THEN NULL
                  WHEN s.due IS NOT NULL AND r.ts <= s.due THEN s.due
                  ELSE r.ts + INTERVAL '{hold}' END,
             CASE WHEN r.ts > s.due THEN s.due END,
             CASE WHEN r.ts > s.due THEN s.value END
      FROM steps s JOIN numbered r ON r.k = s.k AND r.n = s.n + 1
    )
    SELECT k AS {key}, deadline, level FROM steps WHERE deadline IS NOT NULL
    UNION ALL
    SELECT k, due, value FROM steps s
    WHERE due IS NOT NULL AND n = (SELECT max(n) FROM numbered r WHERE r.k = s.k)
    """


def _count_window(size: int, slide: int) -> str:
    return f"""
    SELECT user_id, rn AS seen, CAST(total AS BIGINT) AS cents FROM (
      SELECT user_id, row_number() OVER w AS rn,
             sum({_CENTS}) OVER (PARTITION BY user_id ORDER BY event_id
                                 ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW) AS total
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    WHERE rn % {slide} = 0
    """


_DAILY = """
SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                             ORDER BY event_id) AS nth
FROM events
"""

_ORDER_LOG = """
SELECT coalesce(c.k, p.k) AS order_id, c.d AS created, p.d AS paid
FROM (SELECT o_orderkey AS k, CAST(date_diff('day', DATE '1970-01-01', o_orderdate) AS BIGINT) AS d
      FROM orders) c
FULL JOIN (SELECT l_orderkey AS k,
                  CAST(date_diff('day', DATE '1970-01-01', min(l_shipdate)) AS BIGINT) AS d
           FROM lineitem GROUP BY 1) p ON c.k = p.k
"""

ORACLES: dict[str, str] = {
    "word_count": f"SELECT word, count(*) AS cnt FROM ({_WORDS}) GROUP BY word",
    "pv_total": """
        SELECT event_type, count(*) AS cnt FROM events
        WHERE event_type = 'view' GROUP BY event_type""",
    "pv_running": """
        SELECT event_type, event_id, count(*) OVER (ORDER BY event_id) AS cnt
        FROM events WHERE event_type = 'view'""",
    "uv_approx": """
        SELECT count(DISTINCT user_id) AS uv, TRUE AS within_bound
        FROM events WHERE event_type = 'view'""",
    "uv_exact": """
        SELECT count(DISTINCT user_id) AS uv FROM events WHERE event_type = 'view'""",
    "project_map": """
        SELECT event_id, upper(event_type) AS kind, CAST(1 AS INTEGER) AS one FROM events""",
    "even_filter": "SELECT event_id FROM events WHERE event_id % 2 = 0",
    "flatmap_filter": """
        SELECT event_id, CAST(1 AS INTEGER) AS one FROM events WHERE event_type = 'view'""",
    "explode_list": "SELECT vec_id, unnest(embedding) AS x FROM embeddings",
    "key_repartition": "SELECT event_id, user_id FROM events",
    "random_repartition": "SELECT event_id, user_id FROM events",
    "partition_map": "SELECT event_id, event_id * 3 AS tripled FROM events",
    "level_labels": """
        SELECT event_id, CASE WHEN value < 50 THEN 'normal' WHEN value < 80 THEN 'warn'
                              ELSE 'alarm' END AS label FROM events""",
    "split_select": """
        SELECT event_id, value FROM events WHERE value >= 50 AND value < 80""",
    "multi_label_split": """
        SELECT event_id, CASE WHEN value < 50 THEN 'low' WHEN value < 80 THEN 'low+mid'
                              WHEN value <= 200 THEN 'mid' ELSE 'rest' END AS labels
        FROM events""",
    "union_x10": """
        SELECT event_id * 10 AS x10 FROM events
        WHERE event_type IN ('view', 'click', 'error', 'signup', 'purchase')
        UNION ALL SELECT event_id * 10 FROM events WHERE event_type = 'view'""",
    "connect_map": """
        SELECT CAST(1 AS INTEGER) AS side, concat(event_id, '/', event_type) AS value FROM events
        UNION ALL
        SELECT CAST(2 AS INTEGER), CAST(n_nationkey + 10 AS VARCHAR) FROM nation""",
    "key_process": """
        SELECT concat('key=', user_id, ', time=null, row={user_id=', user_id, ', event_id=',
                      event_id, ', event_type=', event_type, '}') AS value FROM events""",
    "threshold_alarm": """
        SELECT event_id, value, CAST(NULL AS VARCHAR) AS tag FROM events
        UNION ALL SELECT event_id, value, 'alarm' FROM events WHERE value > 300""",
    "pattern_match": """
        SELECT event_id, event_type FROM events
        WHERE (event_type = 'purchase' AND value >= 50) OR event_type = 'view'""",
    "parse_sensor_lines": """
        SELECT concat('sensor_', user_id) AS id, event_id AS ts,
               CAST(floor(value) AS INTEGER) AS vc FROM events""",
    "parse_behavior_lines": """
        SELECT user_id, event_id AS item_id, event_id % 10 AS category_id,
               event_type AS behavior, event_id * 7 AS "timestamp" FROM events""",
    "parse_ad_click_lines": """
        SELECT user_id, event_id % 10 AS ad_id, event_type AS province,
               upper(event_type) AS city, event_id * 7 AS "timestamp" FROM events""",
    "parse_login_lines": """
        SELECT user_id, concat('10.0.0.', event_id % 256) AS ip, event_type,
               event_id AS event_time FROM events""",
    "parse_order_lines": """
        SELECT event_id AS order_id,
               CASE WHEN event_id % 2 = 0 THEN 'create' ELSE 'pay' END AS event_type,
               CASE WHEN event_id % 2 = 0 THEN '' ELSE concat('tx', event_id) END AS tx_id,
               event_id * 7 AS event_time FROM events""",
    "parse_access_log_lines": """
        SELECT concat('10.0.0.', event_id % 256) AS ip, concat('u', user_id) AS user_id,
               CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS event_time,
               'GET' AS method, concat('/', event_type) AS url FROM events""",
    "rolling_sum": f"""
        SELECT user_id, event_id, CAST(sum({_CENTS}) OVER (
                 PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS "sum" FROM events""",
    "rolling_sum_one_type": f"""
        SELECT event_type, event_id, CAST(sum({_CENTS}) OVER (
                 PARTITION BY event_type ORDER BY event_id) AS BIGINT) AS "sum" FROM events""",
    "rolling_count": """
        SELECT user_id, event_id,
               count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS cnt FROM events""",
    "rolling_max": """
        SELECT user_id, first_value(event_id) OVER w AS first_event_id,
               max(value) OVER w AS value
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
    "rolling_reduce": f"""
        SELECT user_id, event_id,
               CASE WHEN row_number() OVER w = 1 THEN event_type ELSE 'reduced' END AS event_type,
               CAST(sum({_CENTS}) OVER w AS BIGINT) AS cents
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
    "rolling_own_reduce": f"""
        SELECT event_type, event_id,
               list_reduce(list({_CENTS} % 1000003) OVER (PARTITION BY event_type ORDER BY event_id),
                           lambda a, b: (a * 31 + b) % 1000003)::BIGINT AS checksum
        FROM events""",
    "own_accumulator": f"""
        SELECT event_type, day, (top[1] - top[2])::BIGINT AS gap
        FROM (SELECT event_type, ts::DATE AS day, max(DISTINCT {_CENTS}, 2) AS top FROM events GROUP BY ALL)""",
    "uv_sliding": f"""
        SELECT window_end - INTERVAL 1 HOUR AS window_start, window_end, uv
        FROM ({_windows(3600, 300, '', "event_type = 'view'")
               .replace('ts, CAST', 'ts, user_id, CAST')
               .replace('count(*) AS cnt', 'count(DISTINCT user_id) AS uv')})""",
    "longest_run": """
        SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end,
               n::INTEGER AS longest, event_type
        FROM (
          SELECT day, event_type, count(*) AS n, min(place) AS place
          FROM (SELECT *, place - row_number() OVER (PARTITION BY day, event_type ORDER BY place) AS run
                FROM (SELECT date_trunc('day', ts) AS day, event_type,
                             row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY ts, event_id) AS place
                      FROM events))
          GROUP BY day, event_type, run)
        QUALIFY row_number() OVER (PARTITION BY day ORDER BY n DESC, place) = 1""",
    "tumbling_count": """
        SELECT user_id, date_trunc('day', ts) AS window_start,
               date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS cnt
        FROM events GROUP BY ALL""",
    "tumbling_sum": f"""
        SELECT event_type, date_trunc('hour', ts) AS window_start,
               date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
               CAST(sum({_CENTS}) AS BIGINT) AS cents, max({_CENTS}) AS most
        FROM events GROUP BY ALL""",
    "window_all": """
        SELECT date_trunc('hour', ts) AS window_start,
               date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt
        FROM events GROUP BY ALL""",
    "window_start_rule": """
        SELECT event_id, event_id - event_id % 7 AS window_start FROM events""",
    "sliding_counts": f"""
        SELECT event_type, window_end - INTERVAL 1 HOUR AS window_start, window_end, cnt
        FROM ({_windows(3600, 300, 'event_type')})""",
    "sliding_uneven": f"""
        SELECT event_type, window_end - INTERVAL 50 MINUTES AS window_start, window_end, cnt
        FROM ({_windows(3000, 1200, 'event_type')})""",
    "sliding_mean": f"""
        SELECT event_type, window_end - INTERVAL 1 HOUR AS window_start, window_end, mean
        FROM ({_windows(3600, 300, 'event_type')
               .replace('event_type, ts,', 'event_type, cents, ts,')
               .replace('SELECT * FROM events', f'SELECT *, {_CENTS} AS cents FROM events')
               .replace('count(*) AS cnt', 'sum(cents)::DOUBLE / count(*) AS mean')})""",
    "session_counts": _sessions("user_id", "3 hours"),
    "session_one_type": _sessions("event_type", "30 minutes"),
    "count_window_tumbling": _count_window(3, 3),
    "count_window_sliding": _count_window(3, 2),
    "count_window_all": f"""
        SELECT (rn + 1) * 100 AS seen, CAST(sum(cents) AS BIGINT) AS cents
        FROM (SELECT (row_number() OVER (ORDER BY event_id) - 1) // 100 AS rn,
                     {_CENTS} AS cents FROM events)
        GROUP BY rn HAVING count(*) = 100""",
    "hot_items": _top3(
        3600, 300, "user_id", "(SELECT * FROM events WHERE event_type = 'view')"
    ),
    "hot_pages": _top3(600, 5, "event_type"),
    "hot_ads_by_province": _top3(600, 5, "event_type, user_id"),
    "hot_by_user": _top3(3600, 300, "user_id, event_type"),
    "blacklist_pass": f"""
        SELECT event_id, ts, user_id, event_type FROM ({_DAILY}) WHERE nth <= 2""",
    "blacklist_alert": f"""
        SELECT user_id, event_type, ts, CAST(2 AS BIGINT) AS clicks
        FROM ({_DAILY}) WHERE nth = 3""",
    "blacklist_hot_ads": _top3(
        3600, 300, "user_id, event_type", f"(SELECT * FROM ({_DAILY}) WHERE nth <= 2)"
    ),
    "login_fail": """
        SELECT user_id, previous_ts, ts FROM (
          SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS previous_ts
          FROM events WHERE event_type = 'error')
        WHERE ts <= previous_ts + INTERVAL 1 HOUR""",
    "order_outcome": f"""
        SELECT order_id, CASE WHEN paid IS NULL THEN 'pay_missing'
                              WHEN created IS NULL THEN 'create_missing'
                              WHEN paid - created > 30 THEN 'paid_late'
                              ELSE 'paid' END AS outcome, created, paid
        FROM ({_ORDER_LOG})""",
    "rising_alert": _rising("user_id", "6 hours"),
    "rising_alert_one_type": _rising("event_type", "20 minutes"),
    "first_timer": """
        SELECT user_id, min(ts) + INTERVAL 5 SECONDS AS fires_at FROM events GROUP BY user_id""",
    "latest_value": f"""
        SELECT user_id, arg_max({_CENTS}, event_id) AS cents FROM events GROUP BY user_id""",
    "json_documents": """
        SELECT concat('{"data":"', event_type, '"}') AS value FROM events""",
    "kafka_values": "SELECT CAST(event_id AS VARCHAR) AS value FROM events",
}

ORACLES.update(
    {
        "stream_word_count": ORACLES["word_count"],
        "stream_tumbling": """
            SELECT event_type, date_trunc('hour', ts) AS window_start,
                   date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt
            FROM events GROUP BY ALL""",
        "stream_sessions": ORACLES["session_counts"],
        "stream_hot_by_user": ORACLES["hot_by_user"],
        "stream_hot_items": ORACLES["hot_items"],
        "stream_hot_pages": ORACLES["hot_pages"],
        "stream_blacklist_hot_ads": ORACLES["blacklist_hot_ads"],
        "stream_rolling_sum": f"""
            SELECT user_id, CAST(sum({_CENTS}) OVER (
                     PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS cents FROM events""",
        "stream_rolling_max": ORACLES["rolling_max"],
        "stream_count_window": ORACLES["count_window_sliding"],
        "stream_blacklist": f"""
            SELECT event_id, ts, user_id, event_type,
                   CASE WHEN nth <= 2 THEN 'main' ELSE 'alert' END AS tag,
                   CAST(least(nth, 2) AS BIGINT) AS clicks
            FROM ({_DAILY}) WHERE nth <= 3""",
        "stream_login_fail": ORACLES["login_fail"],
        "stream_rising_alert": ORACLES["rising_alert"],
        "stream_order_outcome": ORACLES["order_outcome"]
        + f"""
            UNION ALL SELECT order_id, 'pay_missing', created, NULL
            FROM ({_ORDER_LOG}) WHERE paid - created > 30
            UNION ALL SELECT order_id, 'create_missing', NULL, paid
            FROM ({_ORDER_LOG}) WHERE created - paid > 30""",
        "stream_top_items": ORACLES["hot_items"],
        "stream_closed_windows": f"""
            SELECT event_type, date_trunc('day', ts) AS window_start,
                   date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS cnt,
                   CAST(sum({_CENTS}) AS BIGINT) AS cents, max({_CENTS}) AS most
            FROM events GROUP BY ALL""",
        "stream_uv_sliding": ORACLES["uv_sliding"],
        "stream_order_pairs": ORACLES["order_outcome"],
        "stream_dropped_rows": """
            SELECT count(*) FILTER (ts > middle) AS rows_kept,
                   count(*) FILTER (ts <= middle)::BIGINT AS rows_dropped,
                   date_trunc('millisecond', max(ts)) AS watermark
            FROM events, (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS middle FROM events)""",
        "stream_late_windows": """
            SELECT event_type, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
                   count(*) AS cnt FROM events GROUP BY ALL""",
        "stream_side_output": ORACLES["threshold_alarm"],
        "stream_first_timer": ORACLES["first_timer"],
    }
)
