"""Row types of the event logs and of the reports built from them."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LINE = _schema("value string")
SENSOR = _schema("id string, ts bigint, vc int")
USER_BEHAVIOR = _schema(
    "user_id bigint, item_id bigint, category_id bigint, behavior string, timestamp bigint"
)
AD_CLICK = _schema(
    "user_id bigint, ad_id bigint, province string, city string, timestamp bigint"
)
ACCESS_LOG = _schema(
    "ip string, user_id string, event_time timestamp, method string, url string"
)
LOGIN_EVENT = _schema(
    "user_id bigint, ip string, event_type string, event_time bigint"
)
ORDER_EVENT = _schema(
    "order_id bigint, event_type string, tx_id string, event_time bigint"
)
MARKETING_BEHAVIOR = _schema(
    "user_id bigint, behavior string, channel string, timestamp bigint"
)

HOT_ITEM = _schema("item_id bigint, item_count bigint, window_end timestamp")
HOT_PAGE = _schema("url string, view_count bigint, window_end timestamp")
HOT_AD = _schema(
    "province string, ad_id bigint, click_count bigint, window_end timestamp"
)
HOT_AD_BY_USER = _schema(
    "user_id bigint, ad_id bigint, click_count bigint, window_end timestamp"
)
WORD_COUNT = _schema("word string, cnt bigint")
