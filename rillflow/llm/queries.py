"""One query per operator on the supplied tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import conversations, decontaminate, embeddings, language, mixing, neardup, negatives, packing, quality, substrings, tokens, toxicity, urls
from rillflow.llm.common import crc_of_id, table
from rillflow.operators.checkpoints import run_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"

#: Weights in the order of sources, share of all words that the mix holds, epochs at most.
MIX = {"weights": [5, 2, 1], "share": 1.5, "epochs": 2.0}

#: (verdict, host, start of the path)
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op6_mixing(spark, folder):
    """Words that the mix takes of each document."""
    return mixing.mix(table(spark, folder, "documents"), **MIX)


ORACLES["op6_mixing"] = """
WITH docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || doc_id::VARCHAR) AS place
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0 * sum(size) AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM docs GROUP BY source
), filled AS (  -- in the order in which sources reach their caps: the water level once those before are full
  SELECT *, (1.5 * sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), final AS (SELECT arg_min(level, cap / weight) FILTER (WHERE cap > level * weight) AS level FROM filled
), targets AS (
  SELECT source, source_size,
         CASE WHEN (SELECT level FROM final) IS NULL THEN cap::DOUBLE
              ELSE least(cap::DOUBLE, (SELECT level FROM final) * weight) END AS target
  FROM sources
), parts AS (
  SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS whole FROM targets
), placed AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
         round(p.target)::BIGINT - p.whole * p.source_size AS part,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS reached
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, part - reached)))::BIGINT AS taken
FROM placed
"""


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query
def op7_token_output(spark, folder):
    """Encode all texts, write the files, read them back."""
    path = run_folder(spark, "tokens")
    tokens.write_tokens(table(spark, folder, "documents"), path, tokenizer_file(), end_id=1)
    return tokens.read_tokens(spark, path, visit=tokens.crc32_of_ids, kind="bigint", column="ids_crc32")


@query
def op5_url_filter(spark, folder):
    """Rules and, where none fits, boosted trees on every URL."""
    return urls.filter_urls(table(spark, folder, "pages"), URL_RULES)


@query
def op3_language(spark, folder):
    """Language of every document, learned from three quarters of the rows."""
    docs = table(spark, folder, "documents")
    held_out = (F.pmod(crc_of_id(), F.lit(4)) == 2).alias("held_out")
    profiles = language.learn_profiles(docs.where(~held_out))
    return language.identify(docs, profiles, F.col("doc_id"), held_out)


def quality_model(spark, docs, labels):
    """The classifier, learned from labelled rows that are not held out."""
    learn = F.pmod(crc_of_id(), F.lit(4)) != 2
    rows = quality.sample(docs.where(learn), labels.where(learn), "quality")
    return quality.train([text for text, _ in rows], [y for _, y in rows])


@query
def op9_quality(spark, folder):
    """Quality score of every document."""
    docs = table(spark, folder, "documents")
    held_out = (F.pmod(crc_of_id(), F.lit(4)) == 2).alias("held_out")
    model = quality_model(spark, docs, table(spark, folder, "labels"))
    scored = quality.score(docs, model, "doc_id", held_out)
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op10_toxicity(spark, folder):
    """Toxicity score of every document."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = (F.pmod(crc_of_id(), F.lit(5)) == 0).alias("held_out")
    learn = F.pmod(crc_of_id(), F.lit(5)) != 0
    lexicon = toxicity.learn_from(docs.where(learn), labels.where(learn))
    scored = toxicity.score(docs, lexicon, "doc_id", held_out)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op1_embedding_links(spark, folder):
    """Links and components of embeddings with equal labels."""
    return embeddings.link_vectors(table(spark, folder, "embeddings"), threshold=0.98)


ORACLES["op1_embedding_links"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reached AS (
  SELECT u AS id, v AS other FROM links
  UNION
  SELECT r.id, l.v FROM reached r JOIN links l ON r.other = l.u
), lowest AS (SELECT id, min(other) AS other FROM reached GROUP BY id)
SELECT e.vec_id,
       (SELECT count(*) FROM links l WHERE l.u = e.vec_id)::BIGINT AS n_links,
       least(e.vec_id, coalesce(w.other, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(w.other, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN lowest w ON w.id = e.vec_id
"""


@query
def op2_minhash_groups(spark, folder):
    """Groups of near-duplicate documents."""
    return neardup.near_duplicates(table(spark, folder, "documents"), size=2, percent=80)


@query
def op4_decontamination(spark, folder):
    """Benchmark items in documents."""
    return decontaminate.judge(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_repeated_substrings(spark, folder):
    """Bytes of each document that no earlier document covers."""
    return substrings.remove_repeats(table(spark, folder, "documents"))


@query
def op11_prefix_trie(spark, folder):
    """Nodes of the trie of conversations that share their first turns with one of a hundred."""
    rows = table(spark, folder, "conversations")
    donor = F.col("conv_id") - F.col("conv_id") % 100
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return conversations.trie(rows, donor, taken)


# CRC-32 of the decimal id, bit by bit: the reversed polynomial is 3988292384.
ORACLES["op11_prefix_trie"] = """
WITH turns AS (
  SELECT conv_id AS c, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(length(role)::VARCHAR || ':' || role || text)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, n, c - c % 100 AS donor,
         xor(list_reduce(list_concat([4294967295::BIGINT],
                                     list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                         lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
                                                    lambda x, k: xor(x >> 1, (x & 1) * 3988292384))),
             4294967295::BIGINT) % 6 AS h
  FROM (SELECT c, count(*) AS n FROM turns GROUP BY c)
), heads AS (
  SELECT v.c, t.i AS depth, t.role, t.text FROM convs v JOIN turns t ON t.c = v.donor WHERE t.i <= v.h
), rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT v.c, t.i - v.h + (SELECT count(*) FROM heads WHERE heads.c = v.c), t.role, t.text
  FROM convs v JOIN turns t ON t.c = v.c WHERE t.i > v.h
), members AS (
  SELECT c, 0 AS depth, '' AS key, NULL AS above, 0 AS chars,
         c NOT IN (SELECT c FROM rebuilt) AS last
  FROM convs
  UNION ALL
  SELECT c, depth, key, coalesce(lag(key) OVER w, ''), chars, lead(depth) OVER w IS NULL
  FROM (SELECT c, depth, length(text) AS chars,
               string_agg(length(role)::VARCHAR || ':' || role || length(text)::VARCHAR || ':' || text, '')
                 OVER (PARTITION BY c ORDER BY depth) AS key
        FROM rebuilt)
  WINDOW w AS (PARTITION BY c ORDER BY depth)
), nodes AS (
  SELECT depth, key, max(above) AS above, min(c) AS id, count(*) AS n, max(chars) AS chars,
         count(*) FILTER (last) = count(*) AS leaf,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends
  FROM members GROUP BY depth, key
), sums AS (
  SELECT m.depth, m.key, count(*) FILTER (u.leaf) AS n_leaves, sum((u.n - 1) * u.chars) AS saved
  FROM members m JOIN nodes u ON u.id = m.c AND u.depth >= m.depth
  GROUP BY m.depth, m.key
)
SELECT v.id AS conv_id, v.depth::BIGINT AS depth, p.id AS parent_conv_id, v.n AS n_convs,
       (SELECT count(*) FROM nodes k WHERE k.depth = v.depth + 1 AND k.above = v.key) AS n_children,
       s.n_leaves, s.saved::BIGINT AS saved_tokens, v.ends AS ends_sha256
FROM nodes v JOIN sums s ON s.depth = v.depth AND s.key = v.key
LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.key = v.above
"""


@query
def op12_hard_negatives(spark, folder):
    """Hard negatives of every hundredth vector; a seventh of the labels is shifted first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


ORACLES["op12_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_dot_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


def byte_vocabulary() -> tuple[str, str]:
    """The byte-level vocabulary as files of the tokenizers library and of tiktoken."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@query
def op13_packing(spark, folder):
    """Pieces of all documents, packed into sequences of 1024 ids, with a checksum of each piece's ids."""
    checksum = {"ids_crc32": F.crc32("ids")}
    packed = packing.pack(table(spark, folder, "documents"), *byte_vocabulary(), end_id=0, size=1024, columns=checksum)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
