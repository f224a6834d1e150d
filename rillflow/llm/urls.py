"""URL filter: fixed rules first, then gradient-boosted trees on lexical features, on DataFrame functions alone.

The trees learn from the URLs that a rule judges. Features: lengths of URL, host and path, path depth, host labels, digit
ratio, character entropy, number of query parameters, hyphens, and how often labelled URLs with the same host suffix or
the same file suffix are blocked.

Nulls and odd rows: a URL that is null or has no ``://`` has an empty host and path, fits no rule and is judged by its
features; repeated URLs are rows like any other; where labelled URLs are all of one verdict, or there are none, that
verdict (or ``allow``) holds for the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import ascii_lower, stored

#: Labelled URLs learned from, at most about; drawn by hash.
LEARN_URLS = 20_000
TREES, DEPTH = 12, 4
#: A suffix's block rate counts as so many URLs at the overall rate.
PRIOR = 5.0

FEATURES = [
    "url_length",
    "host_length",
    "path_length",
    "depth",
    "labels",
    "digit_ratio",
    "entropy",
    "parameters",
    "hyphens",
    "host_suffix_rate",
    "file_suffix_rate",
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(found, F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """Rule (as host + path) and verdict of the longest rule (verdict, host, path) that fits, or nulls."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, domain, start in reversed(longest):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        name = F.when(fits, domain + start).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def _occurrences(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _entropy(text: Column) -> Column:
    """Shannon entropy over letters, digits and common signs, in bits."""
    length = F.greatest(F.length(text), F.lit(1))
    terms = []
    for sign in "abcdefghijklmnopqrstuvwxyz0123456789-._~/?=&%#:":
        p = _occurrences(text, sign) / length
        terms.append(F.when(p > 0, -p * F.log2(p)).otherwise(0.0))
    return reduce(lambda a, b: a + b, terms)


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host``, ``path`` and the features that need no statistics."""
    text = F.coalesce(F.col(url), F.lit(""))
    lower = F.lower(text)
    length = F.greatest(F.length(text), F.lit(1))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    last = F.element_at(F.split("path", "/"), -1)
    df = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    return df.withColumns(
        {
            "url_length": F.length(text).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": F.regexp_count("path", F.lit("/[^/]")).cast("double"),
            "labels": (F.size(F.split("host", r"\."))).cast("double"),
            "digit_ratio": F.regexp_count(text, F.lit("[0-9]")) / length,
            "entropy": _entropy(lower),
            "parameters": F.regexp_count(query, F.lit("[^&]+")).cast("double"),
            "hyphens": _occurrences(text, "-").cast("double"),
            "host_suffix": F.regexp_extract("host", r"([^.]*)$", 1),
            "file_suffix": F.when(last.contains("."), F.regexp_extract(last, r"\.([^.]*)$", 1)).otherwise(""),
        }
    )


def _rates(train: DataFrame, suffix: str, rate: float) -> DataFrame:
    smooth = (F.sum("label") + PRIOR * rate) / (F.count(F.lit(1)) + PRIOR)
    return train.groupBy(suffix).agg(smooth.alias(f"{suffix}_rate"))


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    *,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """(id, ``host``, ``path``, ``rule``, ``verdict``, ``block_score``), one row per page.

    ``block_score`` is the trees' probability of blocking, null where a rule decides. Suffixes that no labelled URL has
    count as the overall rate.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = lexical(pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url")))
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": rule, "ruled": verdict})

    labelled = rows.where("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    total = labelled.count()
    share = min(1.0, LEARN_URLS / max(total, 1))
    drawn = F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(share * (1 << 30))
    train = stored(labelled.where(drawn).select("label", "host_suffix", "file_suffix", *FEATURES[:-2]))
    rate = labelled.agg(F.avg("label")).first()[0]

    out = [F.col("id").alias(id_column), "host", "path", "rule"]
    if rate is None or rate in (0.0, 1.0):
        rest = F.lit("block" if rate == 1.0 else "allow")
        return rows.select(*out, F.coalesce("ruled", rest).alias("verdict"), F.lit(None).cast("double").alias("block_score"))

    def with_rates(df: DataFrame) -> DataFrame:
        for suffix in ("host_suffix", "file_suffix"):
            df = df.join(stored_rates[suffix], suffix, "left")
        return df.fillna(rate, [f"{s}_rate" for s in stored_rates])

    # Counted over all labelled URLs; only the trees learn from a sample.
    stored_rates = {s: stored(_rates(labelled, s, rate)) for s in ("host_suffix", "file_suffix")}
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, labelCol="label", featuresCol="features")
    model = trees.fit(assembler.transform(with_rates(train)).select("label", "features"))

    judged = model.transform(assembler.transform(with_rates(rows)))
    block = vector_to_array("probability")[1]
    verdict = F.coalesce("ruled", F.when(block >= 0.5, "block").otherwise("allow"))
    score = F.when(F.col("ruled").isNull(), block)
    return judged.select(*out, verdict.alias("verdict"), score.alias("block_score"))
