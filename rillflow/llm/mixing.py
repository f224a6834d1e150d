"""Mixing sources to target weights by capped water-filling, on DataFrame functions alone.

Every source asks for words in proportion to its weight. Sources that would repeat their text more than
``epochs`` times are clamped there; what they cannot give is dealt again by weight among the others until no
source is above its cap. A source's target is then met by whole repetitions of all its documents and, for
the rest, by documents in a seeded order; the last of these gives only the words still missing.

Nulls and odd rows: a null text has size 0; a null source is a source of its own; a source without words has
target 0; repeated ids are rows like any other; an empty table gives no rows. If all caps together are below
the share, every source is at its cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import WORD, stored, written

#: A source's documents are summed in so many slices of the seeded order; a slice is sorted in one task.
SLICES_HEX = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _key(source: str) -> Column:
    named = F.concat(F.lit("="), F.col(source).cast("string"))
    return F.coalesce(named, F.lit("null"))


def cycled_weights(sources: DataFrame, weights: list[int]) -> DataFrame:
    """``weight`` per row of ``sources``: by code point of ``source``, nulls last, in a repeating cycle.

    One row per source is ranked in one task, never documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(order) - 1) % len(weights)
    cycle = F.array(*[F.lit(w) for w in weights])
    return sources.withColumn("weight", F.element_at(cycle, at + 1))


def water_fill(sources: DataFrame, share: float, epochs: float) -> DataFrame:
    """Adds ``target`` to rows (..., ``source_size``, ``weight``).

    ``share`` times all sizes is dealt out. Each round is one aggregation over the sources; a round in which
    no further source reaches its cap is the last.
    """
    sources = stored(sources.withColumn("cap", epochs * F.col("source_size")))
    first = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not first[0]:
        return sources.withColumn("target", F.lit(0.0)).drop("cap")
    wanted, weight, clamped = share * first[0], first[1], 0
    level = wanted / weight
    while True:
        full = F.col("cap") <= level * F.col("weight")
        capped, rest, count = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count(F.when(full, 1)),
        ).first()
        if count == clamped or not rest:
            break
        clamped, level = count, (wanted - capped) / rest
    target = F.least("cap", level * F.col("weight"))
    if not rest:
        target = F.col("cap")
    return sources.withColumn("target", target).drop("cap")


def mix(
    docs: DataFrame,
    *,
    weights: list[int],
    share: float = 1.5,
    epochs: float = 2.0,
    seed: int = 17,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """How many words the mix takes of each document, repetitions counted.

    Returns (id, ``size``, ``source_size``, ``target``, ``taken``) and the columns ``keep``, one row per input row. The
    words taken of a source sum to its rounded target, and no document gives more than ``epochs`` times its size.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))
    sizes = written(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(source_column).cast("string").alias("source"),
            _key(source_column).alias("key"),
            word_count(text_column).alias("size"),
            # A third of all rows may have no id: these are placed by their text.
            F.coalesce(order, F.md5(F.concat(F.lit(f"{seed}:"), F.xxhash64(text_column).cast("string")))).alias("place"),
            *keep,
        ),
        "mix-sizes",
    ).withColumn("slice", F.substring("place", 1, SLICES_HEX))

    slices = stored(sizes.groupBy("key", "source", "slice").agg(F.sum("size").alias("words")))
    sources = slices.groupBy("key", "source").agg(F.sum("words").alias("source_size"))
    sources = water_fill(cycled_weights(sources, weights), share, epochs)
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    sources = sources.withColumn("whole", whole).withColumn(
        "part", F.round("target").cast("bigint") - F.col("whole") * F.col("source_size")
    )

    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(earlier), F.lit(0))
    slices = slices.withColumn("before", before).select("key", "slice", "before")
    slices = slices.join(sources.drop("source", "weight"), "key")

    within = (
        Window.partitionBy("key", "slice")
        .orderBy("place", "id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("reached")))
    return (
        sizes.drop("source")
        .join(slices, ["key", "slice"])
        .withColumn("reached", reached)
        .select(
            F.col("id").alias(id_column),
            "size",
            "source_size",
            "target",
            (F.col("whole") * F.col("size") + extra).cast("bigint").alias("taken"),
            *keep,
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row per repetition, the last one cut to the words it still gives.

    ``docs`` needs ``doc_id``, ``text`` and ``source``. Rows are numbered and stored first, so that repeated and missing ids are
    rows like any other. It returns the columns of ``docs``, with ``n_chars`` counted anew.
    """
    columns = docs.columns
    row, size, taken_, cut_ = (_unused(name, columns) for name in ("_row", "_size", "_taken", "_cut"))
    docs = written(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    taken = mix(docs, keep=(row,), **options).select(row, F.col("size").alias(size), F.col("taken").alias(taken_))
    rest = F.col(taken_) % F.greatest(size, F.lit(1))
    times = (F.col(taken_) / F.greatest(size, F.lit(1))).cast("bigint")
    rows = F.concat(
        F.array_repeat(F.lit(0).cast("bigint"), times.cast("int")),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")),
    )
    token = F.lit(r"[\x20\x09-\x0D]*" + WORD)
    cut = F.array_join(F.slice(F.regexp_extract_all("text", token, F.lit(0)), 1, F.col(cut_).cast("int")), "")
    text = F.when(F.col(cut_) > 0, cut).otherwise(F.col("text"))
    out = docs.join(taken.where(F.col(taken_) > 0), row).withColumn(cut_, F.explode(rows)).withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)


def _unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column is called so, in any case."""
    known = {c.lower() for c in columns}
    while name in known:
        name = f"_{name}"
    return name
