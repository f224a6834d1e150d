"""Helpers that the operators share: tables, stored results, text bytes and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.checkpoints import materialize, run_folder

#: A word, in the syntax of Java, Python and DuckDB: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    return materialize(df)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read again."""
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def crc_of_id(name: str = "doc_id") -> Column:
    """crc32 of an id written as text."""
    return F.crc32(F.col(name).cast("string").cast("binary"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def filled(texts: pa.Array) -> pa.Array:
    """Texts with nulls as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts, "") if texts.null_count else texts


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of texts, and where each text starts and ends."""
    texts = filled(texts)
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    size = int(ends[-1] - ends[0]) if len(ends) else 0
    if not size:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8, size, int(ends[0])), ends - ends[0]


def pieces(
    batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1
    for begin, end in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(int(begin), int(end - begin))


def slices(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches cut to ``size`` rows, so that few rows are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased; ``bytes.split`` cuts at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words; of the whole sequence where it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    runs = len(words) - size + 1
    out = np.full(runs, size, np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + runs])
    return out


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingle hashes of a text, in rising order."""
    return np.unique(shingles(word_hashes(text or ""), size))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most: int, chars: int, *, id_column: str = "doc_id"
) -> list[tuple[str, int]]:
    """At most about ``most`` texts of each class (0 or 1), drawn by hash and cut to ``chars`` characters, in a fixed order."""
    marks = labels.where(F.col(label).isin(0, 1)).select(F.col(id_column).alias("id"), F.col(label).alias("y"))
    sizes = {r.y: r.n for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, min(1.0, most / n)).otherwise(share)
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    marks = marks.where(place < share)
    texts = docs.select(F.col(id_column).alias("id"), F.substring("text", 1, chars).alias("text"))
    # About ``most`` rows per class, whatever the input.
    rows = texts.join(F.broadcast(marks), "id").where("text is not null").select("id", "text", "y").collect()
    return [(r.text, int(r.y)) for r in sorted(rows, key=lambda r: (r.id, r.y))]
