"""Token ids in compressed files with a shared dictionary.

Every document's ids are serialized as little-endian numbers and compressed on their own with one zstandard
dictionary, which is trained on the serialized ids of a bounded sample of documents. A folder holds

- ``dictionary``: one row (``dictionary_hash``, ``dictionary``, ``bytes_per_id``);
- ``blocks``: rows of about ``BLOCK_BYTES``, in rising id order within a part and with parts in rising order:
  the frames of its documents one after another, and an offset index (ids, counts, frame lengths);
- ``parts``: the number of ids before each part.

Spark writes all of it, so a lost executor or a repeated task leaves no half-written files, and any file system that
Spark writes to will do. ``read_documents`` fetches single documents through the index.

Nulls and odd rows: a null or empty text has the end id alone; null document ids come first; rows that share an id are
all kept, in the order of the table; an empty table gives a dictionary and no blocks.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.common import filled, slices

#: The dictionary's largest size, and the sample it is trained on: documents, characters of a piece from any place of each.
DICTIONARY_BYTES, SAMPLE_DOCS, PIECE_CHARS = 64 << 10, 2_000, 2_000
BLOCK_BYTES = 4 << 20
#: Documents of a part, about.
DOCS_PER_PART = 5_000
#: Words that a Python worker remembers, twice at most, and the longest one among them.
REMEMBERED_WORDS, LONGEST_WORD = 250_000, 64
#: The characters by which byte-level vocabularies show bytes: themselves where printable, else numbers from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}
#: A word that stands between others when many are encoded at once.
_BETWEEN = "\x01"
#: Signs that are cut off the end of a word: no letters, no digits, nothing that starts a contraction.
SIGNS = "!\"#$%&)*+,-./:;=?@]^_`|}~"
LEVEL = 3


class WordEncoder:
    """Ids of texts, remembering the ids of words between spaces and line ends.

    Right for tokenizers that lower-case, drop white space, and split runs of letters from other signs before they look up
    anything, so that the ids of a text are those of its words in turn, and those of a word do not change with the case of
    A-Z or when the signs after its last letter are encoded on their own.

    What is remembered is bounded: ``remembered`` words of at most ``LONGEST_WORD`` characters, some 250 bytes each with
    their ids. Past that they become the older generation, from which words that are met again are taken over, and the
    generation before is dropped.
    """

    def __init__(self, path: str, width: int = 4, remembered: int = REMEMBERED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        self.width, self.remembered = width, remembered
        self.kind = {2: "H", 4: "I"}[width]
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned integers of ``width`` bytes; larger ids raise an error."""
        split = [_lower(t).replace("\n", " ").split(" ") for t in texts]
        new = set(itertools.chain.from_iterable(split)) - self.words.keys()
        if new:
            self._learn(new)
        ids = self.words.__getitem__
        out = [b"".join(map(ids, words)) for words in split]
        if new:
            for word in [w for w in new if len(w) > LONGEST_WORD]:
                self.words.pop(word)
                self.words.pop(_stem(word), None)
            if len(self.words) > self.remembered:
                self.older, self.words = self.words, {}
        return out

    def _take_over(self, wanted: set[str]) -> set[str]:
        """Takes words from the older generation; gives the others."""
        again = wanted & self.older.keys()
        self.words.update(zip(again, map(self.older.__getitem__, again)))
        return wanted - again

    def _learn(self, new: set[str]) -> None:
        new = self._take_over(new)
        cut = [(word, stem) for word in new if (stem := word.rstrip(SIGNS)) != word and _ends_alone(word, stem)]
        parts = {stem for _, stem in cut} | {word[len(stem) :] for word, stem in cut}
        whole = new.difference(word for word, _ in cut)
        self._encode(list(whole | self._take_over(parts - self.words.keys())))
        ids = self.words
        ids.update([(word, ids[stem] + ids[word[len(stem) :]]) for word, stem in cut])

    def _bytes(self, ids: list[int]) -> bytes:
        try:
            return array(self.kind, ids).tobytes()
        except OverflowError:
            raise ValueError(f"id {max(ids)} does not fit {self.width} bytes") from None

    def _encode(self, todo: list[str]) -> None:
        """Learn words: plain ones by the tokenizer's model, which they reach unchanged, others many at a time."""
        look_up, others = self.tokenizer.model.tokenize, []
        for word in todo:
            low = word.lower()
            if low.isalpha() and max(low) < "\u0250" and "\u0130" not in word:
                if not low.isascii():
                    low = low.encode("utf-8").decode("latin-1").translate(_SHOWN)
                self.words[word] = self._bytes([t.id for t in look_up(low)])
            else:
                others.append(word)
        self._encode_joined(others)

    def _encode_joined(self, todo: list[str]) -> None:
        """Learn words with a word of its own between them."""
        for at in range(0, len(todo), 20_000):
            some = [w for w in todo[at : at + 20_000] if _BETWEEN not in w and "<|" not in w]
            found = self.tokenizer.encode_batch_fast([f" {_BETWEEN} ".join(some)], add_special_tokens=False)
            ids = np.array(found[0].ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
            if len(self.mark) == 1 and len(ends) == len(some):
                data, ends = self._bytes(ids.tolist()), (self.width * ends).tolist()
                begins = [0, *(e + self.width for e in ends[:-1])]
                self.words.update((word, data[b:e]) for word, b, e in zip(some, begins, ends))
            for word in todo[at : at + 20_000]:
                if word not in self.words:
                    self.words[word] = self._bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)


def _lower(text: str) -> str:
    """A-Z in lower case, unless the text may spell a special token, which has a case of its own."""
    if "<|" in text:
        return text
    return text.lower() if text.isascii() else text.encode("utf-8").lower().decode("utf-8")


def _ends_alone(word: str, stem: str) -> bool:
    """Whether the signs after a word's last letter can be encoded on their own.

    Only after Latin letters that stay one letter in normal form and lower case; special tokens have signs of their own.
    """
    last = stem[-1:]
    return last.isalpha() and last < "\u0250" and last != "\u0130" and "<|" not in word


def _stem(word: str) -> str:
    stem = word.rstrip(SIGNS)
    return stem if _ends_alone(word, stem) else word


_encoders: dict[tuple[str, int], WordEncoder] = {}


def _encoder(path: str, width: int) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, width) not in _encoders:
        _encoders[path, width] = WordEncoder(path, width)
    return _encoders[path, width]


def train_dictionary(rows: DataFrame, path: str, width: int, end_id: int, total: int) -> bytes:
    """A zstandard dictionary from about ``SAMPLE_DOCS`` of ``total`` rows (row, text), a piece from any place of each."""
    share = min(1.0, 1.2 * SAMPLE_DOCS / max(total, 1))
    drawn = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30))
    n_pieces = F.ceil(F.char_length("text") / PIECE_CHARS)
    at = F.pmod(F.xxhash64(F.lit(7), "row"), n_pieces) * PIECE_CHARS + 1
    few = (
        rows.where(drawn)
        .where("length(text) > 0")
        .select(F.substring("text", at.cast("int"), F.lit(PIECE_CHARS)).alias("text"))
        .limit(SAMPLE_DOCS)
        .collect()
    )
    end = np.array([end_id], f"<u{width}").tobytes()
    samples = [ids + end for ids in WordEncoder(path, width)(sorted(r.text for r in few))]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few documents to learn from
        return b"".join(samples)[:DICTIONARY_BYTES] or end


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    *,
    end_id: int,
    bytes_per_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> str:
    """Encode every whole text and write the files. ``bytes_per_id`` is 2 or 4; a larger id raises an error."""
    spark = docs.sparkSession
    if end_id >> (8 * bytes_per_id):
        raise ValueError(f"id {end_id} does not fit {bytes_per_id} bytes")
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    total = rows.select("id").count()
    data = train_dictionary(rows, tokenizer, bytes_per_id, end_id, total)
    key = hashlib.sha256(data).hexdigest()
    spark.createDataFrame(
        [(key, bytearray(data), bytes_per_id)],
        "dictionary_hash string, dictionary binary, bytes_per_id int",
    ).write.parquet(f"{folder}/dictionary")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data), write_content_size=True)
        encoder, end = _encoder(tokenizer, bytes_per_id), np.array([end_id], f"<u{bytes_per_id}").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                places = zip(rows.column(0).to_pylist(), rows.column(2).to_pylist())
                part = [bisect.bisect_right(cuts, _place(*p)) for p in places]
                found = [ids + end for ids in encoder(filled(rows.column(1)).to_pylist())]
                counts = [len(ids) // bytes_per_id for ids in found]
                frames = [compressor.compress(ids) for ids in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.int32()),
                        rows.column(0),
                        rows.column(2),
                        pa.array(counts, pa.int32()),
                        pa.array(frames, pa.binary()),
                    ],
                    ["part", "id", "row", "n_tokens", "frame"],
                )

    cuts = _cuts(rows.select("id", "row"), total)
    frames = rows.mapInArrow(encode, "part int, id bigint, row bigint, n_tokens int, frame binary")
    frames = frames.repartition(len(cuts) + 1, "part")
    frames = frames.sortWithinPartitions("part", F.col("id").asc_nulls_first(), "row")
    frames = frames.select("part", "id", "n_tokens", "frame")
    blocks = frames.mapInArrow(
        lambda b: _packed(b, key),
        "part int, block int, start bigint, n_tokens bigint, first_id bigint, last_id bigint, dictionary_hash string, "
        "ids binary, counts binary, lengths binary, payload binary",
    )
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    totals = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    start, rows = 0, []
    for r in sorted(totals):
        rows.append((r.part, start))
        start += r.n
    spark.createDataFrame(rows, "part int, part_start bigint").coalesce(1).write.parquet(f"{folder}/parts")
    return folder


def _place(doc: int | None, row: int) -> tuple:
    """What documents are ordered by; their place in the table parts those that share an id."""
    return (doc is not None, doc or 0, row)


def _cuts(rows: DataFrame, total: int) -> list[tuple]:
    """Where parts of about ``DOCS_PER_PART`` documents begin, from ranges of (id, row): a row per part."""
    n_parts = -(-total // DOCS_PER_PART)
    if n_parts < 2:
        return []
    order = [F.col("id").asc_nulls_first(), F.col("row")]
    ranged = rows.repartitionByRange(n_parts, *order).groupBy(F.spark_partition_id().alias("p"))
    firsts = ranged.agg(F.min(F.struct(F.col("id").isNotNull().alias("known"), "id", "row")).alias("first")).collect()
    return sorted(_place(r.first.id, r.first.row) for r in firsts)[1:]


#: In place of a null document id in a block's index.
_NO_ID = np.iinfo(np.int64).min


def _packed(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    part, block, start, held = None, 0, 0, []

    def flush():
        ids, counts, frames = zip(*held)
        counts = np.array(counts, "<u4")
        known = [i for i in ids if i != _NO_ID]
        row = {
            "part": pa.array([part], pa.int32()),
            "block": pa.array([block], pa.int32()),
            "start": pa.array([start], pa.int64()),
            "n_tokens": pa.array([int(counts.sum(dtype=np.int64))], pa.int64()),
            "first_id": pa.array([min(known, default=None)], pa.int64()),
            "last_id": pa.array([max(known, default=None)], pa.int64()),
            "dictionary_hash": pa.array([key]),
            "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()),
            "lengths": pa.array([np.array([len(f) for f in frames], "<u4").tobytes()], pa.binary()),
            "payload": pa.array([b"".join(frames)], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(row), int(counts.sum(dtype=np.int64))

    size = 0
    for batch in slices(batches):
        columns = (batch.column(i).to_pylist() for i in range(4))
        for p, i, n, frame in zip(*columns):
            if held and (p != part or size >= BLOCK_BYTES):
                row, n_ids = flush()
                yield row
                block, start, held, size = (block + 1, start + n_ids, [], 0) if p == part else (0, 0, [], 0)
            if p != part:
                part, block, start = p, 0, 0
            held.append((_NO_ID if i is None else i, n, frame))
            size += len(frame)
    if held:
        yield flush()[0]


def _dictionaries(spark: SparkSession, folder: str) -> tuple[str, bytes, int]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data = bytes(row.dictionary)
    if hashlib.sha256(data).hexdigest() != row.dictionary_hash:
        raise ValueError("the dictionary does not match its hash")
    return row.dictionary_hash, data, row.bytes_per_id


def read_tokens(
    spark: SparkSession,
    folder: str,
    visit: Callable[[np.ndarray], object] | None = None,
    kind: str = "array<bigint>",
    column: str = "ids",
    id_column: str = "doc_id",
    only: list[int] | None = None,
) -> DataFrame:
    """Rows (id, ``start``, ``n_tokens``, ``column``) from the files.

    ``column`` holds what ``visit`` makes of a document's ids (unsigned 32-bit), by default the ids themselves.
    ``only``: fetch these documents; blocks without them are skipped, other frames are not decompressed.
    """
    key, data, width = _dictionaries(spark, folder)
    visit = visit or (lambda ids: ids.astype(np.int64).tolist())
    wanted = None if only is None else np.unique(np.array(only, np.int64))
    schema = f"{id_column} bigint, start bigint, n_tokens bigint, {column} {kind}"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        for batch in batches:
            for start, found, ids, counts, lengths, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if found != key:
                    raise ValueError("a block was written with another dictionary")
                ids, counts = np.frombuffer(ids, "<i8"), np.frombuffer(counts, "<u4").astype(np.int64)
                ends = np.cumsum(np.frombuffer(lengths, "<u4").astype(np.int64))
                starts = start + np.cumsum(counts) - counts
                rows = range(len(ids)) if wanted is None else np.flatnonzero(np.isin(ids, wanted))
                out = []
                for k in rows:
                    frame = payload[int(ends[k - 1]) if k else 0 : int(ends[k])]
                    tokens = np.frombuffer(decompressor.decompress(frame), f"<u{width}").astype("<u4")
                    if len(tokens) != counts[k]:
                        raise ValueError("a frame does not match the index")
                    doc = None if ids[k] == _NO_ID else int(ids[k])
                    out.append((doc, int(starts[k]), int(counts[k]), visit(tokens)))
                for at in range(0, len(out), 1_000):
                    frame = pd.DataFrame(out[at : at + 1_000], columns=[id_column, "start", "n_tokens", column])
                    frame[id_column] = frame[id_column].astype("Int64")
                    yield from pa.Table.from_pandas(frame, preserve_index=False).to_batches()

    blocks = spark.read.parquet(f"{folder}/blocks")
    if wanted is not None:
        hit = F.lit(False)
        for doc in wanted.tolist():
            hit = hit | ((F.col("first_id") <= doc) & (F.col("last_id") >= doc))
        blocks = blocks.where(hit)
    parts = spark.read.parquet(f"{folder}/parts")
    blocks = blocks.join(parts, "part").select(
        (F.col("part_start") + F.col("start")).alias("start"), "dictionary_hash", "ids", "counts", "lengths", "payload"
    )
    return blocks.mapInArrow(decode, schema)


def read_documents(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """Single documents through the offset index."""
    return read_tokens(spark, folder, only=ids)


def crc32_of_ids(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
