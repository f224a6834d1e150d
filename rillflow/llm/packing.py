"""Documents packed into sequences of bounded length, by the histogram of piece lengths.

Documents are encoded, ended with an id and cut into pieces of the sequence length and a shorter rest. Only the
histogram of lengths (a number per length) goes to the driver. There, lengths are placed from the longest to the
shortest, each into the pack that has the most space left, all packs of one pattern at once: a pattern is a list of
lengths and a number of sequences, and taking in a length changes the pattern or splits off a part of its sequences.
A piece opens a sequence only where no open one has space, so all but one of the sequences that a length opens are
filled with it. There are at most three patterns per length. The patterns then say for each length which ranks lie
where; pieces are ranked within their length by a prefix scan (:func:`rillflow.operators.running_reduce`), so that a
length which very many documents have is split over tasks, and look up their place.

Sequences are filled without gaps from 0 and padded at the end to the full length, or not at all where their length
is a power of two.

Nulls and odd rows: a null text counts as empty and is a document of the end id alone; null document ids come first;
rows that share an id are documents of their own; an empty table gives no pieces. Further columns of any name are
ignored.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.common import filled, pieces as text_slices
from rillflow.operators import running_reduce
from rillflow.operators.arrow import groups
from rillflow.operators.checkpoints import run_folder

#: Characters after which a long text is encoded in parts.
LONG = 1 << 20
#: White space and Latin letters, whose classes are the same in all versions of Unicode that matter here.
_LATIN = re.compile("[^\t\n\r -~¡-ɏ]")
#: A place where the tokenizer's split always begins a new word.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: How the byte-level tokenizer splits texts (fixed: part of its definition).
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteEncoder:
    """Ids of a byte-level vocabulary.

    ``tokenizer`` is the file for the tokenizers library, whose ids are the right ones; ``ranks`` is the same vocabulary
    for tiktoken, which is several times faster and encodes Latin text. Anything else, and text that spells a special
    token, is left to the tokenizers library.
    """

    def __init__(self, tokenizer: str, ranks: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=_WORDS, mergeable_ranks=known, special_tokens={})
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        sample = "It's 42 words,\n\n  they'll do.  Über Größe\tñ "
        if self._of(sample).tolist() != self.library.encode(sample, add_special_tokens=False).ids:
            raise ValueError("the two vocabulary files give different ids")

    def _of(self, text: str) -> np.ndarray:
        if _LATIN.search(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)

    def __call__(self, text: str) -> np.ndarray:
        parts, begin = [], 0
        while len(text) - begin > LONG:
            cut = _CUT.search(text, begin + LONG)
            if cut is None:
                break
            parts.append(self._of(text[begin : cut.start()]))
            begin = cut.start()
        parts.append(self._of(text[begin:] if begin else text))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


_encoders: dict[tuple[str, str], ByteEncoder] = {}


def _encoder(tokenizer: str, ranks: str) -> ByteEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (tokenizer, ranks) not in _encoders:
        _encoders[tokenizer, ranks] = ByteEncoder(tokenizer, ranks)
    return _encoders[tokenizer, ranks]


def cut(docs: DataFrame, tokenizer: str, ranks: str, end_id: int, size: int, id_column: str, text_column: str) -> DataFrame:
    """Pieces (row, doc_id, start, length, doc_tokens, ids) of every whole text; ids are little-endian, 4 bytes each."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")
    )
    names = ["row", "doc_id", "start", "length", "doc_tokens", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, ranks)
        for batch in batches:
            for some in text_slices(batch):
                out, held = [], 0
                for row, doc, text in zip(*(c.to_pylist() for c in (*some.columns[:2], filled(some.column(2))))):
                    ids = np.append(encoder(text), np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size]
                        out.append((row, doc, start, len(piece), len(ids), piece.tobytes()))
                        held += len(piece)
                        if held > 1 << 20:
                            yield _batch(out, names, types)
                            out, held = [], 0
                if out:
                    yield _batch(out, names, types)

    return rows.mapInArrow(
        encode, "row bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
    )


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences that hold pieces of these lengths one after another."""

    count: int
    lengths: tuple[int, ...]


def patterns(histogram: Mapping[int, int], size: int) -> list[Pattern]:
    """Shortest-pack-first packing of a histogram (pieces per length, up to ``size``)."""
    full: list[Pattern] = []
    open_packs: dict[int, list[Pattern]] = defaultdict(list)  # by space left

    def keep(pack: Pattern, space: int) -> None:
        full.append(pack) if space == 0 else open_packs[space].append(pack)

    for length in sorted(histogram, reverse=True):
        rest = histogram[length]
        while rest:
            space = max((s for s in open_packs if s >= length), default=0)
            if not space:  # as many to a new pack as fit, since each next one finds space in it
                n = size // length
                for count, times in ((rest // n, n), (int(rest % n > 0), rest % n)):
                    if count:
                        keep(Pattern(count, (length,) * times), size - length * times)
                break
            pack = open_packs[space].pop()
            taken = min(pack.count, rest)
            if pack.count > taken:
                open_packs[space].append(Pattern(pack.count - taken, pack.lengths))
            if not open_packs[space]:
                del open_packs[space]
            keep(Pattern(taken, (*pack.lengths, length)), space - length)
            rest -= taken
    return full + [p for space in sorted(open_packs) for p in open_packs[space]]


def places(found: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length, in rising order: the first rank of a slot, its first sequence, its offset in sequences."""
    ranks: dict[int, int] = defaultdict(int)
    slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern in found:
        offset = 0
        for length in pattern.lengths:
            slots[length].append((ranks[length], sequence, offset))
            ranks[length] += pattern.count
            offset += length
        sequence += pattern.count
    return {length: tuple(np.array(s, np.int64).T) for length, s in slots.items()}


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    *,
    end_id: int = 0,
    size: int = 1024,
    folder: str | None = None,
    columns: Mapping[str, Column] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every piece (row, doc_id, start, length, doc_tokens, sequence_id, offset) and its ``columns``.

    ``folder`` gets the pieces with their ids, as Parquet, from which :func:`sequences` makes the sequences;
    ``columns`` are expressions over a piece that are kept with its place, such as a checksum of ``ids``. A document's
    ids begin with those of the text and end with ``end_id``.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "pieces")
    extra = dict(columns or {})
    rows = cut(docs, tokenizer, ranks, end_id, size, id_column, text_column).withColumns(extra)
    rows.write.option("compression", "zstd").parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder).drop("ids")
    # A number per length.
    histogram = {r.length: r.n for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.sparkContext.broadcast(places(patterns(histogram, size)))

    ranked = rows.withColumn("rank", F.lit(1).cast("bigint"))
    ranked = running_reduce(ranked, ["length"], ["doc_id", "row", "start"], ["rank"], lambda a, b: (a[0] + b[0],))
    names = [c for c in ranked.columns if c != "rank"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() - 1
            sequence, offset = np.zeros((2, len(lengths)), np.int64)
            for length in np.unique(lengths):
                of = np.flatnonzero(lengths == length)
                first, first_sequence, offsets = known[int(length)]
                slot = np.searchsorted(first, rank[of], "right") - 1
                sequence[of] = first_sequence[slot] + rank[of] - first[slot]
                offset[of] = offsets[slot]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank")
    return ranked.mapInArrow(look, f"{schema}, sequence_id bigint, offset bigint")


def sequences(spark: SparkSession, folder: str, packed: DataFrame, *, pad_id: int = 0, size: int = 1024) -> DataFrame:
    """(sequence_id, n_tokens, doc_ids, lengths, ids): whole sequences with their padding, ids as little-endian bytes."""
    ids = spark.read.parquet(folder).select("row", "start", "ids")
    rows = ids.join(packed.select("row", "start", "doc_id", "length", "sequence_id", "offset"), ["row", "start"])
    rows = rows.select("sequence_id", "offset", "doc_id", "length", "ids")
    rows = rows.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (sequence,), parts in groups(batches, [0]):
            found = pa.Table.from_batches(parts).to_pydict()
            lengths = found["length"]
            n = sum(lengths)
            expected = np.cumsum([0, *lengths[:-1]]).tolist()
            if found["offset"] != expected or n > size:
                raise ValueError(f"sequence {sequence} has gaps or is too long")
            whole = n if n & (n - 1) == 0 else size
            data = b"".join(found["ids"]) + np.full(whole - n, pad_id, "<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([sequence], pa.int64()),
                    pa.array([n], pa.int64()),
                    pa.array([found["doc_id"]], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([data], pa.binary()),
                ],
                ["sequence_id", "n_tokens", "doc_ids", "lengths", "ids"],
            )

    return rows.mapInArrow(
        join, "sequence_id bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, ids binary"
    )
