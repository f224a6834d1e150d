"""Near-duplicate documents by a chosen-path set similarity join on MinHash tokens.

A document is the set of its word shingles, embedded by ``TOKENS`` minwise tokens. A tree branches documents: a node picks one
of the tree's own tokens, or two for every second node, so that two documents at similarity 0.8 are expected to share 1.2 times
as many paths with every level; documents with equal tokens go on together. Nodes with at most ``NODE_ROWS`` documents are
compared exhaustively, larger ones branch on. No two of the ``TREES`` trees use the same token, so they fail independently: at
similarity 0.8, about two to three pairs in a million share no node at the deepest level (simulated), and fewer above it.

The first ``WAVE`` trees are compared at their roots before the others grow. What they link is contracted: from then on each
document carries its component, nodes whose members are all in one are left out, and only pairs across components are
compared. A node that stays large is a group of documents that
keep agreeing. Its members are compared with ``PIVOTS`` of them first. Where at most ``NODE_ROWS`` members are then outside the
node's largest component, these are compared with all others of the node, in a join that Spark splits; so are up to ``OUTSIDE``
where the largest component is at least half of the node, as branching on would take it along for nothing. Where more are apart,
the node branches on. Candidates pass a 2-bit sketch of the tokens and the size bound before their texts are fetched, those
across the parts of a node also a bound on the symmetric difference by parities of hashed shingles, and every
link is confirmed on the full sets. Documents with equal sets are one class throughout and are never expanded into pairs. Joins of which neither side is
bounded are merge joins at every size, so that small inputs show what large ones cost.

Nulls and odd rows: a null, empty or blank text has an empty set and links with nothing; a text of fewer words than a shingle
is one shingle; rows that share an id are compared one by one and are in one group; a row without an id is returned with
null component and ``kept`` false; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import WORD, filled, mixed, shingle_set, slices, stored, written
from rillflow.llm.components import components
from rillflow.operators.checkpoints import Scratch

TREES, DEPTH, NODE_ROWS = 16, 2, 32
#: Trees of the first wave, and members of a large node that all others are compared with.
WAVE, PIVOTS = 4, 3
#: Tokens of each tree, the first for its root, and of all trees.
OWN = 8
TOKENS = TREES * OWN
#: Members outside a component of at least half of a node that are compared with all others of the node.
OUTSIDE = 1_024
#: Levels that large nodes with many unlinked members go down further before all of these are compared.
FURTHER = 4
#: 2-bit tokens that may differ: at similarity 0.8, 19.2 of 128 do, with a deviation of 4.0; more than 40 with a chance of 1e-6.
MISMATCHES = 40
#: Bits of a bitmap of a set: the parity of how many shingles fall on each. Two bitmaps differ in at most as many bits as there are
#: shingles in one set only. So many may at most differ in ``DEVIATIONS`` standard deviations more bits than the mean.
BITS, DEVIATIONS = 1_024, 5.5
_BITMAP = [f"f{k + 1}" for k in range(BITS // 64)]
_SKETCH = [f"s{k + 1}" for k in range(TOKENS // 32)]

_SKETCH_TYPES = ", ".join(f"{s} bigint" for s in _SKETCH)
_BITMAP_TYPES = ", ".join(f"{f} bigint" for f in _BITMAP)
_SEEDS = mixed(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def minwise(hashes: np.ndarray) -> np.ndarray:
    """Minwise tokens of 32 bits of a set of 64-bit hashes."""
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4_096):
        x = hashes[at : at + 4_096, None] ^ _SEEDS[None, :]
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        np.minimum(best, x.min(0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def _sketch(tokens: np.ndarray) -> list[int]:
    """Two bits of each token, as signed 64-bit numbers of 32 tokens each."""
    bits = mixed(tokens.astype(np.uint64)) & np.uint64(3)
    place = np.arange(32, dtype=np.uint64) * np.uint64(2)
    return (bits.reshape(-1, 32) << place).sum(1, dtype=np.uint64).astype(np.int64).tolist()


def _bitmap(hashes: np.ndarray) -> list[int]:
    """For each of ``BITS`` places, whether an odd number of hashes falls on it, as signed 64-bit numbers."""
    odd = np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def signatures(docs: DataFrame, size: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(``id``, ``n``, ``print``, ``s1`` to ``s4``, ``f1`` to ``f16``, ``tokens``): set size, set fingerprint, sketch, bitmap, tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in filled(batch.column(1)).to_pylist():
                own = shingle_set(text, size)
                tokens = minwise(own)
                mark = xxhash.xxh3_128_digest(own.tobytes())
                rows.append((len(own), mark, *_sketch(tokens), *_bitmap(own), tokens.tobytes()))
            n, marks, *sketch, tokens = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(marks, pa.binary()),
                    *[pa.array(s, pa.int64()) for s in sketch],
                    pa.array(tokens, pa.binary()),
                ],
                ["id", "n", "print", *_SKETCH, *_BITMAP, "tokens"],
            )

    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(run, f"id bigint, n bigint, print binary, {_SKETCH_TYPES}, {_BITMAP_TYPES}, tokens binary")


def _child(nodes: np.ndarray, place: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A node's child by one token; the lowest bits are the number of the tree."""
    mark = tokens.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32))
    tree = nodes % np.uint64(TREES)
    found = mixed(nodes * np.uint64(0x9E3779B97F4A7C15) ^ mark)
    return found - found % np.uint64(TREES) + tree


def _roots(batches: Iterator[pa.RecordBatch], begin: int = 0, end: int = TREES) -> Iterator[pa.RecordBatch]:
    """The first branch of every tree from ``begin`` to before ``end``, by the first of its tokens.

    A row takes along the tokens of its tree (``own``), so that it needs nothing else to branch on.
    """
    trees = np.arange(begin, end, dtype=np.uint64)
    for batch in slices(batches, 2_048):
        tokens = np.array([np.frombuffer(t, np.uint32) for t in batch.column("tokens").to_pylist()])
        own = tokens.reshape(len(tokens), TREES, OWN)[:, begin:end]
        first = np.arange(begin, end) * OWN
        nodes = _child(np.broadcast_to(trees, own.shape[:2]), first[None, :], own[:, :, 0])
        rows = pa.array(np.repeat(np.arange(batch.num_rows), len(trees)))
        kept = [batch.column(c).take(rows) for c in _DOC]
        held = pa.array([o.tobytes() for o in own.reshape(-1, OWN)], pa.binary())
        yield pa.RecordBatch.from_arrays([*kept, held, pa.array(nodes.ravel().astype(np.int64))], [*_DOC, "own", "node"])


def _branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The children of ``node`` that a document goes on to."""
    more = np.uint64(OWN - 1)
    for batch in slices(batches, 4_096):
        nodes = batch.column("node").to_numpy().astype(np.uint64)
        own = np.array([np.frombuffer(t, np.uint32) for t in batch.column("own").to_pylist()])
        choice = mixed(nodes + np.uint64(1))
        rows = np.arange(len(nodes))
        first = (choice & np.uint64(0xFFFF)) % more
        twice = np.flatnonzero((choice >> np.uint64(16)) % np.uint64(2) == 0)
        step = (choice[twice] >> np.uint64(24)) % np.uint64(OWN - 2) + np.uint64(1)
        second = (first[twice] + step) % more
        rows, place = np.concatenate([rows, twice]), np.concatenate([first, second]) + np.uint64(1)
        tokens = own[rows, place.astype(np.int64)]
        children = _child(nodes[rows], nodes[rows] % np.uint64(TREES) * np.uint64(OWN) + place, tokens)
        kept = batch.select([c for c in batch.schema.names if c != "node"]).take(pa.array(rows))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(children.astype(np.int64))], [*kept.schema.names, "node"])


#: What a row keeps of a document.
_DOC = ["id", "n", *_SKETCH]
_ROW = f"id bigint, n bigint, {_SKETCH_TYPES}, own binary, node bigint"


def _differ(a: str, b: str) -> Column:
    """How many 2-bit tokens of two sketches differ."""
    differ = F.lit(0)
    for s in _SKETCH:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        either = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(either)
    return differ


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether two sketches and set sizes allow the similarity."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (_differ(a, b) <= MISMATCHES) & (100 * F.least(n, m) >= percent * F.greatest(n, m))


def _close(a: str, b: str, percent: int) -> Column:
    """Whether two bitmaps allow the similarity, which leaves at most ``most`` shingles in one set only.

    That many, thrown on ``BITS`` places, leave a binomial-like number of odd ones, of the mean and variance below.
    """
    differ = F.lit(0)
    for f in _BITMAP:
        differ = differ + F.bit_count(F.col(f"{a}.{f}").bitwiseXOR(F.col(f"{b}.{f}")))
    most = F.floor((F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent) / (100 + percent))
    even = F.exp(-2.0 * most / BITS)
    variance = BITS / 4 * (1 - even * even) - most * even * even
    return differ <= F.least(most, BITS / 2 * (1 - even) + DEVIATIONS * F.sqrt(F.greatest(variance, F.lit(0.0))))


def _pairs(a: str, b: str) -> list[Column]:
    """A candidate pair, the smaller id first, and the components of both."""
    u, v = F.struct(f"{a}.id", f"{a}.component"), F.struct(f"{b}.id", f"{b}.component")
    low, high = F.least(u, v), F.greatest(u, v)
    return [low["id"].alias("u"), high["id"].alias("v"), low["component"].alias("cu"), high["component"].alias("cv")]


def _with_components(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    if groups is None:
        return rows.withColumn("component", F.col("id"))
    rows = rows.join(groups.hint("merge"), "id", "left")
    return rows.withColumn("component", F.coalesce("component", "id"))


def _sized(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows of nodes that are compared now, and of those that are too large for it.

    Nodes whose members are all in one component are done.
    """
    with Scratch(scratch.spark) as first:
        rows = first.written(rows, "nodes")
        sizes = rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("size"), (F.min("component") < F.max("component")).alias("apart")
        )
        # The same kind of join at every size: neither side is bounded.
        rows = scratch.renewed(rows.join(sizes.where("apart").drop("apart").hint("merge"), "node"), "sized")
    return rows.where(F.col("size") <= NODE_ROWS).drop("own", "size"), rows.where(F.col("size") > NODE_ROWS).drop("size")


def _within(small: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of small nodes, all compared with all."""
    a, b = small.alias("a"), small.alias("b")
    both = (F.col("a.node") == F.col("b.node")) & (F.col("a.id") < F.col("b.id"))
    pairs = a.join(b, both & (F.col("a.component") != F.col("b.component")) & _alike("a", "b", percent))
    return pairs.select(*_pairs("a", "b"))


def _with_pivots(large: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of each member of a large node and ``PIVOTS`` of them, the same ones in different nodes where possible."""
    member = [*_DOC, "component"]
    orders = [F.col("id"), *(F.xxhash64(F.lit(k), "id") for k in range(1, PIVOTS))]
    firsts = [F.min(F.struct(o.alias("o"), *member)).alias(f"p{k}") for k, o in enumerate(orders)]
    pivots = [F.struct(*[F.col(f"p{k}.{c}").alias(c) for c in member]) for k in range(PIVOTS)]
    pivots = large.groupBy("node").agg(*firsts).select("node", F.explode(F.array_distinct(F.array(*pivots))).alias("b"))
    pairs = large.select("node", F.struct(*member).alias("a")).join(pivots, "node")
    return pairs.where((F.col("a.component") != F.col("b.component")) & _alike("a", "b", percent)).select(*_pairs("a", "b"))


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (``u``, ``v``, ...) whose full shingle sets are similar. ``docs``: (``id``, ``text``) of class members."""
    ids = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
    texts = scratch.written(docs.join(ids.hint("merge"), "id", "left_semi"), "candidate-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}  # the last document on each side
        for batch in slices(batches):
            keep = []
            for u, v, one, two in zip(*(batch.column(c).to_pylist() for c in ("u", "v", "one", "two"))):
                known = {i: known[i] for i in (u, v) if i in known}
                for i, text in ((u, one), (v, two)):
                    if i not in known:
                        known[i] = shingle_set(text, size)
                both = len(np.intersect1d(known[u], known[v], assume_unique=True))
                keep.append(100 * both >= percent * (len(known[u]) + len(known[v]) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["u", "v", "cu", "cv"])

    rows = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("one")).hint("merge"), "u")
    rows = rows.join(texts.select(F.col("id").alias("v"), F.col("text").alias("two")).hint("merge"), "v")
    rows = rows.select("u", "v", "cu", "cv", "one", "two")
    return rows.mapInArrow(run, "u bigint, v bigint, cu bigint, cv bigint")


class _Search:
    """The components found so far, and the pairs that were compared."""

    def __init__(self, docs: DataFrame, size: int, percent: int, scratch: Scratch):
        self.docs, self.size, self.percent, self.scratch = docs, size, percent, scratch
        self.groups: DataFrame | None = None  # (id, component) of linked documents
        self.tried: DataFrame | None = None

    def contract(self, links: DataFrame) -> None:
        """Take in links between components (``u``, ``v``)."""
        with Scratch(self.scratch.spark) as first:
            merged = first.written(components(links, first), "merged")
            if not merged.isEmpty():
                self._regroup(merged)

    def _regroup(self, merged: DataFrame) -> None:
        if self.groups is not None:
            old = self.groups.join(merged.select(F.col("id").alias("component"), F.col("component").alias("into")), "component", "left")
            old = old.select("id", F.coalesce("into", "component").alias("component"))
            # Smallest members that were not linked before have no row of their own yet.
            merged = old.union(merged.join(self.groups.select("id"), "id", "left_anti").select("id", "component"))
        self.groups = self.scratch.renewed(merged, "groups")

    def compare(self, pairs: list[DataFrame]) -> None:
        """Confirm candidate pairs and contract those that are links."""
        every = pairs[0]
        for more in pairs[1:]:
            every = every.union(more)
        every = every.distinct()
        if self.tried is not None:
            every = every.join(self.tried, ["u", "v"], "left_anti").select("u", "v", "cu", "cv")
        every = self.scratch.written(every, "compared")
        if every.isEmpty():
            return
        both = every.select("u", "v")
        self.tried = both if self.tried is None else self.tried.union(both)
        with Scratch(self.scratch.spark) as first:
            links = confirmed(every, self.docs, self.size, self.percent, first)
            self.contract(links.select(F.col("cu").alias("u"), F.col("cv").alias("v")))


def near_duplicates(
    docs: DataFrame,
    *,
    size: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, ``n_shingles``, ``component_id``, ``kept``), one row per document.

    Links join documents whose shingle sets have 100 * intersection >= ``percent`` * union.
    """
    with Scratch(docs.sparkSession) as scratch:
        return written(_grouped(docs, size, percent, id_column, text_column, scratch), "near-duplicates")


def _grouped(docs: DataFrame, size: int, percent: int, id_column: str, text_column: str, scratch: Scratch) -> DataFrame:
    with Scratch(scratch.spark) as first:
        signed = first.written(signatures(docs, size, id_column, text_column), "signatures")
        marked = scratch.written(signed.select("id", "n", "print"), "marks")
        classes = marked.where("n > 0 and id is not null").groupBy("print").agg(F.min("id").alias("rep"))
        classes = scratch.written(classes, "prints")
        # One row per class, also where an id occurs in several rows.
        own = signed.join(classes.select(F.col("rep").alias("id"), "print").hint("merge"), ["id", "print"])
        own = own.dropDuplicates(["id", "print"]).select("id", "n", *_SKETCH, *_BITMAP, "tokens")
        own = scratch.written(own, "classes")
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    search = _Search(texts.where("text is not null"), size, percent, scratch)
    # The texts of one id belong together.
    reps = marked.join(classes, "print").groupBy("id").agg(F.collect_set("rep").alias("reps")).where("size(reps) > 1")
    search.contract(reps.select(F.explode("reps").alias("u"), F.array_min("reps").alias("v")))
    _grow(own, search, scratch)

    members = marked.join(classes.hint("merge"), "print", "left")
    if search.groups is not None:
        members = members.join(search.groups.withColumnRenamed("id", "rep").hint("merge"), "rep", "left")
    else:
        members = members.withColumn("component", F.col("rep"))
    component = F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("id"))
    return members.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _grow(own: DataFrame, search: _Search, scratch: Scratch) -> None:
    """Roots of the first trees, then those of the others, then nodes in which many members stay apart, level by level."""
    found: list[DataFrame] = []
    rows = own.mapInArrow(lambda b: _roots(b, 0, WAVE), _ROW)
    for level in range(1 + DEPTH + FURTHER):
        if level < 2:
            rows = _with_components(rows, search.groups)
        small, large = _sized(rows, scratch)
        found.append(scratch.written(_within(small, search.percent).union(_with_pivots(large, search.percent)), "pairs"))
        many = None if large.isEmpty() else large
        if level < 2:  # the roots of the first trees, then those of the others: linked up before any node is judged
            search.compare(found)
            found = []
            large = _with_components(large.drop("component"), search.groups)
        if many is not None:
            few, many = _apart(large, level == DEPTH + FURTHER, scratch)
            if level == 0:
                many = few.union(many)
            else:
                with Scratch(scratch.spark) as first:
                    found.append(scratch.written(_between(few, own, search.percent, first), "pairs"))
            many = None if many is None or many.isEmpty() else _next(many.drop("main", "outside"))
        if level == 0:
            others = own.mapInArrow(lambda b: _roots(b, WAVE, TREES), _ROW)
            rows = others if many is None else others.union(many.drop("component").select(others.columns))
        elif many is None:
            break
        else:
            rows = many
    if found:
        search.compare(found)


def _next(large: DataFrame) -> DataFrame:
    names = [f for f in large.schema.fields if f.name != "node"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names)
    return large.select(*[f.name for f in names], "node").mapInArrow(_branches, f"{schema}, node bigint")


def _apart(large: DataFrame, last: bool, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Rows of nodes with few members outside their largest component (``main``), and of those with many.

    Up to ``OUTSIDE`` are few where the largest component is half of the node or more.
    """
    parts = large.groupBy("node", "component").agg(F.count(F.lit(1)).alias("members"))
    sizes = parts.groupBy("node").agg(
        F.max(F.struct("members", "component")).alias("most"), F.sum("members").alias("all")
    )
    outside = F.col("all") - F.col("most.members")
    few = (outside <= NODE_ROWS) | (outside <= OUTSIDE) & (2 * outside <= F.col("all"))
    sizes = sizes.select("node", F.col("most.component").alias("main"), outside.alias("outside"), few.alias("few"))
    rows = scratch.renewed(large.join(sizes.where("outside > 0").hint("merge"), "node"), "parts")
    if last:
        return rows.drop("few"), None
    return rows.where("few").drop("few"), rows.where("not few").drop("few")


def _between(rows: DataFrame, own: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Candidate pairs across the parts of a node: each member with all those outside the main part, which Spark buffers.

    A pair that meets in several nodes, one per tree as a rule, is taken in the first of them only. These are many pairs
    that are nearly similar, so they must pass the bitmap as well.
    """
    nodes = rows.groupBy("id").agg(F.collect_set("node").alias("nodes"))
    marks = scratch.written(nodes.join(own.select("id", *_BITMAP).hint("merge"), "id"), "places")
    rows = scratch.written(rows.drop("own", "outside").join(marks.hint("merge"), "id"), "members")
    a, b = rows.alias("a"), rows.where("component <> main").alias("b")
    apart = (F.col("a.node") == F.col("b.node")) & (F.col("a.component") != F.col("b.component"))
    half = (F.col("a.component") == F.col("a.main")) | (F.col("a.id") < F.col("b.id"))
    once = F.col("a.node") == F.array_min(F.array_intersect(F.col("a.nodes"), F.col("b.nodes")))
    near = _alike("a", "b", percent) & _close("a", "b", percent)
    return a.join(b, apart & half & near & once).select(*_pairs("a", "b"))


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """The documents (all their columns) with the smallest id of each group, and those without words or id.

    Rows that share an id are in one group, so one of them stays: one with words if there is any, the first by its columns.
    """
    found = near_duplicates(docs, **options)
    others = found.where("not kept and doc_id is not null").select("doc_id").distinct()
    out = docs.join(written(others, "others").hint("merge"), "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    repeated = stored(repeated.select("doc_id"))
    if repeated.isEmpty():
        return out
    blank = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    row = F.min(F.struct(blank.alias("_blank"), *docs.columns)).alias("_first")
    first = out.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(row).select("_first.*").select(*docs.columns)
    return out.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(first)
