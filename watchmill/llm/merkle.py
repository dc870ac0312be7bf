"""Operator 12: a Merkle manifest of a dataset, kept as a postorder append log.

Each document is a leaf. Every language is a tree of runs of 8 over its leaves in order of doc_id; the roots of the
languages are the leaves of one more tree. A tree is a log to which nodes are appended as they complete: a leaf, and
after it every ancestor that it is the last leaf of. How many nodes come before a node then follows from the sizes of
the full subtrees to its left, so its place in the log has a closed form: a leaf ``i`` has ``i // 8 + i // 64 + ...``
ancestors' siblings before it. Builders of aligned blocks of 8**4 leaves therefore write disjoint, contiguous parts
of the log without knowing each other, the next tier does the same over the roots of the blocks, and a proof reads
its siblings at addresses that are computed, not searched.
"""

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from watchmill.operators.ordering import running_totals
from watchmill.session import written

FAN_BITS = 3
FAN = 1 << FAN_BITS
# levels that one builder completes by itself: a block is 8**4 leaves and at most 4,681 nodes of the log
TIER = 4
# no tree of 64-bit ranks is higher
LEVELS = 21
# the tree over the roots of the languages, in the column of tree numbers
TOP = -1
EMPTY = hashlib.sha256(b"").hexdigest()

LOG = "tree long, n long, level int, place long, position long, digest string"


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def position(n: int, level: int, place: int) -> int:
    """Where node ``place`` of ``level`` stands in the log of a tree of ``n`` leaves."""
    last = min((place + 1) << FAN_BITS * level, n) - 1
    before, rest = last, last >> FAN_BITS
    while rest:
        before, rest = before + rest, rest >> FAN_BITS
    return before + level


def height_of(n: Column) -> Column:
    return sum(((n > F.lit(1 << FAN_BITS * k)).cast("int") for k in range(1, LEVELS)), (n > 1).cast("int"))


def position_of(n: Column, level: Column, place: Column) -> Column:
    """``position`` as a column."""
    # a shift by more than 62 bits would wrap; no node that exists needs it
    last = F.least(F.call_function("shiftleft", place + 1, level * FAN_BITS), n) - 1
    return sum((F.shiftright(last, FAN_BITS * k) for k in range(1, LEVELS)), last) + level


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """Digest of a document's columns, each with its length before it, so that no two rows read alike."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*map(_field, columns)), 256)


def leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """``lang, doc_id, leaf, claim``: what is stored and what is claimed of every document (the same by default)."""
    own = leaf()
    return docs.select(
        F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"),
        own.alias("leaf"), (own if claimed is None else claimed).alias("claim"))


def _ranked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``tree, n, rank``, and the trees ``tree, lang, n``.

    Ranges over the whole order, so neither a language nor a doc_id is too large for a task; counts per language and
    range carry the ranks on. Equal doc_ids follow their leaves' digests, a missing doc_id comes first.
    """
    order = ["lang", "doc_id", "leaf", "row"]
    ranged = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order)
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "merkle-ranges")
    counts = ranged.groupBy("lang", "part").agg(F.count("*").alias("n"))
    # one row per language and range
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = written(counts.withColumn("before", F.coalesce(before, F.lit(0))), "merkle-counts")
    trees = counts.groupBy("lang").agg(F.sum("n").alias("n")).withColumn("one", F.lit(1))
    trees = written(running_totals(trees, ["lang"], ["one"]).select((F.col("one_upto") - 1).alias("tree"), "lang", "n"), "merkle-trees")
    starts = counts.select("part", "before", F.col("lang").alias("of")).join(
        trees.select("tree", "n", F.col("lang").alias("named")), F.col("of").eqNullSafe(F.col("named"))).drop("named")
    inside = F.row_number().over(Window.partitionBy("part", "lang").orderBy("doc_id", "leaf", "row"))
    placed = ranged.withColumn("inside", inside).withColumnRenamed("part", "range")
    placed = placed.join(starts, (F.col("range") == F.col("part")) & F.col("lang").eqNullSafe(F.col("of")))
    placed = placed.select("tree", "n", (F.col("before") + F.col("inside") - 1).alias("rank"), "doc_id", "leaf", "claim")
    return written(placed, "merkle-leaves"), trees


class _Builder:
    """Appends the nodes of one aligned block in the order in which they complete."""

    def __init__(self, base: int, tier: int):
        self.base, self.tier, self.key, self.out = base, tier, None, []

    def _emit(self, level: int, place: int, value: str) -> None:
        tree, n, _ = self.key
        self.out.append((tree, n, self.base + level, place, position(n, self.base + level, place), value))

    def _close(self, level: int) -> None:
        value, self.open[level] = digest(self.open[level]), []
        self.open[level + 1].append(value)
        self._emit(level + 1, self.place >> FAN_BITS * (level + 1), value)

    def add(self, tree: int, n: int, place: int, value: str) -> None:
        key = (tree, n, place >> FAN_BITS * self.tier)
        if key != self.key:
            self.finish()
            self.key, self.open = key, [[] for _ in range(self.tier + 1)]
        self.place = place
        self.open[0].append(value)
        if not self.base:
            self._emit(0, place, value)
        level = 0
        while level < self.tier and len(self.open[level]) == FAN:
            self._close(level)
            level += 1

    def finish(self) -> None:
        """The last block of a tree ends its open runs, from the leaves up."""
        if self.key is None:
            return
        for level in range(min(self.tier, height(self.key[1]) - self.base)):
            if self.open[level]:
                self._close(level)


def _built(base: int, tier: int):
    def run(batches):
        builder = _Builder(base, tier)
        schema = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("position", pa.int64()), ("digest", pa.string())])

        def rows():
            out, builder.out = builder.out, []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                builder.add(*row)
            if builder.out:
                yield rows()
        builder.finish()
        if builder.out:
            yield rows()

    return run


def append_log(nodes: DataFrame, tier: int = TIER) -> DataFrame:
    """The log ``tree, n, level, place, position, digest`` of trees over the leaves ``tree, n, rank, digest``.

    One tier of builders after the other: the roots of a tier's blocks are the leaves of the next.
    """
    log, base, rows = None, 0, nodes.select("tree", "n", F.col("rank").alias("place"), "digest")
    while True:
        dealt = rows.withColumn("block", F.shiftright("place", FAN_BITS * tier)).repartition("tree", "block")
        dealt = dealt.sortWithinPartitions("tree", "place").select("tree", "n", "place", "digest")
        built = written(dealt.mapInArrow(_built(base, tier), LOG), "merkle-log")
        log = built if log is None else log.union(built)
        base += tier
        rows = built.filter((F.col("level") == base) & (height_of(F.col("n")) > base)).select("tree", "n", "place", "digest")
        if not rows.limit(1).count():
            return log


@dataclass(frozen=True)
class Manifest:
    leaves: DataFrame  # tree, n, rank, doc_id, leaf, claim
    trees: DataFrame  # tree, lang, n, subroot
    log: DataFrame  # of the trees of the languages
    top: DataFrame  # of the tree over their roots
    root: str
    tier: int


def roots(log: DataFrame) -> DataFrame:
    return log.filter(F.col("level") == height_of(F.col("n"))).select("tree", F.col("digest").alias("root"))


def manifest(docs: DataFrame, claimed: Column | None = None, tier: int = TIER) -> Manifest:
    """Build the log over all of ``docs``. The root of an empty table is the digest of nothing."""
    placed, trees = _ranked(written(leaves(docs, claimed), "merkle-digests"))
    log = append_log(placed.select("tree", "n", "rank", F.col("leaf").alias("digest")), tier)
    trees = written(trees.join(roots(log).withColumnRenamed("root", "subroot"), "tree"), "merkle-subroots")
    top = append_log(trees.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(trees.count()).cast("long").alias("n"), F.col("tree").alias("rank"), F.col("subroot").alias("digest")), tier)
    found = roots(top).first()
    return Manifest(placed, trees, log, top, found.root if found else EMPTY, tier)


STEP = "array<struct<level: int, own: int, others: array<string>>>"


def paths(nodes: DataFrame, log: DataFrame) -> DataFrame:
    """``tree, level, place, path``: for the given nodes ``tree, n, level, place``, the siblings of each level up to the root.

    Addresses are computed and joined to the log. A root has no row.
    """
    n, step, place = F.col("n"), F.col("step"), F.col("place")
    levels = nodes.filter(F.col("level") < height_of(n)).withColumn("step", F.explode(F.sequence("level", height_of(n) - 1)))
    at = F.call_function("shiftright", place, (step - F.col("level")) * FAN_BITS)
    count = F.call_function("shiftright", n - 1, step * FAN_BITS) + 1
    first = at - F.pmod(at, F.lit(FAN))
    runs = levels.withColumns({"at": at, "other": F.explode(F.sequence(first, F.least(first + FAN, count) - 1))})
    known = log.select("tree", "position", "digest")
    wanted = runs.withColumn("position", position_of(n, step, F.col("other")))
    found = wanted.join(known, ["tree", "position"]).groupBy("tree", "level", "place", "step", "at").agg(
        F.array_sort(F.collect_list(F.when(F.col("other") != F.col("at"), F.struct("other", "digest")))).alias("others"))
    steps = found.select("tree", "level", "place", F.struct(
        F.col("step").cast("int").alias("level"), F.pmod("at", F.lit(FAN)).cast("int").alias("own"), F.col("others.digest").alias("others")).alias("one"))
    return steps.groupBy("tree", "level", "place").agg(F.array_sort(F.collect_list("one")).cast(STEP).alias("path"))


def _proofs(tier: int):
    """Rows come by block: its path above, its part of the log, then the leaves to prove, all in order."""

    def run(batches):
        key, upper, nodes, first, runs = None, [], [], 0, []
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("tree", "n", "block", "kind", "at", "digest", "doc_id", "leaf", "path")))
            for tree, n, block, kind, at, value, doc_id, own, path in rows:
                if (tree, block) != key:
                    key, upper, nodes, first, runs = (tree, block), [], [], 0, {}
                if kind == 0:
                    upper = [(step["own"], step["others"]) for step in path]
                elif kind == 1:
                    if not nodes:
                        first = at
                    nodes.append(value)
                else:
                    proof, folded = [], value
                    for level in range(min(tier, height(n))):
                        place = at >> FAN_BITS * level
                        group = place >> FAN_BITS
                        if runs.get(level, (-1,))[0] != group:
                            last = (n - 1) >> FAN_BITS * level
                            members = range(group << FAN_BITS, min((group + 1) << FAN_BITS, last + 1))
                            runs[level] = group, [nodes[position(n, level, p) - first] for p in members]
                        run = list(runs[level][1])
                        mine = place & FAN - 1
                        proof += run[:mine] + run[mine + 1 :]
                        run[mine] = folded
                        folded = digest(run)
                    for mine, others in upper:
                        proof += others
                        folded = digest(others[:mine] + [folded] + others[mine:])
                    out.append((tree, doc_id, own, proof, folded))
            if out:
                columns = zip(("tree", "doc_id", "leaf", "proof", "folded"), zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.string()))
                yield pa.RecordBatch.from_pydict({name: pa.array(values, kind) for name, values, kind in columns})

    return run


def proofs(made: Manifest) -> DataFrame:
    """``doc_id, leaf, lang, subroot, proof, folded`` of every leaf: its siblings level by level up to the root, and
    the root that its claim leads to with them.

    A block's path above itself is joined once per block, not per leaf; inside, siblings are read from the block's
    part of the log by address. A task holds one block's nodes, at most 4,681.
    """
    tier = made.tier
    block = F.shiftright(F.col("rank"), FAN_BITS * tier)
    blocks = made.leaves.select("tree", "n", block.alias("place")).distinct()
    high = made.log.filter(F.col("level") >= tier)
    inner = paths(blocks.filter(height_of(F.col("n")) > tier).select("tree", "n", F.lit(tier).alias("level"), "place"), high)
    total = F.lit(made.trees.count()).cast("long")
    outer = paths(made.trees.select(F.lit(TOP).cast("long").alias("tree"), total.alias("n"), F.lit(0).alias("level"), F.col("tree").alias("place")), made.top)
    none = F.array().cast(STEP)
    upper = blocks.join(inner.select("tree", "place", F.col("path").alias("inner")), ["tree", "place"], "left")
    upper = upper.join(outer.select(F.col("place").alias("tree"), F.col("path").alias("outer")), "tree", "left")
    no = {"digest": "string", "doc_id": "long", "leaf": "string", "path": STEP}
    null = {name: F.lit(None).cast(kind).alias(name) for name, kind in no.items()}
    above = upper.select(
        "tree", "n", F.col("place").alias("block"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), null["digest"], null["doc_id"], null["leaf"],
        F.concat(F.coalesce("inner", none), F.coalesce("outer", none)).alias("path"))
    # the block that a node of the log's lowest tier lies in
    within = F.call_function("shiftright", F.col("place"), (F.lit(tier) - F.col("level")) * FAN_BITS)
    nodes = made.log.filter(F.col("level") <= tier).select(
        "tree", "n", within.alias("block"), F.lit(1).alias("kind"), F.col("position").alias("at"), "digest", null["doc_id"], null["leaf"], null["path"])
    claims = made.leaves.select(
        "tree", "n", block.alias("block"), F.lit(2).alias("kind"), F.col("rank").alias("at"), F.col("claim").alias("digest"), "doc_id", "leaf", null["path"])
    dealt = above.union(nodes).union(claims).repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "at")
    found = dealt.mapInArrow(_proofs(tier), "tree long, doc_id long, leaf string, proof array<string>, folded string")
    return found.join(made.trees.select("tree", "lang", "subroot"), "tree").select("doc_id", "leaf", "lang", "subroot", "proof", "folded")


def verified(docs: DataFrame, claimed: Column | None = None, tier: int = TIER) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root, verified`` for every row of ``docs``.

    ``claimed`` is the digest that each row's holder shows (by default the true one). Nulls in any column are marked
    in the digest and differ from empty texts; a null lang is a tree of its own, before the others; null doc_ids come
    first in their tree, rows with equal doc_ids in order of their digests; equal rows are leaves of their own. An
    empty table gives no rows; other columns are ignored.
    """
    made = manifest(docs, claimed, tier)
    rows = proofs(made).withColumnRenamed("folded", "folded_root").withColumn("root", F.lit(made.root))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
