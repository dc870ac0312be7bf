"""Operator 7: near-duplicate vectors by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform; its hash is the axis it then lies
nearest to, with the sign. A table joins ``k`` such hashes to a bucket; besides its own bucket a vector visits those in
which the least certain axis is replaced by its runner-up. Candidate pairs are verified by cosine in double precision.

Equal vectors of one label are one class from the start. A pair that meets in several buckets counts in the first
only, decided from both vectors' buckets, so nothing needs to be collected to remove repetitions. A crowded bucket is
cut into blocks, each pair of blocks a group of its own; a group returns sums per vector and a spanning forest of its
links, never pairs.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from watchmill.llm.components import components
from watchmill.session import written

LEAST_COSINE = 0.98
# two vectors at the least cosine share one of their visited buckets with a chance of over AGREE to the power of the
# hashes per table (measured for 64 and 768 dimensions); MISS is the wanted chance that no table brings them together
AGREE, MISS = 0.88, 1e-3
PROBES = 2
# vectors of one bucket that are compared in one group with each other, or with as many others
BLOCK = 512
TASK_ROWS = 200_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the number of columns is a power of two."""
    rows, n = x.shape
    step = 1
    while step < n:
        x = x.reshape(rows, n // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(rows, n)


def sizes(n: int, dim: int) -> tuple[int, int]:
    """Hashes per table and number of tables: buckets as many as vectors, misses as rare as MISS."""
    width = 1 << max(0, dim - 1).bit_length()
    k = max(1, math.ceil(math.log(max(2, n)) / math.log(2 * width)))
    return k, math.ceil(math.log(MISS) / math.log(1 - AGREE**k))


def buckets(vectors: np.ndarray, k: int, tables: int, probes: int = PROBES, seed: int = 7) -> np.ndarray:
    """(rows, tables, 1 + probes): buckets of unit vectors, as 64-bit numbers that differ between tables."""
    rows, dim = vectors.shape
    width = 1 << max(0, dim - 1).bit_length()
    rng = np.random.default_rng([seed, dim])
    mix = np.uint64(0x9E3779B97F4A7C15)
    padded = np.zeros((rows, width))
    padded[:, :dim] = vectors
    out = np.zeros((rows, tables, 1 + probes), np.uint64)
    every = np.arange(rows)
    for t in range(tables):
        own, other, gap = (np.zeros((rows, k), np.uint64), np.zeros((rows, k), np.uint64), np.zeros((rows, k)))
        for j in range(k):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width)) / math.sqrt(width)
            size = np.abs(y)
            first = size.argmax(axis=1)
            best = size[every, first].copy()
            size[every, first] = -1
            second = size.argmax(axis=1) if width > 1 else first
            gap[:, j] = best - size[every, second]
            for codes, axis in ((own, first), (other, second)):
                codes[:, j] = axis * 2 + (y[every, axis] < 0)
        order = gap.argsort(axis=1, kind="stable")
        for p in range(1 + probes):
            codes = own
            if p:
                at = order[:, (p - 1) % k]
                codes = own.copy()
                codes[every, at] = other[every, at]
            value = np.full(rows, t + 1, np.uint64) * mix
            for j in range(k):
                value = (value ^ (codes[:, j] + np.uint64(j + 1))) * mix
                value ^= value >> np.uint64(29)
            out[:, t, p] = value
    return out.view(np.int64)


def _unit(values: list, dim: int) -> np.ndarray:
    x = np.array(values, dtype=float).reshape(-1, dim)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sign(k: int, tables: int):
    def run(batches):
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_dim.setdefault(len(v), []).append(i)
            codes = np.zeros((len(vectors), tables, 1 + PROBES), np.int64)
            for dim, at in by_dim.items():
                codes[at] = buckets(_unit([vectors[i] for i in at], dim), k, tables)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * (tables * (1 + PROBES))), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("cid"), flat], names=["cid", "codes"])

    return run


def _first_met(codes: np.ndarray, i: np.ndarray, j: np.ndarray, here: int) -> np.ndarray:
    """Which pairs meet for the first time in bucket ``here``. ``codes``: (rows, tables, visits)."""
    table = int(np.flatnonzero((codes[i[0]] == here).any(axis=1))[0])
    left = np.arange(len(i))
    for t in range(table):
        met = (codes[i[left], t][:, :, None] == codes[j[left], t][:, None, :]).any(axis=(1, 2))
        left = left[~met]
    a, b = codes[i[left], table], codes[j[left], table]
    earlier = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] < here)).any(axis=(1, 2))
    return left[~earlier]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(cid, n, block, vectors, codes, bucket, cross: bool, least: float):
    """Links of one group: ``cid, links`` (rows linked, weighed) and ``root`` (a spanning forest)."""
    if len({len(v) for v in vectors}) > 1:
        raise ValueError("a bucket holds vectors of one dimension")
    x = _unit(vectors, len(vectors[0]))
    near = x @ x.T >= least
    near &= block[:, None] < block[None, :] if cross else np.triu(np.ones(near.shape, bool), 1)
    i, j = np.nonzero(near)
    found_i, found_j = [], []
    for a in range(0, len(i), 1 << 14):
        pick = _first_met(codes, i[a : a + (1 << 14)], j[a : a + (1 << 14)], bucket) + a
        found_i.append(i[pick])
        found_j.append(j[pick])
    if not found_i or not sum(map(len, found_i)):
        return None
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    links = np.bincount(i, n[j], len(cid)).astype(np.int64) + np.bincount(j, n[i], len(cid)).astype(np.int64)
    on = np.flatnonzero(links)
    return cid[on], links[on], cid[_roots(len(cid), i, j)[on]]


def _verify(least: float, tables: int):
    """Rows come sorted by group; a group that the batches cut apart is put together first."""

    def groups(batches):
        rest = None
        for batch in batches:
            whole = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            if not whole.num_rows:
                continue
            key = np.stack([whole.column(c).to_numpy() for c in ("part", "bucket", "low", "high")])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts[:-1]], cuts):
                yield whole.slice(a, b - a)
            last = whole.slice(cuts[-1] if len(cuts) else 0).combine_chunks()
            rest = last.to_batches()[0]
        if rest is not None:
            yield pa.Table.from_batches([rest])

    def run(batches):
        out = []
        for g in groups(batches):
            if g.num_rows < 2:
                continue
            cross = g.column("low")[0].as_py() != g.column("high")[0].as_py()
            codes = np.array(g.column("codes").to_pylist(), np.int64).reshape(g.num_rows, tables, -1)
            found = _compare(
                g.column("cid").to_numpy(), g.column("n").to_numpy(), g.column("block").to_numpy(), g.column("v").to_pylist(),
                codes, g.column("bucket")[0].as_py(), cross, least)
            if found:
                out.append(found)
            if len(out) >= 1000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return run


def _batch(parts):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=["cid", "links", "root"])


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding, label``).

    Rows with equal labels link at a cosine of ``least`` or more; a null label, a null, empty or zero vector, one with
    a null, NaN or infinite component, and vectors of different lengths link with nothing: 0 links, a component of
    their own. Repeated rows link with each other. Other columns are ignored. Empty table: no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    good = rows.filter(usable)
    classes = good.groupBy("label", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    count, dim = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), (~usable).alias("_alone"))
    alone = alone.filter("_alone").drop("_alone")
    if not count:
        return alone.withColumn("kept", F.lit(True))
    k, tables = sizes(count, dim)
    signed = written(classes.select("cid", "v").mapInArrow(_sign(k, tables), "cid long, codes array<long>"), "signed")
    part = F.xxhash64("label", F.size("v"))
    entries = signed.join(classes.select("cid", part.alias("part")), "cid").select(
        "cid", "part", F.explode(F.array_distinct("codes")).alias("bucket"))
    crowds = entries.groupBy("part", "bucket").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    cut = F.ceil(F.col("crowd") / BLOCK).cast("int")
    met = entries.join(crowds, ["part", "bucket"]).withColumn("blocks", cut).withColumn(
        "block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("cid", "part", "bucket", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    full = met.join(signed.join(classes.select("cid", "n", "v"), "cid"), "cid")
    key = ["part", "bucket", "low", "high"]
    found = written(
        full.select(*key, "cid", "n", "block", "v", "codes").repartition(*key).sortWithinPartitions(*key)
        .mapInArrow(_verify(least, tables), "cid long, links long, root long"), "links")
    labels = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = classes.select("cid", "least").join(labels.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    named = groups.join(smallest, "component").join(links, "cid", "left").select("cid", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    judged = classes.join(named, "cid").select("label", "v", "component_id", (F.col("links") + F.col("n") - 1).alias("n_links"))
    linked = good.join(judged, ["label", "v"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
