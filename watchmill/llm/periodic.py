"""Operator 11: periodic runs of words, found by string synchronising sets.

A run is a maximal stretch of words with a smallest period q that it holds at least REPEATS times. Periods below BASE
are found by comparing every word with the one q before it. For longer ones a set of synchronising positions is taken
at each scale t = 4, 8, 16, ...: every window of t words has a hash, and a position belongs to the set if the least
hash among the t + 1 windows from there on is at one of the two ends. That depends on the 2t words from the position
on and on nothing else, so equal words make equal choices, and of any t positions one is in the set, unless all
windows there lie in a stretch whose period is at most t / 4. Such windows are left out, which keeps the set sparse;
their stretches are runs with a short period, which a smaller scale has found already.

A run with t <= q < 2t therefore has a position of the set near its start and the same one q words on, with equal
contexts of 2t words, and no such position between, since that would make the period smaller. So only neighbours
among the positions of one context propose periods; every proposal is extended to both sides on the words themselves.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

REPEATS = 4
LEAST = 6
# periods below are compared directly
BASE = 4
# words of several documents that are searched at once
AT_ONCE = 1 << 17
# words that an extension compares first, doubled as it goes on
STRIDE = 64
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


def _same_ahead(codes: np.ndarray, at: int, q: int) -> int:
    """How many words from ``at`` on equal the word ``q`` later."""
    n, step, stop = 0, STRIDE, len(codes) - q
    while at + n < stop:
        end = min(at + n + step, stop)
        differs = codes[at + n : end] != codes[at + n + q : end + q]
        first = int(differs.argmax())
        if differs[first]:
            return n + first
        n, step = end - at, step * 2
    return n


def _same_behind(codes: np.ndarray, at: int, q: int) -> int:
    """How many words before ``at`` equal the word ``q`` later."""
    n, step = 0, STRIDE
    while n < at:
        start = max(0, at - n - step)
        differs = (codes[start : at - n] != codes[start + q : at - n + q])[::-1]
        first = int(differs.argmax())
        if differs[first]:
            return n + first
        n, step = at - start, step * 2
    return n


def _direct(codes: np.ndarray, q: int) -> np.ndarray:
    """Starts and ends of all maximal stretches with period ``q`` and enough repeats."""
    same = np.concatenate([[False], codes[q:] == codes[:-q], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1])
    spans = np.stack([edges[::2], edges[1::2] + q], axis=1)
    return spans[spans[:, 1] - spans[:, 0] >= REPEATS * q]


def _least_ahead(values: np.ndarray, scale: int) -> np.ndarray:
    """The least of each ``scale + 1`` values in a row; ``scale`` is a power of two."""
    least, width = values, 1
    while width < scale:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    return np.minimum(least[:-1], values[scale:])


def synchronising(windows: np.ndarray, scale: int, left_out: np.ndarray) -> np.ndarray:
    """Positions of the set: ``windows`` holds a hash of the ``scale`` words from each position on."""
    ids = np.where(left_out, _NEVER, _mixed(windows))
    if len(ids) <= scale:
        return np.zeros(0, np.int64)
    least = _least_ahead(ids, scale)
    return np.flatnonzero((least != _NEVER) & ((least == ids[: len(least)]) | (least == ids[scale:])))


def find_runs(codes: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs in a row of word numbers, whatever their length.

    No run is longer than ``longest`` words.
    """
    longest = len(codes) if longest is None else longest
    periods: dict[tuple[int, int], int] = {}  # of each stretch its smallest period
    for q in range(1, min(BASE, longest // REPEATS + 1)):
        for a, b in _direct(codes, q).tolist():
            periods.setdefault((a, b), q)
    windows = _mixed(codes.astype(np.uint64) + _B)
    width = 1
    for scale in (1 << k for k in range(2, 63)):
        if scale * REPEATS > longest:
            break
        while width < scale:
            windows = _mixed(windows[: len(windows) - width] * _A + windows[width:] * _B)
            width *= 2
        covered = np.zeros(len(windows) + 1, np.int64)
        for (a, b), q in periods.items():
            if q * REPEATS <= scale <= b - a:
                covered[a] += 1
                covered[b - scale + 1] -= 1
        at = synchronising(windows, scale, np.cumsum(covered[:-1]) > 0)
        at = at[at + 2 * scale <= len(codes)]
        contexts = _mixed(windows[at] * _A + windows[at + scale] * _B)
        order = np.argsort(contexts, kind="stable")
        gap = at[order[1:]] - at[order[:-1]]
        near = (contexts[order[1:]] == contexts[order[:-1]]) & (gap >= scale) & (gap < 2 * scale)
        proposed = sorted(zip(at[order[:-1]][near].tolist(), gap[near].tolist()))
        ends: dict[int, int] = {}  # of each period, the end of the last stretch that was extended
        for p, q in proposed:
            if p + q < ends.get(q, 0):
                continue
            a, b = p - _same_behind(codes, p, q), p + _same_ahead(codes, p, q) + q
            ends[q] = b
            if b - a >= REPEATS * q:
                periods.setdefault((a, b), q)
    return [(a, b - a, q) for (a, b), q in sorted(periods.items())]


def _groups(texts: list[list[bytes]]):
    """Numbers of texts that are searched together: of like length, AT_ONCE words or a single longer one."""
    group, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if group and size + len(texts[i]) > AT_ONCE:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(texts[i])
    if group:
        yield group


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of the runs of at least LEAST words of each text, in order."""
    out = [[] for _ in texts]
    for group in _groups(texts):
        known: dict[bytes, int] = {}
        codes, starts = [], []
        for k, i in enumerate(group):
            starts.append(len(codes))
            codes.extend([known.setdefault(w, len(known)) for w in texts[i]])
            codes.append(-1 - k)  # a word of its own between two texts, so that nothing crosses
        found = find_runs(np.array(codes, np.int64), max(len(texts[i]) for i in group))
        for (a, n, q), k in zip(found, np.searchsorted(starts, [f[0] for f in found], "right") - 1):
            if n >= LEAST:
                out[group[k]].append((a - starts[k], n, q))
    return [sorted(r, key=lambda f: (f[0], f[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats: of each run only the first period stays."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for a, n, q in runs:
        change[a + q] += 1
        change[a + n] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def _searched(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for at in range(0, len(batch), 512):
            # bytes.split cuts at the six characters that the contract names, and drops empty words
            words = [(t or b"").split() for t in texts.slice(at, 512).to_pylist()]
            found = runs_of(words)
            yield pa.RecordBatch.from_pydict({
                "rest": batch.column("rest").slice(at, 512),
                "n_words": pa.array([len(w) for w in words], pa.int64()),
                "runs": pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found], _RUNS),
                "collapsed": pa.array([collapsed(w, r) for w, r in zip(words, found)], pa.binary()).cast(pa.string()),
            })


def periodic_runs(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``; ``text`` in place of their own texts.

    ``runs`` has ``start, length, period`` in words, by start and period; ``collapsed`` joins by one space the words
    that repeat no run. A null or blank text has no words and no runs, and collapses to an empty string. Rows are
    searched one by one: repeated rows, shared or missing doc_ids and other columns change nothing. No shuffle.
    """
    rows = docs.select(
        F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("rest"), (F.col("text") if text is None else text).cast("string").alias("text"))
    schema = T.StructType([
        rows.schema["rest"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_searched, schema).select("rest.doc_id", "n_words", "runs", "collapsed")


def made_periodic(text: Column, doc_id: Column) -> Column:
    """The contract's test texts: of a tenth of the documents, by checksum of the doc_id, the end repeats one stretch.

    From word a = g % n on, word i is word a + (i - a) % p of the original, with p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1)).cast("long")
    a = F.pmod(g, n).cast("int")
    left = (n - a).cast("int")
    p = (F.floor(left / (g % 8 + 3)) + 1).cast("int")
    part = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(part, F.ceil(left / p).cast("int"))), F.lit(1), left)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (F.size(words) > 0), changed).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of ``periodic_runs``."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("from"), (-r.period).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.withColumn("best", best)
    period = -F.col("best.q")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.from")).alias("start"), F.col("best.length").alias("length"), period.alias("period"),
        F.floor(F.col("best.length") * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
