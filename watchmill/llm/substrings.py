"""Operator 6: remove every byte of a long string that occurs twice, by refining buckets of q-grams.

Suffixes are compared no further than LENGTH bytes, and only where a comparison can decide something. Of the q-grams
in each string of LENGTH bytes the one with the least hash is an anchor, so equal strings have equal anchors at equal
places, and about one position in 85 is one. Anchors of a q-gram form a bucket:

1. buckets of one anchor go: no string around it repeats;
2. a bucket is refined by the identifier of all that any string through the anchor can reach, 168 bytes before to 200
   after it. Anchors that agree in this settle every string through them at once;
3. of the others, and one of each settled kind as a partner, the strings fall into two halves by where they begin. Each
   half shares a core around the anchor, 116 or 117 bytes. Buckets are refined by the cores; what is alone goes;
4. what is left compares its strings place by place inside its bucket. A bucket too large for one task is refined to the
   last step instead, by the string itself, as counts.

Identifiers are hashes; those of step 2 are reused in 3 and 4. Steps 1 to 3 see fixed-size rows only, combined before
the shuffle; step 4 and the result read the texts, which are shuffled once.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from watchmill.llm.common import pieces, text_bytes
from watchmill.session import written

LENGTH, GRAM = 200, 32
REACH = LENGTH - GRAM  # 168: the earliest string with the anchor's q-gram at its end begins so far before it
HALF = REACH // 2  # strings that begin up to 84 before the anchor, and those that begin earlier
SEGMENT, MARGIN = 1 << 20, 400
TEXT_BYTES = 16 << 20
# anchors of a refined bucket that one task compares
CROWD = 20_000
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Hasher:
    """Hashes of ranges of a byte array, each in constant time after one pass."""

    def __init__(self, seed: int = 11, room: int = SEGMENT + 2 * MARGIN + 1):
        self.values = np.random.default_rng(seed).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        inverse = pow(_BASE, -1, 1 << 64)
        self.powers = np.cumprod(np.append(np.uint64(1), np.full(room, _BASE, np.uint64)), dtype=np.uint64)
        self.inverse = np.cumprod(np.append(np.uint64(1), np.full(room, inverse, np.uint64)), dtype=np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.inverse[: len(data)], out=sums[1:])
        return sums

    def ranges(self, prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((prefix[stop] - prefix[start]) * self.powers[start])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, best, fill) -> np.ndarray:
    """``best`` (minimum or maximum) of each ``width`` neighbours, in linear time."""
    n = len(values)
    rows = np.append(values, np.full(-n % width, fill, values.dtype)).reshape(-1, width)
    ahead = best.accumulate(rows, axis=1).ravel()
    back = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[: n - width + 1], ahead[width - 1 : n])


def anchors(grams: np.ndarray) -> np.ndarray:
    """Positions that are least among some REACH + 1 neighbours."""
    width = REACH + 1
    if len(grams) < width:
        return np.zeros(0, np.int64)
    least = _sliding(grams, width, np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF))
    room = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([room, least, room]), width, np.maximum, np.uint64(0)) == grams)


def _small(x: np.ndarray) -> np.ndarray:
    """31 bits, never 0."""
    return ((x >> np.uint64(33)) | np.uint64(1)).astype(np.int32)


def anchor_rows(hasher: Hasher, text: np.ndarray):
    """Per anchor: position, q-gram, identifier of its whole reach, those of both cores (0 where no string begins)."""
    n = len(text)
    for begin in range(0, n if n >= LENGTH else 0, SEGMENT):
        low = max(0, begin - MARGIN)
        data = text[low : begin + SEGMENT + MARGIN]
        if len(data) < LENGTH:
            continue
        prefix = hasher.prefix(data)
        grams = mixed((prefix[GRAM:] - prefix[:-GRAM]) * hasher.powers[: len(data) - GRAM + 1])
        at = anchors(grams)
        at = at[(at + low >= begin) & (at + low < begin + SEGMENT)]
        left, right = np.maximum(0, at - REACH), np.minimum(len(data), at + LENGTH)
        reach = hasher.ranges(prefix, left, right)
        reach = mixed(reach + (at - left).astype(np.uint64) * _MIX + (right - at).astype(np.uint64))
        place = at + low
        least, most = np.maximum(0, place + LENGTH - n), np.minimum(REACH, place)
        late, early = (least <= HALF) & (most >= least), (most > HALF) & (most >= least)
        cores = []
        for on, a, b in ((late, at, at + LENGTH - HALF), (early, at - HALF - 1, at + GRAM)):
            core = np.zeros(len(at), np.int32)
            core[on] = _small(hasher.ranges(prefix, a[on], b[on]))
            cores.append(core)
        yield place, grams[at].view(np.int64), reach.view(np.int64), cores[0], cores[1]


def _anchors(batches):
    hasher = Hasher()
    names = ["dk", "th", "pos", "gram", "reach", "late", "early"]
    for batch in batches:
        keys, salts = batch.column("dk").to_numpy(), batch.column("th").to_numpy()
        out = []
        for i, text in enumerate(batch.column("bytes")):
            for rows in anchor_rows(hasher, np.frombuffer(text.as_buffer(), np.uint8)):
                if len(rows[0]):
                    out.append((np.full(len(rows[0]), keys[i]), np.full(len(rows[0]), salts[i]), rows[0], *rows[1:]))
            if len(out) >= 512 or i == len(keys) - 1:
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)
                out = []


ANCHOR = "dk long, th long, pos long, gram long, reach long, late int, early int"
# bytes before the anchor with which a half's strings begin, first and last
SIDES = {0: (0, HALF), 1: (HALF + 1, REACH)}


def _contexts(batches):
    """Per anchor and half, the bytes that its strings cover, set so that the anchors lie at one place."""
    names = ["gram", "core", "side", "dk", "th", "pos", "need", "length", "lead", "context"]
    for batch in batches:
        for i in range(len(batch)):
            text = batch.column("bytes")[i].as_py()
            rows = []
            for t in batch.column("tasks")[i].as_py():
                first, last = SIDES[t["side"]]
                low, high = max(0, t["pos"] - last), min(len(text), t["pos"] - first + LENGTH)
                rows.append((t["gram"], t["core"], t["side"], batch.column("dk")[i].as_py(), batch.column("th")[i].as_py(), t["pos"], t["need"], len(text), low - (t["pos"] - last), text[low:high]))
            for a in range(0, len(rows), 4096):
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[a : a + 4096]), kinds)], names=names)


CONTEXT = "gram long, core int, side int, dk long, th long, pos long, need boolean, length long, lead int, context binary"
SPAN = "dk long, th long, start long, stop long"


def _runs(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joins strings of consecutive starts: index of the row, first start, past the last byte."""
    new = np.append(True, (np.diff(row) != 0) | (np.diff(start) != 1))
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(row)) - 1
    return row[at], start[at], start[end] + LENGTH


def _compare(hasher: Hasher, table: pa.Table) -> tuple | None:
    """Whole buckets of one half: spans of the strings that occur more than once."""
    first, last = SIDES[table.column("side")[0].as_py()]
    width = last - first + LENGTH
    pos, length, lead = (table.column(c).to_numpy() for c in ("pos", "length", "lead"))
    data = np.zeros((table.num_rows, width), np.uint8)
    for i, (skip, context) in enumerate(zip(lead.tolist(), table.column("context"))):
        bytes_ = np.frombuffer(context.as_buffer(), np.uint8)
        data[i, skip : skip + len(bytes_)] = bytes_
    prefix = np.zeros((table.num_rows, width + 1), np.uint64)
    np.cumsum(hasher.values[data] * hasher.inverse[:width], axis=1, out=prefix[:, 1:])
    bucket = mixed(table.column("gram").to_numpy().view(np.uint64) + table.column("core").to_numpy().astype(np.uint64) * _MIX)
    need = table.column("need").to_numpy()
    hits = np.zeros((table.num_rows, last - first + 1), bool)
    for k in range(last - first + 1):  # the string begins last - k bytes before the anchor
        begin = pos - last + k
        valid = np.flatnonzero((begin >= 0) & (begin + LENGTH <= length))
        if len(valid) < 2:
            continue
        strings = mixed(prefix[valid, k + LENGTH] - prefix[valid, k] + bucket[valid])
        order = np.argsort(strings)
        same = strings[order][1:] == strings[order][:-1]
        again = np.append(False, same) | np.append(same, False)
        hits[valid[order[again]], k] = True
    hits &= need[:, None]
    row, k = np.nonzero(hits)
    if not len(row):
        return None
    row, start, stop = _runs(row, pos[row] - last + k)
    return table.column("dk").to_numpy()[row], table.column("th").to_numpy()[row], start, stop


def _matches(batches):
    """Rows come sorted by half and bucket; a bucket that the batches cut apart is put together first."""
    hasher, rest = Hasher(room=1024), None

    def spans(table):
        side = table.column("side").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(side)) + 1).tolist(), len(side)]
        for a, b in zip(cuts, cuts[1:]):
            found = _compare(hasher, table.slice(a, b - a))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["dk", "th", "start", "stop"])

    for batch in batches:
        whole = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
        if not whole.num_rows:
            continue
        key = np.stack([whole.column(c).to_numpy() for c in ("side", "gram", "core")])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield from spans(whole.slice(0, last))
        rest = whole.slice(last)
    if rest is not None and rest.num_rows:
        yield from spans(rest)


def _strings(batches):
    """Two hashes of every string of a half, for buckets that are refined to the last step."""
    one, two = Hasher(13), Hasher(17)
    for batch in batches:
        for i in range(len(batch)):
            text = np.frombuffer(batch.column("bytes")[i].as_buffer(), np.uint8)
            starts = set()
            for t in batch.column("tasks")[i].as_py():
                first, last = SIDES[t["side"]]
                starts.update(range(max(0, t["pos"] - last), min(len(text) - LENGTH, t["pos"] - first) + 1))
            for a in range(0, len(text), SEGMENT):
                here = np.array(sorted(s for s in starts if a <= s < a + SEGMENT), np.int64)
                if len(here):
                    data = text[a : a + SEGMENT + LENGTH]
                    keys = [h.ranges(h.prefix(data), here - a, here - a + LENGTH).view(np.int64) for h in (one, two)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[0]), pa.array(keys[1]), pa.array(np.full(len(here), batch.column("dk")[i].as_py())),
                         pa.array(np.full(len(here), batch.column("th")[i].as_py(), np.int64)), pa.array(here)], names=["k1", "k2", "dk", "th", "start"])


def union(spans: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        a, b = max(0, a), min(n, b)
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        elif a < b:
            out.append((a, b))
    return out


def _result(batches):
    for batch in batches:
        rows = []
        for i in range(len(batch)):
            text = batch.column("bytes")[i].as_py()
            spans = union([(s["start"], s["stop"]) for s in batch.column("spans")[i].as_py() or ()], len(text))
            kept, at = hashlib.sha256(), 0
            for a, b in [*spans, (len(text), len(text))]:
                kept.update(memoryview(text)[at:a])
                at = b
            rows.append((batch.column("doc_id")[i].as_py(), len(text), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [{"start": a, "stop": b} for a, b in spans]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
        columns = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>"


def repeated_bytes(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` for every row of ``docs``.

    A byte goes if a string of LENGTH bytes that covers it also begins anywhere else, the same document included; texts
    are UTF-8 bytes, null is empty, shorter texts lose nothing. Repeated rows are different documents and so go
    whole if long enough. ``spans`` are the removed runs in bytes. Other columns are ignored. Empty table: no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("bytes"))
    # rows that a doc_id does not name alone are named by 128 bits of it and the text
    repeats = not rows.groupBy("doc_id").count().filter((F.col("count") > 1) & F.col("doc_id").isNotNull()).isEmpty()
    own = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).cast("binary"), F.lit(b":"), F.col("bytes"))
    half = lambda at: F.conv(F.substring(F.md5(own), at, 16), 16, -10).cast("long")
    odd = F.lit(True) if repeats else F.col("doc_id").isNull()
    rows = rows.withColumns({"dk": F.when(odd, half(1)).otherwise(F.col("doc_id")), "th": F.when(odd, half(17)).otherwise(F.lit(0).cast("long"))})
    found = rows.select("dk", "th", "bytes").mapInArrow(_anchors, ANCHOR)
    # written apart, so that the joins read plain shuffles, of which Spark can split the large partitions
    buckets = written(found.groupBy("gram").count().filter("count > 1").select("gram"), "grams")
    kept = written(found.join(buckets, "gram"), "anchors")
    place = F.struct("dk", "th", "pos")
    kinds = written(kept.groupBy("gram", "reach").agg(F.count("*").alias("n"), F.min(place).alias("partner")), "reaches")
    sorted_out = written(kept.join(kinds, ["gram", "reach"]), "kinds")
    settled = sorted_out.filter("n > 1").select("dk", "th", (F.col("pos") - REACH).alias("start"), (F.col("pos") + LENGTH).alias("stop"))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("late").alias("core")), F.struct(F.lit(1).alias("side"), F.col("early").alias("core"))))
    left = sorted_out.filter((F.col("n") == 1) | (place == F.col("partner"))).withColumn("need", F.col("n") == 1)
    left = left.select("dk", "th", "pos", "gram", "need", sides.alias("s")).select("dk", "th", "pos", "gram", "need", "s.side", "s.core").filter("core <> 0")
    cores = left.groupBy("gram", "side", "core").agg(F.count("*").alias("k"), F.max("need").alias("any")).filter("k > 1 AND any")
    tasks = written(left.join(cores.drop("any"), ["gram", "side", "core"]), "cores")
    texts = rows.repartition(pieces(text_bytes(docs), TEXT_BYTES), "dk", "th")
    task = F.collect_list(F.struct("pos", "side", "gram", "core", "need")).alias("tasks")
    # the same columns wherever the texts are joined, so that their shuffle is used again
    whole = ["doc_id", "dk", "th", "bytes", "tasks"]
    usual = texts.join(tasks.filter(F.col("k") <= crowd).groupBy("dk", "th").agg(task), ["dk", "th"]).select(*whole)
    bucket = ["side", "gram", "core"]
    spans = usual.mapInArrow(_contexts, CONTEXT).repartition(*bucket).sortWithinPartitions(*bucket).mapInArrow(_matches, SPAN).union(settled)
    crowded = tasks.filter(F.col("k") > crowd)
    if crowded.limit(1).count():
        last = texts.join(crowded.groupBy("dk", "th").agg(task), ["dk", "th"]).select(*whole).mapInArrow(
            _strings, "k1 long, k2 long, dk long, th long, start long")
        twice = last.groupBy("k1", "k2").count().filter("count > 1").select("k1", "k2")
        spans = spans.union(last.join(twice, ["k1", "k2"]).select("dk", "th", "start", (F.col("start") + LENGTH).alias("stop")))
    per = spans.groupBy("dk", "th").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return texts.join(per, ["dk", "th"], "left").select("doc_id", "bytes", "spans").mapInArrow(_result, RESULT)
