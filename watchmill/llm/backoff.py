"""Operator 4: Stupid-Backoff scores of every document under the n-gram counts of all the others.

Relations of n-grams, in blocks: a chunk of documents holds its words as positions in its own list of different words.
Each chunk asks for its different n-grams, once each, with its own counts; requests are cut by the leading bits of the
n-gram's 64-bit hash and shuffled to the count table of that part. The table adds the counts of all chunks up and answers
every chunk in its own order; answers and chunk meet again and scores are summed per document. As a row per n-gram the
same join moves several times the input; in blocks an n-gram costs about six bytes and no n-gram, however common, comes
more than once from a chunk. Counts leave out the document that is scored, else each n-gram would always be known.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from watchmill.llm.common import pieces, text_bytes, word_count

ORDER = 2
ALPHA = 0.4
CHUNK_WORDS = 500_000
PART_BYTES = 4 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from the hash of all but the last word and that of the last word."""
    x = (left ^ (left >> np.uint64(31))) * _MIX + right
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _planes(values: np.ndarray) -> bytes:
    """Bytes of the same weight together: the high ones are mostly zero and vanish when Spark compresses."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _small(values: np.ndarray) -> bytes:
    """Planes of numbers, of 32 bits if they fit, compressed to about their entropy; width and number come before."""
    kind = np.uint32 if not len(values) or values.max() < 1 << 32 else np.uint64
    data = _planes(values.astype(kind))
    return bytes([np.dtype(kind).itemsize]) + len(values).to_bytes(8, "little") + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def _unpacked(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    return _values(pa.decompress(data[9:], n * width, codec="zstd", asbytes=True) if n else b"", np.uint32 if width == 4 else np.uint64).astype(np.int64)


def _values(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, len(data) // width).T).view(kind).ravel()


class Chunk:
    """Documents as arrays: ``words`` (hash of each word), ``lengths`` (words per document)."""

    def __init__(self, doc_ids: list, words: np.ndarray, lengths: np.ndarray):
        self.doc_ids, self.words, self.lengths = doc_ids, words, lengths
        self.owner = np.repeat(np.arange(len(lengths)), lengths)
        starts = np.cumsum(lengths) - lengths
        self.place = np.arange(len(words)) - starts[self.owner]

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams and the positions of their last words, both in text order."""
        if order == 1:
            return self.words, np.arange(len(self.words))
        left, _ = self._ending(order - 1)
        at = np.flatnonzero(self.place >= order - 1)
        return _joined(left[at - 1], self.words[at]), at

    def _ending(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """For every position the hash of the n-gram that ends there (anything where it does not exist)."""
        full = self.words
        for n in range(2, order + 1):
            shifted = np.concatenate([full[:1], full[:-1]])
            full = np.where(self.place >= n - 1, _joined(shifted, self.words), np.uint64(0))
        return full, self.place >= order - 1

    def different(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted different hashes, their counts, the index of each n-gram among them, and its end."""
        grams, at = self.grams(order)
        keys, index, counts = np.unique(grams, return_inverse=True, return_counts=True)
        return keys, counts, index, at

    def to_row(self) -> dict:
        keys, index = np.unique(self.words, return_inverse=True)
        return {"docs": self.doc_ids, "lengths": self.lengths, "keys": _planes(np.diff(keys, prepend=np.uint64(0))), "index": _small(index), "n_words": len(self.words)}

    @classmethod
    def from_row(cls, docs, lengths, keys, index) -> "Chunk":
        return cls(docs, np.cumsum(_values(keys, np.uint64), dtype=np.uint64)[_unpacked(index)], np.asarray(lengths, np.int64))


def _chunks(batches):
    from pyspark import TaskContext
    from xxhash import xxh64_intdigest

    part = TaskContext.get().partitionId()
    known: dict[bytes, int] = {}
    docs, found, lengths, n, size = [], [], [], 0, 0

    def row():
        chunk = Chunk(docs, np.concatenate(found) if found else np.zeros(0, np.uint64), np.array(lengths, np.int64)).to_row()
        return pa.RecordBatch.from_arrays([
            pa.array([(part << 32) + n]), pa.array([chunk["n_words"]]), pa.array([chunk["docs"]], pa.list_(pa.int64())),
            pa.array([chunk["lengths"]], pa.list_(pa.int64())), pa.array([chunk["keys"]], pa.binary()), pa.array([chunk["index"]], pa.binary()),
        ], names=["chunk", "n_words", "docs", "lengths", "keys", "index"])

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            words = (text.as_py() or "").lower().encode("utf-8", "surrogatepass").split()
            if len(known) > 200_000:
                known.clear()
            for w in set(words).difference(known):
                known[w] = xxh64_intdigest(w)
            docs.append(doc)
            found.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
            lengths.append(len(words))
            size += len(words) + 1
            if size >= CHUNK_WORDS:
                yield row()
                docs, found, lengths, n, size = [], [], [], n + 1, 0
    if docs:
        yield row()


CHUNK = "chunk long, n_words long, docs array<long>, lengths array<long>, keys binary, index binary"


def _read(batch):
    for i in range(len(batch)):
        yield batch.column("chunk")[i].as_py(), Chunk.from_row(*(batch.column(c)[i].as_py() for c in ("docs", "lengths", "keys", "index")))


def _requests(order: int, bits: int):
    def run(batches):
        for batch in batches:
            for number, chunk in _read(batch):
                for n in range(1, order + 1):
                    keys, counts, _, _ = chunk.different(n)
                    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    cuts = np.flatnonzero(np.diff(part)) + 1
                    out = []
                    for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                        if a < b:
                            steps = np.diff(keys[a:b], prepend=np.uint64(0))
                            out.append((int(part[a]), n, number, _planes(steps), _planes(counts[a:b].astype(np.uint32))))
                    for a in range(0, len(out), 64):
                        columns = list(zip(*out[a : a + 64]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                            names=["part", "n", "chunk", "keys", "counts"])

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Of one part and order: counts over all chunks, for each chunk in its order."""
    keys = [np.cumsum(_values(k.as_py(), np.uint64), dtype=np.uint64) for k in table.column("keys")]
    counts = [_values(c.as_py(), np.uint32) for c in table.column("counts")]
    _, index = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(index, np.concatenate(counts)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    totals = [sums[index[e - len(k) : e]] for k, e in zip(keys, ends)]
    return pa.table({"chunk": table.column("chunk"), "n": table.column("n"), "part": table.column("part"), "totals": pa.array([_small(t) for t in totals], pa.binary())})


def _scores(chunk: Chunk, totals: dict[int, np.ndarray], all_words: int, order: int, alpha: float):
    """Per document: sum of log scores, words scored by a single word, words nobody else uses."""
    size, docs = len(chunk.words), len(chunk.lengths)
    others = {}
    for n in range(1, order + 1):
        keys, _, index, at = chunk.different(n)
        pair = chunk.owner[at] * max(1, len(keys)) + index
        _, own, times = np.unique(pair, return_inverse=True, return_counts=True)
        full = np.zeros(size, np.int64)
        full[at] = totals[n][index] - times[own]
        others[n] = full
    rest = np.maximum(1, all_words - chunk.lengths)[chunk.owner]
    known = others[1] > 0
    score = np.log(np.where(known, others[1], 1) / rest) + (order - 1) * math.log(alpha)
    level = np.ones(size, np.int64)
    for n in range(2, order + 1):
        below = np.concatenate([[0], others[n - 1][:-1]]) if size else others[n - 1]
        seen = (chunk.place >= n - 1) & (others[n] > 0) & (below > 0)
        ratio = np.log(np.where(seen, others[n], 1) / np.where(seen, below, 1)) + (order - n) * math.log(alpha)
        score, level = np.where(seen, ratio, score), np.where(seen, n, level)
    add = lambda x: np.bincount(chunk.owner, x, docs)
    return add(score), add(level == 1).astype(np.int64), add(~known).astype(np.int64)


def _score(order: int, alpha: float, all_words: int):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        for row in chunks.to_batches():
            for _, chunk in _read(row):
                found = answers.sort_by([("n", "ascending"), ("part", "ascending")])
                numbers, blobs = found.column("n").to_pylist(), found.column("totals").to_pylist()
                totals = {n: np.concatenate([np.zeros(0, np.int64), *(_unpacked(b) for m, b in zip(numbers, blobs) if m == n)]) for n in range(1, order + 1)}
                for column, values in zip(out, (chunk.doc_ids, chunk.lengths, *_scores(chunk, totals, all_words, order, alpha))):
                    column.extend(values)
        return pa.table({
            "doc_id": pa.array(out[0], pa.int64()), "n_words": pa.array(out[1], pa.int64()), "log_score": pa.array(out[2], pa.float64()),
            "n_single": pa.array(out[3], pa.int64()), "n_unknown": pa.array(out[4], pa.int64())})

    return run


def scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """``doc_id, n_words, log_score, mean_score, n_single, n_unknown`` for every row of ``docs``.

    A word after its predecessors scores count(n-gram) / count(its beginning), both without this document; if either
    is 0, ``alpha`` times the score one order lower; a word nobody else uses scores as one in all others' words. Words
    are cut at ASCII white space, in lower case; sentences are not marked. ``n_single``: words scored by themselves
    alone. Null and blank texts: no words, score 0, null mean. A repeated row is another document. Empty: no rows.
    """
    bits = (pieces(text_bytes(docs), PART_BYTES) - 1).bit_length()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    all_words = docs.agg(F.sum(word_count("text"))).first()[0] or 0
    # chunks are dealt out once; requests are made of them where they lie, and answers come to them
    chunks = rows.mapInArrow(_chunks, CHUNK).repartition(pieces(all_words, CHUNK_WORDS * 4), "chunk")
    requests = chunks.mapInArrow(_requests(order, bits), "part long, n long, chunk long, keys binary, counts binary")
    answers = requests.groupBy("part", "n").applyInArrow(_answer, "chunk long, n long, part long, totals binary")
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(order, alpha, all_words), "doc_id long, n_words long, log_score double, n_single long, n_unknown long")
    return scored.withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
