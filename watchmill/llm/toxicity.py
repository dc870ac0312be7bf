"""Operator 13: toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A document has a feature for every n-gram of LOW to HIGH bytes that occurs in its words, a space standing for each
end of a word; features are hashed to 2**BITS buckets. A feature's value is its log-count ratio: how much likelier a
toxic document has it than another one, counted over a large, bounded sample of the labelled documents. Counts start at the
classes' shares, so that a feature nobody has seen has ratio 0, and a ratio is moved towards 0 by SHRINK standard
errors, so that chance alone gives a feature no say. On these values a logistic regression is fitted, in numpy, on a
smaller sample of those documents. Learning moves no text but the samples', at every size of the tables.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from watchmill.session import written

LOW, HIGH = 3, 6
BITS = 18
# what each count starts with, shared between the classes as their documents are
PRIOR = 2.0
SHRINK = 2.0
# bounds of the samples of each class: documents that the ratios are counted over, bytes of a text to learn from;
# documents that the weights are fitted on and bytes of their texts
DOCS_EACH, LONGEST = 20_000, 1 << 20
FIT_EACH, BYTES_EACH = 2000, 16 << 20
EPOCHS, BATCH, RATE, PENALTY = 20, 100, 0.02, 1e-5
LIMIT = 0.7
# bytes of a text whose n-grams are hashed at a time
PIECE = 1 << 16
_TIMES, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SPACE = 32


@functools.cache
def _scratch() -> np.ndarray:
    return np.zeros(1 << BITS, np.int64)


def _distinct(found: np.ndarray) -> np.ndarray:
    """Each value once, without sorting: of equal ones the one that wrote last stays."""
    last, at = _scratch(), np.arange(len(found))
    last[found] = at
    return found[last[found] == at]


def _hashed(piece: bytes) -> np.ndarray:
    codes = np.frombuffer(piece, np.uint8)
    spaces = np.cumsum(codes == _SPACE)
    letters = codes.astype(np.uint64)
    grams, out = letters, []
    for n in range(2, HIGH + 1):
        if len(letters) < n:
            break
        grams = grams[:-1] * _TIMES + letters[n - 1 :]
        if n >= LOW:
            inside = spaces[n - 2 : len(spaces) - 1] == spaces[: len(spaces) - n + 1]  # no space but at the ends
            kept = (grams[inside] ^ (grams[inside] >> np.uint64(31))) * _SPREAD
            out.append((kept >> np.uint64(64 - BITS)).astype(np.int64))
    return _distinct(np.concatenate(out)) if out else np.zeros(0, np.int64)


def features(text: bytes | None) -> np.ndarray:
    """Buckets of the n-grams in a whole text, each once. No words: none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    line = b" " + b" ".join(words) + b" "
    # each n-gram starts in one piece, which reaches as far as it does
    found = [_hashed(line[a : a + PIECE + HIGH - 1]) for a in range(0, len(line), PIECE)]
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def held_out() -> F.Column:
    """crc32 of the doc_id as text leaves 1 when divided by 3; false for a null doc_id, which has no label."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic, k, text`` of at most DOCS_EACH documents of each class, ``k`` their rank by a hash of the doc_id.

    Held-out documents are not among them. Of several labels of one doc_id the highest counts, of several texts the one
    with the least hash. Texts are whole; those of more than LONGEST bytes are not learned from.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    marks = marks.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    # the ranking drops all but the first of each class before it shuffles
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = marks.withColumn("k", rank).filter(F.col("k") <= DOCS_EACH)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST)
    # at most 2 x DOCS_EACH rows are broadcast
    found = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "k")
    return found.agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")).select("doc_id", "toxic", "k", "one.text")


def _counted(batches):
    """Documents of each class that have a feature; the last row, beyond all buckets, counts the documents."""
    counts = np.zeros((2, (1 << BITS) + 1), np.int64)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for text, toxic in zip(texts, batch.column("toxic").to_pylist()):
            counts[toxic][features(text.as_py())] += 1
            counts[toxic][-1] += 1
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0][at]), pa.array(counts[1][at])], names=["feature", "clean", "toxic"])


def ratios(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """Log-count ratio of every bucket over all of ``rows``, and how many documents are clean and toxic.

    Tasks count in arrays of 2**BITS buckets; what is added up and collected has a row per bucket.
    """
    found = rows.select("text", "toxic").mapInArrow(_counted, "feature long, clean long, toxic long")
    found = found.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    counts = np.zeros((2, (1 << BITS) + 1))
    counts[:, found["feature"].to_numpy(np.int64)] = found[["clean", "toxic"]].to_numpy().T
    (clean, n_clean), (toxic, n_toxic) = ((c[:-1], int(c[-1])) for c in counts)
    if not n_clean or not n_toxic:
        return np.zeros(1 << BITS), n_clean, n_toxic
    more = PRIOR * n_toxic / (n_clean + n_toxic)
    toxic, all_toxic, clean, all_clean = toxic + more, n_toxic + more, clean + PRIOR - more, n_clean + PRIOR - more
    ratio = np.log(toxic / all_toxic) - np.log(clean / all_clean)
    error = np.sqrt(1 / toxic - 1 / all_toxic + 1 / clean - 1 / all_clean)
    return np.sign(ratio) * np.maximum(0, np.abs(ratio) - SHRINK * error), n_clean, n_toxic


def _featured(wanted: np.ndarray):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows = [f[wanted[f]] for f in (np.sort(features(t.as_py())) for t in texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("toxic"), pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32()))], names=["k", "toxic", "features"])

    return run


def examples(rows: DataFrame, ratio: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Features with a say and the class, of the documents that the weights are fitted on."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    upto = F.sum("size").over(Window.partitionBy("toxic").orderBy("k"))
    light = rows.filter(F.col("k") <= FIT_EACH).select("toxic", "k", size.alias("size")).withColumn("upto", upto)
    # at most 2 x FIT_EACH rows
    chosen = light.filter(F.col("upto") <= BYTES_EACH).select("toxic", "k")
    found = rows.join(F.broadcast(chosen), ["toxic", "k"]).select("text", "toxic", "k").mapInArrow(
        _featured(ratio != 0), "k int, toxic int, features array<int>").toArrow().sort_by([("k", "ascending"), ("toxic", "ascending")])
    return [np.asarray(f.values, np.int64) for f in found.column("features")], found.column("toxic").to_numpy()


def fit(found: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights of the features, ratios included, and the constant: logistic loss with a quadratic penalty, by Adam.

    Both classes weigh alike. Without documents all weights are 0.
    """
    size = len(ratio)
    if not found:
        return np.zeros(size, np.float32), 0.0
    rng = np.random.default_rng(seed)
    # the last place is the constant, a feature that every document has
    scale = np.append(ratio, 1.0)
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    weight = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum())) * len(toxic)
    rows = [np.append(f, size) for f in found]
    step = 0
    for epoch in range(epochs):
        for part in np.array_split(rng.permutation(len(rows)), -(-len(rows) // BATCH)):
            step += 1
            at = np.concatenate([rows[i] for i in part])
            own = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            z = np.bincount(own, (w * scale)[at], len(part))
            miss = (_sigmoid(z) - toxic[part]) * weight[part] / len(part)
            grad = np.bincount(at, miss[own], size + 1) * scale + PENALTY * w
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            w -= RATE * (1 - epoch / epochs) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return (w * scale)[:-1].astype(np.float32), float(w[-1])


def _sigmoid(z):
    return 0.5 * (np.tanh(0.5 * z) + 1)


def learn(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The fitted weights and constant.

    With labels of one class only, every text gets that class; without any, all are clean.
    """
    rows = written(sample(docs, labels), "labelled")
    ratio, n_clean, n_toxic = ratios(rows)
    if not n_clean or not n_toxic:
        return np.zeros(1 << BITS, np.float32), 20.0 if n_toxic else -20.0
    return fit(*examples(rows, ratio), ratio)


def _scored(model: tuple[np.ndarray, float]):
    def run(batches):
        weights, constant = model
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            z = np.array([weights[features(t.as_py())].sum(dtype=float) for t in texts]) + constant
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_sigmoid(z), pa.float64())], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, float], limit: float = LIMIT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``; only texts are read.

    Null, empty and blank texts have no features and get the constant's score. Equal texts score alike; repeated rows
    and missing doc_ids stay; other columns are ignored. Empty table: no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_scored(model), "doc_id long, score double")
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
