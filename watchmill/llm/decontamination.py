"""Operator 8: training passages that give benchmark items away.

Benchmark items form a BM25 inverted index in shards of bounded size; items lie in blocks and each term knows its
greatest impact in each block. Every passage of every document, 2 x STRIDE words with a step of STRIDE, is a query: a
block whose summed greatest impacts stay below the lowest score wanted in it is skipped, as WAND's pivot would skip it;
in the rest every item is scored. Blocks are bounded for many passages at once, in numpy. An item is retrieved at
RETRIEVE of the score that its own text would get, then verified: shares of the question's five-word shingles and of the
answer's words that the passage holds.
"""

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from watchmill.session import written

K1, B = 1.2, 0.75
RETRIEVE, VERIFY = 0.5, 0.8
SHINGLE = 5
# words of a part of an item; a longer item is indexed in several parts
PART_WORDS = 256
SHARD_PARTS, BLOCK_ITEMS = 1024, 4
WORDS = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def question_words(text: str) -> int:
    """Words before the answer. The answer is the last sentence; without two sentences, or with a question of less
    than five words, all is question."""
    parts = [p for p in SENTENCE.split(text.strip()) if words_of(p)]
    n = len(words_of(text))
    asked = n - len(words_of(parts[-1])) if len(parts) > 1 else n
    return asked if asked >= SHINGLE else n


def shingles(words: list[str]) -> list[tuple[str, ...]]:
    """Five words each; fewer words: the whole sequence."""
    return [tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))] if words else []


def _parts(batches):
    for batch in batches:
        rows = []
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text or "")
            asked = question_words(text or "")
            n = -(-len(words) // PART_WORDS)
            for p in range(n):
                part = words[p * PART_WORDS : (p + 1) * PART_WORDS]
                rows.append((item, p, n, max(0, min(len(part), asked - p * PART_WORDS)), part))
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["item_id", "part", "parts", "asked", "words"])


class Index:
    """BM25 postings of one shard, as a matrix of impacts of terms (rows) on items, and its maxima by block."""

    def __init__(self, parts: list[tuple], df: dict[str, int], total: int, mean: float, retrieve: float = RETRIEVE, verify: float = VERIFY):
        self.verify = verify
        self.terms = {t: i for i, t in enumerate(sorted({w for p in parts for w in p[4]}))}
        idf = np.array([np.log(1 + (total - df[t] + 0.5) / (df[t] + 0.5)) for t in self.terms], np.float32)
        own = []
        for p in parts:
            ids, counts = np.unique([self.terms[w] for w in p[4]], return_counts=True)
            own.append((ids, idf[ids] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(p[4]) / mean))))
        # items of like scores share a block, so that its lowest wanted score says much
        order = sorted(range(len(parts)), key=lambda i: (float(own[i][1].sum()), parts[i][:2]))
        self.parts = [parts[i] for i in order]
        self.wanted = np.array([own[i][1].sum() * retrieve for i in order], np.float32)
        self.width = BLOCK_ITEMS
        n_blocks = -(-len(parts) // self.width)
        impact = np.zeros((len(self.terms), n_blocks * self.width), np.float32)
        for k, i in enumerate(order):
            impact[own[i][0], k] = own[i][1]
        self.blocks = impact.reshape(len(self.terms), n_blocks, self.width)
        self.most = self.blocks.max(axis=2)
        # places past the last item are never wanted
        self.wanted_in = np.append(self.wanted, np.full(n_blocks * self.width - len(parts), np.inf, np.float32)).reshape(n_blocks, self.width)
        self.least = self.wanted_in.min(axis=1)
        self.stride = max(len(p[4]) for p in parts)
        self.shingles = [self._grouped(p) for p in self.parts]

    @staticmethod
    def _grouped(part) -> tuple[list, list]:
        asked = part[4][: part[3]]
        return shingles(asked), part[4][part[3] :]

    def candidates(self, ids: np.ndarray, owner: np.ndarray, n_docs: int):
        """``ids``: index terms of the words of several documents (-1: none); ``owner``: document of each word.

        Yields (document, first word, past the last, item) for every passage and item at its wanted score.
        """
        sizes = np.bincount(owner, minlength=n_docs)
        starts = np.cumsum(sizes) - sizes
        steps = -(-sizes // self.stride)
        passages = np.maximum(steps - 1, np.minimum(steps, 1))
        first = np.cumsum(passages) - passages
        # a passage is a stretch of ``stride`` words and the next one of the same document
        stretch = (np.arange(len(ids)) - starts[owner]) // self.stride
        ahead = (ids >= 0) & (stretch < passages[owner])
        behind = (ids >= 0) & (stretch >= 1)
        n_terms = max(1, len(self.terms))
        pairs = np.unique(np.concatenate([
            (first[owner[ahead]] + stretch[ahead]) * n_terms + ids[ahead], (first[owner[behind]] + stretch[behind] - 1) * n_terms + ids[behind]]))
        of, term = pairs // n_terms, pairs % n_terms
        present, at = np.unique(of, return_index=True)
        sizes_of = np.diff(at, append=len(of))
        for a in range(0, len(present), 1024):
            cuts, stop = at[a : a + 1024], at[a + 1024] if a + 1024 < len(at) else len(term)
            bounds = np.add.reduceat(self.most[term[cuts[0] : stop]], cuts - cuts[0], axis=0)
            row, block = np.nonzero(bounds >= self.least * (1 - 1e-5))
            for b in range(0, len(row), 1024):
                r, k = row[b : b + 1024] + a, block[b : b + 1024]
                n = sizes_of[r]
                ends = np.cumsum(n)
                flat = np.repeat(at[r] - (ends - n), n) + np.arange(ends[-1])
                scores = np.add.reduceat(self.blocks[term[flat], np.repeat(k, n)], ends - n, axis=0)
                for x, y in zip(*np.nonzero(scores >= self.wanted_in[k] * (1 - 1e-5))):
                    passage = int(present[r[x]])
                    doc = int(np.searchsorted(first + passages, passage, side="right"))
                    begin = int(starts[doc] + (passage - first[doc]) * self.stride)
                    end = int(min(begin + 2 * self.stride, starts[doc] + sizes[doc]))
                    yield doc, begin, end, int(k[x] * self.width + y), float(scores[x, y])

    def overlaps(self, item: int, words: list[str]) -> tuple[float, float]:
        """Shares of the question's shingles and of the answer's words in a passage; 1 for a part that is empty."""
        asked, answer = self.shingles[item]
        held = set(shingles(words)) if words else set()
        if asked and len(asked[0]) < SHINGLE:
            k = len(asked[0])
            held = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
        left = {}
        for w in words:
            left[w] = left.get(w, 0) + 1
        found = 0
        for w in answer:
            if left.get(w, 0):
                left[w] -= 1
                found += 1
        return (sum(s in held for s in asked) / len(asked) if asked else 1.0), (found / len(answer) if answer else 1.0)


HIT = "doc_id long, item_id long, part int, parts int, score double, question double, answer double"


def _search(index: Index):
    def run(batches):
        get = index.terms.get
        for batch in batches:
            for a in range(0, len(batch), 64):
                part = batch.slice(a, 64)
                texts = [words_of(t or "") for t in part.column("text").to_pylist()]
                numbers = part.column("doc_id").to_pylist()
                ids = np.fromiter(map(get, chain.from_iterable(texts), repeat(-1)), np.int64)
                owner = np.repeat(np.arange(len(texts)), [len(ws) for ws in texts])
                starts = np.cumsum([0, *map(len, texts)])
                best = {}
                for doc, begin, end, item, score in index.candidates(ids, owner, len(texts)):
                    asked, answered = index.overlaps(item, texts[doc][begin - starts[doc] : end - starts[doc]])
                    if min(asked, answered) >= index.verify:
                        key = doc, item
                        best[key] = max(best.get(key, (0, 0, 0)), (score, asked, answered))
                rows = [(numbers[d], *index.parts[i][:3], *found) for (d, i), found in best.items()]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "item_id", "part", "parts", "score", "question", "answer"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, retrieve: float = RETRIEVE, verify: float = VERIFY) -> DataFrame:
    """``doc_id, item_id, score, question, answer`` for every document and item that it gives away.

    ``score`` is the best passage's BM25 score, the other two its shares of the question's shingles and the answer's
    words, both at least ``verify``. An item of several parts needs that share of its parts. Null or empty texts and
    items match nothing; repeated items or rows count once per id. Other columns are ignored. No items, no rows.

    Documents are read once per shard of SHARD_PARTS item parts, and a task holds one shard; this bounds memory by
    constants, and work grows with documents times shards.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    parts = items.distinct().mapInArrow(_parts, "item_id long, part int, parts int, asked int, words array<string>")
    parts = written(parts.withColumn("key", F.xxhash64("item_id", "part", "words")), "parts")
    total, mean = parts.agg(F.count("*"), F.avg(F.size("words"))).first()
    shards = -(-total // (SHARD_PARTS * 3 // 4)) if total > SHARD_PARTS else min(1, total)
    terms = written(parts.select("key", F.explode(F.array_distinct("words")).alias("term")), "terms")
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    found = None
    for shard in range(shards):
        chosen = F.pmod("key", F.lit(shards)) == shard
        # about SHARD_PARTS parts of at most PART_WORDS words
        here = [tuple(r) for r in parts.filter(chosen).select("item_id", "part", "parts", "asked", "words").collect()]
        if not here:
            continue
        known = dict(map(tuple, terms.filter(chosen).select("term").distinct().join(df, "term").collect()))
        hits = rows.mapInArrow(_search(Index(here, known, total, mean, retrieve, verify)), HIT)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, question double, answer double")
    per = found.groupBy("doc_id", "item_id", "part").agg(
        F.max("parts").alias("parts"), F.max("score").alias("score"), F.max("question").alias("question"), F.max("answer").alias("answer"))
    whole = per.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n"), F.max("parts").alias("parts"), F.sum("score").alias("score"), F.min("question").alias("question"), F.min("answer").alias("answer"))
    return whole.filter(F.col("n") >= F.col("parts") * verify).select("doc_id", "item_id", "score", "question", "answer")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that give no item away; a null doc_id is compared like any other."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
