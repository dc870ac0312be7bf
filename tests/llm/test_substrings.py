import hashlib
import random
from collections import Counter

import pytest

from tests.llm.conftest import DOCS
from watchmill.llm import substrings


def brute(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    n = substrings.LENGTH
    seen = Counter(b[i : i + n] for _, b in texts for i in range(len(b) - n + 1))
    out = []
    for d, b in texts:
        spans = substrings.union([(i, i + n) for i in range(len(b) - n + 1) if seen[b[i : i + n]] > 1], len(b))
        kept = bytearray()
        at = 0
        for s, e in [*spans, (len(b), len(b))]:
            kept += b[at:s]
            at = e
        out.append((d, len(b), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed):
    """Passages of lengths about the limit in other surroundings, copies with edits, short periods, repeats inside."""
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdefgh éü") for _ in range(n))
    shared = [noise(n) for n in (150, 198, 199, 200, 201, 203, 260, 700)]
    out = [noise(rng.randint(0, 400)) + rng.choice(shared) + noise(rng.randint(0, 300)) for _ in range(40)]
    base = noise(3000)
    for _ in range(6):
        copy = list(base)
        for _ in range(8):
            copy[rng.randrange(3000)] = "#"
        out.append("".join(copy)[rng.randint(0, 300) :])
    out += ["a" * 199, "ab" * 150, "x" * 1000, noise(50) + shared[6] + noise(20) + shared[6], "x" * 200, "", noise(200), shared[4], shared[4]]
    return list(enumerate(out))


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_against_brute_force(spark, crowd):
    rows = texts(crowd)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).repartition(3)
    got = sorted((tuple(r)[:5] for r in substrings.repeated_bytes(docs, crowd).collect()), key=str)
    assert got == brute(rows)


def test_segments_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 500)
    rows = [(0, "".join(t for _, t in texts(9))), (1, "".join(t for _, t in texts(9))[777:9000])]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    for crowd in (20_000, 1):
        assert sorted((tuple(r)[:5] for r in substrings.repeated_bytes(docs, crowd).collect()), key=str) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    got = sorted((tuple(r)[:5] for r in substrings.repeated_bytes(odd_docs).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert substrings.repeated_bytes(no_docs).collect() == []


def test_one_doc_id_with_two_texts(spark):
    long = texts(3)[45][1]
    rows = [(1, long), (1, "other"), (2, "start " + long), (None, long[:500]), (None, "none")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    assert sorted((tuple(r)[:5] for r in substrings.repeated_bytes(docs).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("ids", [(None, None, 7), (3, 3, 7)])
def test_equal_hashes_of_texts_take_nothing_away(spark, ids):
    """Two texts with one 32-bit hash and without ids of their own: what repeats of one is not removed from the other."""
    from pyspark.sql import functions as F

    number = lambda i: F.concat(*[F.md5(F.concat(F.col(i).cast("string"), F.lit(f"-{k}"))) for k in range(10)])
    rows = spark.range(200_000).select(number("id").alias("text"))
    found = rows.groupBy(F.hash("text").alias("h")).agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a <> b").orderBy("h").first()
    rows = list(zip(ids, (found["a"], found["b"], found["a"])))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    assert sorted((tuple(r)[:5] for r in substrings.repeated_bytes(docs).collect()), key=str) == brute(rows)
