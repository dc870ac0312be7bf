"""Runs against all periods tried one by one."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import DOCS
from watchmill.llm import periodic


def brute_runs(w, least=6):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(4 * q, least):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def changed(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def brute(doc_id, text):
    w = changed(doc_id, (text or "").encode().split())
    runs = brute_runs(w)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(top and (*top, 1000 * top[1] // top[2]) or (None,) * 4),
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def run(df):
    from pyspark.sql import functions as F

    text = periodic.made_periodic(F.col("text"), F.col("doc_id"))
    return sorted(map(str, map(tuple, periodic.digests(periodic.periodic_runs(df, text)).collect())))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.integers(1, 9)), max_size=6))
def test_repeated_pieces(pieces):
    w = [x for piece, times in pieces for x in piece * times]
    assert [r for r in periodic.find_runs(np.array(w, np.int64)) if r[1] >= 6] == sorted(brute_runs(w), key=lambda r: (r[0], r[0] + r[1]))


def test_long_periods_and_overlaps():
    """Periods up to 300 words, runs that touch, runs inside runs, many texts at once."""
    rng = random.Random(3)
    texts = []
    for p in (3, 4, 5, 7, 8, 15, 16, 17, 31, 64, 127, 300):
        one = [rng.randrange(3 if p % 2 else 400) for _ in range(p)]
        w = (one * 5)[: 4 * p + rng.randrange(p)]
        texts.append([rng.randrange(2) for _ in range(20)] + w + one[:2] + w[:p] * 4 + [7] * 9 + w)
    want = [brute_runs(w) for w in texts]
    assert periodic.runs_of([[b"%d" % x for x in w] for w in texts]) == want and all(want)


def test_synchronising_sets_are_consistent_and_dense():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 3000)
    for scale in (4, 8, 32):
        windows = np.array([hash(codes[i : i + scale].tobytes()) % (1 << 63) for i in range(len(codes) - scale + 1)], np.uint64)
        at = periodic.synchronising(windows, scale, np.zeros(len(windows), bool))
        inside = set(at.tolist())
        last = len(codes) - 2 * scale + 1
        chosen = {}
        for i in range(last):
            assert chosen.setdefault(codes[i : i + 2 * scale].tobytes(), i in inside) == (i in inside)
        assert max(np.diff(at)) <= scale and len(at) < 4 * len(codes) / scale


def test_nothing_crosses_documents():
    assert periodic.runs_of([[b"a"] * 5, [b"a"] * 5, [b"a"] * 6]) == [[], [], [(0, 6, 1)]]


def test_documents_changed_and_not(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        w = [f"w{rng.randrange(30)}" for _ in range(rng.choice([0, 1, 5, 40, 300]))]
        rows.append((i, " \t".join(w) if i % 2 else "\n".join(w * 5), "en", "s", 0))
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)
    assert run(spark.createDataFrame(rows, DOCS)) == sorted(str(brute(r[0], r[1])) for r in rows)


def test_odd_rows(odd_docs):
    assert run(odd_docs) == sorted(str(brute(r.doc_id, r.text)) for r in odd_docs.collect())


def test_long_runs_of_one_word(spark):
    rows = [(1, "a " * 100_000, "en", "s", 0), (2, "a b c d e " * 20_000, "en", "s", 0)]
    got = periodic.periodic_runs(spark.createDataFrame(rows, DOCS)).collect()
    assert [(r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [(100_000, [(0, 100_000, 1)], "a"), (100_000, [(0, 100_000, 5)], "a b c d e")]


def test_empty(no_docs):
    assert run(no_docs) == [] and math.isfinite(len(periodic.periodic_runs(no_docs).columns))


@pytest.mark.parametrize("words", [[], [b"a"], [b"a"] * 5, [b"a", b"b"] * 3])
def test_too_short(words):
    assert periodic.runs_of([words]) == [[]]
