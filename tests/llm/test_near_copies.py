import random

import numpy as np

from tests.llm.conftest import DOCS, words
from watchmill.llm import near_copies, simhash
import corpus_pipeline


def sets(text, n=5):
    ws = (text or "").lower().split()
    return {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))}


def brute(rows, least=0.8):
    """Smallest doc_id of each group that pairs of at least that similarity connect."""
    found = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(found):
        for j in range(i):
            if len(a & found[j]) >= least * len(a | found[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc)
    return sorted(min(g) for g in groups.values())


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS)


def test_edited_copies_go(spark):
    """Up to 12 of 300 words changed: many bits apart, but above 0.8 up to about six changes."""
    rng = random.Random(7)
    rows = []
    for i in range(15):
        base = words(300, i).split()
        for k in (0, 3, 5, 6, 12):
            copy = list(base)
            for at in rng.sample(range(300), k):
                copy[at] = f"new{rng.random()}"
            rows.append((1000 - len(rows), " ".join(copy)))
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame(spark, rows), "").collect())
    assert got == brute(rows) and len(got) < 45


def test_chains_and_pairs_beside_the_first(spark):
    """Windows over one long text: neighbours are similar, ends are not; all are connected."""
    long = words(500, 1).split()
    rows = [(i, " ".join(long[i * 12 : i * 12 + 200])) for i in range(24)] + [(50 + i, " ".join(long[i * 60 : i * 60 + 150])) for i in range(4)]
    random.Random(3).shuffle(rows)
    got = sorted(r.doc_id for r in near_copies.one_of_each(frame(spark, rows)).collect())
    assert got == brute(rows) and 0 in got


def crowd(n, seed=5):
    """Variants of one text, near 0.8 to it and mostly below that to each other, and texts that share a long passage."""
    rng = random.Random(seed)
    base, rows = words(150, 1).split(), []
    for i in range(n):
        copy = list(base)
        for at in rng.sample(range(150), rng.choice([1, 3, 5, 7])):
            copy[at] = f"new{rng.random()}"
        rows.append((i, " ".join(copy)))
    passage = words(60, 2)
    rows += [(1000 + i, f"{words(8, 100 + i)} {passage} {words(8, 500 + i)}") for i in range(n)]
    return rows + [(2000 + i, f"{words(40, 100 + i)} {passage} {words(2, 500 + i)}") for i in range(n)]


def test_a_crowd_without_pairs(spark, monkeypatch):
    """The same groups as brute force, and joins that make rows in proportion to the members."""
    rows, made = crowd(120), []
    links = near_copies._links

    def counted(pairs, texts, least):
        made.append(pairs.count())
        return links(pairs, texts, least)

    monkeypatch.setattr(near_copies, "_links", counted)
    got = sorted(r.doc_id for r in near_copies.one_of_each(frame(spark, rows)).collect())
    assert got == brute(rows)
    assert sum(made) < 40 * len(rows)


def test_crowds_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK_ROWS", 16)
    monkeypatch.setattr(near_copies, "FEW", 0)
    rows = crowd(50, 6)
    assert sorted(r.doc_id for r in near_copies.one_of_each(frame(spark, rows)).collect()) == brute(rows)


def test_connected_equals_pairs():
    rng = np.random.default_rng(0)
    for least in (0.5, 0.8):
        sets = [np.unique(rng.integers(0, 30, rng.integers(1, 30))) for _ in range(60)]
        u, v = near_copies._connected(np.arange(60), sets, least)
        root = list(range(60))
        for a, b in sorted(zip(v.tolist(), u.tolist())):
            root[b] = root[a]
        want = list(range(60))
        for i in range(60):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if len(a & b) >= least * len(a | b) and want[i] != want[j]:
                    low, high = sorted((want[i], want[j]))
                    want = [low if w == high else w for w in want]
        assert root == want


def test_odd_rows(spark, odd_docs, no_docs):
    got = near_copies.one_of_each(odd_docs)
    assert got.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(["1", "3", "6", "7", "None", "8", "9"])
    assert near_copies.one_of_each(no_docs).collect() == []


def test_simhash_proposes_pairs(spark, monkeypatch):
    """Operator 5 takes part: its links connect what lies within 2 bits, equal fingerprints too, and are verified."""
    marks = {10: 0, 11: 0, 12: 3, 13: 2**40 + 3, 14: 2**63 - 1, 15: -1}
    rows = spark.createDataFrame([*marks.items(), (12, 3)], "sh long, fp long")
    links = {(r.u, r.v) for r in near_copies._by_simhash(rows).collect()}
    assert {(10, 11), (12, 13)} <= links and all((marks[u] % 2**64 ^ marks[v] % 2**64).bit_count() <= 2 for u, v in links)
    assert {v for pair in links for v in pair} == set(marks)
    calls, given = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda different: calls.append(1) or given(different))
    text = words(40, 1)
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, [(1, text), (2, text.upper()), (3, words(40, 2))]), "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and calls
