import random
import re

import numpy as np
import xxhash

from tests.llm.conftest import DOCS, words
from watchmill.llm import simhash
from watchmill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    ws = WORD.findall((text or "").translate(LOWER))
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 3]), 42) for i in range(max(1, len(ws) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    """(doc_id, fingerprint, smallest doc_id reachable) with links at 2 bits or fewer."""
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 2:
                    root[i] = root[j] = min(root[i], root[j])
    least = {}
    for (doc, _), r in zip(rows, root):
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return sorted(((d, format(f, "016x"), least[r]) for (d, _), f, r in zip(rows, fps, root)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(odd_docs):
    assert rows_of(simhash.near_duplicates(odd_docs)) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_near_copies(spark):
    rng = random.Random(4)
    rows = []
    for i in range(12):
        base = words(150, i).split()
        for k in range(4):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(150)] = f"new{rng.random()}"
            rows.append((100 - len(rows), " ".join(copy)))
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS)
    got = rows_of(simhash.near_duplicates(docs))
    assert got == brute(rows) and len({c for _, _, c in got}) < 48
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in got})


def test_links_meet_in_the_middle(spark):
    """Every pair within 2 bits is connected, the sign bit included, and no pair beyond."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 30, np.uint64)
    flips = [np.uint64(0), *(np.uint64(1) << rng.integers(0, 64, 6).astype(np.uint64))]
    values = np.unique(np.concatenate([base ^ a ^ b for a in flips for b in flips])).view(np.int64)
    df = spark.createDataFrame([(int(v),) for v in values], "fp long")
    pairs = [(r.u, r.v) for r in simhash.links(df).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in pairs)

    def groups(edges):
        root = {int(v): int(v) for v in values}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            root[top(a)] = top(b)
        return {frozenset(x for x in root if top(x) == t) for t in map(top, list(root))}

    unsigned = values.view(np.uint64)
    want = [(int(values[i]), int(values[j])) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(unsigned ^ unsigned[i]) <= 2)]
    assert groups(pairs) == groups(want)


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(1, 200)]
    hub = [(1000, 1001 + i) for i in range(300)]
    df = spark.createDataFrame([*path, *hub, (5, 5), (None, 3)], "u long, v long")
    got = {r.id: r.component for r in components(df).collect()}
    assert got == {i: 1 for i in range(1, 201)} | {i: 1000 for i in range(1000, 1301)}


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.one_of_each(no_docs).collect() == []


def test_rows_without_or_with_one_doc_id(spark):
    """Each group keeps one row, whatever the doc_ids are."""
    a, b, c = words(50, 1), words(50, 2), words(50, 3)
    rows = [(None, a), (None, a), (None, b), (7, b), (7, c), (7, c), (None, None)]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS)
    assert sorted(map(str, [(r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()])) == sorted(map(str, [(None, a), (7, b), (7, c), (None, None)]))
