import random

from tests.llm.conftest import DOCS
from watchmill.llm import decontamination as D


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 7))) for _ in range(n)).capitalize() + "."


def fixture(spark, rng):
    items = [(i, f"{sentence(rng, rng.randint(8, 25))} {sentence(rng, rng.randint(4, 9))}") for i in range(12)]
    items += [(20, " ".join(sentence(rng, 12) for _ in range(60))), (21, "Two words"), (22, None), (23, ""), (24, sentence(rng, 9))]
    fill = lambda n: sentence(rng, n)
    docs = []
    for i, (item, text) in enumerate(items):
        text = text or ""
        docs.append((3 * i, f"{fill(rng.randint(0, 200))} {text} {fill(rng.randint(1, 90))}"))
        docs.append((3 * i + 1, f"{fill(40)} {' '.join(text.split()[: len(text.split()) // 2])} {fill(40)}"))
        docs.append((3 * i + 2, f"{fill(70)}\n{text.upper().replace(' ', chr(10))}! {fill(100)}"))
    docs += [(900, None), (901, ""), (902, fill(400)), (None, f"{fill(5)} {items[3][1]}"), (0, docs[0][1])]
    return (items, docs, spark.createDataFrame(items, "item_id long, text string"),
            spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS))


def brute(items, docs):
    """Every item against all windows of a document in which it could lie; both overlaps, without an index."""
    out = set()
    for item, text in items:
        ws, asked = D.words_of(text or ""), D.question_words(text or "")
        question, answer = D.shingles(ws[:asked]), ws[asked:]
        for doc, body in docs:
            have = D.words_of(body or "")
            size = len(question[0]) if question else 0
            held = {tuple(have[i : i + size]) for i in range(len(have) - size + 1)}
            if ws and sum(q in held for q in question) >= 0.8 * len(question) and sum(w in have for w in answer) >= 0.8 * len(answer):
                out.add((doc, item))
    return out


def test_against_brute_force(spark):
    items, docs, bench, table = fixture(spark, random.Random(2))
    got = D.leaks(table, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute(items, docs)
    bad = {d for d, _ in brute(items, docs)}
    kept = D.without_leaks(table, bench)
    assert kept.columns == table.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


def test_shards_agree(spark, monkeypatch):
    items, docs, bench, table = fixture(spark, random.Random(3))
    monkeypatch.setattr(D, "SHARD_PARTS", 6)
    monkeypatch.setattr(D, "BLOCK_ITEMS", 2)
    assert {(r.doc_id, r.item_id) for r in D.leaks(table, bench).collect()} == brute(items, docs)


def test_blocks_skip_nothing_wanted():
    """Bounds by blocks give the same passages as scoring every item."""
    import numpy as np

    rng = random.Random(5)
    parts = [(i, 0, 1, 8, D.words_of(sentence(rng, rng.randint(6, 20)))) for i in range(40)]
    df = {}
    for p in parts:
        for w in set(p[4]):
            df[w] = df.get(w, 0) + 1
    index = D.Index(parts, df, 40, 12.0)
    pool = [w for p in parts for w in p[4]]
    docs = [[rng.choice(pool) for _ in range(rng.randint(0, 150))] + rng.sample(p[4], len(p[4]) * 2 // 3) + [rng.choice(pool) for _ in range(rng.randint(0, 60))] for p in parts[:30]]
    ids = np.array([index.terms.get(w, -1) for d in docs for w in d])
    got = {(d, b - sum(map(len, docs[:d])), i) for d, b, _, i, _ in index.candidates(ids, np.repeat(np.arange(30), [len(d) for d in docs]), 30)}
    flat = index.blocks.reshape(len(index.terms), -1)[:, :40]
    want = set()
    for d, ws in enumerate(docs):
        for b in range(0, max(1, len(ws)), index.stride):
            if b and b + index.stride >= len(ws) + index.stride:
                continue
            if b and len(ws) - b <= 0 or b and -(-len(ws) // index.stride) - 1 <= b // index.stride:
                continue
            score = flat[sorted({index.terms[w] for w in ws[b : b + 2 * index.stride]})].sum(axis=0)
            want |= {(d, b, int(i)) for i in np.flatnonzero(score >= index.wanted)}
    assert got == want and got


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "The first text of all, with a few more words."), (1, "The first text of all, with a few more words."), (None, None)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in D.leaks(odd_docs, bench).collect()) == [(1, 1), (2, 1)]
    assert D.without_leaks(odd_docs, bench).columns == odd_docs.columns
    assert D.leaks(no_docs, bench).collect() == [] and D.leaks(odd_docs, bench.limit(0)).collect() == []
