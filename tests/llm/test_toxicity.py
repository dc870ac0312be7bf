"""Features and ratios against brute force, gradients by what they reach, held-out documents, odd rows."""

import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import DOCS
from watchmill.llm import toxicity
from watchmill.llm.common import table

LABELS = "doc_id long, toxic int"


def brute_grams(text):
    out = set()
    for w in text.lower().split():
        s = b" " + w + b" "
        out |= {s[a : a + n] for n in range(toxicity.LOW, toxicity.HIGH + 1) for a in range(len(s) - n + 1)}
    return out


def bucket(gram):
    value = 0
    for c in gram:
        value = (value * int(toxicity._TIMES) + c) % (1 << 64)
    return ((value ^ (value >> 31)) * int(toxicity._SPREAD)) % (1 << 64) >> (64 - toxicity.BITS)


@pytest.mark.parametrize("text", ["", " \t\n", "a", "You IDIOT, ähnlich", "x" * 30, "one  two\nthree"])
def test_features_are_the_n_grams_of_the_words(text):
    data = text.encode()
    got = toxicity.features(data).tolist()
    assert sorted(got) == sorted({bucket(g) for g in brute_grams(data)}) and len(got) == len(set(got))


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(1)
    data = " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 12))) for _ in range(2000)).encode()
    whole = sorted(toxicity.features(data).tolist())
    for piece in (7, 50, 1000):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        assert sorted(toxicity.features(data).tolist()) == whole
    assert toxicity.features(None).tolist() == []


def corpus(n=400, seed=0):
    """Invented words; each tenth document has one of three bad ones, and its label says so."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice(["ra", "ti", "on", "el", "us", "ko"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        bad = i % 10 == 0
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["Vilezork", "blafgrim,", "QUAZNIT!"])
        docs.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, int(bad)))
    return docs, labels


def test_ratios_equal_counts(spark):
    docs, labels = corpus(120)
    rows = toxicity.sample(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(labels, LABELS))
    ratio, clean, toxic = toxicity.ratios(rows)
    learned = [(d[1], t) for d, (i, t) in zip(docs, labels) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert (clean, toxic) == (sum(t == 0 for _, t in learned), sum(t for _, t in learned))
    more = toxicity.PRIOR * toxic / (clean + toxic)
    for gram in (b"vile", b" ra", b"on ", b"nothere"):
        f = bucket(gram)
        a, c = (more * (t == 1) + (toxicity.PRIOR - more) * (t == 0) + sum(f in toxicity.features(x.encode()) for x, y in learned if y == t) for t in (1, 0))
        na, nc = toxic + more, clean + toxicity.PRIOR - more
        plain = np.log(a / na) - np.log(c / nc)
        want = np.sign(plain) * max(0, abs(plain) - toxicity.SHRINK * np.sqrt(1 / a - 1 / na + 1 / c - 1 / nc))
        assert ratio[f] == pytest.approx(want)


def test_fit_reaches_the_least_loss():
    """On few features, the fitted weights are where the loss has no slope."""
    rng = np.random.default_rng(0)
    ratio = np.array([1.5, -0.7, 0.4, 2.0])
    rows = [np.flatnonzero(rng.random(4) < 0.5) for _ in range(400)]
    toxic = np.array([int(rng.random() < 1 / (1 + np.exp(-(ratio[r].sum() - 1)))) for r in rows])
    w, b = toxicity.fit(rows, toxic, ratio, epochs=400)
    miss = np.array([1 / (1 + np.exp(-(w[r].sum() + b))) for r in rows]) - toxic
    miss *= np.where(toxic == 1, 0.5 / (toxic == 1).mean(), 0.5 / (toxic == 0).mean())
    assert abs(miss.mean()) < 0.01 and all(abs(np.mean([m * (k in r) for m, r in zip(miss, rows)])) < 0.01 for k in range(4))


def test_held_out_documents(spark):
    docs, labels = corpus()
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = {r.doc_id: r for r in toxicity.score(df, toxicity.learn(df, marks)).collect()}
    assert len(got) == len(docs)
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert all(got[i].predicted == labels[i][1] == int(got[i].score >= 0.7) for i in held)
    # their labels are not learned from
    other = spark.createDataFrame([(i, 1 - t if i in held else t) for i, t in labels], LABELS)
    again = {r.doc_id: r.score for r in toxicity.score(df, toxicity.learn(df, other)).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_given_table(spark):
    """Held-out documents of the given table; a part of its labels follows no text."""
    d = "/root/testdata/sf0.01"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    got = toxicity.score(docs, toxicity.learn(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted for r in got if r.toxic]) >= 0.7 and np.mean([r.predicted for r in got if not r.toxic]) <= 0.02


def test_order_of_rows_does_not_matter(spark):
    docs, labels = corpus(150)
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    w, b = toxicity.learn(df, marks)
    again, c = toxicity.learn(df.repartition(7), marks.repartition(3))
    assert np.array_equal(w, again) and b == c


def test_odd_rows(spark, odd_docs):
    marks = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (4, None), (None, 1), (5, 0), (7, 0), (8, 0), (9, 0), (99, 1)], LABELS)
    got = toxicity.score(odd_docs, toxicity.learn(odd_docs, marks)).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1  # null, empty, blank
    assert not any(r.held_out for r in got if r.doc_id is None)


@pytest.mark.parametrize("labels, want", [([], 0), ([(1, 0), (2, 0)], 0), ([(1, 1)], 1), ([(1, None)], 0)])
def test_nothing_or_one_class_to_learn(spark, odd_docs, labels, want):
    model = toxicity.learn(odd_docs, spark.createDataFrame(labels, LABELS))
    assert {r.predicted for r in toxicity.score(odd_docs, model).collect()} == {want}


def test_a_doc_id_repeated_very_often_is_sampled_once(spark, monkeypatch):
    docs, labels = corpus(60)
    marks = spark.createDataFrame(labels + labels[:3], LABELS)
    want = {(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    rows = spark.createDataFrame(docs + [docs[0]] * 300 + [(docs[0][0], f"t{i}", "en", "s", 0) for i in range(300)], DOCS)
    assert sorted((r.doc_id, r.toxic) for r in toxicity.sample(rows, marks).collect()) == sorted(want)
    monkeypatch.setattr(toxicity, "DOCS_EACH", 3)
    assert sorted(r.toxic for r in toxicity.sample(rows, marks).collect()) == [0, 0, 0, 1, 1, 1]


def test_bounds_of_the_fitted_documents(spark, monkeypatch):
    docs, labels = corpus(100)
    rows = toxicity.sample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).cache()
    monkeypatch.setattr(toxicity, "FIT_EACH", 4)
    found, toxic = toxicity.examples(rows, np.ones(1 << toxicity.BITS))
    assert sorted(toxic) == [0] * 4 + [1] * 4
    texts = {r.text for r in rows.collect() if r.k <= 4}
    assert sorted(map(tuple, found)) == sorted(tuple(np.sort(toxicity.features(t.encode()))) for t in texts)
    monkeypatch.setattr(toxicity, "BYTES_EACH", 1)
    assert toxicity.examples(rows, np.ones(1 << toxicity.BITS))[0] == []


def test_empty(spark, no_docs):
    assert toxicity.score(no_docs, toxicity.learn(no_docs, spark.createDataFrame([], LABELS))).collect() == []
