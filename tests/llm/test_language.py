import zlib

import numpy as np
import pytest

from tests.llm.conftest import CLASHES, DOCS
from watchmill.llm import language
from watchmill.llm.language import ByteGRU, Labeller

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def net(given):
    return language.learn(given, steps=400)


def test_gradients():
    net = ByteGRU(["a", "b", "c"], hidden=4, seed=3)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    rng = np.random.default_rng(1)
    codes, labels = rng.integers(97, 103, (5, 4)).astype(np.uint8), rng.integers(0, 3, 5)

    def loss():
        return -np.log(net._run(codes)[1][np.arange(5), :, labels]).mean()

    grads = net.step(codes, labels)
    for name, values in net.p.items():
        at = (int(codes[0, 1]), 2) if name.startswith("w") else tuple(int(rng.integers(0, n)) for n in values.shape)
        old = values[at]
        values[at] = old + 1e-4
        up = loss()
        values[at] = old - 1e-4
        down = loss()
        values[at] = old
        assert grads[name][at] == pytest.approx((up - down) / 2e-4, abs=1e-6)


def test_held_out_accuracy(given, net):
    true = {r.doc_id: r.lang for r in given.collect()}
    got = language.identify(given, net).collect()
    assert len(got) == given.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    kept_back = [r.lang_pred == true[r.doc_id] for r in got if r.held_out]
    assert len(kept_back) > 30 and sum(kept_back) >= 0.97 * len(kept_back)


def test_learns_from_nothing_held_out(spark, given):
    changed = given.withColumn("lang", language.F.when(language.held_out(), language.F.lit("xx")).otherwise(language.F.col("lang")))
    assert sorted(map(tuple, language.sample(changed).collect())) == sorted(map(tuple, language.sample(given).collect()))


def test_every_byte_counts_once(net):
    """The pooled probabilities are the mean over all bytes, whatever is remembered and however texts are grouped."""
    texts = ["Der eine und the other " * 3, "x" * 100, "kurz " + "y" * 70]
    alone = np.concatenate([Labeller(net).probabilities([t]) for t in texts])
    assert np.allclose(alone, Labeller(net).probabilities(texts), atol=1e-5)
    for text, probs in zip(texts, alone):
        parts = [w[a : a + language.LONGEST] for w in text.encode().split() for a in range(0, len(w), language.LONGEST)]
        assert np.allclose(probs, net.sums(parts).sum(axis=0) / sum(map(len, parts)), atol=1e-5) and probs.sum() == pytest.approx(1, abs=1e-4)


def test_odd_rows(spark, odd_docs, no_docs, net):
    got = {(r.doc_id, r.lang_pred == "und") for r in language.identify(odd_docs, net).collect()}
    assert got == {(1, False), (2, False), (3, True), (4, True), (5, True), (6, True), (7, False), (None, False), (8, False), (9, False)}
    kept = language.in_known_language(odd_docs, net)
    assert kept.columns == odd_docs.columns and set(CLASHES) <= set(kept.columns)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "2", "7", "8", "9", "None"]
    assert language.identify(no_docs, net).collect() == [] and language.learn(no_docs) is None
    unlabelled = spark.createDataFrame([(1, "some text", None, None, None), (2, "more", "en", None, None)], DOCS).filter("lang IS NULL")
    assert [r.lang_pred for r in language.identify(unlabelled, language.learn(unlabelled)).collect()] == ["und"]
