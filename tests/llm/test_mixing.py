import re

import pytest

from tests.llm.conftest import DOCS, words
from watchmill.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        left, open_ = total - sum(capped.values()), [s for s in names if s not in capped]
        aim = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if aim[s] > 2 * sizes[s]]
        if not over:
            return aim | capped
        capped |= {s: 2.0 * sizes[s] for s in over}


@pytest.fixture(scope="module")
def many(spark):
    rows = [(i, words(i % 37, i % 5), "en", [None, "b", "a", "ü", "Z"][i % 5] if i % 3 else "a", 0) for i in range(2000)]
    return spark.createDataFrame(rows, DOCS)


def test_targets_rates_and_reruns(many):
    got = mixing.mix(many).collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s, t in taken.items():
        assert abs(t - want[s]) <= 40
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(many.repartition(5)).collect()))


def test_rates_are_exponentially_tilted(many):
    """The multiplier is one per source: log rate over size is the same for all documents below the cap."""
    import math

    tilt = {}
    for r in mixing.mix(many).filter("size > 0 AND rate < 1.999").collect():
        tilt.setdefault(r.source, set()).add(round(math.log(r.rate) / r.size, 7))
    assert tilt and all(len(v) == 1 for v in tilt.values())


def test_odd_rows(odd_docs):
    got = mixing.mix(odd_docs).collect()
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t in texts)


def test_mixed_documents_repeat_whole_rows(odd_docs, many):
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    plan = {r.doc_id: r.copies for r in mixing.mix(many).collect()}
    count = {r.doc_id: r["count"] for r in mixing.mixed_documents(many).groupBy("doc_id").count().collect()}
    assert count == {i: n for i, n in plan.items() if n}


def test_copies_of_rows_that_share_a_number(spark):
    """No or one doc_id for all: the mixture has exactly the words that the plan takes."""
    for number in (None, 5):
        rows = [(number, words(300, i), "en", "ab"[i % 2], 0) for i in range(400)]
        df = spark.createDataFrame(rows, DOCS)
        plan = {(r.doc_id, r.source): r.n for r in mixing.mix(df).groupBy("doc_id", "source").agg({"copies": "sum"}).toDF("doc_id", "source", "n").collect()}
        got = mixing.mixed_documents(df)
        assert {(r.doc_id, r.source): r["count"] for r in got.groupBy("doc_id", "source").count().collect()} == plan
        per = {r.text: r["count"] for r in got.groupBy("text").count().collect()}
        for s in "ab":
            each = [per.get(r[1], 0) for r in rows if r[3] == s]
            assert max(each) - min(each) <= 1
        assert got.columns == df.columns


def test_empty(no_docs):
    assert mixing.mix(no_docs).collect() == [] and mixing.mixed_documents(no_docs).collect() == []
