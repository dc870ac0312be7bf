import math
from collections import Counter

import pytest

from tests.llm.conftest import DOCS
from watchmill.llm import backoff


def brute(rows, order, alpha=0.4):
    docs = [(t or "").lower().split() for _, t in rows]
    grams = [[Counter(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) for n in range(1, order + 1)] for ws in docs]
    totals = [sum((g[n] for g in grams), Counter()) for n in range(order)]
    all_words = sum(map(len, docs))
    out = []
    for (doc, _), ws, own in zip(rows, docs, grams):
        left = lambda g: totals[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: B023, E731
        score, single, unknown = 0.0, 0, 0
        for i, w in enumerate(ws):
            for n in range(order, 0, -1):
                g = tuple(ws[i - n + 1 : i + 1])
                if n == 1:
                    c = left((w,))
                    score += math.log((c or 1) / max(1, all_words - len(ws))) + (order - 1) * math.log(alpha)
                    single, unknown = single + 1, unknown + (c == 0)
                elif i >= n - 1 and left(g) and left(g[:-1]):
                    score += math.log(left(g) / left(g[:-1])) + (order - n) * math.log(alpha)
                    break
        out.append((doc, len(ws), single, unknown, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("order,chunk", [(1, 50), (2, 50), (3, 7), (4, 1_000_000)])
def test_scores(spark, monkeypatch, order, chunk):
    monkeypatch.setattr(backoff, "CHUNK_WORDS", chunk)
    texts = ["the cat sat on the mat", "the cat ate the rat", "a cat sat", "The CAT sat on\ta hat", "unique words only here", "", None, "the", "the cat sat on the mat"]
    rows = [(i if i != 4 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).repartition(3)
    got = sorted(((r.doc_id, r.n_words, r.n_single, r.n_unknown, r.log_score) for r in backoff.scores(docs, order).collect()), key=str)
    want = brute(rows, order)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])


def test_parts_agree(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 40), i -> concat('w', (id * i * 7) % 50))) AS text")
    rows = lambda: sorted((r.doc_id, r.n_single, r.n_unknown, round(r.log_score, 6)) for r in backoff.scores(docs).collect())
    one = rows()
    monkeypatch.setattr(backoff, "PART_BYTES", 5000)
    assert rows() == one


def test_odd_rows(odd_docs, no_docs):
    got = backoff.scores(odd_docs).collect()
    assert len(got) == odd_docs.count() and all((r.mean_score is None) == (r.n_words == 0) for r in got)
    assert sorted((str(r.doc_id), r.n_words) for r in got) == sorted((str(r.doc_id), len((r.text or "").split())) for r in odd_docs.collect())
    assert backoff.scores(no_docs).collect() == []


def test_counts_beyond_32_bits():
    import numpy as np

    for values in ([], [0, 1, 7], [3, 1 << 40, (1 << 32) - 1]):
        assert backoff._unpacked(backoff._small(np.array(values, np.int64))).tolist() == values


def test_a_registered_query_scores_trigrams(spark):
    import __spark_entry__

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(map(tuple, __spark_entry__.queries()["op4_backoff_order3"](spark, folder).collect()), key=str)
    want = brute(rows, 3)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], abs=1e-4)
