import math

import numpy as np
import pytest

from watchmill.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    def unit(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float32).astype(float)
        return x / np.sqrt((x * x).sum())

    units = [unit(v) if label is not None else None for _, v, label in rows]
    n = len(rows)
    linked = [[i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
               and float(units[i] @ units[j]) >= E.LEAST_COSINE for j in range(n)] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in range(n):
                if linked[i][j]:
                    root[i] = root[j] = min(root[i], root[j])
    least = {}
    for (v, _, _), r in zip(rows, root):
        least[r] = min((x for x in (least.get(r), v) if x is not None), default=None)
    return sorted(((v, sum(linked[i]), least[root[i]], v is not None and v == least[root[i]]) for i, (v, _, _) in enumerate(rows)), key=str)


def found(spark, rows):
    return sorted((tuple(r) for r in E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def clusters(n, dim, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        base = rng.normal(size=dim)
        for _ in range(rng.integers(1, 6)):
            v = base + rng.normal(size=dim) * np.linalg.norm(base) / math.sqrt(dim) * rng.choice([0.02, 0.1, 0.19])
            rows.append((1000 - len(rows), [float(x) for x in v.astype(np.float32)], int(c % 3)))
    return rows


@pytest.mark.parametrize("block", [512, 2])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    rows = clusters(15, 16, 1)
    rows += [(5000 + i, rows[0][1], 0) for i in range(4)] + [(6000, rows[0][1], 1), (6001, [2 * x for x in rows[1][1]], rows[1][2])]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 3.0], 1), (7, [1.0, float("nan"), 3.0], 1),
            (8, [1.0, float("inf"), 3.0], 1), (9, [1.0, 2.0], 1), (10, v, 1), (10, v, 1), (None, v, 1), (11, [3.0], 1), (12, [5.0], 1), (13, [-5.0], 1)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [r for r in rows if r[0] in (3, 4)]) == [(3, 0, 3, True), (4, 0, 4, True)]
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_extra_columns(spark):
    df = spark.createDataFrame(clusters(4, 8, 2), SCHEMA)
    odd = df.selectExpr("*", "1 AS v", "2 AS n", "3 AS cid", "4 AS codes", "5 AS part")
    rows = lambda d: sorted(map(tuple, E.near_duplicates(d).collect()))
    assert rows(odd) == rows(df)


def test_rotation_is_orthogonal():
    x = np.random.default_rng(0).normal(size=(3, 32))
    y = E.hadamard(x) / math.sqrt(32)
    assert np.allclose((y * y).sum(1), (x * x).sum(1)) and np.allclose(E.hadamard(y) / math.sqrt(32), x)


@pytest.mark.parametrize("dim", [64, 200])
def test_recall(dim):
    """Pairs at just the least cosine meet in some table with a chance of at least 0.99."""
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(1500, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.normal(size=x.shape)
    off -= (off * x).sum(1, keepdims=True) * x
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * off / np.linalg.norm(off, axis=1, keepdims=True)
    k, tables = E.sizes(50_000, dim)
    a, b = E.buckets(x, k, tables), E.buckets(y, k, tables)
    assert (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3)).mean() >= 0.99
