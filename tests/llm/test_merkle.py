"""Roots, proofs and log positions against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS
from watchmill.llm import merkle
from watchmill.llm.common import ascii_lower


def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row[:5]
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("-" if v is None else f"{len(v.encode())}:{v}" for v in fields)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, at):
    for level in tree[:-1]:
        first = at - at % 8
        yield at % 8, level[first : min(first + 8, len(level))]
        at //= 8


def brute(rows, changes):
    """doc_id, leaf, subroot, root, siblings, folded root per row."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    built, order = {}, {}
    for g in langs:
        order[g] = sorted(trees[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[g] = levels([leaf(r) for r in order[g]])
    top = levels([built[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(order[g]):
            folded, proof = leaf(changes(r)), []
            for own, run in [*path(built[g], i), *path(top, k)]:
                proof += run[:own] + run[own + 1 :]
                folded = sha(run[:own] + [folded] + run[own + 1 :])
            out.append((r[0], leaf(r), built[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def lowered(r):
    if r[0] is None or r[1] is None or zlib.crc32(str(r[0]).encode()) % 3:
        return r
    return (r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])


def run(df, tier=merkle.TIER):
    third = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    claim = F.when(third, merkle.leaf(ascii_lower(F.col("text")))).otherwise(merkle.leaf())
    return [tuple(r) for r in merkle.verified(df, claim, tier).collect()]


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 73, 512, 513, 4097])
def test_positions_are_a_postorder(n):
    """Nodes listed by position: children before their parent, each place taken once."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // 8))
    at = {(level, place): merkle.position(n, level, place) for level, size in enumerate(sizes) for place in range(size)}
    assert sorted(at.values()) == list(range(sum(sizes))) and merkle.height(n) == len(sizes) - 1
    log = []

    def walk(level, place):
        if level:
            for child in range(place * 8, min(place * 8 + 8, sizes[level - 1])):
                walk(level - 1, child)
        log.append((level, place))

    walk(len(sizes) - 1, 0)
    assert log == sorted(at, key=at.get)


def test_positions_as_columns(spark):
    rows = [(n, level, place) for n in (1, 9, 600, 32769, 1 << 40) for level in range(merkle.height(n) + 1)
            for place in {0, min(5, (n - 1) >> 3 * level), (n - 1) >> 3 * level}]
    df = spark.createDataFrame(rows, "n long, level int, place long")
    got = df.select("n", "level", "place", merkle.position_of(F.col("n"), F.col("level"), F.col("place")), merkle.height_of(F.col("n"))).collect()
    assert all(tuple(r)[3:] == (merkle.position(*r[:3]), merkle.height(r[0])) for r in got)


@pytest.mark.parametrize("tier", [1, 4])
def test_equal_to_brute_force(spark, tier):
    """Small blocks too, so that trees have several tiers of builders."""
    sizes = {None: 1, "": 8, "a": 9, "de": 64, "en": 700, "ü": 65, "z1": 2, "z2": 3, "z3": 1, "z4": 7}
    rows = [(i * 7 + k, f"Text {i % 5} Of {g}", g, None if i % 3 else "S", i if i % 2 else None) for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    got = run(spark.createDataFrame(rows, DOCS).repartition(5), tier)
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, lowered)))
    assert {r[-1] for r in got} == {True, False}


def test_odd_rows(odd_docs):
    rows = [tuple(r) for r in odd_docs.collect()]
    assert sorted(map(str, run(odd_docs))) == sorted(map(str, brute(rows, lowered)))


def test_a_third_of_all_rows_share_a_doc_id(spark):
    rows = [(None if i % 3 else 5, f"t{i}", "en", "s", i) for i in range(300)] + [(9, "same", "en", "s", 1)] * 150
    assert sorted(map(str, run(spark.createDataFrame(rows, DOCS)))) == sorted(map(str, brute(rows, lowered)))


def test_fields_do_not_run_together(spark):
    rows = [(1, "b", None, "a", None), (1, "", None, "ab", None), (1, None, None, "ab", None), (1, "-", None, "a", None)]
    assert len({r.leaf for r in spark.createDataFrame(rows, DOCS).select(merkle.leaf().alias("leaf")).collect()}) == 4


def test_empty(no_docs):
    assert run(no_docs) == [] and merkle.manifest(no_docs).root == merkle.EMPTY
