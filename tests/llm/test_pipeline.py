"""Every stage of the pipeline against brute force over what its predecessor kept."""

import pytest

import corpus_pipeline
from tests.llm.conftest import DOCS
from tests.llm.test_decontamination import brute as brute_leaks
from tests.llm.test_near_copies import brute as brute_copies
from tests.llm.test_token_files import brute as brute_tokens
from watchmill.llm import mixing
from watchmill.session import fresh_path, written

GIVEN = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark):
    """Given documents with a copy, a near copy, a leak and some without a language."""
    path = fresh_path(spark, "pipeline-test")
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet").filter("length(text) < 4000")
    rows = [tuple(r) for r in docs.orderBy("doc_id").limit(60).collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{GIVEN}/benchmark.parquet").orderBy("item_id").limit(10).collect()]
    clean = next(r for r in rows if len(r[1]) > 1500)
    rows += [(5000, clean[1], "en", "src1", 1), (5001, clean[1] + " end", "en", "src1", 1), (5002, f"{rows[3][1]} {items[2][1]} and so on", "en", None, 1),
             (5003, None, "en", "src2", None), (5004, "1 2 3 !", None, None, 7), (5005, "", None, "src3", 0)]
    spark.createDataFrame(rows, docs.schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def kept(spark, folder):
    out = {"documents": spark.read.parquet(f"{folder}/documents.parquet")}
    last = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        last = out[name] = written(stage(spark, last, folder), name)
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "tokens"]


def test_all_but_the_last_keep_the_columns(kept):
    for name in ("language", "near_duplicates", "decontamination", "mixing"):
        assert kept[name].schema.simpleString() == kept["documents"].schema.simpleString()


def test_language(kept):
    want = [(d, t) for d, t in pairs(kept["documents"]) if t and any(map(str.isalpha, t))]
    assert sorted(pairs(kept["language"])) == sorted(want) and len(want) == kept["documents"].count() - 3


def test_near_duplicates(kept):
    """A copy and a copy with one word more go, by five-word sets with a similarity of 0.8."""
    before = pairs(kept["language"])
    stay = set(brute_copies(before))
    assert sorted(pairs(kept["near_duplicates"])) == sorted(p for p in before if p[0] in stay)
    assert not stay & {5000, 5001} and len(stay) < len(before)


def test_decontamination(spark, folder, kept):
    before = pairs(kept["near_duplicates"])
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute_leaks(items, before)}
    assert 5002 in bad and sorted(pairs(kept["decontamination"])) == sorted(p for p in before if p[0] not in bad)


def test_mixing(kept):
    copies = {r.doc_id: r.copies for r in mixing.mix(kept["decontamination"]).collect()}
    got = {}
    for d, _ in pairs(kept["mixing"]):
        got[d] = got.get(d, 0) + 1
    assert got == {d: n for d, n in copies.items() if n}


def test_tokens(spark, folder, kept):
    want = sorted(brute_tokens(pairs(kept["mixing"])))
    assert sorted(map(tuple, kept["tokens"].collect())) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == want


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_nothing_to_learn_and_no_numbers(spark, tmp_path):
    """Without a labelled language no document is refused; rows that share a doc_id or have none are all mixed."""
    rows = [(None if i % 2 else 7, " ".join(f"w{i}x{j}" for j in range(30)), None, "s", 0) for i in range(20)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == 30 and {r.doc_id for r in got} == {None, 7}
