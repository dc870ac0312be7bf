import pytest

from tests.llm.conftest import DOCS, words
from watchmill.llm import lines

A = "This very line is repeated in several of the documents."
B = "Another sentence that comes twice, here and there."


def result(spark, rows):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    return {r.doc_id: r for r in lines.dedup(docs).collect()}


def test_earliest_stays_and_offsets_hold(spark):
    rows = [(5, f"{words(9, 1)}.\n{A}\n{words(9, 2)}."), (2, f"{words(8, 3)}. {A}\n{B}"), (9, f"{A.upper()} To. {B} {words(7, 4)} to"), (1, "To. So.\nTo.")]
    got = result(spark, rows)
    assert got[2].n_removed == 0 and got[1].n_removed == 0 and got[1].n_units == 3
    assert got[5].kept == f"{words(9, 1)}.\n\n{words(9, 2)}."
    # the short sentence between two removed ones goes along
    assert got[9].kept == f" {words(7, 4)} to" and got[9].n_removed == 3
    for i, t in rows:
        gone = [t[s.start : s.stop] for s in got[i].spans]
        assert got[i].removed_chars == sum(map(len, gone))
        whole = got[i].kept
        for s in got[i].spans:
            whole = whole[: s.start] + t[s.start : s.stop] + whole[s.start :]
        assert whole == t


def brute(rows):
    """Removed unit starts per row: digest seen at a smaller (doc_id, start)."""
    seen, out = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        gone = set()
        for s, e in lines.units(text or ""):
            ws = lines.WORDS.findall(text[s:e].lower())
            if len(ws) >= lines.LEAST_WORDS and seen.setdefault(tuple(ws), (doc, s)) != (doc, s):
                gone.add(s)
        out[doc] = lines.removed_spans(text or "", gone)
    return out


def test_against_brute_force(spark):
    import random

    rng = random.Random(5)
    pool = [f"{words(rng.randint(3, 9), i)}{rng.choice('.!?')}" for i in range(40)]
    rows = [(i, rng.choice(["\n", " "]).join(rng.choice(pool) for _ in range(rng.randint(1, 30)))) for i in range(60)]
    got, want = result(spark, rows), brute(rows)
    for i, _ in rows:
        assert (got[i].n_units, got[i].n_removed, [(s.start, s.stop) for s in got[i].spans]) == want[i]


def test_odd_rows(odd_docs, no_docs):
    got = sorted(lines.dedup(odd_docs).collect(), key=lambda r: (str(r.doc_id), r.n_removed))
    assert [r.n_removed for r in got if r.doc_id in (1, 2)] == [0, 1, 1]
    assert [r.kept for r in got if r.doc_id in (3, 4)] == ["", ""]
    assert len(got) == odd_docs.count() and lines.dedup(no_docs).collect() == []


def test_passage_in_the_middle_of_sentences(spark):
    passage = words(120, 77)
    rows = [(i, f"{words(40 + i, i)} {passage} {words(30 + i, 50 + i)}.") for i in range(4)]
    got = result(spark, rows)
    assert got[0].n_removed == 0
    for i in (1, 2, 3):
        gone = " ".join(rows[i][1][s.start : s.stop] for s in got[i].spans).split()
        assert len(gone) > 80 and set(gone) <= set(passage.split())


def test_many_units_take_linear_time():
    text = "a. " * 200_000
    assert lines.removed_spans(text, {0}) == (200_000, 1, [(0, 2)])


def same_hash(spark, make):
    """Two different texts of one 32-bit hash, found among many that ``make`` numbers."""
    from pyspark.sql import functions as F

    rows = spark.range(200_000).select(make("id").alias("text"))
    hashed = rows.groupBy(F.hash("text").alias("h")).agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a <> b")
    found = hashed.orderBy("h").first()
    return found["a"], found["b"]


@pytest.mark.parametrize("ids", [(None, None, 7), (3, 3, 7)])
def test_equal_hashes_of_texts_take_nothing_away(spark, ids):
    from pyspark.sql import functions as F

    a, b = same_hash(spark, lambda i: F.concat(F.lit("A line of several words numbered "), F.md5(F.col(i).cast("string")), F.lit(".")))
    got = lines.dedup(spark.createDataFrame(list(zip(ids, (a, b, a))), "doc_id long, text string")).collect()
    assert [r.kept for r in got if r.kept == b] == [b] and sum(r.n_removed for r in got) == 1


def test_units_are_hashed_once(spark):
    """The digests are read twice, so they come from a written table: what is left in the plan is the cut alone."""
    docs = spark.createDataFrame([(1, A, None, None, None), (2, A, None, None, None)], DOCS)
    plan = lines.dedup(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
