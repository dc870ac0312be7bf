import __spark_entry__ as entry
from watchmill.llm.queries import QUERIES, SQL


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(QUERIES)
