"""Small fixed tables as CASE expressions, so that they stay inside generated code."""

from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F


def choose(key: Column, table: dict[str, Any], otherwise: Any) -> Column:
    """The value whose key equals ``key``."""
    cases = reduce(lambda c, kv: c.when(key == kv[0], F.lit(kv[1])), table.items(), F)
    return cases.otherwise(F.lit(otherwise))


def first_contained(text: Column, table: dict[str, Any], otherwise: Any) -> Column:
    """The value of the first key, in table order, that occurs in ``text``."""
    cases = reduce(lambda c, kv: c.when(F.contains(text, F.lit(kv[0])), F.lit(kv[1])), table.items(), F)
    return cases.otherwise(F.lit(otherwise))
