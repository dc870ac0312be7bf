"""Column expressions over raw host records (process, command line, event type)."""

from functools import reduce

from pyspark.sql import Column, functions as F

from watchmill import fixed_values as V
from watchmill.functions.lookup import choose, first_contained


def guess_service(process: Column) -> Column:
    return first_contained(F.lower(process), V.PROCESS_SERVICE, "unknown")


def classify_event(event_type: Column) -> Column:
    return choose(event_type, V.EVENT_CATEGORY, "host")


def is_suspicious(command: Column) -> Column:
    text = F.lower(F.coalesce(command, F.lit("")))
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(word)) for word in V.SUSPICIOUS_WORDS])
