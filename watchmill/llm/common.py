"""Small helpers that the operators share."""

import os
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# white space as the contracts define it: space and U+0009 to U+000D
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(c: Column) -> Column:
    """Lower case for A-Z only, whatever the locale."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(total: int | None, each: int) -> int:
    """How many partitions of about ``each`` a total needs: it grows with the input."""
    return max(1, -(-(total or 0) // each))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def open_folder(uri: str):
    """The file system of a folder that all executors share, and the folder's path in it."""
    from pyarrow import fs

    if not urlparse(uri).scheme:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(uri)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """``docs`` as one column ``row`` beside new ``columns``, whose names then clash with nothing; ``row.*`` undoes it."""
    return docs.select(F.struct(*docs.columns).alias("row"), *[c.alias(name) for name, c in columns.items()])
