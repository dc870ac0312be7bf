"""Operator 5: near-duplicates by SimHash, found by ball hashing that meets in the middle.

Two fingerprints at most 2 bits apart share a value at most 1 bit from both. Every different fingerprint therefore
emits its whole ball of radius 1, itself and its 64 neighbours, and a shuffle brings equal values together. All that
meet at one value lie within 2 bits of each other, at most 65 of them, so linking each to the one before it, sorted,
loses no connection and emits no pairs. Links are checked all the same.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from watchmill.llm.common import packed
from watchmill.llm.components import components
from watchmill.session import written

BITS = 64
SEED = 42
SHINGLE = 3
# shingles whose bits are counted at a time
BLOCK = 1 << 15


def fingerprint(text: str | None, words_each: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes. No words: 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words) - words_each + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n < 1:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends - 1)[words_each - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def _fingerprints(batches):
    for batch in batches:
        values = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(values)], names=["doc_id", "th", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, th`` (a hash of the text), ``fp`` (a signed 64-bit number) for every row."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, th long, fp long")


def links(different: DataFrame) -> DataFrame:
    """``u, v``: of the different values ``fp``, pairs within 2 bits that connect all pairs within 2 bits."""
    ball = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(BITS)])
    met = different.select("fp", F.explode(ball).alias("value"))
    before = F.lag("fp").over(Window.partitionBy("value").orderBy("fp"))
    pairs = met.select(F.col("fp").alias("v"), before.alias("u")).filter("u IS NOT NULL")
    return pairs.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2).select("u", "v")


def _grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, th, fp, component`` (one of its fingerprints), ``component_id`` for every row."""
    rows = written(fingerprints(docs), "fingerprints")
    different = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "different")
    found = components(links(different.select("fp")))
    groups = different.join(found.withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    # the smallest doc_id of each component, back to its fingerprints, then to all documents
    named = groups.select("fp", "component").join(ids, "component").select("fp", "component", "component_id")
    return rows.join(named, "fp").select("doc_id", "th", "fp", "component", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Null and blank texts have fingerprint 0 and are linked like any other. Repeated rows share a component. A null
    doc_id is kept and never the smallest; a component of nothing else has a null id. Empty table: no rows.
    """
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return _grouped(docs).select("doc_id", text.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per group of near-duplicates: the smallest doc_id, of equal ones the text with the smallest hash.

    Rows without a doc_id come last in their group.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "th"))
    kept = _grouped(docs).groupBy("component").agg(first.alias("k")).select(F.col("k.doc_id").alias("kept"), F.col("k.th").alias("text_hash"))
    rows = packed(docs, id=F.col("doc_id").cast("long"), th=F.xxhash64(F.col("text").cast("string")))
    found = rows.join(kept, F.col("id").eqNullSafe(F.col("kept")) & (F.col("th") == F.col("text_hash")))
    return found.dropDuplicates(["id", "th"]).select("row.*")
