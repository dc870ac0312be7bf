"""Operator 10: drop lines that occurred before, anywhere in the corpus.

A unit is a line, or a sentence of it: the text between line breaks and after ``.``, ``!`` or ``?`` with white space.
A sentence of over
LONG_WORDS words is cut between words whose common hash says so, wherever they stand: a passage set into the middle of
other sentences has the same cuts there. Units of at least LEAST_WORDS words are normalised and hashed to 128 bits. Of each digest the earliest place, by doc_id
and then offset, stays; the others are removed. A shorter unit is too common to compare; it goes with its neighbours if
both go. Digests and places are made once and written; only they are shuffled, combined before; one digest's places can
be any number.
"""

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from watchmill.session import written

LEAST_WORDS = 5
# a sentence of more words is cut into clauses of about CLAUSE_WORDS
LONG_WORDS, CLAUSE_WORDS = 24, 10
# hashes of words met before
_CODES: dict[str, int] = {}
UNIT = re.compile(r"[^\n]*?[.!?]+(?=\s)|[^\n]+")
WORDS = re.compile(r"[^\W_]+")
PLACES = pa.schema([("doc_id", pa.int64()), ("th", pa.binary()), ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int32())])


def _clauses(text: str, start: int, end: int):
    # that many words and the gaps between them need twice as many characters
    words = WORDS.findall(text, start, end) if end - start > 2 * LONG_WORDS else ()
    if len(words) > LONG_WORDS:
        if len(_CODES) > 200_000:
            _CODES.clear()
        before, at = None, start
        for word in words:
            code = _CODES.get(word)
            if code is None:
                code = _CODES[word] = zlib.crc32(word.lower().encode("utf-8", "surrogatepass"))
            at = text.index(word, at)
            if before is not None and (before + 31 * code) % CLAUSE_WORDS == 0:
                yield start, at
                start = at
            before, at = code, at + len(word)
    yield start, end


def units(text: str) -> list[tuple[int, int]]:
    """Start and end of each unit, in characters."""
    return [u for m in UNIT.finditer(text) if not m.group().isspace() for u in _clauses(text, m.start(), m.end())]


def digest(unit: str, least: int = LEAST_WORDS) -> tuple[int, int] | None:
    """128 bits of the unit's words in lower case, without anything between them; None if they are too few."""
    from xxhash import xxh3_128_intdigest

    words = WORDS.findall(unit.lower())
    if len(words) < least:
        return None
    value = xxh3_128_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
    return (value >> 64) - (1 << 63), (value & (1 << 64) - 1) - (1 << 63)


def _places(least: int):
    def run(batches):
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                out = [[], [], [], [], []]
                for doc, th, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "th", "text"))):
                    for start, end in units(text or ""):
                        key = digest(text[start:end], least)
                        if key:
                            for column, value in zip(out, (doc, th, *key, start)):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, PLACES)], schema=PLACES)

    return run


def removed_spans(text: str, starts: set[int], least: int = LEAST_WORDS) -> tuple[int, int, list[tuple[int, int]]]:
    """Number of units, number removed and the removed spans, joined where only white space lies between."""
    found = units(text)
    state = [1 if s in starts else None if len(WORDS.findall(text[s:e].lower())) < least else 0 for s, e in found]
    ahead, behind = [0] * len(state), [0] * len(state)
    for marks, order in ((behind, range(len(state))), (ahead, reversed(range(len(state))))):
        last = 0
        for i in order:
            last = marks[i] = last if state[i] is None else state[i]
    state = [s if s is not None else ahead[i] and behind[i] for i, s in enumerate(state)]
    spans: list[tuple[int, int]] = []
    for (start, end), s in zip(found, state):
        if s and spans and not text[spans[-1][1] : start].strip():
            spans[-1] = spans[-1][0], end
        elif s:
            spans.append((start, end))
    return len(found), sum(1 for s in state if s), spans


def _cut(least: int):
    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, starts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "starts"))):
                text = text or ""
                n, gone, spans = removed_spans(text, set(starts), least) if starts else (len(units(text)), 0, [])
                at, kept = 0, []
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                whole = "".join(kept)
                rows.append((doc, n, gone, sum(b - a for a, b in spans), [{"start": a, "stop": b} for a, b in spans], whole,
                             hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest()))
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string(), pa.string())
            names = ("doc_id", "n_units", "n_removed", "removed_chars", "spans", "kept", "kept_sha256")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def dedup(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, n_units, n_removed, removed_chars, spans, kept, kept_sha256`` for every row of ``docs``.

    ``spans`` are the removed ranges of the given text, in characters; ``kept`` is the rest. Null text: no units, an
    empty rest. A null doc_id ranks first. Rows that repeat doc_id and text are the same place: what is kept of
    one is kept of all. Other columns are ignored. Empty table: no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # only rows that a doc_id does not name alone need 128 bits of their text beside it
    odd = not rows.groupBy("doc_id").count().filter("count > 1").isEmpty()
    rows = rows.withColumn("th", F.unhex(F.md5(F.coalesce("text", F.lit("")))) if odd else F.lit(b""))
    # read twice: making them costs far more than reading them
    places = written(rows.mapInArrow(_places(least), "doc_id long, th binary, k1 long, k2 long, at int"), "places")
    place = F.struct("doc_id", "at", "th")
    known = places.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(~F.col("first").eqNullSafe(F.col("last"))).select("k1", "k2", "first")
    again = places.join(known, ["k1", "k2"]).filter(~place.eqNullSafe(F.col("first")))
    starts = again.groupBy("doc_id", "th").agg(F.collect_list("at").alias("starts")).toDF("_d", "_t", "starts")
    joined = rows.join(starts, rows["doc_id"].eqNullSafe(starts["_d"]) & (rows["th"] == starts["_t"]), "left")
    return joined.select("doc_id", "text", "starts").mapInArrow(
        _cut(least), "doc_id long, n_units long, n_removed long, removed_chars long, spans array<struct<start:long,stop:long>>, kept string, kept_sha256 string")
