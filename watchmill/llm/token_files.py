"""Operator 2: token ids in binary files, document boundaries as Elias-Fano sequences.

One file per range of doc_id, named in that order:

    ids           n_ids little-endian unsigned integers of ``width`` bytes, all documents one after another
    ends          Elias-Fano sequence of the n_docs document ends within this file
    doc_ids       Elias-Fano sequence of the doc_ids less the smallest one; n_null documents without one come first
    footer        6 unsigned 64-bit integers: n_ids, n_docs, n_null, smallest doc_id (two's complement), bytes of ends,
                  bytes of doc_ids; then width as one byte and the magic ``WMTOK01``

An Elias-Fano sequence of n values below u keeps the low ``floor(log2(u / n))`` bits of each value as they are and the
rest in unary, about 2 + log2(u / n) bits a value; ``select(i)`` finds the i-th one bit from a sample every 128 ones.
"""

import re
import struct
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from watchmill.llm.common import open_folder, pieces, text_bytes
from watchmill.session import fresh_path, written

MAGIC = b"WMTOK01"
FOOTER = "<6QB7s"
HEAD = "<3Q"
SAMPLE = 128
SHARD_BYTES = 32 << 20
CACHED_WORDS = 400_000
SEPARATOR = "\x00"
# texts whose new words go to the library together
GROUP = 64


class EliasFano:
    """A non-decreasing sequence of non-negative integers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, high: np.ndarray, low: np.ndarray):
        self.n, self.low_bits, self.high, self.low = n, low_bits, high, low
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        # byte in which each 128th one bit lies
        self.sample = np.searchsorted(self.counts, np.arange(0, n, SAMPLE), side="right").astype(np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8))
        low_bits = max(0, ((int(values[-1]) + 1) // n).bit_length() - 1)
        tops = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(tops[-1]) + 1, np.uint8)
        bits[tops] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        lows = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        return cls(n, low_bits, np.packbits(bits, bitorder="little"), np.packbits(lows.ravel(), bitorder="little"))

    def to_bytes(self) -> bytes:
        return struct.pack(HEAD, self.n, self.low_bits, len(self.high)) + self.high.tobytes() + self.low.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, low_bits, size = struct.unpack_from(HEAD, data)
        body = np.frombuffer(data, np.uint8, offset=struct.calcsize(HEAD))
        return cls(n, low_bits, body[:size], body[size:])

    def select(self, i: int) -> int:
        """The i-th value, from 0."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        byte = int(self.sample[i // SAMPLE])
        while self.counts[byte] <= i:
            byte += 1
        left = i - int(self.counts[byte - 1])
        value = int(self.high[byte - 1])
        for _ in range(left):
            value &= value - 1
        top = (byte - 1) * 8 + ((value & -value).bit_length() - 1) - i
        at, low = i * self.low_bits, 0
        for k in range(self.low_bits):
            low |= (int(self.low[(at + k) >> 3]) >> ((at + k) & 7) & 1) << k
        return top << self.low_bits | low

    def values(self) -> np.ndarray:
        tops = np.flatnonzero(np.unpackbits(self.high, bitorder="little")).astype(np.uint64) - np.arange(self.n, dtype=np.uint64)
        if not self.low_bits:
            return tops
        bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
        lows = bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))
        return tops << np.uint64(self.low_bits) | lows


def _first_half(cache: dict) -> dict:
    """What came first: frequent words are met early."""
    return dict(islice(cache.items(), len(cache) // 2))


class Encoder:
    """Ids of whole texts by the tokenizers library, each different word encoded once while it is remembered.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its words, and those
    of "word," are those of "word" and ",". A new word of plain Latin letters is one unit for the tokenizer and goes, in
    lower case and as its byte characters, straight to the library's model; other new words go through the whole
    tokenizer in one call, with a separator between.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.mark = self._plain(SEPARATOR)
        self.model = self.library.model.tokenize
        self.latin = re.compile("[a-zß-öø-ÿ]+").fullmatch
        byte_character = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {ord(c): byte_character(c)[0][0] for c in map(chr, range(0xDF, 0x100))}
        self.known: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _learn(self, words: set[str]) -> None:
        if len(self.stems) > CACHED_WORDS:
            self.stems = _first_half(self.stems)
        split, new, known, stems = {}, {}, self.known, self.stems
        for w in words:
            if SEPARATOR in w or "<|" in w:
                known[w] = self._plain(w)
                continue
            stem, tail = (w[:-1], w[-1]) if w[-1] in ",." else (w, "")
            small = stem.lower()
            if self.latin(small) and len(small) == len(stem):
                stem = small
                found = stems.get(stem)
                if found is None:
                    ids = [t.id for t in self.model(stem if stem.isascii() else stem.translate(self.spelling))]
                    found = stems[stem] = struct.pack(f"<{len(ids)}I", *ids)
                if not tail:
                    known[w] = found
                    continue
                if tail in stems:
                    known[w] = found + stems[tail]
                    continue
                new[tail] = None
            else:
                stem, tail = w, ""
                if stem not in stems:
                    new[stem] = None
            split[w] = stem, tail
        if new:
            joined = f" {SEPARATOR} ".join(new)
            ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            mark = np.frombuffer(self.mark, np.uint32)
            cuts = np.flatnonzero(ids == mark[0])
            starts, ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(ids)]])
            data = ids.tobytes()
            stems.update(zip(new, (data[a:b] for a, b in zip((starts * 4).tolist(), (ends * 4).tolist()))))
        known.update((w, stems[s] + stems[t] if t else stems[s]) for w, (s, t) in split.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for i in range(0, len(texts), GROUP):
            group = texts[i : i + GROUP]
            # U+001C to U+001F separate words for Python but not for the tokenizer
            odd = [len(self.mark) != 4 or any(map(t.__contains__, "\x1c\x1d\x1e\x1f")) for t in group]
            words = [[] if o else t.split() for t, o in zip(group, odd)]
            if len(self.known) > CACHED_WORDS:
                self.known = _first_half(self.known)
            # one look at each word; most are known
            ids = [list(map(self.known.get, ws)) for ws in words]
            self._learn({w for ws, found in zip(words, ids) if None in found for w, x in zip(ws, found) if x is None})
            known = self.known
            for text, o, ws, found in zip(group, odd, words, ids):
                if None in found:
                    found = [known[w] if x is None else x for w, x in zip(ws, found)]
                out.append(self._plain(text) if o else b"".join(found))
        return out


def _write(tokenizer: str, end_id: int, folder: str):
    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        shard, attempt = task.partitionId(), task.taskAttemptId()
        files, base = open_folder(folder)
        name, draft = f"{base}/part-{shard:08d}.tok", f"{base}/_draft-{shard:08d}-{attempt}"
        encoder, end = Encoder(tokenizer), np.uint32(end_id).tobytes()
        kind = np.uint16 if encoder.width == 2 else np.uint32
        lengths, ids, n_null = [], [], 0
        with files.open_output_stream(draft) as out:
            for batch in batches:
                numbers = batch.column("doc_id")
                n_null += numbers.null_count
                ids.append(numbers.drop_null().to_numpy())
                for at in range(0, len(batch), GROUP):
                    for data in encoder.encode(batch.column("text").slice(at, GROUP).to_pylist()):
                        data += end
                        lengths.append(len(data) // 4)
                        out.write(np.frombuffer(data, np.uint32).astype(kind).tobytes())
            ends = np.cumsum(np.array(lengths, np.int64))
            numbers = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            least = int(numbers[0]) if len(numbers) else 0
            first = EliasFano.of(ends).to_bytes()
            second = EliasFano.of((numbers.astype(np.int64) - np.int64(least)).view(np.uint64)).to_bytes()
            total = int(ends[-1]) if len(ends) else 0
            out.write(first + second)
            out.write(struct.pack(FOOTER, total, len(ends), n_null, least & (1 << 64) - 1, len(first), len(second), encoder.width, MAGIC))
        if len(ends):
            files.move(draft, name)
        else:
            files.delete_file(draft)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [len(ends)], "n_ids": [total]}, schema=pa.schema(
            [("shard", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode every whole text, append ``end_id``, write files in ascending doc_id order; returns ``shard, n_docs, n_ids``.

    A null text is empty, a null doc_id sorts first, rows with one doc_id lie side by side in the order of their texts.
    An empty table writes no file. A task writes a draft and renames it, so a repeated task leaves one whole file.
    """
    files, base = open_folder(folder)
    files.create_dir(base, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = pieces(text_bytes(docs), shard_bytes)
    ordered = rows.repartitionByRange(n, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    return written(ordered.mapInArrow(_write(tokenizer, end_id, folder), "shard long, n_docs long, n_ids long"), "manifest")


class TokenFile:
    """One file, from its bytes: ``document(i)`` gives any document's ids by two selects."""

    def __init__(self, data: bytes):
        n_ids, self.n_docs, self.n_null, least, a, b, width, magic = struct.unpack_from(FOOTER, data, len(data) - struct.calcsize(FOOTER))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.ids = np.frombuffer(data, np.uint16 if width == 2 else np.uint32, count=n_ids)
        at = n_ids * width
        self.ends = EliasFano.from_bytes(data[at : at + a])
        self.numbers = EliasFano.from_bytes(data[at + a : at + a + b])
        self.least = least - (1 << 64) if least >> 63 else least

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def doc_ids(self) -> list:
        return [None] * self.n_null + [self.least + int(v) for v in self.numbers.values()]


def _read(batches):
    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
            file = TokenFile(data.as_py())
            ends = file.ends.values().astype(np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            wide = file.ids.astype(np.uint32)
            sums = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            shard = int(path.rpartition("part-")[2].removesuffix(".tok"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(ends), pa.int64()), pa.array(file.doc_ids(), pa.int64()), pa.array(starts),
                 pa.array(ends - starts), pa.array(sums, pa.int64())], names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files and the sizes of those before."""
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = manifest.select("shard", F.coalesce(before, F.lit(0)).alias("before"))  # one row per file
    blobs = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select("path", "content")
    rows = blobs.mapInArrow(_read, "shard long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "shard").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write ``docs`` to a new folder in the shared place and read the files back."""
    folder = fresh_path(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, folder, tokenizer, end_id, shard_bytes)
    if not manifest.agg(F.sum("n_docs")).first()[0]:
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(docs.sparkSession, folder, manifest)
