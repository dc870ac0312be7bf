"""Near copies by word shingles: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Two texts are compared if their SimHash fingerprints meet (operator 5's ball hashing, ``simhash.links``): that finds copies
and the closest near copies, but edited ones lie up to 11 bits apart. So they are also compared if the least hashes of
their shingles agree in all ROWS places of one of BANDS bands: at a similarity of 0.8 that happens with
1 - (1 - 0.8**6)**25 = 0.9995, and more above. Every compared pair is verified on the shingles themselves. First each text meets the smallest and the largest of its band, which links a large group of
copies by a number of pairs that grows with its size. Then the members of a band that these links have not brought
together are compared too: if all but FEW of them are in one group, those few meet the others. What is left are bands
of many texts that have something in common and are not alike, such as a passage that is found everywhere. Their texts
are joined anew by prefixes: two sets of similarity ``least`` share one of the rarest shingles of each, which a common
passage is not among, so nothing is lost. Those that share one are compared in blocks inside a task, which counts all
common shingles by matrix products and gives back only the links that span what it connected.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from watchmill.llm import simhash
from watchmill.llm.common import packed
from watchmill.llm.components import components
from watchmill.session import written

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 25, 6
# shingles that meet all hash functions at a time
BLOCK = 512
# members of a band beside its largest group that meet all others
FEW = 8
# members of a block and their shingles, a block's columns that are multiplied at a time
BLOCK_ROWS, BLOCK_SHINGLES, COLUMNS = 1024, 1 << 20, 4096
_RANDOM = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64)
_FLIP, _TIMES = _RANDOM[0], _RANDOM[1] | np.uint64(1)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], words_each: int = SHINGLE) -> np.ndarray:
    """Different hashes of all runs of that many words; of fewer words, of all of them."""
    from xxhash import xxh64_intdigest

    joined = b" ".join(words)
    if len(words) <= words_each:
        return np.array([xxh64_intdigest(joined)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - words_each + 1].tolist()
    stops = (ends - 1)[words_each - 1 :].tolist()
    return np.unique(np.array([xxh64_intdigest(joined[a:b]) for a, b in zip(starts, stops)], np.uint64))


def bands(found: np.ndarray) -> list[int]:
    """Of each band a signed 64-bit hash of its least hashes."""
    from xxhash import xxh64_intdigest

    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for a in range(0, len(found), BLOCK):
        np.minimum(least, ((found[a : a + BLOCK] ^ _FLIP) * _TIMES).min(axis=1), out=least)
    return [xxh64_intdigest(row.tobytes(), i) - (1 << 63) for i, row in enumerate(least.reshape(BANDS, ROWS))]


def _signed(batches):
    from xxhash import xxh64_intdigest

    for batch in batches:
        for a in range(0, len(batch), 1024):
            part = batch.slice(a, 1024)
            keys, marks, rows = [], [], []
            for text in part.column("text").to_pylist():
                words = _words(text)
                keys.append(xxh64_intdigest(b" ".join(words)) - (1 << 63))
                marks.append(simhash.fingerprint(text))
                rows.append(bands(shingles(words)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("th"), pa.array(keys, pa.int64()), pa.array(np.array(marks, np.uint64).view(np.int64)),
                 pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "th", "sh", "fp", "bands"])


def _verified(least: float):
    def run(batches):
        for batch in batches:
            same, last, left = [], None, None
            for a, b in zip(batch.column("tu").to_pylist(), batch.column("tv").to_pylist()):
                if a != last:
                    last, left = a, shingles(_words(a))
                right = shingles(_words(b))
                both = len(np.intersect1d(left, right, assume_unique=True)) if min(len(left), len(right)) >= least * max(len(left), len(right)) else 0
                same.append(both >= least * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(same, pa.bool_()))

    return run


def _links(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (``u``, ``v``) that are as similar as wanted."""
    left, right = texts.toDF("u", "tu"), texts.toDF("v", "tv")
    rows = pairs.join(left, "u").join(right, "v").select("u", "v", "tu", "tv")
    return written(rows.mapInArrow(_verified(least), "u long, v long"), "links")


def _pairs(a: str, b: str, met: DataFrame) -> DataFrame:
    return met.filter(f"{a} <> {b}").select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))


def _by_simhash(rows: DataFrame) -> DataFrame:
    """``u, v``: texts of one fingerprint, each with the smallest, and these of fingerprints that ``simhash.links`` links."""
    marked = written(rows.groupBy("sh").agg(F.min("fp").alias("fp")), "marked")
    different = written(marked.groupBy("fp").agg(F.min("sh").alias("first")), "different")
    same = _pairs("first", "sh", marked.join(different, "fp"))
    near = simhash.links(different.select("fp"))
    for end in ("u", "v"):
        near = near.join(different.toDF(end, f"{end}_first"), end)
    return written(same.union(_pairs("u_first", "v_first", near)).distinct(), "by-simhash")


def _strangers(met: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """``key, sh, group, top, apart``: members of buckets with several groups, the largest group there and how many are not in it."""
    known = met.select(key, "sh").join(groups, "sh", "left").select(key, "sh", F.coalesce("group", "sh").alias("group"))
    sizes = known.groupBy(key, "group").agg(F.count("*").alias("n"))
    per = sizes.groupBy(key).agg(F.sum("n").alias("all"), F.max(F.struct("n", "group")).alias("most"))
    per = per.select(key, F.col("most.group").alias("top"), (F.col("all") - F.col("most.n")).alias("apart")).filter("apart > 0")
    return written(known.join(per, key), "strangers")


def _across(strangers: DataFrame, key: str) -> DataFrame:
    """Each member beside the largest group with every member of another group: pairs grow with both numbers."""
    few = strangers.filter("group <> top").select(key, F.col("sh").alias("other"), F.col("group").alias("other_group"))
    return _pairs("sh", "other", strangers.join(few, key).filter("group <> other_group AND (group = top OR sh < other)"))


def _listed(batches):
    for batch in batches:
        for key, text in zip(batch.column("sh").to_pylist(), batch.column("text").to_pylist()):
            found = shingles(_words(text)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), key)), pa.array(np.full(len(found), len(found))), pa.array(found)], names=["sh", "n", "shingle"])


def _sets(batches):
    for batch in batches:
        found = [shingles(_words(t)).view(np.int64) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("sh"), pa.array(found, pa.list_(pa.int64()))], names=["sh", "shingles"])


def _prefixed(crowd: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """``shingle, sh, n``: of the texts ``sh`` so many of their rarest shingles that any two that are alike share one."""
    listed = written(texts.join(crowd, "sh", "left_semi").mapInArrow(_listed, "sh long, n long, shingle long"), "listed")
    counts = listed.groupBy("shingle").agg(F.count("*").alias("uses")).filter("uses > 1")
    # a shingle of one text alone takes a place in the order, before all others
    order = F.row_number().over(Window.partitionBy("sh").orderBy("uses", "shingle"))
    single = listed.groupBy("sh", "n").agg(F.count("*").alias("all")).select("sh", "n")
    shared = listed.join(counts, "shingle").select("sh", "shingle", "uses").withColumn("k", order)
    alone = single.join(shared.groupBy("sh").agg(F.count("*").alias("shared")), "sh").select("sh", "n", (F.col("n") - F.col("shared")).alias("alone"))
    # two sets of n and m shingles with a similarity of at least `least` share at least `least` x n of them
    length = F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1
    return shared.join(alone, "sh").filter(F.col("k") + F.col("alone") <= length).select("shingle", "sh", "n")


def _connected(keys: np.ndarray, sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """``u, v``: links that connect what pairs of at least that similarity connect among ``sets`` (distinct values each)."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values, code, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # a shingle of one text alone is common to none; the others are numbered anew
    number = np.cumsum(uses > 1) - 1
    kept = uses[code] > 1
    owner, code = owner[kept], number[code[kept]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((n, n), np.float32)
    for low in range(0, int((uses > 1).sum()), COLUMNS):
        a, b = np.searchsorted(code, [low, low + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[owner[a:b], code[a:b] - low] = 1
        common += part @ part.T
    alike = common >= least * (sizes[:, None] + sizes[None, :] - common)
    np.fill_diagonal(alike, True)
    label = np.arange(n)
    while True:
        lower = np.where(alike, label[None, :], n).min(axis=1)
        if (lower == label).all():
            break
        label = lower
    moved = np.flatnonzero(label != np.arange(n))
    return keys[moved], keys[label[moved]]


def _blocks(least: float):
    """Rows come sorted by block: each whole block is compared."""

    def run(batches):
        last, keys, sets = None, [], []

        def links():
            u, v = _connected(np.array(keys), sets, least) if len(keys) > 1 else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            lists = batch.column("shingles")
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in ("shingle", "low", "high", "sh")))):
                if row[:3] != last:
                    yield links()
                    last, keys, sets = row[:3], [], []
                keys.append(row[3])
                sets.append(np.asarray(lists[i].values))
        yield links()

    return run


def _compared(rare: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """``u, v``: links between the members of each bucket of ``rare``, compared in pairs of blocks of bounded size."""
    sizes = rare.groupBy("shingle").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    own = F.pmod(F.xxhash64("sh", F.lit(1)), F.col("blocks"))
    dealt = rare.join(sizes, "shingle").select("shingle", "sh", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("shingle", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "sh")
    lists = texts.join(rare.select("sh").distinct(), "sh", "left_semi").mapInArrow(_sets, "sh long, shingles array<long>")
    rows = dealt.join(lists, "sh").repartition("shingle", "low", "high").sortWithinPartitions("shingle", "low", "high", "sh")
    found = rows.select("shingle", "low", "high", "sh", "shingles").mapInArrow(_blocks(least), "u long, v long")
    return written(found.distinct(), "block-links")


def _grouped(docs: DataFrame, least: float) -> DataFrame:
    """``doc_id, th, component`` (a hash of its words) for every row; ``th`` is a hash of the text."""
    text = F.col("text").cast("string")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    rows = written(given.mapInArrow(_signed, "doc_id long, th long, sh long, fp long, bands array<long>"), "bands")
    banded = rows.dropDuplicates(["sh"]).select("sh", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("sh").alias("first"), F.max("sh").alias("last")).filter("first <> last")
    met = written(banded.join(shared, "band"), "met")
    by_simhash = _by_simhash(rows)
    tried = written(by_simhash.union(_pairs("first", "sh", met)).union(_pairs("last", "sh", met)).distinct(), "tried")
    # one text of each set of words that is compared
    compared = met.select("sh").union(by_simhash.select("u")).union(by_simhash.select("v"))
    wanted = compared.distinct().join(rows.groupBy("sh").agg(F.min("th").alias("th")), "sh")
    texts = given.select("th", "text").join(wanted, "th").dropDuplicates(["sh"]).select("sh", "text")
    texts = written(texts, "texts")
    links = _links(tried, texts, least)
    groups = components(links).toDF("sh", "group")
    strangers = _strangers(met, "band", groups)
    rest = _across(strangers.filter(F.col("apart") <= FEW), "band")
    crowd = strangers.filter(F.col("apart") > FEW).select("sh").distinct()
    links = links.union(_links(rest.distinct().join(tried, ["u", "v"], "left_anti"), texts, least))
    prefixes = written(_prefixed(crowd, texts, least), "prefixes")
    open_ = _strangers(prefixes, "shingle", components(links).toDF("sh", "group")).select("shingle", "sh")
    links = links.union(_compared(open_.join(prefixes, ["shingle", "sh"]), texts, least))
    groups = components(links).toDF("sh", "group")
    return rows.join(groups, "sh", "left").select("doc_id", "th", F.coalesce("group", "sh").alias("component"))


def one_of_each(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` with one row per group of near copies: the smallest doc_id, of equal ones the text with the smallest hash.

    A group holds all that links of similarity ``least`` or more connect. Words are cut at ASCII white space, in lower
    case for A-Z; texts of the same words are copies, those without words too. Rows without a doc_id come last in their
    group. Empty table: no rows.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "th"))
    kept = _grouped(docs, least).groupBy("component").agg(first.alias("k")).select(F.col("k.doc_id").alias("kept"), F.col("k.th").alias("text_hash"))
    rows = packed(docs, id=F.col("doc_id").cast("long"), th=F.xxhash64(F.col("text").cast("string")))
    found = rows.join(kept, F.col("id").eqNullSafe(F.col("kept")) & (F.col("th") == F.col("text_hash")))
    return found.dropDuplicates(["id", "th"]).select("row.*")
