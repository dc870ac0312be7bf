"""One query per operator of this folder, with production parameters over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchmill.llm import (
    backoff, decontamination, embeddings, language, lines, merkle, mixing, periodic, simhash, substrings, token_files, toxicity,
    url_filter,
)
from watchmill.llm.common import ascii_lower, table


def word_tokenizer() -> str:
    """Where the tokenizer file lies on this machine; the operators take its path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_mix(spark, d):
    return mixing.mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


@query
def op2_token_files(spark, d):
    return token_files.token_files(table(spark, d, "documents"), word_tokenizer())

@query
def op3_urls(spark, d):
    return url_filter.judge(table(spark, d, "pages"))


@query
def op5_simhash(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


@query
def op9_language(spark, d):
    docs = table(spark, d, "documents")
    return language.identify(docs, language.learn(docs))


@query
def op7_embeddings(spark, d):
    return embeddings.near_duplicates(table(spark, d, "embeddings"))


@query
def op4_backoff(spark, d):
    rows = backoff.scores(table(spark, d, "documents"))
    return rows.select("doc_id", "n_words", "n_single", "n_unknown", F.round("log_score", 4).alias("log_score"))


def op4_backoff_order3(spark, d):
    """The same with trigrams; beside QUERIES, since the SQL of op4_backoff says bigrams."""
    rows = backoff.scores(table(spark, d, "documents"), 3)
    return rows.select("doc_id", "n_words", "n_single", "n_unknown", F.round("log_score", 4).alias("log_score"))


MORE: dict[str, Query] = {"op4_backoff_order3": op4_backoff_order3}


@query
def op10_lines(spark, d):
    return lines.dedup(table(spark, d, "documents")).drop("kept")


@query
def op8_leaks(spark, d):
    return decontamination.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op6_substrings(spark, d):
    return substrings.repeated_bytes(table(spark, d, "documents")).drop("spans")


@query
def op11_periodic(spark, d):
    text = periodic.made_periodic(F.col("text"), F.col("doc_id"))
    return periodic.digests(periodic.periodic_runs(table(spark, d, "documents"), text))


@query
def op12_merkle(spark, d):
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    claim = F.when(tampered, merkle.leaf(ascii_lower(F.col("text")))).otherwise(merkle.leaf())
    rows = merkle.verified(table(spark, d, "documents"), claim)
    return rows.withColumn("proof_sha256", F.sha2(F.array_join("proof", ""), 256)).drop("proof")


@query
def op13_toxicity(spark, d):
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, d, "labels")))


# crc32 of a doc_id's digits, unsigned: eight steps of the reflected polynomial for each
CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
 lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
  lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295)"""

SQL: dict[str, str] = {
    "op11_periodic": f"""
WITH docs AS (SELECT doc_id, {CRC} AS h, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS ws FROM documents),
cut AS (SELECT *, len(ws) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) ELSE len(ws) END AS a FROM docs),
bent AS (SELECT doc_id, n, a, ws, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
words AS (SELECT doc_id, n, i, CASE WHEN i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS w
 FROM (SELECT *, unnest(range(n)) AS i FROM bent)),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i AND (y.i - x.i) * 4 <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS m FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s, m, min(q) AS q FROM stretches GROUP BY ALL),
listed AS (SELECT doc_id, count(*) AS n_runs, arg_min({{'s': s, 'm': m, 'q': q}}, {{'m': -m, 's': s, 'q': q}}) AS top,
 sha256(string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256 FROM runs GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + m)) AS i FROM runs),
left_over AS (SELECT doc_id, sha256(string_agg(w, ' ' ORDER BY i)) AS kept FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.m AS length, top.q AS period, top.m * 1000 // top.q AS exponent_milli,
 coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(kept, sha256('')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (doc_id) LEFT JOIN left_over USING (doc_id)
""",
    "op12_merkle": f"""
WITH RECURSIVE docs AS (SELECT doc_id, lang, text, {CRC} % 3 = 0 AS bad,
  coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
  || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM documents),
leaves AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  CASE WHEN bad THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
  ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS shown FROM docs),
langs AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees FROM leaves GROUP BY lang),
placed AS (SELECT doc_id, leaf, shown, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS i
  FROM leaves JOIN langs ON leaves.lang IS NOT DISTINCT FROM langs.lang),
low AS (SELECT 0 AS level, tree, i, n, leaf AS d FROM placed
  UNION ALL SELECT level + 1, tree, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY level, tree, i // 8, n),
subroots AS (SELECT tree, d AS subroot, level AS height FROM low WHERE n = 1),
high AS (SELECT 0 AS level, tree AS i, trees AS n, subroot AS d FROM subroots JOIN langs USING (tree)
  UNION ALL SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 8, n),
steps AS (
  SELECT p.doc_id, p.leaf, p.tree, p.i, low.level AS step, p.i // CAST(8 ** low.level AS BIGINT) AS own, low.i AS place, d FROM placed p JOIN low ON p.tree = low.tree
   AND low.n > 1 AND low.i // 8 = p.i // CAST(8 ** (low.level + 1) AS BIGINT)
  UNION ALL SELECT p.doc_id, p.leaf, p.tree, p.i, s.height + high.level, p.tree // CAST(8 ** high.level AS BIGINT), high.i, d FROM placed p JOIN subroots s USING (tree)
   JOIN high ON high.n > 1 AND high.i // 8 = p.tree // CAST(8 ** (high.level + 1) AS BIGINT)),
proofs AS (SELECT tree, i, sha256(coalesce(string_agg(d, '' ORDER BY step, place) FILTER (place <> own), '')) AS proof_sha256 FROM steps GROUP BY tree, i),
runs AS (SELECT tree, i, step, coalesce(string_agg(d, '' ORDER BY place) FILTER (place < own), '') AS before,
  coalesce(string_agg(d, '' ORDER BY place) FILTER (place > own), '') AS after FROM steps GROUP BY tree, i, step),
folds AS (SELECT tree, i, 0 AS step, shown AS d FROM placed
  UNION ALL SELECT f.tree, f.i, f.step + 1, sha256(before || d || after) FROM folds f JOIN runs USING (tree, i, step)),
folded AS (SELECT tree, i, arg_max(d, step) AS folded_root FROM folds GROUP BY 1, 2),
root AS (SELECT d AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (tree) JOIN folded USING (tree, i) LEFT JOIN proofs USING (tree, i) CROSS JOIN root
""",
    "op4_backoff": """
WITH docs AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \\t-\\r]+'), lambda w: w <> '') AS ws FROM documents),
words AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM docs),
pairs AS (SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM words),
own1 AS (SELECT doc_id, w, count(*) AS c FROM words GROUP BY ALL), all1 AS (SELECT w, sum(c) AS c FROM own1 GROUP BY ALL),
own2 AS (SELECT doc_id, before, w, count(*) AS c FROM pairs WHERE before IS NOT NULL GROUP BY ALL),
all2 AS (SELECT before, w, sum(c) AS c FROM own2 GROUP BY ALL),
per AS (SELECT doc_id, len(ws) AS n FROM docs),
seen AS (SELECT p.doc_id, all1.c - own1.c AS c1, b.c - ob.c AS c0, coalesce(all2.c - own2.c, 0) AS c2,
  greatest(1, (SELECT sum(n) FROM per) - per.n) AS rest
 FROM pairs p JOIN per USING (doc_id) JOIN all1 ON all1.w = p.w JOIN own1 ON own1.doc_id = p.doc_id AND own1.w = p.w
 LEFT JOIN all1 b ON b.w = p.before LEFT JOIN own1 ob ON ob.doc_id = p.doc_id AND ob.w = p.before
 LEFT JOIN all2 ON all2.before = p.before AND all2.w = p.w LEFT JOIN own2 ON own2.doc_id = p.doc_id AND own2.before = p.before AND own2.w = p.w),
scored AS (SELECT doc_id, c2 > 0 AND c0 > 0 AS pair, c1 = 0 AS unknown,
  CASE WHEN c2 > 0 AND c0 > 0 THEN ln(c2 / c0) ELSE ln(greatest(c1, 1) / rest) + ln(0.4) END AS s FROM seen)
SELECT doc_id, n AS n_words, coalesce(n_single, 0) AS n_single, coalesce(n_unknown, 0) AS n_unknown, coalesce(round(s, 4), 0) AS log_score
FROM per LEFT JOIN (SELECT doc_id, CAST(sum(CAST(NOT pair AS INT)) AS BIGINT) AS n_single, CAST(sum(CAST(unknown AS INT)) AS BIGINT) AS n_unknown,
  sum(s) AS s FROM scored GROUP BY 1) USING (doc_id)
""",
    "op7_embeddings": """
WITH RECURSIVE vectors AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM least
""",
}
