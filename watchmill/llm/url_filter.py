"""Operator 3: judge urls by rules, else by words in the host and path.

Host and path names are runs of letters that often hide several words. A unigram model of the pages' words splits
each different run by Viterbi's algorithm; multinomial naive Bayes then scores the words. Its training labels are weak:
a url one of whose words is a seed word counts as unwanted. All counts are over all different (host, path).
"""

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchmill.llm.common import ascii_lower
from watchmill.session import written

# fixed values: rules as (verdict, host and path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# fixed values: words that mark an unwanted site
SEED_WORDS = (
    "adult", "ads", "bet", "bets", "betting", "bingo", "casino", "escort", "gambling", "hentai", "jackpot", "malware", "nude",
    "payday", "phishing", "pill", "pills", "poker", "porn", "sex", "slots", "spam", "torrent", "track", "tracker", "viagra",
    "warez", "webcam", "xxx",
)
LONGEST_WORD = 20
# a run of more letters is cut into blocks of this many; no name in a host may be longer
LONGEST_RUN = 64
SEED_COUNT = 1000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty if the url is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def by_rule(places: DataFrame, rules=RULES) -> DataFrame:
    """``host, path, rule, ruled`` for those (host, path) that a rule fits; the longest rule wins."""
    parts = [(verdict, rule, *rule.partition("/")[::2]) for verdict, rule in rules]
    known = places.sparkSession.createDataFrame(
        [(verdict, rule, host, f"/{path}" if "/" in rule else "") for verdict, rule, host, path in parts],
        "ruled string, rule string, suffix string, prefix string")
    names = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, i, F.size(names)), "."))
    fits = places.select("host", "path", F.explode(F.array_distinct(above)).alias("suffix")).join(known, "suffix").filter(
        F.startswith("path", "prefix"))
    best = F.max_by(F.struct("rule", "ruled"), F.struct(F.length("rule"), "rule"))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.ruled")


def word_counts(pages: DataFrame) -> DataFrame:
    """``word, n``: words of at most 20 letters in the pages' texts, tags, scripts and styles left out; seeds added."""
    text = F.regexp_replace(F.lower("html"), r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&[a-z0-9#]+;", " ")
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"))).alias("word")).filter(F.length("word") <= LONGEST_WORD)
    seeds = pages.sparkSession.createDataFrame([(w, SEED_COUNT) for w in SEED_WORDS], "word string, n long")
    return words.groupBy("word").agg(F.count("*").alias("n")).union(seeds).groupBy("word").agg(F.sum("n").alias("n"))


def _runs(c: Column) -> Column:
    found = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}{1,%d})" % LONGEST_RUN))
    return F.coalesce(found, F.array().cast("array<string>"))


def runs(places: DataFrame) -> DataFrame:
    """``host, path, side, run``: runs of letters of the host (its last name left out) and of the path."""
    front = F.regexp_replace("host", r"\.[^.]*$", "")
    tagged = F.concat(
        F.transform(_runs(front), lambda r: F.struct(F.lit("h").alias("side"), r.alias("run"))),
        F.transform(_runs(F.col("path")), lambda r: F.struct(F.lit("p").alias("side"), r.alias("run"))))
    return places.select("host", "path", F.explode(tagged).alias("t")).select("host", "path", "t.side", "t.run")


def best_split(run: str, found, total: float) -> list[str]:
    """The likeliest words. ``found``: (start, length, count) of known words in the run; others cost 10x a letter."""
    n = len(run)
    scores, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    known = {(s, s + k): math.log(c / total) for s, k, c in found}
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            score = scores[start] + known.get((start, end), math.log(0.1 / total) - (end - start) * math.log(10))
            if score > scores[end]:
                scores[end], back[end] = score, start
    words, end = [], n
    while end:
        words.append(run[back[end] : end])
        end = back[end]
    return words[::-1]


def segmented(different: DataFrame, counts: DataFrame) -> DataFrame:
    """``run, words`` for every different ``run``: only its own substrings of known counts go to its Viterbi search."""
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    starts = F.sequence(F.lit(0), F.length("run") - 1)
    sizes = F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("run") - F.col("start")))
    cut = different.select("run", F.explode(starts).alias("start")).select("run", "start", F.explode(sizes).alias("size"))
    cut = cut.withColumn("word", F.substr("run", F.col("start") + 1, F.col("size")))
    hits = cut.join(counts, "word").groupBy("run").agg(F.collect_list(F.struct("start", "size", "n")).alias("found"))

    @F.pandas_udf("array<string>")
    def split(run: pd.Series, found: pd.Series) -> pd.Series:
        rows = zip(run, found)
        return pd.Series([best_split(r, [] if f is None else [(x["start"], x["size"], x["n"]) for x in f], total) for r, f in rows])

    return different.join(hits, "run", "left").select("run", split("run", "found").alias("words"))


def bayes(tokens: DataFrame, smooth: float = 1.0) -> DataFrame:
    """``host, path, score``: log odds of unwanted. ``tokens``: ``host, path, word, token``."""
    marked = F.max(F.col("word").isin(*SEED_WORDS).cast("int")).alias("bad")
    labels = tokens.groupBy("host", "path").agg(marked)
    named = tokens.join(labels, ["host", "path"])
    bad, good = labels.agg(F.sum("bad"), F.sum(1 - F.col("bad"))).first()
    per = written(named.groupBy("token").agg(F.sum("bad").alias("b"), F.sum(1 - F.col("bad")).alias("g")), "tokens")
    all_b, all_g, kinds = per.agg(F.sum("b"), F.sum("g"), F.count("*")).first()
    if not bad or not good:
        return labels.select("host", "path", F.lit(-1.0).alias("score"))
    odds = F.log((F.col("b") + smooth) / (all_b + smooth * kinds)) - F.log((F.col("g") + smooth) / (all_g + smooth * kinds))
    weights = per.select("token", odds.alias("odds"))
    sums = tokens.join(weights, "token").groupBy("host", "path").agg(F.sum("odds").alias("sum"))
    return sums.select("host", "path", (F.round("sum", 9) + math.log(bad / good)).alias("score"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages``.

    The verdict is the rule's if one fits, else ``block`` if the words' log odds are above 0. A null url, or one without
    ``://``, has an empty host and path, no words and is allowed, as is every place without words. A null html adds no
    words. Repeated rows stay repeated; urls of one host and path are judged once. Empty table: no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    places = written(rows.select("host", "path").distinct(), "places")
    counts = written(word_counts(pages), "words")
    pieces = written(runs(places), "runs")
    words = segmented(pieces.select("run").distinct(), counts)
    tokens = written(
        pieces.join(words, "run").select("host", "path", "side", F.explode("words").alias("word"))
        .withColumn("token", F.concat_ws(":", "side", "word")), "named")
    judged = places.join(by_rule(places, rules), ["host", "path"], "left").join(bayes(tokens), ["host", "path"], "left")
    own = F.when(F.coalesce("score", F.lit(-1.0)) > 0, "block").otherwise("allow")
    judged = judged.select("host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
    return rows.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "score")
