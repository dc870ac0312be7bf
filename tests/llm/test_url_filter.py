import itertools
import math

from watchmill.llm import url_filter as U

SCHEMA = "page_id long, url string, html string"
URLS = [
    "https://Blog.Cheap-Pills.Example.org/en/1?x=1", "http://cheappills.example.org/x", "http://a.example.net/en/2", "http://a.example.net/EN/2", "http://net/", "http://net",
    "http://x.net?en", "http://b.example.com/de/", "http://b.example.com/de", "http://myexample.com/de/", "http://w.org/fr/x#y", "org/fr/", None, "", "no scheme", "x://y://z.net/p",
    "http://the.garden.example.org/flower", "http://thegarden.example.org/", "http:///path/only", "http://garden.example.org/#x", "http://casino.example.org/", "http://q\nr.net/a\nb?c",
]


def brute_place(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = "".join(itertools.takewhile(lambda c: c not in "/?#", rest))
    path = "".join(itertools.takewhile(lambda c: c not in "?#", rest[len(host) :]))
    return "".join(c.lower() if c.isascii() else c for c in host), path


def brute_rule(host, path):
    fits = []
    for verdict, rule in U.RULES:
        name, slash, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
            fits.append((len(rule), rule, verdict))
    return max(fits, default=(0, None, None))[1:]


def pages(spark, urls=URLS):
    html = "<p>the garden has a flower and cheap pills</p><script>var casino</script>"
    return spark.createDataFrame([(i, u, html if i % 3 else None) for i, u in enumerate(urls)], SCHEMA)


def test_places_and_rules(spark):
    got = {r.page_id: r for r in U.judge(pages(spark)).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = brute_place(url)
        rule, verdict = brute_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or got[i].verdict) and got[i].verdict in ("allow", "block")


def test_unwanted_words_block(spark):
    got = {r.url: r.verdict for r in U.judge(pages(spark)).join(pages(spark), "page_id").collect()}
    assert got[URLS[0]] == got[URLS[1]] == "block"
    assert got["http://the.garden.example.org/flower"] == got["http://garden.example.org/#x"] == got[None] == got[""] == "allow"


def test_viterbi_is_the_best_split():
    counts = {"a": 50, "ab": 9, "abc": 4, "b": 20, "bc": 30, "c": 7, "cab": 2}
    total = 200.0
    cost = lambda w: math.log(counts[w] / total) if w in counts else math.log(0.1 / total) - len(w) * math.log(10)
    for n in range(1, 7):
        for run in map("".join, itertools.product("abcx", repeat=n)):
            splits = [[run[i:j] for i, j in zip((0, *cut), (*cut, n))] for k in range(n) for cut in itertools.combinations(range(1, n), k)]
            found = [(s, k, counts[run[s : s + k]]) for s in range(n) for k in range(1, n - s + 1) if run[s : s + k] in counts]
            got = U.best_split(run, found, total)
            assert "".join(got) == run and math.isclose(sum(map(cost, got)), max(sum(map(cost, s)) for s in splits))


def test_scores_are_naive_bayes(spark):
    rows = [("h1", "p", w, f"h:{w}") for w in ("cheap", "pills")] + [("h2", "p", w, f"h:{w}") for w in ("cheap", "garden", "garden")] + [("h3", "p", "pills", "h:pills")]
    got = {r.host: r.score for r in U.bayes(spark.createDataFrame(rows, "host string, path string, word string, token string")).collect()}
    bad, good = {"cheap": 1, "pills": 2}, {"cheap": 1, "garden": 2}
    odds = {t: math.log((bad.get(t, 0) + 1) / (3 + 3)) - math.log((good.get(t, 0) + 1) / (3 + 3)) for t in ("cheap", "pills", "garden")}
    want = {"h1": odds["cheap"] + odds["pills"], "h2": odds["cheap"] + 2 * odds["garden"], "h3": odds["pills"]}
    assert all(math.isclose(got[h], w + math.log(2 / 1), abs_tol=1e-6) for h, w in want.items())


def test_odd_tables(spark):
    long = "http://" + "verylongname" * 500 + ".example.org/" + "x" * 20_000
    df = pages(spark, [long, *URLS[:3], URLS[0], None]).selectExpr("*", "'z' AS host", "'z' AS path", "1 AS word", "2 AS run", "3 AS score")
    got = U.judge(df).collect()
    assert len(got) == 6 and sorted(r.host for r in got)[0] == "" and long[7:].partition("/")[0] in {r.host for r in got}
    assert U.judge(spark.createDataFrame([], SCHEMA)).collect() == []
