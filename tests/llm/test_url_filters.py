from pyspark.sql import functions as F
from tidewatch.llm.url_filters import Rule, build_cascade, judge_urls

RULES = [
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"),
]
URLS = [
    "http://A.Example.NET/en/x?y#z", "http://example.net/de/", "https://notexample.net/en/", "http://x.net",
    "http://x.net?q=/en/", "http://example.com/de/a", "http://sub.example.com/de", "http://a.org/fr/1#top",
    "no scheme/x", "", None, "http://", "http:///path", "a://b.org/fr/://c", "http://É.com/de/é\nx",
    "http://bad.com/", "http://bad.com/", "http://fine.com/de/", "ftp://bad.com?x",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:stop], rest[stop:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def brute(url):
    host, path = parts(url)
    fits = [
        r for r in RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.name), default=None)
    if best:
        return host, path, best.name, best.verdict
    return host, path, None, "block" if host == "bad.com" else "allow"


def frame(spark, urls):
    rows = [(k, u, "x", 1) for k, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule int")


def test_verdicts(spark):
    listed = spark.createDataFrame([("bad.com",), ("absent.com",), (None,)], "key string")
    wanted = [brute(u) for u in URLS]
    for bits in (1 << 20, 0):  # by cascade, and by the join that a too large one gives way to
        got = judge_urls(frame(spark, URLS), RULES, listed, bits).orderBy("page_id").collect()
        assert [(r.host, r.path, r.rule, r.verdict) for r in got] == wanted
    none = listed.where("false")
    assert judge_urls(frame(spark, URLS), RULES, none).where("verdict = 'block'").count() == sum(
        w[3] == "block" and w[2] is not None for w in wanted
    )
    assert judge_urls(frame(spark, []), RULES, listed).count() == 0


def test_keys_with_paths(spark):
    listed = spark.createDataFrame([("bad.com/",), ("fine.com/de/",), ("fine.com",), (None,)], "key string")
    wanted = [brute(u) for u in URLS]
    wanted = [
        (h, p, rule, v if rule else "block" if h + p in ("bad.com/", "fine.com/de/") else "allow")
        for h, p, rule, v in wanted
    ]
    for bits in (1 << 20, 0):
        got = judge_urls(frame(spark, URLS), RULES, listed, bits, by_path=True).orderBy("page_id").collect()
        assert [(r.host, r.path, r.rule, r.verdict) for r in got] == wanted
    # a host without its path is another key
    assert {r.verdict for r in got if r.host == "bad.com" and r.path == ""} == {"allow"}


def test_cascade_is_exact(spark):
    universe = spark.range(30_000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("cast(key as int) % 9 = 4")
    cascade = build_cascade(universe, listed)
    assert len(cascade.levels) > 2
    wrong = universe.where(cascade.listed(F.col("key")) != (F.col("key").cast("int") % 9 == 4))
    assert wrong.isEmpty()
