import re

from voicecorpus.llm import urlfilter as U

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/5?q#f", "x://example.com/en/77", "https://a.example.com/en/7", "http://notexample.com/en/7",
    "http://b.net/de/8", "http://example.net/de/81", "http://x.example.net/de/7", "http://org/es/", "http://a.org/es", "http://www.bad.io/p/", "http://bad.io/p?x", "http://bad.io/p#y",
    "http://bad.io", "http://bad.io/", "a://b://c/d", "http://ÄB.com/en/\n", "http://bad.io/p", "x" * 50000 + "://bad.io/p" + "/y" * 20000,
]


def brute(url, listed):
    host, path, rule, verdict = "", "", None, None
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1])
        path = m[2]
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
    else:
        c = (host[4:] if host.startswith("www.") else host) + (path[:-1] if path.endswith("/") else path)
        verdict = "block" if host and c in listed else "allow"
    return host, path, rule, verdict


def test_matches_brute_force_and_the_filter_loses_nothing(spark):
    listed = {"bad.io/p", "bad.io"} | {f"n{i}.io/p" for i in range(3000)}
    urls = URLS + [f"http://n{i}.io/p" for i in range(0, 6000)]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    lst = spark.createDataFrame([(x,) for x in [*listed, *listed, None]], "curl string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df, lst).collect()}
    assert got == {i: brute(u, listed) for i, u in enumerate(urls)}


def test_filter_rejects_most(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(4000)], "curl string")
    table, n = U.bloom(keys, 4000)
    probes = spark.createDataFrame([(f"q{i}",) for i in range(4000)], "curl string")
    j = probes.withColumn("b", U._block(U.F.col("curl"), U.F.lit(n))).join(table, "b")
    cond = U.F.lit(True)
    for i, bit in enumerate(U._bits(U.F.col("curl"))):
        cond = cond & (U.F.col(f"w{i}").bitwiseAND(bit) != 0)
    assert j.where(cond).count() < 200 and table.count() <= n == 250


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    lst = spark.createDataFrame([], "curl string")
    assert U.judge(none, lst).collect() == []
    assert U.judge(spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string"), lst).first().verdict == "allow"
