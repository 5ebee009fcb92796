from lapsekit.llm import url_filters as U

URLS = ["http://Www.Cheap-Pills.example.com/en/1", "https://x.org", "https://x.org/", "http://a.example.org/es/1?x",
        "http://example.org/en/12#t", "http://notexample.org/en/1", "http://a.com/fr/2", "http://a.com/de/",
        "http://spam-farm.example.net:80/x", "ftp://spam-farm.example.net", "no scheme", None, "", "://", "http://",
        "http://a.b.c.cheap-pills.example.net?q=/fr/", "http://ÄB.ORG/x", "a://b://c/d", "http://a.com/fr/\nx"]


def plain(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(r), r, v) for r, v in U.RULES
            if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0]))
            and path.startswith("/" + r.partition("/")[2])]
    bad = any(host == k or host.endswith("." + k) for k in listed)
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else "block" if bad else "allow"


def frame(spark, urls):
    return spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, verdict string")


def check(spark, urls, listed=None, **kw):
    df = None if listed is None else spark.createDataFrame([(k,) for k in listed], "key string")
    got = U.filter_urls(frame(spark, urls), df, **kw).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(urls[r["page_id"]], listed or U.LISTED), r


def test_rules_and_edges(spark):
    check(spark, URLS)
    check(spark, [])


def test_join_beyond_the_bound(spark):
    check(spark, URLS, max_bytes=10)


def test_cascade_is_exact_over_the_universe(spark, monkeypatch):
    monkeypatch.setattr(U, "CHUNK", 64)  # small chunks: filters as tight for few keys as for many
    names = [f"h{k}.net" for k in range(4000)]
    listed = names[::3] + ["never.seen.net", "net.", ""]
    urls = [f"http://{n}/x" for n in names] + [f"http://sub.{n}/" for n in names[:50]]
    check(spark, urls, [k for k in listed if k])
    uni = spark.createDataFrame([(n,) for n in names], "key string")
    levels = U.cascade(spark.createDataFrame([(n,) for n in listed], "key string"), uni)
    assert len(levels) >= 3  # false positives of several levels were encoded
    rows = uni.select("key", U.is_member(uni["key"], levels).alias("m")).collect()
    assert {r["key"] for r in rows if r["m"]} == set(names[::3])


def test_nothing_listed(spark):
    check(spark, URLS, ["nowhere.example"])
