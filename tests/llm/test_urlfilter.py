from llm_oracle import same

from strataforge.llm import urlfilter as U


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h) + len(p), len(h), v == "block", h + p) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], default if best is None else "block" if best[2] else "allow"


URLS = [None, "", "no scheme", "http://", "://x", "http://A.Example.COM/en/1", "https://www.example.com/en/1?x=/es/", "http://example.com", "http://example.com/en", "http://com/", "http://notexample.com/en/",
        "http://.com/x", "http://a..com/x", "http://x.net/es/a/b/c/", "http://x.net/fr#/es/", "http://x.net/private/page", "http://x.net/privateer", "http://u@x.net:80/es/", "http://É.net/es/\nzeile", "http://deep.a.b.c.d.net/es/" + "s/" * 3000, "ftp://x.net/es/"]
RULES = [*U.PAGE_RULES, ("x.net", "/private", "block"), ("x.net", "/private", "allow"), ("net", "/private/p", "allow"), ("", "/", "block"), ("a.b.c.d.net", "", "block"), ("c.d.net", "/es/s/s/s/s", "allow"), (None, "/", "block")]


def test_rules_and_edge_cases(spark):
    urls = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(3, URLS[5], "x", "y"), (None, URLS[5], "x", "y")]
    df = spark.createDataFrame(urls, "page_id long, url string, host string, rule_key string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted(map(tuple, U.judge_urls(df, rules, keep=["page_id"]).collect()), key=repr)
    want = sorted(((i, *brute(u, [r for r in RULES if r[0]])) for i, u, *_ in urls), key=repr)
    assert got == want
    none = U.judge_urls(df, rules.limit(0), keep=["page_id"], default="block").collect()
    assert len(none) == len(urls) and {(r.rule, r.verdict) for r in none} == {(None, "block")}
    assert U.judge_urls(df.limit(0), rules, keep=["page_id"]).count() == 0


def test_shuffled_rules_give_the_same(spark, sf, monkeypatch):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = sorted(map(tuple, U.page_verdicts(pages).collect()))
    monkeypatch.setattr(U, "MOST_RULES", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, U.page_verdicts(pages).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sql(spark, sf):
    same(U.page_verdicts(spark.read.parquet(f"{sf}/pages.parquet")), U.page_verdicts_sql(), sf)


def test_clashing_names_are_refused(spark):
    import pytest

    from strataforge.llm import simhash

    df = spark.createDataFrame([(1, "http://a.b/")], "Rule long, url string")
    rules = spark.createDataFrame([("b", "/", "block")], "host string, path string, verdict string")
    with pytest.raises(ValueError, match="clash"):
        U.judge_urls(df, rules, keep=["Rule"])
    with pytest.raises(ValueError, match="fp"):
        simhash.near_duplicate_classes(df.withColumnRenamed("Rule", "fp"), "fp", "url")


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    import pytest

    from strataforge.llm import common

    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)
