import re

from strikepath.llm import urls

PAGES = "page_id bigint, url string, host string, rule string, features string"
URLS = [
    "https://WWW.Example.com/en/1?x#y", "http://a.example.com/en/2", "http://example.com/en", "http://example.com/de/", "http://notexample.net/es/3", "http://net/fr/x",
    "http://x.org/en/", "no scheme", None, "", "http://a.com", "ftp://A.ÉXAMPLE.com/é/ü?q=/://z", "http://b.net#/es/", "http://c.net?x/fr/",
]


def brute(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", "r", "f") for i, u in rows], PAGES)


def test_rules_equal_brute_force(spark):
    rows = [*enumerate(URLS), (0, URLS[0])]
    out = urls.judge(pages(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule = brute(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.name if rule else None)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")
    assert urls.judge(pages(spark, [])).count() == 0


def test_model_learns_words_of_hosts_it_has_not_seen(spark):
    words = "harbour valley painter summit orchard lantern meadow copper willow canyon".split()
    rows = [(i, f"https://{w}-{i}.example.org/en/{i}") for i, w in enumerate(words * 200)]
    rows += [(10_000 + i, f"https://{w}.example.org/en/{i}") for i, w in enumerate(("casino-night", "best-poker-now", "adult-zone", "free-pills24"))]
    out = {r["page_id"]: r["verdict"] for r in urls.judge(pages(spark, rows)).collect()}
    assert sum(out[10_000 + i] == "block" for i in range(4)) >= 3
    assert sum(out[i] == "block" for i in range(2000)) <= 10


def test_without_both_verdicts_no_model_is_trained(spark):
    only = spark.createDataFrame([("http://a.org/", True)], "url string, blocked boolean")
    out = urls.judge(pages(spark, [(1, "http://b.org/"), (2, "http://b.net/es/")]), only).collect()
    assert {r["page_id"]: r["verdict"] for r in out} == {1: "allow", 2: "block"}
