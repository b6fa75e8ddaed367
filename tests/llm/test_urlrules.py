"""Operator 13 against every rule tried on every URL."""
import random

import pytest

from voltcube.llm import queries, urlrules

RULES = "host string, path string, verdict string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, rest = (rest[:min(ends)], rest[min(ends):]) if ends else (rest, "")
    for c in "?#":
        rest = rest.split(c, 1)[0]
    return host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), rest


def brute(url, rules, default="allow"):
    host, path = parts(url)
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else default


def judged(spark, urls, rules, **options):
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    out = urlrules.judge(df, spark.createDataFrame(rules, RULES), **options)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}


URLS = [None, "", "no scheme", "http://", "http://x.net", "http://x.net/", "HTTP://EXAMPLE.NET/en/a", "https://a.example.net/en/", "https://a.example.net/EN/",
        "https://example.com/de/x?y=/fr/", "https://bexample.com/de/", "https://x.org?q=/fr/", "https://x.org/fr/#top", "http://u:p@x.net:80/", "http://x.net:80/",
        "http://..net/", "http://x.net./", "a://b://c.net/", "http://é.net/en/é", "http://ÄX.net/", "http://" + "a." * 5000 + "net/" + "p/" * 5000, "http://x\n.net/a\nb", "http://org/fr/"]


def test_fixed_rules(spark):
    urls = URLS + URLS[:7]                      # repeated rows are judged each
    got = judged(spark, urls, queries.URL_RULES)
    assert got == {i: brute(u, queries.URL_RULES) for i, u in enumerate(urls)}


@pytest.mark.parametrize("broadcast", [True, False])
def test_random_rules(spark, monkeypatch, broadcast):
    rng = random.Random(5)
    label = lambda: rng.choice(["a", "b", "net", "org", "x-y"])
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "/".join(rng.choice(["", "en", "e", "de"]) for _ in range(rng.randint(0, 3)))
    rules = list({(h, p): (h, p, v) for h, p, v in ((host(), rng.choice(["", path()]), rng.choice(["block", "allow"])) for _ in range(40))}.values())
    urls = [f"http://{host()}{path()}{rng.choice(['', '?a', '#b'])}" for _ in range(400)] + ["http://a.net/en"] * 200
    if not broadcast:
        monkeypatch.setattr(urlrules, "BROADCAST", 0)
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_rules_that_repeat_or_are_empty(spark):
    rules = [("net", "/", "allow"), ("NET", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("org", None, "block")]
    got = judged(spark, ["http://a.net/", "http://a.com/", "http://org"], rules)
    assert [got[i][3] for i in range(3)] == ["block", "allow", "block"]
    assert judged(spark, ["http://a.net/"], [], default="block")[0] == ("a.net", "/", None, "block")
    assert judged(spark, [], rules) == {}


def test_short_prefixes_are_confirmed(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "PREFIX", 1)         # many expressions agree in a byte
    rules = [(f"h{i}", "/", "block") for i in range(0, 300, 2)]
    urls = [f"http://h{i}/" for i in range(300)]
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}
