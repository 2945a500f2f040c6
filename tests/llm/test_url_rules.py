import random

from spendlake.llm import url_rules as U
from tests.llm.helpers import rows

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("a.b.c", "", "block"), ("B.C", "/x", "allow"), ("b.c", "/x", "block"), (None, "/", "block"), ("", "/", "block"), ("net", None, "block"), ("d", "/", "maybe")]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        rest = rest[cut:]
        cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
        path = rest[:cut]
    best = None
    for h, p, v in RULES:
        h, p = (h or "").lower(), p or ""
        if h and v in ("allow", "block") and host and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(h + p), len(h), v == "block", h + p, v))
    return host, path, best and best[3], best[4] if best else "allow"


def test_matches_brute_force(spark):
    rng = random.Random(1)
    hosts = ["x.example.org", "example.org", "badexample.org", "EXAMPLE.ORG", "a.b.c", "z.a.b.c", "b.c", "q.b.c", "com", "m.com", "x.net", "", "u@h:80", "d", ".org", "org.", "É.org"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/en/2", "/fr/x", "/x", "/xy/z", "/a?b/c", "#/es/", "?x=/es/", "/a#b?c", "/" + "y" * 50_000, "/né"]
    urls = [None, "", "no scheme", "://", "http://", "a://b://c"] + [f"http{rng.choice(['', 's'])}://{h}{p}" for h in hosts for p in paths]
    df = spark.createDataFrame([(i, u, "t", "h") for i, u in enumerate(urls + urls[:20])], "page_id long, url string, rule string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert rows(U.url_verdicts(df, rules)) == sorted(((i, *brute(u)) for i, u in enumerate(urls + urls[:20])), key=repr)


def test_many_shapes_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_SHAPES", 1)
    urls = ["http://x.example.org/es/1", "http://q.a.b.c", "http://a.b.c/", "http://com/fr/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert rows(U.url_verdicts(df, rules)) == sorted(((i, *brute(u)) for i, u in enumerate(urls)), key=repr)
    assert U.url_verdicts(df.limit(0), rules).collect() == []
    assert rows(U.url_verdicts(df, rules.limit(0)), "rule", "verdict") == [(None, "allow")] * 4
