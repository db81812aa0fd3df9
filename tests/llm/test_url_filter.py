"""Verdicts against a plain scan of all rules; nested and odd rules and URLs."""

import random

import pytest

from tallyroll.llm.url_filter import rule_table, url_filter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[at:]
    end = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return rest[:at].translate(UPPER_TO_LOWER), path[:end]


def judged(url, rules, default="allow"):
    host, path = parts(url)
    fits = {}
    for rule_host, rule_path, action in rules:
        rule_host, rule_path = (rule_host or "").translate(UPPER_TO_LOWER), rule_path or ""
        if rule_host and not set("/?#") & set(rule_host) and not set("?#") & set(rule_path):
            if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
                key = (len(rule_host + rule_path), len(rule_host), rule_host + rule_path)
                fits[key] = max(fits.get(key, ""), action)
    best = max(fits, default=None)
    return host, path, best and best[2], fits[best] if best else default


def run(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = url_filter(pages, rule_table(spark, rules), **options).collect()
    assert len(rows) == len(urls)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: tuple(r)[1:] for r in url_filter(pages, rule_table(spark, RULES)).collect()}
    assert got == {r.page_id: judged(r.url, RULES) for r in pages.collect()}


@pytest.mark.parametrize("seed", [0, 1])
def test_nested_rules(spark, seed):
    rng = random.Random(seed)

    def host():
        return ".".join(rng.choice(["a", "b", "ab", "é", "-", ""]) for _ in range(rng.randint(1, 5)))

    def path():
        return "".join(rng.choice(["/", "a", "b", "/a", "ü", "\U0001f600", "."]) for _ in range(rng.randint(0, 6)))

    rules = [(host(), rng.choice(["", "/"]) + path(), rng.choice(["allow", "block"])) for _ in range(150)]
    urls = [f"http://{host()}{rng.choice(['', '/'])}{path()}{rng.choice(['', '?q=/a', '#x'])}" for _ in range(400)]
    got = run(spark, urls, rules)
    for i, url in enumerate(urls):
        assert got[i] == judged(url, rules), url


def test_odd_urls_and_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "http:///p", "HTTP://EXAMPLE.Net/EN/x", "http://example.net/en/x", "http://net", "http://net?/", "http://net/", "http://xnet/",
        "http://a.example.com:80/de/", "http://u@b.example.com/de/?x", "a://b://net/", "http://x.org/fr/#y", "http://x.org/fr", "http://net./", "http://.net/", "http://É.net/", "http://k.net/\n?",
        "http://net/" + "x" * 100_000, "http://net/", "http://net/",
    ]
    rules = [*RULES, ("", "/", "block"), (None, None, "block"), ("net", "/?", "allow"), ("a/b", "/", "allow"), ("ORG", "/fr/", "block"), ("é.net", None, "allow")]
    got = run(spark, urls, rules, default="unknown")
    for i, url in enumerate(urls):
        assert got[i] == judged(url, rules, "unknown"), url


def test_many_rules_of_one_host_and_many_copies(spark):
    rules = [("h.com", f"/{i:04d}/", "block") for i in range(2000)] + [("com", "/", "allow")]
    urls = [f"http://w.h.com/{i % 3:04d}/x" for i in range(3000)]
    got = run(spark, urls, rules)
    assert set(got.values()) == {("w.h.com", f"/{i:04d}/x", f"h.com/{i:04d}/", "block") for i in range(3)}


def test_empty_tables_and_other_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (None, "http://a.net/"), (1, "http://a.net/")], "page_id long, url string")
    pages = pages.selectExpr("*", "'q' as host", "1 as rule", "2 as key", "3 as path", "4 as action")
    rows = [tuple(r) for r in url_filter(pages, rule_table(spark, RULES)).collect()]
    assert sorted(rows, key=str) == sorted([(1, "a.net", "/", "net/", "block")] * 2 + [(None, "a.net", "/", "net/", "block")], key=str)
    assert url_filter(pages.limit(0), rule_table(spark, RULES)).collect() == []
    assert {r.verdict for r in url_filter(pages, rule_table(spark, RULES).limit(0)).collect()} == {"allow"}


def test_large_dimensions_are_met_by_shuffle(spark, monkeypatch):
    import tallyroll.llm.url_filter as module

    plain = module.lookup_join
    monkeypatch.setattr(module, "lookup_join", lambda *a, **b: plain(*a, **b, broadcast_bytes=0))
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    urls = ["http://w.example.net/en/1"] * 300 + [f"http://h{i}.example.com/de/{i}" for i in range(300)]
    got = run(spark, urls, RULES)
    assert all(got[i] == judged(u, RULES) for i, u in enumerate(urls))


def test_native(spark, sf_dir):
    text = url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark, RULES))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
