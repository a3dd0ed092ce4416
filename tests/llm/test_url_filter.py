"""URL filter: rules by brute force, and the cascade against sets."""

import random

import pytest
from pyspark.sql import functions as F

from feedrecon.llm import url_filter as U


def verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:end], rest[end:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


URLS = [None, "", "no scheme", "http://", "http://net", "http://NET/", "https://a.net/x?y=/z", "http://x.Example.NET/en/1#t",
        "http://example.net/en", "http://example.net/en/", "ftp://notexample.net/en/", "http://example.com/de/x", "http://org/fr/",
        "http://a.b.c.org/fr/é", "http://É.org/fr/", "x://y://example.com/de/", "http://example.com?/de/", "http://a.net\n/x",
        "http://" + "a." * 3000 + "net/" + "p" * 20000, "://net/", "http://u@net/", "http://net:80/", "http://.net/"]


def test_registered_rules(spark):
    rows = list(enumerate(URLS)) + [(3, URLS[3]), (None, URLS[6])]
    df = spark.createDataFrame([(*r, "h", "r") for r in rows], "page_id long, url string, host string, rule string")
    got = U.filter_urls(df, U.rules_table(spark, U.RULES)).collect()
    key = lambda x: str(x)
    assert sorted([tuple(r) for r in got], key=key) == sorted([(i, *verdict(u, U.RULES)) for i, u in rows], key=key)


@pytest.mark.parametrize("max_keys", [10 ** 6, 5])
def test_many_rules_and_the_way_beyond_the_bound(spark, max_keys):
    rng = random.Random(1)
    hosts = [f"{a}.{b}" for a in ("x", "y", "zz") for b in ("com", "net", "org")] + ["com", "a.x.com"]
    rules = sorted({(rng.choice(["block", "allow"]), rng.choice(hosts), rng.choice(["/", "/a", "/a/b/", ""])) for _ in range(40)})
    rules = list({(h, p): (v, h, p) for v, h, p in rules}.values())
    urls = [(i, f"http://{rng.choice(['', 'w.', 'a.', 'q.a.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/a/b/c', '/ab', '/b'])}") for i in range(300)]
    got = U.filter_urls(spark.createDataFrame(urls, "page_id long, url string"), U.rules_table(spark, rules), max_keys=max_keys)
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, *verdict(u, rules)) for i, u in urls)


def test_cascade_is_exact_over_its_universe(spark):
    """Small filters make false positives, so several levels are built."""
    listed = spark.range(300).select(F.concat(F.lit("l"), "id").alias("key"))
    universe = spark.range(40000).select(F.concat(F.when(F.col("id") < 300, F.lit("l")).otherwise(F.lit("u")), "id").alias("key"))
    c = U.build_cascade(listed, universe)
    assert len(c.levels) >= 3 and sum(x.bits for x in c.levels) < 40 * 300
    wrong = universe.where(c.contains(F.col("key")) != F.col("key").startswith("l")).count()
    assert wrong == 0


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert U.filter_urls(empty, U.rules_table(spark, U.RULES)).count() == 0
    got = U.filter_urls(spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string"), U.rules_table(spark, [])).collect()
    assert [tuple(r) for r in got] == [(1, "a.net", "/", None, "allow")]
