import random

from pyspark.sql import functions as F

from tablework.llm import bloom, url_filter
from tablework.llm.queries import URL_RULES

PAGES = [(1, "http://a.example.net/en/x"), (2, "https://a.example.net/de/x"), (3, "HTTP://www.Example.COM/de/1?x=1"),
         (4, "http://example.com/fr/1"), (5, "x://org/fr/"), (6, "ftp://ORG/en"), (7, None), (8, ""), (9, "no scheme"),
         (10, "http://notexample.net"), (11, "http://evil.com/a/?utm_source=x&ref=2#top"), (12, "https://www.evil.com/a"),
         (13, "http://evil.com/a?b=1"), (14, "http://evil.com:80/a/"), (15, "http://evil.com/ab"), (11, None),
         (16, "http://example.net/en/"), (17, "http://example.net"), (None, "http://evil.com/a")]


def plain(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3:]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit, key=lambda r: len(r[0]), default=None)


def test_rules_and_list(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string").withColumns(
        {"host": F.lit("mine"), "maybe": F.lit(1), "row": F.lit(2), "canonical": F.lit("c")})
    listed = spark.createDataFrame([("http://evil.com/a",), ("https://www.evil.com/a/",), (None,), ("junk",)], "url string")
    rows = url_filter.filter_urls(pages, listed, URL_RULES).collect()
    assert len(rows) == len(PAGES)
    assert rows[0].maybe == 1 and rows[0].row == 2 and rows[0].canonical == "c"
    for r in rows:
        host, path, rule = plain(r.url)
        blocked = {11, 12, 14, None}
        want = rule[1] if rule else ("block" if r.page_id in blocked and r.url else "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule[0] if rule else None, want), r


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    some = spark.createDataFrame(PAGES, "page_id long, url string")
    assert url_filter.filter_urls(none, some, URL_RULES).collect() == []
    assert {r.verdict for r in url_filter.filter_urls(some, none).collect()} == {"allow"}


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    random.seed(3)
    keys = [f"k{i}" for i in range(5000)]
    inside = spark.createDataFrame([(k,) for k in keys], "k string")
    table, blocks = bloom.build(inside, "k", len(keys))
    both = inside.withColumn("real", F.lit(True)).unionAll(
        spark.range(5000).select(F.concat(F.lit("other"), "id"), F.lit(False)))
    for bound in (1 << 20, 0):                      # broadcast, and joined on the block
        got = bloom.probe(both, F.col("k"), table, blocks, bound=bound)
        counts = {(r.real, r.maybe): r["count"] for r in got.groupBy("real", "maybe").count().collect()}
        assert counts[True, True] == 5000 and (True, False) not in counts
        assert counts.get((False, True), 0) < 50
