"""URL filter: host/path rules, then a list of canonical URLs.

A URL that no rule fits is looked up in the list: a blocked Bloom filter of
the listed canonical URLs lets possible hits through to an exact hash join,
which removes the false positives.  Everything is DataFrame functions.

Defined results: a null URL or one without ``://`` has an empty host and
path, fits no rule and is not listed, so it is allowed; null entries and
repeated entries of the list change nothing; an empty list blocks nothing;
repeated pages are judged one by one; a very long url is read whole, inside
its row; other columns pass through, but ``host``, ``path``, ``rule`` and
``verdict`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm import bloom
from tablework.llm.common import handover, lower_ascii, need, pack, unpack

#: (verdict, host, path)
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at == 0, "").otherwise(F.substr(F.coalesce(url, F.lit("")), at + 3))


def canonical(url: Column) -> Column:
    """host + path + query of a URL with the differences removed that do not
    change the page: scheme, upper case and one leading ``www.`` of the host,
    default ports, trailing slashes, fragment, and the query parameters
    ``ref`` and ``utm_*``; null where there is no ``://`` or no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&", -1),
                                 lambda p: ~p.rlike(r"^(ref|utm_[^=]*)(=.*)?$") & (p != "")), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    _, h, p = rule
    return ((host == h) | host.endswith("." + h)) & path.startswith(p)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits, else nulls.
    Of rules of one length the one with the longer host wins."""
    name = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):   # the longest test ends up outermost
        name = F.when(fits(rule, host, path), rule[1] + rule[2]).otherwise(name)
        verdict = F.when(fits(rule, host, path), rule[0]).otherwise(verdict)
    return name, verdict


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (),
                url: str = "url", listed_url: str = "url",
                bits_per_key: int = bloom.BITS_PER_KEY) -> DataFrame:
    """pages plus ``host``, ``path``, ``rule``, ``verdict`` (allow or block).

    ``listed`` holds URLs to block in a column of that name.  The list is
    made canonical, distinct, and written once; only pages that no rule
    judges and that the Bloom filter lets through meet it in the exact join,
    whose large partitions Spark may split."""
    need(listed, listed_url)
    entries = handover(listed.select(canonical(F.col(listed_url)).alias("entry"))
                       .filter(F.col("entry").isNotNull()).distinct(), "listed-urls")
    table, blocks = bloom.build(entries, "entry", entries.count(), bits_per_key)
    name, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    judged = (pack(pages, url).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
              .withColumns({"rule": name, "verdict": verdict,
                            "canonical": F.when(verdict.isNull(), canonical(F.col(url)))}).drop(url))
    probed = bloom.probe(judged, F.col("canonical"), table, blocks)
    sure = probed.filter(~F.col("maybe")).withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    possible = (probed.filter("maybe")
                .join(entries.hint("shuffle_hash"), F.col("canonical") == F.col("entry"), "left")
                .withColumn("verdict", F.when(F.col("entry").isNotNull(), "block").otherwise("allow"))
                .drop("entry"))
    return unpack(sure.unionByName(possible), **{c: F.col(c) for c in ("host", "path", "rule", "verdict")})
