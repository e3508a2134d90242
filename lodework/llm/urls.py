"""URL filter: host rules, then a weighted vocabulary.

A rule names a host and the begin of a path and fits the host and all its subdomains; the
longest that fits decides. Other urls are searched for the vocabulary by Aho-Corasick, in
one pass for all terms. A term counts where no ASCII letter or digit stands beside it, in
any case of A-Z. One strict term blocks a url, and so do ``SOFT`` different soft terms.

NULL urls and urls without ``://`` have an empty host and path, so no rule fits; NULL
urls are allowed, others are still searched. Each row stands for itself: repeated rows,
NULL ids, long urls, empty tables and extra columns need no care.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
STRICT = ("porn", "porno", "xxx", "hentai", "camgirls", "escorts", "warez", "keygen", "spam-farm", "spam", "linkfarm")
SOFT_TERMS = ("adult", "sex", "sexy", "nude", "dating", "casino", "poker", "betting", "bet", "jackpot", "viagra", "pills",
              "replica", "torrent", "crack", "coupon", "lottery", "loan", "ads", "affiliate")
SOFT = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BESIDE = re.compile("[a-z0-9]")


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, as between the first ``://`` and the query or fragment."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, "(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*(/[^?#]*)?", 1)
    return lowered(host), path


def rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; NULL without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, ruled, begin in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == ruled) | host.endswith("." + ruled)) & path.startswith(begin)
        name, verdict = F.when(fits, ruled + begin).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def terms(url: Column, strict: tuple = STRICT, soft: tuple = SOFT_TERMS) -> Column:
    """``struct<strict, soft>``: the different terms of the vocabulary that a url holds, in order."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        search = ahocorasick.Automaton()
        for term in {*strict, *soft}:
            search.add_word(term, term)
        search.make_automaton()
        weights = {True: frozenset(strict), False: frozenset(soft)}
        for urls in batches:
            found = []
            for url in urls.to_pylist():
                held = set()
                for last, term in search.iter(url or ""):
                    first = last - len(term) + 1
                    if not (first and _BESIDE.match(url[first - 1])) and not _BESIDE.match(url[last + 1:last + 2]):
                        held.add(term)
                found.append({"strict": sorted(held & weights[True]), "soft": sorted(held & weights[False])})
            yield pa.array(found, pa.struct([("strict", pa.list_(pa.string())), ("soft", pa.list_(pa.string()))]))

    return F.arrow_udf(run, "strict array<string>, soft array<string>")(lowered(url))


def judge(pages: DataFrame, rules: tuple = RULES, soft: int = SOFT) -> DataFrame:
    """One row per page row: ``page_id, host, path, rule, verdict, strict_terms, soft_terms``."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"), terms(F.col("url")).alias("_terms"))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    by_terms = F.when((F.size("_terms.strict") > 0) | (F.size("_terms.soft") >= soft), "block").otherwise("allow")
    return split.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, by_terms).alias("verdict"),
                        F.array_join("_terms.strict", ",").alias("strict_terms"), F.array_join("_terms.soft", ",").alias("soft_terms"))
