"""URL filters: host and path rules first, then a blocked Bloom filter of listed
canonical URLs whose possible hits an exact hash join confirms.

The filter is a split-block Bloom filter: a key's hash picks one block of eight 32-bit
words and one bit in each.  It is built by one aggregation (bitwise or by block) and has
at most ``MAX_BLOCKS`` blocks, whatever the list's length, so what is broadcast is at
most 2^17 rows of 80 bytes; on a longer list more URLs pass to the join, and no result
changes.  Only possible hits are shuffled.  DataFrame functions only.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, sized

RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_WORDS = ("idiot", "moron", "scum", "trash")
KEYS_PER_BLOCK, MAX_BLOCKS = 16, 1 << 17
_SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host and path without a www. before and a slash after; null where there is no host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/$", "")))


def _rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value) -> Column:
    """``value`` of the longest rule that fits (then the one with the longer host)."""
    out = F.lit(None).cast("string")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(value(verdict, h, p))).otherwise(out)
    return out


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _bits(key: Column) -> list[Column]:
    h = F.hash(key, F.lit("bit")).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    one = F.lit(1).cast("long")
    top = lambda salt: F.shiftright((h * F.lit(salt >> 1)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int")
    return [F.call_function("shiftleft", one, top(salt)) for salt in _SALTS]


def bloom(listed: DataFrame, keys: int) -> tuple[DataFrame, int]:
    """(table of b, w0..w7; number of blocks) for the ``keys`` distinct URLs in ``listed`` (curl)."""
    n = min(MAX_BLOCKS, max(1, -(-keys // KEYS_PER_BLOCK)))
    words = [F.bit_or(x).alias(f"w{i}") for i, x in enumerate(_bits(F.col("curl")))]
    return listed.groupBy(_block(F.col("curl"), F.lit(n)).alias("b")).agg(*words), n


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    ``listed``: one column curl of canonical URLs to block; nulls and repeats are allowed.
    A null url, or one without ://, has an empty host and path, fits no rule and is
    allowed.  A URL is listed or not by itself: neither its host nor a part of its path
    decides.  Repeated rows and rows with a null page_id each get their row; URLs of any
    length count whole; other columns are not read; empty tables give empty ones."""
    url = F.col("url").cast("string")
    listed = cut(listed.select("curl").where("curl is not null").distinct())
    table, n = bloom(listed, listed.count())
    d = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    d = d.withColumn("rule", _rule(F.col("host"), F.col("path"), rules, lambda v, h, p: h + p))
    d = d.withColumn("verdict", _rule(F.col("host"), F.col("path"), rules, lambda v, h, p: v))
    d = d.withColumn("curl", F.when(F.col("rule").isNull(), canonical(F.col("host"), F.col("path"))))
    d = d.withColumn("b", _block(F.col("curl"), F.lit(n)))
    d = d.join(F.broadcast(table), "b", "left")  # at most MAX_BLOCKS rows
    hit = F.col("curl").isNotNull()
    for i, bit in enumerate(_bits(F.col("curl"))):
        hit = hit & F.coalesce(F.col(f"w{i}").bitwiseAND(bit) != 0, F.lit(False))
    d = d.withColumn("hit", hit).select("page_id", "host", "path", "rule", "verdict", "curl", "hit")
    out = ["page_id", "host", "path", "rule"]
    clear = d.where("not hit").select(*out, F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    known = sized(listed).withColumn("found", F.lit(True))
    maybe = d.where("hit").join(known, "curl", "left").select(*out, F.when(F.col("found"), "block").otherwise("allow").alias("verdict"))
    return clear.unionByName(maybe)


def listed_urls(pages: DataFrame, labels: Sequence[str] = LISTED_LABELS, words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """curl: the canonical URLs of ``pages`` (url, html) on hosts that have one of ``labels``, and of
    those whose html has one of ``words``: a stand-in for a list of reported pages.  Null url or
    html, and URLs without a host, report nothing."""
    host = host_of(F.col("url"))
    on = F.arrays_overlap(F.split(host, r"\."), F.array(*[F.lit(x) for x in labels]))
    said = F.coalesce(F.col("html").rlike(f"(?i)(^|[^A-Za-z])({'|'.join(words)})([^A-Za-z]|$)"), F.lit(False))
    return pages.where(on | said).select(canonical(host, path_of(F.col("url"))).alias("curl"))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages.select("page_id", "url"), listed_urls(pages.select("url", "html")))


def _sql_rule(value) -> str:
    whens = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h, p)}'"
        for v, h, p in sorted(RULES, key=lambda r: (len(r[1] + r[2]), len(r[1]), r), reverse=True)
    ]
    return f"CASE {' '.join(whens)} END"


ORACLE_SQL = rf"""WITH u AS (SELECT page_id,
  coalesce(translate(regexp_extract(url, '{_PARTS}', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '') AS host,
  coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path, html FROM pages),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '') END AS curl FROM u),
listed AS (SELECT DISTINCT curl FROM c WHERE list_has_any(string_split(host, '.'), [{', '.join(f"'{x}'" for x in LISTED_LABELS)}])
  OR coalesce(regexp_matches(html, '(?i)(^|[^A-Za-z])({'|'.join(LISTED_WORDS)})([^A-Za-z]|$)'), false))
SELECT page_id, host, path, {_sql_rule(lambda v, h, p: h + p)} AS rule,
  coalesce({_sql_rule(lambda v, h, p: v)}, CASE WHEN curl IN (SELECT curl FROM listed WHERE curl IS NOT NULL) THEN 'block' ELSE 'allow' END) AS verdict FROM c"""
