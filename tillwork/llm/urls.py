"""URL filters: prefix rules, and a list behind a blocked Bloom filter.

A page's URL is listed when its canonical form is in a table of URLs.  The list is hashed into a
blocked Bloom filter: every URL owns one 256-bit block and sets two bits in each of its four words.
The filter has a bounded number of blocks, so it may be broadcast whatever the length of the list;
a fuller filter only lets more pages through to the exact join, which settles every possible hit.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import ascii_lower, query, stored, table

#: 131,072 blocks of four longs: under 16 MB as a broadcast table.
MAX_BLOCKS = 1 << 17
BLOCK_BITS = 256
BITS_PER_URL = 16

#: Query parameters that name a campaign, not a page.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, and for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without trailing slashes, real parameters sorted.

    Scheme, fragment and tracking parameters go.  Null, or a URL without a host: null.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    parts = F.split(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(parts, lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; null when none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks)).cast("int")


def _masks(url: str) -> list[Column]:
    """The bits that a URL sets in the four words of its block."""

    def bit(i: int) -> str:
        return f"shiftleft(1L, cast(shiftright(xxhash64({url}, 'bits'), {6 * i}) & 63 as int))"

    return [F.expr(f"{bit(2 * w)} | {bit(2 * w + 1)}") for w in range(4)]


def bloom_blocks(urls: DataFrame, blocks: int) -> DataFrame:
    """The filter as rows (block, w0..w3); ``urls`` has one column, ``canonical_url``.

    Words are or-ed before the shuffle, so no task sends more than one row a block.
    """
    words = [m.alias(f"w{i}") for i, m in enumerate(_masks("canonical_url"))]
    bits = urls.select(_block(F.col("canonical_url"), blocks).alias("block"), *words)
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def listed_pages(pages: DataFrame, listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The distinct ``canonical_url`` values of ``pages`` that ``listed.url`` holds, and no other.

    ``pages`` has the column ``canonical_url``; null is never listed.
    """
    exact = stored(
        listed.select(canonical(F.col("url")).alias("canonical_url")).dropna().distinct(), "listed-urls"
    )
    blocks = min(max_blocks, max(1, math.ceil(exact.count() * BITS_PER_URL / BLOCK_BITS)))
    bloom = bloom_blocks(exact, blocks)
    # at most max_blocks rows by construction
    probe = pages.select("canonical_url").dropna().withColumn("block", _block(F.col("canonical_url"), blocks))
    hits = probe.join(F.broadcast(bloom), "block")
    for i, mask in enumerate(_masks("canonical_url")):
        hits = hits.where(F.col(f"w{i}").bitwiseAND(mask) == mask)
    # one row a URL before the exact join, however many pages share it
    return hits.select("canonical_url").distinct().join(exact, "canonical_url", "left_semi")


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: list[Rule], max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """A verdict for every row of ``pages`` (page_id, url); other columns are left behind.

    A page that a rule fits gets the longest rule's verdict; any other is blocked when its
    canonical URL is in ``listed`` (column url), else allowed.  Null URLs and those without ``://``
    have an empty host and path and are never listed.  Repeated pages come out as often as they
    go in.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.select(
        "page_id",
        host.alias("host"),
        path.alias("path"),
        matching_rule(host, path, rules).alias("by_rule"),
        canonical(F.col("url")).alias("canonical_url"),
    )
    # decided pages and those without a host stay out of the join: nulls would meet in one task
    is_open = F.col("by_rule").isNull() & F.col("canonical_url").isNotNull()
    open_pages = judged.where(is_open)
    hits = listed_pages(open_pages, listed, max_blocks).withColumn("verdict", F.lit("block"))
    columns = ["page_id", "host", "path", F.col("by_rule.rule").alias("rule")]
    by_list = open_pages.join(hits, "canonical_url", "left").select(
        *columns, F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )
    by_rule = judged.where(~is_open).select(
        *columns, F.coalesce("by_rule.verdict", F.lit("allow")).alias("verdict")
    )
    return by_rule.unionByName(by_list)


# -- the query ---------------------------------------------------------------------------------

RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]

#: Words in the names of sites whose pages make up the list.
LISTED_SITE = r"(^|[.-])(ads|adult|bets|casino|pills|spam)[.-]"

_CANONICAL_SQL = r"""
    CASE WHEN host <> '' THEN
        regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
        || regexp_replace(path, '/+$', '')
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END"""

SQL = rf"""
WITH parts AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
           list_sort(list_filter(string_split(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))) AS kept
    FROM pages),
canon AS (SELECT page_id, host, path, {_CANONICAL_SQL} AS url FROM parts),
listed AS (SELECT DISTINCT url FROM canon WHERE regexp_matches(host, '{LISTED_SITE}') AND url IS NOT NULL),
rules(verdict, rhost, rpath) AS (VALUES {", ".join(str(tuple(r)) for r in RULES)}),
fits AS (
    SELECT page_id, any_value(host), any_value(path),
           arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
           arg_max(verdict, length(rhost || rpath)) AS verdict
    FROM canon JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
    GROUP BY page_id)
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.verdict, CASE WHEN l.url IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM canon c LEFT JOIN fits f USING (page_id) LEFT JOIN listed l ON c.url = l.url
"""


@query("op2_url_filter", SQL)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, and by a list of the pages of the sites named above."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(host_of(F.col("url")).rlike(LISTED_SITE)).select("url")
    return judge_urls(pages, listed, RULES)
