"""URL filtering (operator 3): rules, then a blocked Bloom filter and an exact join.

``canonical`` brings the spellings of one page together: scheme, ``www.``,
default port, fragment, tracking parameters, a final ``index`` page, ``.html``
and closing slashes go, and A-Z of the host is lower-cased.

Listed URLs fill a Bloom filter of 256-bit blocks (a key picks one block and
sets one bit in each of its eight 32-bit words), built with ``bit_or`` per
block. Pages whose block has all eight bits are possible hits; only those go on
to a hash join with the listed URLs, which removes the false ones. The filter
has 16 bits a listed URL; it is broadcast when that counted size is within
``BROADCAST_BYTES`` and joined by block number otherwise.

Edge cases: a null URL or one without ``://`` has empty host and path, no
canonical form and is allowed; repeated rows are judged alike; an empty list
blocks nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import maybe_broadcast, table

WORDS = 8  # 32-bit words of a block
BITS_PER_URL = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rules of the query (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
# Sites whose pages make up the query's list.
LISTED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host_path(url: str) -> tuple[Column, Column]:
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(u.contains("://"), F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*(/[^?#]*)?", 1)
    return F.translate(host, UPPER, LOWER), path


def canonical(url: str, host: str = "host", path: str = "path") -> Column:
    """Canonical form of the URL in column ``url`` (null when the host is empty)."""
    h = F.regexp_replace(F.regexp_replace(F.col(host), r"\Awww\.", ""), r":(80|443)\z", "")
    p = F.regexp_replace(F.col(path), r"/index\.[a-z]+\z", "/")
    p = F.regexp_replace(F.regexp_replace(p, r"\.html?\z", ""), r"/+\z", "")
    q = F.regexp_extract(F.col(url), r"\A[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(q, "&"), lambda x: ~x.rlike(r"\A((utm_[^=]*|ref|fbclid|gclid)(=.*)?)?\z")))
    q = F.array_join(kept, "&")
    return F.when(F.col(host) != "", F.concat(h, p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")))


def judge_rules(rules: Sequence[tuple[str, str, str]] = RULES, host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(blocks))


def _bit(key: str, word: int) -> Column:
    """The bit (0-31) that a key sets in a word: five bits of a second hash."""
    h = F.xxhash64(F.lit("bit"), F.col(key))
    return F.shiftrightunsigned(h, 5 * word).bitwiseAND(F.lit(31)).cast("int")


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """``_block`` and its words ``_w0`` to ``_w7``, for the keys of ``listed``."""
    bits = [F.expr("1L").alias("_one")] + [_bit(key, i).alias(f"_b{i}") for i in range(WORDS)]
    rows = listed.select(_block(key, blocks).alias("_block"), *bits)
    return rows.groupBy("_block").agg(*[F.bit_or(F.expr(f"shiftleft(_one, _b{i})")).alias(f"_w{i}") for i in range(WORDS)])


def listed_hits(pages: DataFrame, listed: DataFrame, key: str = "canonical") -> DataFrame:
    """``pages`` with ``listed`` (boolean): the key is on the list."""
    urls = listed.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    n = urls.count()
    blocks = max(1, -(-n * BITS_PER_URL // 256))
    words = maybe_broadcast(bloom_filter(urls, key, blocks), blocks, 72)
    probe = pages.withColumn("_block", _block(key, blocks)).join(words, "_block", "left")
    maybe = F.lit(True)
    for i in range(WORDS):
        probe = probe.withColumn(f"_b{i}", _bit(key, i))
        maybe = maybe & F.expr(f"coalesce(shiftright(_w{i}, _b{i}) & 1, 0) = 1")
    probe = probe.select(*pages.columns, (F.col(key).isNotNull() & maybe).alias("_maybe"))
    exact = maybe_broadcast(urls.withColumn("listed", F.lit(True)), n, 160)
    hit = probe.filter("_maybe").join(exact, key, "left").select(*pages.columns, F.coalesce("listed", F.lit(False)).alias("listed"))
    return hit.unionByName(probe.filter("not _maybe").select(*pages.columns, F.lit(False).alias("listed")))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                id_col: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, canonical, rule, listed and verdict of every page;
    ``listed`` has a column ``canonical``."""
    host, path = host_path(url)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("canonical", canonical("url"))
    rule, verdict = judge_rules(rules)
    out = listed_hits(rows, listed).withColumn("rule", rule)
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
                      "canonical", "listed")


def listed_urls(pages: DataFrame, sites: Sequence[str] = LISTED_SITES) -> DataFrame:
    """The query's list: canonical URLs of the pages of the listed sites."""
    host, path = host_path("url")
    rows = pages.select(F.col("url"), host.alias("host"), path.alias("path"))
    site = F.exists(F.split("host", r"\."), lambda x: x.isin(*sites))
    return rows.filter(site).select(canonical("url").alias("canonical"))


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, listed_urls(pages))


ORACLE = r"""
with u as (select page_id, url,
   case when url is null or strpos(url, '://') = 0 then '' else substring(url, strpos(url, '://') + 3) end as rest from pages),
 h as (select page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
   regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) as path from u),
 q as (select *, array_to_string(list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '^[^?#]*\?([^#]*)', 1), '&'),
   lambda x: not regexp_matches(x, '^((utm_[^=]*|ref|fbclid|gclid)(=.*)?)?$'))), '&') as query from h),
 c as (select *, case when host <> '' then
   regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') ||
   regexp_replace(regexp_replace(regexp_replace(path, '/index\.[a-z]+$', '/'), '\.html?$', ''), '/+$', '') ||
   case when query <> '' then '?' || query else '' end end as canonical from q),
 l as (select distinct canonical from c where canonical is not null and len(list_filter(string_split(host, '.'),
   lambda x: x in ('ads-track','adult-x','casino-win','cheap-pills','free-bets','spam-farm'))) > 0),
 r as (select c.*, l.canonical is not null as listed,
   case when (host = 'example.org' or host like '%.example.org') and path like '/en/1%' then 'example.org/en/1'
        when (host = 'example.org' or host like '%.example.org') and path like '/es/%' then 'example.org/es/'
        when (host = 'com' or host like '%.com') and path like '/fr/%' then 'com/fr/'
        when (host = 'com' or host like '%.com') and path like '/de/%' then 'com/de/'
        when (host = 'org' or host like '%.org') and path like '/%' then 'org/' end as rule
   from c left join l using (canonical))
select page_id, host, path, rule,
 case rule when 'org/' then 'allow' when 'example.org/es/' then 'block' when 'example.org/en/1' then 'block'
   when 'com/fr/' then 'allow' when 'com/de/' then 'block' else case when listed then 'block' else 'allow' end end as verdict,
 canonical, listed from r
"""
