"""URL filters: host and path rules, then a blocked Bloom filter in front of an exact hash join.

The whole path is DataFrame functions. The filter is one array of 256-bit blocks (eight 32-bit words): a listed URL
sets one bit in each word of its block. A URL that hits all eight bits of its block is a possible hit; only possible
hits take part in the exact join on the canonical URL, which removes false positives. The array has a bounded size and
goes to every executor as one row, so asking it costs no shuffle and stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that do not name a resource.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
#: Bits of the filter for each listed URL.
BITS_PER_URL = 16
#: The filter has at most so many blocks (32 bytes each: 32 MiB). A longer list gives more possible hits, not other results.
MOST_BLOCKS = 1 << 20
WORDS = 8


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, ASCII letters lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling for each resource: no scheme, fragment, tracking parameters or trailing slash; sorted parameters.

    Null, and URLs without ``://``, give null.
    """
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    base = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/+$", ""))
    full = F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base)
    return F.when(url.contains("://"), full)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as ``struct<rule, verdict>``, or null. ``rules``: (verdict, host, path).

    A rule fits its host and all subdomains, if the path starts with the rule's path.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    bits = F.xxhash64(url, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(WORDS)]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """The blocked Bloom filter of ``listed(url)``: one row with ``bloom``, the words of all blocks in order."""
    masks = listed.select(_block(F.col("url"), blocks).alias("block"), *(m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("url")))))
    found = masks.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))
    every = listed.sparkSession.range(blocks).withColumnRenamed("id", "block").join(found, "block", "left").fillna(0)
    # As many entries as blocks, a bounded number.
    words = F.array_sort(F.collect_list(F.struct("block", F.array(*(f"w{i}" for i in range(WORDS))).alias("words"))))
    return every.agg(F.flatten(F.transform(words, lambda x: x["words"])).alias("bloom"))


def filter_urls(urls: DataFrame, listed: DataFrame, *, id_col: str, url_col: str, rules: list[tuple[str, str, str]], bits_per_url: int = BITS_PER_URL) -> DataFrame:
    """Judge every URL: the longest rule decides, else ``block`` for a listed canonical URL, else ``allow``.

    ``listed`` has a column ``url`` of canonical URLs (repeats and nulls are harmless). Returns one row for each
    row of ``urls``: id, host, path, rule, verdict, canonical_url, possible (the filter's answer; null under a rule).
    Null and malformed URLs have empty host and path and are allowed. Other columns of ``urls`` are not read.
    """
    # Written once: it is counted, hashed into the filter and joined.
    listed = materialize(listed.select("url").where(F.col("url").isNotNull()).distinct(), "listed-urls")
    blocks = min(max(1, -(-listed.count() * bits_per_url // (32 * WORDS))), MOST_BLOCKS)
    bloom = materialize(bloom_filter(listed, blocks), "url-filter")
    url, c, r = F.col("url_"), F.col("canonical_url"), F.col("r")
    base = urls.select(F.col(id_col), F.col(url_col).alias("url_")).select(id_col, host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical_url"))
    base = base.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).join(F.broadcast(bloom))
    hit = F.lit(True)
    for i, mask in enumerate(_masks(c)):
        hit &= F.get("bloom", (_block(c, blocks) * WORDS + i).cast("int")).bitwiseAND(mask) == mask
    possible = F.when(r.isNull(), F.coalesce(hit, F.lit(False)))
    # Written once: the patterns are evaluated in one pass, and only possible hits go on to the join.
    asked = materialize(base.select(id_col, "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", F.lit("allow")).alias("verdict"), "canonical_url", possible.alias("possible")), "asked-urls")
    exact = listed.select(F.col("url").alias("listed_url"))
    checked = asked.where("possible").join(exact, F.col("canonical_url") == F.col("listed_url"), "left")
    checked = checked.withColumn("verdict", F.when(F.col("listed_url").isNotNull(), "block").otherwise("allow")).select(asked.columns)
    return asked.where(~F.coalesce("possible", F.lit(False))).unionByName(checked)


#: Visible characters below which a page counts as thin.
THIN_CHARS = 1000


def thin_page_urls(pages: DataFrame, thin_chars: int = THIN_CHARS) -> DataFrame:
    """A list derived from the crawl: canonical URLs of pages with little visible text. A null page is thin."""
    visible = F.length(F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<(script|style)[^>]*>.*?</(script|style)>", ""), "<[^>]*>", ""))
    return pages.where(visible < thin_chars).select(canonical(F.col("url")).alias("url"))


#: The query on the table of pages with the rules of ``queries.RULES``; an exact join only.
ORACLE_SQL = r"""
WITH base AS (
  SELECT page_id, url, coalesce(html, '') AS html,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params
  FROM pages
), named AS (
  SELECT page_id, host, path, html,
    CASE WHEN url LIKE '%://%' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical_url,
    CASE
      WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM base
), listed AS (
  SELECT DISTINCT canonical_url FROM named WHERE canonical_url IS NOT NULL AND length(
    regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '<[^>]*>', '', 'g')) < 1000
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN canonical_url IN (SELECT canonical_url FROM listed) THEN 'block' ELSE 'allow' END AS verdict, canonical_url
FROM named
"""
