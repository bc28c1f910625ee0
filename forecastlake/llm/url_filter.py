"""URL filter: host and path rules, then a list of canonical URLs.

The list is put into a blocked Bloom filter: one 64-bit word for each block, four
bits of one word for each listed URL. URLs whose four bits are set are possible
hits; only they go to an exact hash join with the list, which removes the false
positives. DataFrame functions only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column

#: (verdict, host, path): a rule holds for the host and its subdomains where the path starts so.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
URLS_PER_WORD = 4
#: A filter of up to so many 16-byte rows is broadcast (64 MB); a larger one is joined by block.
BROADCAST_WORDS = 1 << 22

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url):
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER),
                      F.lit(""))


def path_of(url):
    """After the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url):
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def canonical(host, path):
    """Without scheme, query, fragment, a leading ``www.`` and trailing slashes."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))


def rule_column(host, path, rules):
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rules = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    fits = [((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
            for _, h, p in rules]
    pairs = [F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for v, h, p in rules]
    return F.coalesce(*[F.when(f, x) for f, x in zip(fits, pairs)])


def _bits(url):
    """Four bits of a 64-bit word, from a hash that the block number doesn't use."""
    h = F.xxhash64(url, F.lit("bits"))
    one = F.lit(1).cast("long")
    return reduce(lambda a, b: a.bitwiseOR(b),
                  [F.call_function("shiftleft", one, F.shiftrightunsigned(h, s).bitwiseAND(F.lit(63)).cast("int"))
                   for s in (0, 6, 12, 18)])


def bloom_filter(listed: DataFrame, words: int) -> DataFrame:
    """(block, word) of the distinct canonical URLs in column ``canon``."""
    return listed.select(F.pmod(F.xxhash64("canon"), F.lit(words)).alias("block"),
                         _bits(F.col("canon")).alias("bits")) \
        .groupBy("block").agg(F.bit_or("bits").alias("word"))


def filter_urls(pages: DataFrame, listed: DataFrame, *, id_col: str = "page_id",
                url_col: str = "url", list_col: str = "url", rules=RULES) -> DataFrame:
    """One row for each page: id, host, path, canon, rule, verdict, possible, listed.

    ``verdict`` is the longest fitting rule's, else ``block`` where the page's
    canonical URL is on the list, else ``allow``. A null URL or one without
    ``://`` has an empty host and path, fits no rule and is never listed.
    Repeated pages and URLs each keep their row; either table may be empty; other
    columns are left out, so their names can't clash.
    """
    target = canonical(host_of(column(list_col)), path_of(column(list_col)))
    wanted = listed.select(target.alias("canon")).filter("canon != ''").distinct()
    words = max(1, math.ceil(wanted.count() / URLS_PER_WORD))
    bloom = bloom_filter(wanted, words)
    if words <= BROADCAST_WORDS:
        bloom = F.broadcast(bloom)
    url = column(url_col)
    seen = pages.select(column(id_col).alias("page_id"), host_of(url).alias("host"),
                        path_of(url).alias("path")) \
        .withColumn("canon", canonical(F.col("host"), F.col("path"))) \
        .withColumn("ruled", rule_column(F.col("host"), F.col("path"), rules)) \
        .withColumn("block", F.pmod(F.xxhash64("canon"), F.lit(words)))
    bits = _bits(F.col("canon"))
    probed = seen.join(bloom, "block", "left").withColumn(
        "possible", (F.col("canon") != "") & F.coalesce(F.col("word").bitwiseAND(bits) == bits, F.lit(False)))
    hits = probed.filter("possible").join(wanted.withColumn("listed", F.lit(True)), "canon", "left")
    misses = probed.filter("not possible").withColumn("listed", F.lit(False))
    both = hits.withColumn("listed", F.coalesce("listed", F.lit(False))).unionByName(misses)
    return both.select("page_id", "host", "path", "canon", F.col("ruled.rule").alias("rule"),
                       F.coalesce("ruled.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
                       "possible", "listed")


def op2_url_filters(spark, sf_dir):
    """List: the canonical URLs that some page was fetched by with a campaign tag (``utm_``)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    tagged = pages.filter(F.col("url").contains("utm_"))
    return filter_urls(pages, tagged).select("page_id", "host", "path", "rule", "verdict", "listed")


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
q AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
c AS (
  SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') AS canon,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM q),
l AS (SELECT DISTINCT canon FROM c WHERE contains(url, 'utm_') AND canon <> '')
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  l.canon IS NOT NULL AS listed
FROM c LEFT JOIN l USING (canon)
"""
