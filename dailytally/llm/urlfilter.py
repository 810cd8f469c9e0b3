"""URL filter: a blocked Bloom filter before an exact hash join.

The list holds two kinds of keys: rules (host and path prefix, with a verdict)
and canonical URLs to block. Each URL makes one candidate key per host suffix
and path length that rules have, and one for its canonical form. The blocked
Bloom filter (a 256-bit block per key, one bit in each of its eight words) lets
listed keys and a few others pass; an exact join on the key removes the others.
Both joins are plain equi-joins: Spark broadcasts the filter or the list while
they are small and shuffles by block or key beyond.

Null url or one without ``://``: empty host and path, no rule, allow. Several
fitting rules: the longest, then the one first in byte order. Repeated pages:
each gets the verdict of its url. Empty list or pages: no rule, or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import ascii_lower

#: Host and path prefix, verdict.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

BITS_PER_KEY = 16
WORDS = 8


def host_of(url: Column) -> Column:
    rest = F.when(url.contains("://"), F.expr("substring(url, locate('://', url) + 3)"))
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(url.contains("://"), F.expr("substring(url, locate('://', url) + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without www. or m., path without .html and closing slashes."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(\.html)?/*$", ""))


def parsed(pages: DataFrame) -> DataFrame:
    u = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    p = u.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return p.withColumn("canonical", canonical(F.col("host"), F.col("path")))


def tagged_urls(pages: DataFrame) -> DataFrame:
    """The list of the query: canonical URLs that occur with a feed's tracking tag."""
    p = parsed(pages).filter((F.col("host") != "") & F.col("url").contains("utm_source="))
    return p.select("canonical").distinct()


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))


def _masks(key: Column) -> tuple[list[Column], Column]:
    """One bit of each word, from five bits of the hash column ``_h``, and that hash."""
    h = F.xxhash64(key, F.lit("bits"))
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_h, {5 * i}) & 31 as int))") for i in range(WORDS)], h


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """block, w0 .. w7: the filter of a ``key`` column, as a table of its blocks."""
    masks, h = _masks(F.col("key"))
    bits = keys.select(_block(F.col("key"), blocks).alias("block"), h.alias("_h"))
    return bits.groupBy("block").agg(*[F.bit_or(m).alias(f"w{i}") for i, m in enumerate(masks)])


def passes(candidates: DataFrame, filt: DataFrame, blocks: int) -> DataFrame:
    """Candidates whose bits are all set in their block."""
    masks, h = _masks(F.col("key"))
    c = candidates.withColumn("block", _block(F.col("key"), blocks)).withColumn("_h", h)
    hit = F.lit(True)
    for i, m in enumerate(masks):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) != 0)
    return c.join(filt, "block").filter(hit).drop("block", "_h", *[f"w{i}" for i in range(WORDS)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed; ``listed`` has a column ``canonical``."""
    spark = pages.sparkSession
    rows = [(r, r, v) for r, v in rules]
    rule_keys = spark.createDataFrame(rows, "key string, rule string, rule_verdict string")
    keys = rule_keys.unionByName(
        listed.select(F.concat(F.lit("="), F.col("canonical")).alias("key")).distinct()
        .withColumns({"rule": F.lit(None).cast("string"), "rule_verdict": F.lit(None).cast("string")})
    )
    blocks = max(1, -(-keys.count() * BITS_PER_KEY // (32 * WORDS)))
    filt = bloom(keys, blocks)

    # Only the suffix depths and prefix lengths that some rule has can fit.
    depths = sorted({r.split("/", 1)[0].count(".") + 1 for r, _ in rules})
    lengths = sorted({len(r) - r.index("/") for r, _ in rules})
    pages = parsed(pages)
    made = [
        F.when(F.length("path") >= n, F.concat(F.substring_index("host", ".", -d), F.substring(F.col("path"), 1, n)))
        for d in depths for n in lengths
    ]
    urls = pages.filter("host <> ''").select("host", "path", "canonical").distinct()
    tried = urls.select(
        "host", "path",
        F.explode(F.array_distinct(F.array_compact(F.array(F.concat(F.lit("="), F.col("canonical")), *made)))).alias("key"),
    )
    hits = passes(tried, filt, blocks).join(keys, "key")
    best = hits.groupBy("host", "path").agg(
        F.min(F.when(F.col("rule").isNotNull(), F.struct((-F.length("rule")).alias("n"), "rule", "rule_verdict"))).alias("best"),
        F.max(F.col("rule").isNull()).alias("listed"),
    )
    return pages.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.rule_verdict"), F.when(F.col("listed"), F.lit("block")), F.lit("allow")).alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"),
    )
