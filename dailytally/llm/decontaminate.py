"""Benchmark decontamination by winnowing, with column functions alone.

Words are runs of digits, ASCII letters and non-ASCII characters, A-Z
lower-cased. Each text keeps the least hash of its k-word shingles in every run
of ``WINDOW - K + 1`` shingles: two texts that share ``WINDOW`` consecutive
words keep a common hash. Documents' hashes are joined with those of the items;
around each hit the document's windows are joined with the item's windows, word
for word, so that only true occurrences count. An item shorter than a window is
one window: its length is hashed at every place of the documents instead.

Null text: no words, not hit; a null item or one without words: no window; null
item_id: counted as an item, left out of the joined ids. Rows that share a
doc_id but not the text are judged apart. Empty tables: no rows, or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import ascii_lower, stored, text_key, texts

WINDOW = 10
K = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def places(n: Column) -> Column:
    """0 .. n - 1, or nothing."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def shingles(words: str, k: int) -> Column:
    """The hash of the k words at each place; k is part of it."""
    return F.transform(places(F.size(words) - (k - 1)), lambda i: F.xxhash64(F.lit(k), *[F.get(words, i + j) for j in range(k)]))


def winnowed(shingle: str, window: int) -> Column:
    """The least of each ``window`` neighbouring hashes, once each."""
    return F.array_distinct(F.transform(
        places(F.size(shingle) - (window - 1)), lambda i: F.least(*[F.get(shingle, i + j) for j in range(window)])))


def _hashed(df: DataFrame, short: list[int]) -> DataFrame:
    """Adds the shingles of K words and of each short length in use."""
    df = df.withColumn("h", shingles("words", K))
    for m in short:
        df = df.withColumn(f"h{m}", shingles("words", m))
    return df


#: Up to so many prints a text's places look through all of them, beyond by halving.
FEW_PRINTS = 16


def among_prints(value: Column) -> Column:
    """Whether the value is one of the sorted ``prints``; ``halves`` holds the powers of two up to their number, largest first."""
    below = F.aggregate("halves", F.lit(0), lambda at, step: F.when(F.get("prints", at + step - 1) < value, at + step).otherwise(at))
    return F.when(F.size("prints") <= FEW_PRINTS, F.array_contains("prints", value)).otherwise(F.coalesce(F.get("prints", below) == value, F.lit(False)))


def _short_hits(m: int) -> Column:
    own = F.filter(places(F.size(f"h{m}")), lambda i: among_prints(F.get(f"h{m}", i)))
    return F.transform(own, lambda s: F.struct(s.alias("s"), F.lit(m).alias("m")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (and tk, which tells
    rows of one doc_id apart)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))
    items = items.withColumn("m", F.least(F.size("words"), F.lit(WINDOW))).filter("m > 0")
    short = [r.m for r in items.filter(F.col("m") < WINDOW).select("m").distinct().sort("m").collect()]  # nine at most

    item_prints = items.filter(F.col("m") == WINDOW).withColumn("h", shingles("words", K)).select(F.explode(winnowed("h", WINDOW - K + 1)).alias("print"))
    item_windows = items.select("item_id", "m", F.explode(F.transform(
        places(F.size("words") - F.col("m") + 1), lambda i: F.array_join(F.slice("words", i + 1, F.col("m")), " "))).alias("window")).distinct()
    for m in short:
        own = items.filter(F.col("m") == m).withColumn("h", shingles("words", m))
        item_prints = item_prints.unionByName(own.select(F.explode("h").alias("print")))
    item_prints = item_prints.distinct()

    base = texts(docs).withColumn("tk", text_key(F.col("text")))
    hashed = _hashed(base.select("doc_id", "tk", words_of(F.col("text")).alias("words")), short)
    prints = F.array_distinct(F.concat(winnowed("h", WINDOW - K + 1), *[F.col(f"h{m}") for m in short]))
    # One row of each text carries its count of words; it travels under a hash of its own.
    own = F.array(F.struct(F.xxhash64("doc_id", "tk").alias("print"), F.size("words").cast("long").alias("n_words")))
    shared = F.transform(prints, lambda x: F.struct(x.alias("print"), F.lit(None).cast("long").alias("n_words")))
    judged = (
        hashed.select("doc_id", "tk", F.explode(F.concat(own, shared)).alias("x")).select("doc_id", "tk", "x.*")
        .join(item_prints.withColumn("listed", F.lit(True)), "print", "left").filter("listed OR n_words IS NOT NULL")
        .groupBy("doc_id", "tk").agg(
            F.max("n_words").alias("n_words"),
            F.sort_array(F.collect_set(F.when(F.col("n_words").isNull(), F.col("print")))).alias("prints"))  # a text's own, so bounded by it
    )
    judged = stored(judged, "decontaminate")
    hits = judged.filter(F.size("prints") > 0).withColumn(
        "halves", F.filter(F.array(*[F.lit(1 << b) for b in reversed(range(31))]), lambda step: step <= F.size("prints")))

    # Extend: windows that hold a common shingle, joined word for word.
    again = base.join(hits.select(F.col("doc_id").alias("d"), F.col("tk").alias("t"), "prints", "halves"),
                      F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tk") == F.col("t")))
    again = _hashed(again.select("doc_id", "tk", "prints", "halves", words_of(F.col("text")).alias("words")), short).dropDuplicates(["doc_id", "tk"])
    near = F.array_distinct(F.flatten(F.transform(
        F.filter(places(F.size("h")), lambda i: among_prints(F.get("h", i))),
        lambda i: F.filter(F.sequence(i - (WINDOW - K), i), lambda s: (s >= 0) & (s + WINDOW <= F.size("words"))))))
    at = F.transform(near, lambda s: F.struct(s.alias("s"), F.lit(WINDOW).alias("m")))
    for m in short:
        at = F.concat(at, _short_hits(m))
    windows = again.select("doc_id", "tk", F.explode(F.transform(at, lambda x: F.struct(
        x["s"].alias("s"), x["m"].alias("m"), F.array_join(F.slice("words", x["s"] + 1, x["m"]), " ").alias("window")))).alias("x")).select("doc_id", "tk", "x.*")
    found = windows.join(item_windows, ["m", "window"]).groupBy("doc_id", "tk").agg(
        F.collect_set(F.struct("s", "m")).alias("at"), F.collect_set(F.col("item_id").cast("string")).alias("ids"),
        (F.count_distinct("item_id") + F.max(F.col("item_id").isNull().cast("int"))).alias("n_items"),
    ).select(
        F.col("doc_id").alias("d"), F.col("tk").alias("t"), "n_items", "ids",
        F.size(F.array_distinct(F.flatten(F.transform("at", lambda x: F.sequence(x["s"], x["s"] + x["m"] - 1))))).cast("long").alias("n_hit"),
    )
    result = judged.select(F.col("doc_id").alias("own_id"), F.col("tk").alias("own_tk"), "n_words").join(
        found, F.col("own_id").eqNullSafe(F.col("d")) & (F.col("own_tk") == F.col("t")), "left")
    rows = base.select("doc_id", "tk")  # repeated rows: the result of each
    return rows.join(result, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("tk") == F.col("own_tk"))).select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join(F.array_sort("ids"), ","), F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), "tk",
    )
