"""Quality rules on documents, with verdicts on whole hosts.

Counts per text come from column functions alone. A host's failure rate is
shrunk with a beta prior fitted to all hosts by moments, the noise of few documents
taken out, so a host of few documents stays near the common rate; a host whose
shrunk rate is above ``host_limit`` is rejected, and its verdict joined back to its
documents.

Null or empty text: no words, so the base rules fail. Null source: a host of its
own. Repeated rows: each gets its own row. Very long texts: like others. Extra columns
are never read, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import stored

#: Characters that count as symbols; white space between words.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[ \t-\r]+"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host falls when more than this share of its documents fail, after shrinking.
HOST_LIMIT = 0.5


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text.alias("text"),
    )
    split = base.select(
        "doc_id", "source",
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^ \t-\r]")).alias("lines"),
        F.array_remove(F.split("text", SPACE_RUN), "").alias("words"),
    )
    # A hash for each three-word window, in order of position.
    windows = F.when(
        F.size("words") >= 3,
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(
            F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = split.select(
        "doc_id", "source", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("h"),
    ).withColumn("repeats", F.size(F.array_distinct("h")) < F.size("h"))
    # Only texts with a repeat are sorted: equal hashes are then neighbours.
    ordered = hashed.withColumn(
        "s", F.when(F.col("repeats"), F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    found = ordered.withColumn("p", F.when(F.col("repeats"), F.transform(
        F.filter("s", lambda x, j: (x["h"] == F.get("s", j - 1)["h"]) | (x["h"] == F.get("s", j + 1)["h"])),
        lambda x: x["i"])))
    covered = F.size(F.array_distinct(F.flatten(F.transform("p", lambda i: F.array(i, i + 1, i + 2)))))
    return found.select(
        "doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("repeats"), covered).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def host_verdicts(counts: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """source, docs, failed, shrunk_rate, host_kept: one row per host.

    Failures of a host are taken as beta-binomial: with mean p and correlation r of two
    documents of one host, E sum n (rate - p)^2 = p (1 - p) ((k - 1) + r (N - sum n^2 / N - (k - 1)))
    for k hosts of n documents, N in all, and the observed p (1 - p) falls short of the true one by
    the share (1 - r) / N + r sum n^2 / N^2. So r is what the rates vary by beyond sampling noise;
    the prior's strength is (1 - r) / r documents, and r = 0 leaves every host at p.
    """
    hosts = counts.groupBy("source").agg(
        F.count("*").alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    hosts = stored(hosts, "quality-hosts")
    n, x = F.col("docs").cast("double"), F.col("failed").cast("double")
    # A handful of numbers, whatever the number of hosts.
    m = hosts.agg(F.count("*").alias("k"), F.sum(n).alias("n"), F.sum(x).alias("x"), F.sum(x * x / n).alias("xx"), F.sum(n * n).alias("nn")).first()
    p, r = 0.0, 0.0
    if m.k:
        p = m.x / m.n
        if 0 < p < 1:
            seen = (m.xx - m.x * m.x / m.n) / (p * (1 - p))
            room = m.n - m.nn / m.n - (m.k - 1) + seen * (m.nn / m.n - 1) / m.n
            r = min(1.0, max(0.0, (seen * (1 - 1 / m.n) - (m.k - 1)) / room)) if room > 1e-9 else 0.0
    shrunk = (x * r + p * (1 - r)) / (n * r + (1 - r))
    return hosts.select("source", "docs", "failed", shrunk.alias("shrunk_rate"), (shrunk <= host_limit).alias("host_kept"))


def judge_quality(docs: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """The counts, base_failed, kept and the host's shrunk_rate, per document."""
    failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    counts = stored(text_counts(docs).withColumn("base_failed", failed), "quality")
    hosts = host_verdicts(counts, host_limit).select(F.col("source").alias("host"), "shrunk_rate", "host_kept")
    return (
        counts.join(hosts, F.col("source").eqNullSafe(F.col("host")))
        .withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                F.round("shrunk_rate", 9).alias("shrunk_rate"))
    )
