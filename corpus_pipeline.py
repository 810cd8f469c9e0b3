"""From raw documents to packed sequences: five stages, each on what the one before kept.

Every stage but the last returns the columns of ``documents``; ``run`` writes each
result as Parquet into the shared work folder and reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailytally.llm import decontaminate, langid, minhash, packing, secrets
from dailytally.llm.common import ship, stored, table, text_key
from dailytally.llm.queries import tokenizer_path

#: Words of a shingle in the near-duplicate stage.
SHINGLE = 5


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of docs has them."""
    taken, out = {c.lower() for c in docs.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
    return out


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, keep: Collection[str] | None = None) -> DataFrame:
    """Texts without a language (no letter, or null) go, and with ``keep`` those of other languages,
    unless ambiguous. Where lang is null, a clear prediction takes its place."""
    ship(spark)
    pred, score, unclear, letter = fresh(docs, *langid.ADDED, "has_letter")
    found = langid.predict(docs, langid.train(docs), (pred, score, unclear, letter)).filter(F.col(letter))
    if keep is not None:
        found = found.filter(F.col(unclear) | F.col(pred).isin(*keep))
    clear = F.when(~F.col(unclear), F.col(pred)).cast(docs.schema["lang"].dataType)
    return found.withColumn("lang", F.coalesce("lang", clear)).select(*[f"`{c}`" for c in docs.columns])


def without(docs: DataFrame, gone: DataFrame, how: str = "left_anti") -> DataFrame:
    """The documents that aren't in ``gone`` (doc_id, tk), or are, by a left_semi join: rows that share a doc_id are judged by their own text."""
    own_id, own_key = fresh(docs, "_id", "_tk")
    gone = gone.select(F.col("doc_id").alias(own_id), F.col("tk").alias(own_key)).distinct()
    key = text_key(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (key == F.col(own_key)), how)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that of the smallest id (without any, or with the same, of the smallest text hash)."""
    ship(spark)
    found = minhash.near_duplicates(docs, SHINGLE).filter("component IS NOT NULL").groupBy("component", "doc_id", "tk").agg(F.count("*").alias("rows"))
    found = stored(found.withColumn("rank", F.struct(F.col("doc_id").isNull(), "doc_id", "tk")), "pipeline-groups")
    best = found.groupBy("component").agg(F.min("rank").alias("best"))
    kept = without(docs, found.join(best, "component").filter(~F.col("rank").eqNullSafe(F.col("best"))))
    again = found.join(best, "component").filter(F.col("rank").eqNullSafe(F.col("best")) & (F.col("rows") > 1))
    if not again.take(1):
        return kept
    once = without(docs, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return without(kept, again).unionByName(once)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.filter("contaminated"))


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by the name of their kind, and n_chars counted anew."""
    ship(spark)
    out = secrets.redact_secrets(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids, and the sequence that each goes to."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_free),
    ("secrets", secret_free),
    ("packing", packed),
]

#: Language identification, signatures, guess costs and byte-pair encoding aren't
#: SQL; tests/llm holds the first three stages against small cases with known results instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
