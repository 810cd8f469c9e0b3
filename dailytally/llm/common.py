"""Helpers shared by the operators: input columns, stored tables, gapless ranks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dailytally.session import work_path

#: ASCII letters, for lower-casing A-Z and nothing else.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


_SHIPPED: set[str] = set()


#: Rows of an Arrow batch, where the session has not chosen: with texts of some KB a few MB.
BATCH_ROWS = 1000
_ARROW_ROWS, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Lets the tasks import this package, once per application (as --py-files does),
    and keeps Arrow batches of texts small where the session has Spark's default."""
    if spark.conf.get(_ARROW_ROWS) == _ARROW_DEFAULT:
        spark.conf.set(_ARROW_ROWS, str(BATCH_ROWS))
    if (app := spark.sparkContext.applicationId) in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="dailytally-py-"), "dailytally.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that extra columns never clash; null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def text_key(c: Column) -> Column:
    """Tells rows that share a doc_id apart; rows equal in both get equal results."""
    return F.xxhash64(c)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame once into the shared work folder and reads it back:
    cuts the lineage, survives a lost executor, and is compressed."""
    path = work_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gapless_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, rows: int) -> DataFrame:
    """Adds 0, 1, 2, ... within each group, without a task per group.

    Rows of a group are dealt to hash buckets of about 20,000 rows; the counts of
    (group, bucket) give each bucket its start, and rows are numbered within the
    bucket. ``df`` is read twice, so it should be stored. ``order`` must name
    every column in which rows of a group differ: full ties are then alike.
    """
    buckets = max(1, rows // 20_000)
    b = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        b.groupBy(*group, "_b").agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long")).drop("_n")
    )
    within = Window.partitionBy(*group, "_b").orderBy(*order)
    ranked = b.withColumn("_r", F.row_number().over(within) - 1)
    return (
        ranked.join(starts, [*group, "_b"])
        .withColumn(out, F.col("_start") + F.col("_r")).drop("_start", "_r", "_b")
    )


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string or binary column, uncopied."""
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) else b"")
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def runs(off: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``most`` bytes, or of a single longer row."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)
