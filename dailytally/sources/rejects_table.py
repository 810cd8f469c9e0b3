"""Rejected orders: Parquet, one folder per reporting day, each reject there once.

A run replaces the rejects of the days it touches by those that their orders give now, so
it doesn't matter which run saw a bad row first. Rows without a day have a folder too.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailytally.operators import quality as Q
from dailytally.operators.extract import extract_backfill
from dailytally.operators.transform import with_group_key

DAY = "reject_day"
#: Spark's folder name of a null partition value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def rejects_of_days(orders: DataFrame, days: Iterable[_dt.date | None]) -> DataFrame:
    """Bad rows of the given days (None: of no day), with reason and day; the days' range is pushed to the scan."""
    known = sorted(d for d in set(days) if d is not None)
    rows = with_group_key(orders)
    parts = []
    if known:
        parts.append(extract_backfill(rows, known[0], known[-1]).where(F.col("date").isin(known)))
    if None in set(days):
        parts.append(rows.where(F.col("created_at").isNull()))
    if not parts:
        return _with_day(rows.where(F.lit(False)))
    return _with_day(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))


def all_rejects(orders: DataFrame) -> DataFrame:
    return _with_day(with_group_key(orders))


def _with_day(rows: DataFrame) -> DataFrame:
    return Q.rejected_orders(rows.withColumn(DAY, F.col("date")).drop("date", "order_date"))


def replace_rejects(rejects: DataFrame, path: str, days: Iterable[_dt.date | None] | None) -> None:
    """Replaces the rejects of ``days`` (None: all of them)."""
    from dailytally.sources.metrics_table import _files, _names

    top = path.rstrip("/")
    # A day with very many rejects is spread over tasks.
    laid = rejects.hint("rebalance", DAY).write.partitionBy(DAY)
    if days is None:
        laid.mode("overwrite").parquet(top)
        return
    laid.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(top)
    left = {NO_DAY if r[0] is None else r[0].isoformat() for r in rejects.select(DAY).distinct().collect()}
    fs, make = _files(rejects.sparkSession, top)
    touched = {NO_DAY if d is None else d.isoformat() for d in days}
    for name in _names(rejects.sparkSession, f"{top}/{DAY}=*"):
        if (day := name.rsplit("=", 1)[1]) in touched and day not in left:
            fs.delete(make(name), True)
