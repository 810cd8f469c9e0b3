"""Progress state per job id (S6, W3, W4, R7) as DataFrame operations.

A state frame has the ``dailytally.schemas.STATE`` columns, one row per
``pipeline_id``. These functions compute the next state; storing it is the
job of ``dailytally.sources.state_log`` (append-only, so a crash never
leaves a half-written state).

Unlike the reference, the stored mark keeps microseconds: rounding it up to
the millisecond would skip rows stamped inside that millisecond. Use
``dailytally.functions.columns.ceil_millis`` only for a millisecond store.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailytally.config import EPOCH
from dailytally.functions.columns import ts_ntz
from dailytally.schemas import STATE

STATE_COLS = [f.name for f in STATE.fields]


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def watermark_of(state: DataFrame, pipeline_ids: DataFrame) -> DataFrame:
    """S6 for many ids: the stored mark of each requested id, epoch if none.

    ``pipeline_ids`` has one ``pipeline_id`` column.
    """
    ids = pipeline_ids.select("pipeline_id").distinct()
    found = state.groupBy("pipeline_id").agg(F.max("last_watermark").alias("_wm"))
    return ids.join(found, "pipeline_id", "left").select(
        "pipeline_id", F.coalesce(F.col("_wm"), ts_ntz(EPOCH)).alias("last_watermark")
    )


def get_watermark(state: DataFrame, pipeline_id: str) -> _dt.datetime:
    """The mark of one id as a Python value (epoch when absent)."""
    row = (
        state.where(F.col("pipeline_id") == F.lit(pipeline_id))
        .agg(F.coalesce(F.max("last_watermark"), ts_ntz(EPOCH)).alias("wm"))
        .first()
    )
    return row["wm"]


def save_state(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert whole state rows by ``pipeline_id`` (all fields set)."""
    upd = updates.select(*STATE_COLS)
    return state.select(*STATE_COLS).join(upd.select("pipeline_id"), "pipeline_id", "left_anti").unionByName(upd)


def save_row(
    spark: SparkSession,
    pipeline_id: str,
    watermark: _dt.datetime,
    run_at: _dt.datetime,
    rows_processed: int = 0,
    groups_affected: int = 0,
) -> DataFrame:
    """The state row a successful run writes."""
    return spark.createDataFrame(
        [(pipeline_id, watermark, run_at, int(rows_processed), int(groups_affected))], STATE
    )


def reset_state(state: DataFrame, pipeline_ids: DataFrame, run_at: _dt.datetime) -> DataFrame:
    """Mark back to epoch for the given ids, counters kept; inserted when
    absent (then without counters, like a partial document)."""
    ids = pipeline_ids.select("pipeline_id").distinct()
    s = state.select(*STATE_COLS)
    hit = s.join(ids, "pipeline_id", "left_semi").select(
        "pipeline_id",
        ts_ntz(EPOCH).alias("last_watermark"),
        ts_ntz(run_at).alias("last_run_at"),
        "rows_processed",
        "groups_affected",
    )
    absent = ids.join(s.select("pipeline_id"), "pipeline_id", "left_anti").select(
        "pipeline_id",
        ts_ntz(EPOCH).alias("last_watermark"),
        ts_ntz(run_at).alias("last_run_at"),
        F.lit(None).cast("long").alias("rows_processed"),
        F.lit(None).cast("long").alias("groups_affected"),
    )
    untouched = s.join(ids, "pipeline_id", "left_anti")
    return untouched.unionByName(hit).unionByName(absent)
