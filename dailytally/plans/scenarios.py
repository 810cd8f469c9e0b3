"""Scenarios derived from the driver tables by Spark (FIXTURES.md).

Everything here is computed from the ``orders`` adapter, so its work grows
with the tables; nothing is made up. Constants are the scenario parameters
of FIXTURES.md.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailytally.config import KEY_COLS, ORDER_COLS
from dailytally.functions.columns import ts_ntz
from dailytally.operators.transform import with_group_key
from dailytally.sources.orders import adapt_tpch_orders

MARK = _dt.datetime(2024, 4, 1)  # "wm"
SPLIT = _dt.datetime(2024, 2, 15)  # T of the two-snapshot method
BACKFILL_START = _dt.date(2024, 1, 10)
BACKFILL_END = _dt.date(2024, 1, 17)
PAGE_SIZE = 100
RUN_TS = _dt.datetime(2024, 4, 7, 12, 0, 0)  # fixed run stamp


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt_tpch_orders(spark, sf_dir)


def snapshot_v1(orders: DataFrame, split: _dt.datetime = SPLIT) -> DataFrame:
    """The table as it was at ``split``: later rows absent, later changes
    not yet made (status back to placed, stamp back to creation)."""
    t = ts_ntz(split)
    later = F.col("updated_at") > t
    return orders.where(F.col("created_at") <= t).select(
        "order_id",
        "restaurant_id",
        "user_id",
        F.when(later, F.lit("placed")).otherwise(F.col("status")).alias("status"),
        "amount",
        "country",
        "created_at",
        F.when(later, F.col("created_at")).otherwise(F.col("updated_at")).alias("updated_at"),
        *[c for c in orders.columns if c == "order_date"],  # the layout's day, for pruning
    )


def changes_after(orders: DataFrame, split: _dt.datetime = SPLIT) -> DataFrame:
    """The change feed from v1 to v2: every row version stamped after split."""
    return orders.where(F.col("updated_at") > ts_ntz(split))


def late_rows(orders: DataFrame, split: _dt.datetime = SPLIT) -> DataFrame:
    """Rows created by ``split`` and changed after it (late changes)."""
    t = ts_ntz(split)
    return orders.where((F.col("created_at") <= t) & (F.col("updated_at") > t))


def with_defects(orders: DataFrame) -> DataFrame:
    """Deterministic bad rows for the quality rules: every 50th order gets a
    negative amount, every 70th a one-letter country, every 110th an unknown
    status, every 130th no user."""
    k = F.col("order_id").cast("long")
    return orders.select(
        "order_id",
        "restaurant_id",
        F.when(k % 130 != 0, F.col("user_id")).alias("user_id"),
        F.when(k % 110 == 0, F.lit("refunded")).otherwise(F.col("status")).alias("status"),
        F.when(k % 50 == 0, -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        F.when(k % 70 == 0, F.substring("country", 1, 1)).otherwise(F.col("country")).alias("country"),
        "created_at",
        "updated_at",
    )


def as_json_lines(orders: DataFrame) -> DataFrame:
    """The orders as JSON lines, some of them broken: every 60th is cut short, every 90th has an
    amount that is no number, every 77th no user, every 101st a change time that is none."""
    k = F.col("order_id").cast("long")

    def text(name: str, value: F.Column) -> F.Column:
        return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))

    def stamp(name: str) -> F.Column:
        return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")

    parts = [
        text("order_id", F.col("order_id")), text("restaurant_id", F.col("restaurant_id")),
        F.when(k % 77 != 0, text("user_id", F.col("user_id"))), text("status", F.col("status")),
        F.concat(F.lit('"amount":'), F.when(k % 90 == 0, F.lit('"n/a"')).otherwise(F.col("amount").cast("string"))),
        text("country", F.col("country")), text("created_at", stamp("created_at")),
        text("updated_at", F.when(k % 101 == 0, F.lit("soon")).otherwise(stamp("updated_at"))),
    ]
    line = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return orders.select(F.when(k % 60 == 0, F.substring(line, 1, 50)).otherwise(line).alias("value"))


def with_deletes(orders: DataFrame) -> DataFrame:
    """Every 97th order is gone."""
    return orders.where(F.col("order_id").cast("long") % 97 != 0)


def with_late_defects(orders: DataFrame, split: _dt.datetime = SPLIT) -> DataFrame:
    """Late changes of even orders turn the row bad (negative amount)."""
    t = ts_ntz(split)
    bad = (F.col("created_at") <= t) & (F.col("updated_at") > t) & (F.col("order_id").cast("long") % 2 == 0)
    return orders.withColumn("amount", F.when(bad, -F.col("amount")).otherwise(F.col("amount")).cast("decimal(12,2)"))


def with_metric_defects(metrics: DataFrame) -> DataFrame:
    """Bad metrics on some days of a month: a negative count on the 13th,
    negative revenue on the 17th, a one-letter country on the 19th, more
    completed orders than orders on the 23rd."""
    day = F.dayofmonth("date")
    return metrics.withColumns({
        "total_orders": F.when(day == 13, -F.col("total_orders")).otherwise(F.col("total_orders")),
        "completed_orders": F.when(day == 23, F.col("total_orders") + 1).otherwise(F.col("completed_orders")),
        "country": F.when(day == 19, F.substring("country", 1, 1)).otherwise(F.col("country")),
        "gross_revenue": F.when(day == 17, -F.col("gross_revenue") - 1).otherwise(F.col("gross_revenue")).cast("decimal(22,2)"),
    })


def dirty_feed(changes: DataFrame) -> DataFrame:
    """What a careless producer sends: countries of every 11th order in lower
    case, and for every 17th order a later version that breaks a row rule."""
    k = F.col("order_id").cast("long")
    own = with_lowercase_countries(changes)
    later = (F.col("updated_at") + F.expr("INTERVAL 1 SECOND")).alias("updated_at")
    bad = own.where(k % 17 == 0).select(
        *[c for c in ORDER_COLS if c not in ("status", "amount", "updated_at")],
        F.lit("bogus").alias("status"), F.lit(-5).cast("decimal(12,2)").alias("amount"), later)
    return own.unionByName(bad)


def with_lowercase_countries(orders: DataFrame) -> DataFrame:
    """Every 11th order stores its country in lower case."""
    k = F.col("order_id").cast("long")
    return orders.withColumn(
        "country", F.when(k % 11 == 0, F.lower("country")).otherwise(F.col("country"))
    ).select(*ORDER_COLS)


def country_pipeline_id() -> F.Column:
    """One progress key per country (independent jobs, R7)."""
    return F.concat(F.lit("daily_metrics_"), F.lower(F.col("country")))


def per_country_state(orders: DataFrame, run_ts: _dt.datetime = RUN_TS) -> DataFrame:
    """State rows of per-country jobs that processed ``orders`` completely."""
    return (
        with_group_key(orders)
        .groupBy(country_pipeline_id().alias("pipeline_id"))
        .agg(
            F.max("updated_at").alias("last_watermark"),
            F.count(F.lit(1)).alias("rows_processed"),
            F.count_distinct(*KEY_COLS).alias("groups_affected"),
        )
        .select(
            "pipeline_id",
            "last_watermark",
            ts_ntz(run_ts).alias("last_run_at"),
            "rows_processed",
            "groups_affected",
        )
    )
