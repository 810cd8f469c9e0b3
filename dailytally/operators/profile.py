"""Table profiles and lookups."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailytally.config import KEY_COLS
from dailytally.functions.columns import date_lit


def orders_profile(orders: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, distinct restaurants, first and last creation time.

    ``approximate=True`` uses a HyperLogLog count for the distinct
    restaurants (no shuffle of distinct values at all).
    """
    distinct = (
        F.approx_count_distinct("restaurant_id") if approximate else F.count_distinct("restaurant_id")
    )
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        distinct.alias("restaurants"),
        F.min("created_at").alias("min_created_at"),
        F.max("created_at").alias("max_created_at"),
    )


def key_uniqueness(metrics: DataFrame, keys: Sequence[str] = KEY_COLS) -> DataFrame:
    """A10: row count, distinct keys, and keys stored more than once."""
    per_key = metrics.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").cast("long").alias("metric_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    )


def metric_lookup(metrics: DataFrame, restaurant_id: str, day: _dt.date | str, country: str) -> DataFrame:
    """The metric of one key. Filters on grouping columns pass below an
    aggregate, so on a computed metric frame this reads one day only."""
    return metrics.where(
        (F.col("restaurant_id") == F.lit(restaurant_id))
        & (F.col("date") == date_lit(day))
        & (F.col("country") == F.lit(country))
    )
