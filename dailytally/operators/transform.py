"""Group keys and metric (re)computation.

The metric of a group is always computed from *all* of its source rows
(never adjusted by deltas), so any recompute is idempotent.

Scale notes
-----------
* Every aggregate is algebraic (count, conditional count, decimal sum), so
  Spark aggregates partially before the one exchange: a hot group (say a
  third of all rows) arrives at its reducer as one partial row per task.
* The touched-groups recompute never shuffles raw rows:
  - small key set (count checked against a limit): broadcast left-semi join
    in the scan stage, then the partial aggregate;
  - large key set: a Bloom filter of the keys (``keyfilter``, of bounded size)
    drops nearly all untouched rows in the scan stage; then aggregate (partial +
    final) and inner-join the aggregate with the distinct keys (co-partitioned).
    An inner join is used on purpose: a left-semi join here would be pushed
    below the aggregate by the optimizer and shuffle raw rows again.
* Both paths first restrict ``created_at`` to the day range of the keys,
  which becomes a pushed Parquet filter, and a partition filter plus
  dynamic partition pruning on the day-partitioned layout.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailytally.config import DEFAULT_BROADCAST_KEY_LIMIT, KEY_COLS, REVENUE_TYPE
from dailytally.functions.columns import (
    is_cancelled,
    is_completed,
    order_date,
    parse_iso_date,
)
from dailytally.operators.extract import extract_backfill
from dailytally.operators.keyfilter import prefilter
from dailytally.session import materialize


def with_group_key(orders: DataFrame) -> DataFrame:
    """Add ``date`` = reporting day (from ``order_date`` when the layout
    carries it, so joins on it prune partitions)."""
    if "date" in orders.columns:
        return orders
    d = F.col("order_date") if "order_date" in orders.columns else order_date("created_at")
    return orders.withColumn("date", d)


def group_keys(orders: DataFrame) -> DataFrame:
    """Every order with its group key."""
    return with_group_key(orders).select("order_id", *KEY_COLS)


def affected_groups(changed: DataFrame) -> DataFrame:
    """Distinct group keys touched by a set of changed rows."""
    return with_group_key(changed).select(*KEY_COLS).distinct()


def aggregate_metrics(orders: DataFrame, extra: Sequence[Column] = (), counted: Column | None = None) -> DataFrame:
    """A1-A4: one metric row per group of the given rows (``extra``: more
    aggregates computed in the same pass; ``counted``: only rows of which it
    holds enter the metrics, the others just their group and ``extra``)."""
    done, off = is_completed(), is_cancelled()
    if counted is not None:
        done, off = done & counted, off & counted
    return (
        with_group_key(orders)
        .groupBy(*KEY_COLS)
        .agg(
            (F.count(F.lit(1)) if counted is None else F.count_if(counted)).alias("total_orders"),
            F.count_if(done).alias("completed_orders"),
            F.count_if(off).alias("cancelled_orders"),
            F.coalesce(F.sum(F.when(done, F.col("amount"))), F.lit(0))
            .cast(REVENUE_TYPE)
            .alias("gross_revenue"),
            *extra,
        )
    )


def daily_metrics_full(orders: DataFrame) -> DataFrame:
    """Metrics of every group, one aggregation, no join."""
    return aggregate_metrics(orders)


def key_profile(keys: DataFrame) -> tuple[int, _dt.date | None, _dt.date | None]:
    """Size and day range of a key set (one small aggregate)."""
    row = keys.agg(F.count(F.lit(1)), F.min("date"), F.max("date")).first()
    return int(row[0]), row[1], row[2]


def restrict_to_days(orders: DataFrame, first: _dt.date, last: _dt.date) -> DataFrame:
    """Keep rows created on ``first``..``last``; pushed to the scan."""
    return extract_backfill(orders, first, last)


def recompute_metrics(
    orders: DataFrame,
    keys: DataFrame,
    broadcast_key_limit: int = DEFAULT_BROADCAST_KEY_LIMIT,
) -> DataFrame:
    """Full metrics of exactly the groups in ``keys``.

    Empty key set -> empty result; a key without source rows yields no row.
    The key set is measured first (one small aggregate) and broadcast only
    when it holds at most ``broadcast_key_limit`` keys.
    """
    # The key set is used twice (its profile, then the join): written once so
    # the changed-row scan behind it runs once.
    keys = materialize(keys.select(*KEY_COLS).distinct())
    return recompute_known(orders, keys, *key_profile(keys), broadcast_key_limit)


def recompute_known(
    orders: DataFrame,
    keys: DataFrame,
    n: int,
    first: _dt.date | None,
    last: _dt.date | None,
    broadcast_key_limit: int = DEFAULT_BROADCAST_KEY_LIMIT,
) -> DataFrame:
    """J1 for distinct keys that were measured already: ``n`` of them on the days ``first``..``last``."""
    if n == 0 or first is None:
        return aggregate_metrics(orders.where(F.lit(False)))
    scoped = with_group_key(restrict_to_days(orders, first, last))
    if n <= broadcast_key_limit:
        touched = scoped.join(F.broadcast(keys), list(KEY_COLS), "left_semi")
        return aggregate_metrics(touched)
    return aggregate_metrics(prefilter(scoped, keys, n, KEY_COLS)).join(keys, list(KEY_COLS), "inner")


def recompute_affected(
    orders: DataFrame,
    changed: DataFrame,
    broadcast_key_limit: int = DEFAULT_BROADCAST_KEY_LIMIT,
) -> DataFrame:
    """Incremental step: metrics of every group the changed rows touch."""
    return recompute_metrics(orders, affected_groups(changed), broadcast_key_limit)


def recompute_days(orders: DataFrame, start: _dt.date | str, end: _dt.date | str) -> DataFrame:
    """Backfill fast form: every group of every day in range is complete by
    construction, so no semi-join is needed; filter the days, aggregate."""
    return aggregate_metrics(extract_backfill(orders, start, end))


def recompute_days_of(
    orders: DataFrame,
    days: DataFrame,
) -> DataFrame:
    """All groups of the given days (``days`` has one ``date`` column).

    The day set is bounded by the calendar, so it is broadcast; on the
    day-partitioned layout the semi-join prunes partitions at run time.
    """
    days = days.select("date").distinct()
    n, first, last = key_profile(days)
    if n == 0:
        return aggregate_metrics(orders.where(F.lit(False)))
    scoped = with_group_key(restrict_to_days(orders, first, last))
    return aggregate_metrics(scoped.join(F.broadcast(days), ["date"], "left_semi"))


def keys_from_arrays(
    spark: SparkSession,
    restaurant_ids: Sequence[str],
    dates: Sequence[str | _dt.date],
    countries: Sequence[str],
) -> DataFrame:
    """Three parallel arrays given by a caller -> key rows.

    The keys travel as an Arrow table (no literal per key in the plan); dates
    are ISO text parsed with ANSI semantics (bad text raises).
    """
    if not (len(restaurant_ids) == len(dates) == len(countries)):
        raise ValueError("key arrays must have equal length")
    iso = [d.isoformat() if isinstance(d, _dt.date) else str(d) for d in dates]
    columns = {"restaurant_id": restaurant_ids, "date_text": iso, "country": countries}
    rows = spark.createDataFrame(pa.table({k: pa.array(list(v), pa.string()) for k, v in columns.items()}))
    return rows.select("restaurant_id", parse_iso_date("date_text").alias("date"), "country")


__all__ = [
    "affected_groups",
    "aggregate_metrics",
    "daily_metrics_full",
    "group_keys",
    "key_profile",
    "keys_from_arrays",
    "recompute_affected",
    "recompute_days",
    "recompute_days_of",
    "recompute_known",
    "recompute_metrics",
    "restrict_to_days",
    "with_group_key",
]
