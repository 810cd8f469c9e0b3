"""Differences of two snapshots of the orders table, without a change stamp (W6 with deletes).

Each day gets a digest that doesn't depend on the order of its rows: their number, and the sum and
xor of their hashes. Days with equal digests are left alone: no row of them is shuffled. The others,
given as a partition filter, are compared key by key. The digests of the older snapshot can be stored when
it is taken, so that it is read again only on the days that differ.

Two different days with equal digests would need equal counts, 64-bit sums and 64-bit xors of two
hashes at once; rows are not compared beyond that. ``key`` is unique in each snapshot and not null.
Rows without a day form a day of their own.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailytally.config import ORDER_COLS
from dailytally.functions.columns import order_date
from dailytally.sources.orders import ORDER_DATE_COL

DIGEST = ("rows", "sum_1", "sum_2", "xor_1", "xor_2")


def _day(rows: DataFrame) -> Column:
    return F.col(ORDER_DATE_COL) if ORDER_DATE_COL in rows.columns else order_date("created_at")


def day_digests(rows: DataFrame) -> DataFrame:
    """``day``, and the digest of its rows: partial aggregation, one row a day and task is shuffled."""
    hashes = [F.xxhash64(*ORDER_COLS), F.xxhash64(F.lit("second"), *reversed(ORDER_COLS))]
    return rows.select(_day(rows).alias("day"), *[h.alias(f"h{i}") for i, h in enumerate(hashes, 1)]).groupBy("day").agg(
        F.count("*").alias("rows"), *[F.sum(F.col(h).cast("decimal(20,0)")).alias(f"sum_{h[1:]}") for h in ("h1", "h2")],
        *[F.bit_xor(h).alias(f"xor_{h[1:]}") for h in ("h1", "h2")])


def changed_days(old_digests: DataFrame, new_digests: DataFrame) -> list[_dt.date | None]:
    """Days whose digests differ, or that only one side has (bounded by the calendar)."""
    a = old_digests.select("day", F.struct(*DIGEST).alias("a"))
    b = new_digests.select(F.col("day").alias("day_b"), F.struct(*DIGEST).alias("b"))
    both = a.join(b, F.col("day").eqNullSafe(F.col("day_b")), "full_outer")
    found = both.where(~F.col("a").eqNullSafe(F.col("b"))).select(F.when(F.col("a").isNull(), F.col("day_b")).otherwise(F.col("day")).alias("day"))
    return [r.day for r in found.collect()]


def of_days(rows: DataFrame, days: Iterable[_dt.date | None]) -> DataFrame:
    """The rows of some days, by a partition filter on the day layout."""
    days, day = set(days), _day(rows)
    some = day.isin(sorted(d for d in days if d is not None))
    return rows.where(some | day.isNull() if None in days else some)


def snapshot_diff(old: DataFrame, new: DataFrame, old_digests: DataFrame | None = None, key: str = "order_id") -> DataFrame:
    """One row per order that was inserted, changed or deleted: ``change`` and its row (a deleted one's last)."""
    days = changed_days(day_digests(old) if old_digests is None else old_digests, day_digests(new))
    a = of_days(old, days).select(F.col(key).alias("_key"), F.struct(*ORDER_COLS).alias("a"))
    b = of_days(new, days).select(key, F.struct(*ORDER_COLS).alias("b"))
    both = a.join(b, F.col("_key") == F.col(key), "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    change = F.when(F.col("a").isNull(), "inserted").when(F.col("b").isNull(), "deleted").otherwise("changed")
    row = F.coalesce("b", "a")
    return both.select(change.alias("change"), *[row[c].alias(c) for c in ORDER_COLS])
