"""Synthetic orders (G1), generated on the executors.

Every column is a pure function of a row id, built from integer mixing
modulo the prime 2^31-1 (products stay below 2^62, so ANSI mode never sees
an overflow). A retried task regenerates exactly the same rows, unlike
``rand()``, and the same rows can be derived in plain SQL.

Distribution (see ``dailytally.config`` fixed values): 500 restaurants,
6 countries, status placed/completed/cancelled 20/70/10 %, amount uniform
50.00-5000.00, created on one of 91 days from 2024-01-01 at a uniform second
of the day; 15 % of non-placed orders changed 1-5 days and 0-23 hours later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailytally.config import (
    SYNTH_COUNTRIES,
    SYNTH_DAYS,
    SYNTH_LATE_PERCENT,
    SYNTH_RESTAURANTS,
    SYNTH_START,
    SYNTH_STATUS_WEIGHTS,
)
from dailytally.functions.columns import ts_ntz

PRIME = 2147483647
# Multipliers of the two mixing rounds (full-period multipliers mod 2^31-1).
ROUND1 = 742938285
ROUND2 = 950706376
# Offset between the streams of different columns.
STREAM_STEP = 1000003

_AMOUNT_MIN_CENTS = 5000
_AMOUNT_SPAN_CENTS = 495001  # 50.00 .. 5000.00 inclusive


def uniform(row_id: Column, stream: int, modulus: int) -> Column:
    """Deterministic integer in [0, modulus) for a row and a column stream."""
    x = (row_id + F.lit(stream * STREAM_STEP)) % PRIME
    x = (x * ROUND1) % PRIME
    x = x.bitwiseXOR(F.shiftright(x, 16))
    x = (x * ROUND2) % PRIME
    return x % modulus


def synth_orders_from_ids(ids: DataFrame, id_col: str = "id", hot_share: float = 0.0) -> DataFrame:
    """One synthetic order per row id of ``ids`` (ids must be >= 0).

    ``hot_share`` (0..1) puts that share of the orders into one group
    (``rest_0000``, first day, first country): a skew test of the plans.
    """
    rid = F.col(id_col).cast("long")
    hot = uniform(rid, 11, 1_000_000) < F.lit(int(round(hot_share * 1_000_000)))
    p_placed, p_completed, _ = SYNTH_STATUS_WEIGHTS
    pick = uniform(rid, 2, 100)
    status = (
        F.when(pick < p_placed, F.lit("placed"))
        .when(pick < p_placed + p_completed, F.lit("completed"))
        .otherwise(F.lit("cancelled"))
    )
    country_idx = F.when(hot, F.lit(0)).otherwise(uniform(rid, 4, len(SYNTH_COUNTRIES)))
    country = F.element_at(F.array(*[F.lit(c) for c in SYNTH_COUNTRIES]), (country_idx + 1).cast("int"))
    day = F.when(hot, F.lit(0)).otherwise(uniform(rid, 5, SYNTH_DAYS))
    secs = (day * 86400 + uniform(rid, 6, 86400)).cast("int")
    created = ts_ntz(SYNTH_START) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))
    late_shift = F.make_dt_interval(
        (1 + uniform(rid, 8, 5)).cast("int"), uniform(rid, 9, 24).cast("int"), F.lit(0), F.lit(0)
    )
    base = ids.select(
        rid.alias("_rid"),
        F.concat(F.lit("ord_"), rid.cast("string")).alias("order_id"),
        F.concat(
            F.lit("rest_"),
            F.lpad(F.when(hot, F.lit(0)).otherwise(uniform(rid, 1, SYNTH_RESTAURANTS)).cast("string"), 4, "0"),
        ).alias("restaurant_id"),
        F.concat(F.lit("user_"), uniform(rid, 10, PRIME).cast("string")).alias("user_id"),
        status.alias("status"),
        ((uniform(rid, 3, _AMOUNT_SPAN_CENTS) + _AMOUNT_MIN_CENTS).cast("decimal(14,2)") / 100)
        .cast("decimal(12,2)")
        .alias("amount"),
        country.alias("country"),
        created.cast("timestamp_ntz").alias("created_at"),
        late_shift.alias("_shift"),
        (uniform(rid, 7, 100) < SYNTH_LATE_PERCENT).alias("_late"),
    )
    updated = F.when(
        (F.col("status") != F.lit("placed")) & F.col("_late"), F.col("created_at") + F.col("_shift")
    ).otherwise(F.col("created_at"))
    return base.withColumn("updated_at", updated.cast("timestamp_ntz")).drop("_rid", "_shift", "_late")


def synth_orders(spark: SparkSession, n: int, num_partitions: int | None = None, hot_share: float = 0.0) -> DataFrame:
    """``n`` synthetic orders, ids 0..n-1, spread over ``num_partitions``."""
    parts = num_partitions or max(1, spark.sparkContext.defaultParallelism)
    return synth_orders_from_ids(spark.range(0, n, 1, parts), "id", hot_share)
