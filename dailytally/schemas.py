"""Explicit schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType(), False),
        T.StructField("restaurant_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("amount", T.DecimalType(12, 2), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("updated_at", T.TimestampNTZType(), False),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("restaurant_id", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("total_orders", T.LongType(), False),
        T.StructField("completed_orders", T.LongType(), False),
        T.StructField("cancelled_orders", T.LongType(), False),
        T.StructField("gross_revenue", T.DecimalType(22, 2), False),
    ]
)

# A metric row in the table: with the time of the run that wrote it.
STORED_METRICS = T.StructType([*METRICS.fields, T.StructField("last_updated_at", T.TimestampNTZType(), True)])

STATE = T.StructType(
    [
        T.StructField("pipeline_id", T.StringType(), False),
        T.StructField("last_watermark", T.TimestampNTZType(), False),
        T.StructField("last_run_at", T.TimestampNTZType(), True),
        T.StructField("rows_processed", T.LongType(), True),
        T.StructField("groups_affected", T.LongType(), True),
    ]
)
