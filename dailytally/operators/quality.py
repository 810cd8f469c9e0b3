"""Row and metric contracts as column rules.

No row objects and no UDF: each rule is a boolean column, evaluated inside
the scan stage. Two ways to act on bad order rows:

* strict (the reference's way): the first bad row fails the job, lazily,
  through ``raise_error`` inside a filter, so no extra pass is needed;
* quarantine: split into valid rows and rejects with a reason column, so the
  rejects can be written aside while the valid rows go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailytally.config import COUNTRY_CODE_LENGTH, DATE_TEXT_PATTERN, ORDER_COLS, STATUSES

#: Column of text sources: the line, where it could not be parsed whole.
RAW_COL = "raw_line"


def normalize_orders(orders: DataFrame) -> DataFrame:
    """Upper-case country (before keys are built on *both* sides)."""
    return orders.withColumn("country", F.upper(F.col("country")))


def reject_reason(prefix: str = "") -> Column:
    """First violated rule of an order row, NULL when the row is valid."""
    c = lambda name: F.col(prefix + name)
    missing = None
    for name in ORDER_COLS:
        cond = c(name).isNull()
        missing = cond if missing is None else (missing | cond)
    return (
        F.when(missing, F.lit("missing_field"))
        .when(~c("status").isin(*STATUSES), F.lit("bad_status"))
        .when(c("amount") < 0, F.lit("negative_amount"))
        .when(F.char_length(c("country")) != COUNTRY_CODE_LENGTH, F.lit("bad_country"))
    )


def row_reason(orders: DataFrame) -> Column:
    """``reject_reason`` for the rows of ``orders``: those of a text source may be ``unparsed``."""
    if RAW_COL not in orders.columns:
        return reject_reason()
    return F.when(F.col(RAW_COL).isNotNull(), F.lit("unparsed")).otherwise(reject_reason())


def with_reject_reason(orders: DataFrame) -> DataFrame:
    return orders.withColumn("reject_reason", row_reason(orders))


def valid_orders(orders: DataFrame) -> DataFrame:
    """Rows passing every rule."""
    return orders.where(row_reason(orders).isNull())


def rejected_orders(orders: DataFrame) -> DataFrame:
    """Rows failing a rule, with the first failed rule."""
    return with_reject_reason(orders).where(F.col("reject_reason").isNotNull())


def enforce_strict(orders: DataFrame) -> DataFrame:
    """F6 strict mode: pass rows through, fail the job on a bad one."""
    reason = row_reason(orders)
    name = F.coalesce(F.col("order_id").cast("string"), *([F.col(RAW_COL)] if RAW_COL in orders.columns else []), F.lit("without id"))
    guard = F.when(reason.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("invalid order "), name, F.lit(": "), reason)))
    return orders.where(guard)


def contract_violations() -> Column:
    """a metric row that violates any rule (all rules of ``metrics_contract``)."""
    return (
        (F.least("total_orders", "completed_orders", "cancelled_orders") < 0)
        | (F.col("gross_revenue") < 0)
        | F.col("date").isNull()
        | (F.char_length("country") != COUNTRY_CODE_LENGTH)
    )


def metrics_contract(metrics: DataFrame) -> DataFrame:
    """number of metric rows violating each rule (one row)."""
    date_text = F.date_format("date", "yyyy-MM-dd") if dict(metrics.dtypes)["date"] == "date" else F.col("date")
    return metrics.agg(
        F.count(F.lit(1)).alias("metric_rows"),
        F.count_if(
            (F.col("total_orders") < 0) | (F.col("completed_orders") < 0) | (F.col("cancelled_orders") < 0)
        ).alias("negative_counts"),
        F.count_if(F.col("gross_revenue") < 0).alias("negative_revenue"),
        F.count_if(~date_text.rlike(DATE_TEXT_PATTERN)).alias("bad_dates"),
        F.count_if(F.char_length("country") != COUNTRY_CODE_LENGTH).alias("bad_countries"),
    )


def consistency_flag() -> Column:
    """F8: total >= completed + cancelled."""
    return F.col("total_orders") >= F.col("completed_orders") + F.col("cancelled_orders")


def metrics_consistency(metrics: DataFrame) -> DataFrame:
    """F8: every metric with its consistency flag (a warning, rows still load)."""
    return metrics.withColumn("is_consistent", consistency_flag())
