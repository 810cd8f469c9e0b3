import datetime as dt
from decimal import Decimal

import pytest
from conftest import order

from dailytally.config import EPOCH
from dailytally.functions.columns import ceil_millis
from dailytally.operators import quality as Q
from dailytally.operators import state as S
from dailytally.schemas import STATE


def test_reject_reasons(orders_df):
    df = orders_df(
        [
            order(order_id="ok"),
            order(order_id="neg", amount="-1.00"),
            order(order_id="cty", country="I"),
            order(order_id="sts", status="refunded"),
        ]
    )
    got = {r.order_id: r.reject_reason for r in Q.rejected_orders(df).collect()}
    assert got == {"neg": "negative_amount", "cty": "bad_country", "sts": "bad_status"}
    assert [r.order_id for r in Q.valid_orders(df).collect()] == ["ok"]


def test_strict_mode_fails_the_run(orders_df):
    df = orders_df([order(order_id="ok"), order(order_id="bad", amount="-5.00")])
    with pytest.raises(Exception, match="invalid order"):
        Q.enforce_strict(df).count()
    assert Q.enforce_strict(orders_df([order()])).count() == 1


def test_metrics_contract_counts(spark):
    m = spark.createDataFrame(
        [
            ("r", dt.date(2024, 1, 1), "IN", 1, 1, 0, Decimal("1.00")),
            ("r", dt.date(2024, 1, 2), "I", -1, 0, 0, Decimal("-2.00")),
        ],
        "restaurant_id string, date date, country string, total_orders long, completed_orders long, "
        "cancelled_orders long, gross_revenue decimal(18,2)",
    )
    r = Q.metrics_contract(m).first()
    assert (r.metric_rows, r.negative_counts, r.negative_revenue, r.bad_dates, r.bad_countries) == (2, 1, 1, 0, 1)


@pytest.mark.parametrize(
    "ts,expected",
    [
        (dt.datetime(2024, 1, 1, 0, 0, 0, 764976), dt.datetime(2024, 1, 1, 0, 0, 0, 765000)),
        (dt.datetime(2024, 1, 1, 0, 0, 0, 764000), dt.datetime(2024, 1, 1, 0, 0, 0, 764000)),
        (dt.datetime(2024, 1, 1, 23, 59, 59, 999001), dt.datetime(2024, 1, 2, 0, 0, 0, 0)),
        (dt.datetime(2024, 1, 1, 0, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 0, 0)),
    ],
)
def test_ceil_millis(spark, ts, expected):
    df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
    assert df.select(ceil_millis("ts").alias("c")).first().c == expected


def test_state_get_default_save_reset(spark):
    run = dt.datetime(2024, 5, 1)
    empty = S.empty_state(spark)
    assert S.get_watermark(empty, "p1") == EPOCH
    saved = S.save_state(empty, S.save_row(spark, "p1", dt.datetime(2024, 4, 1), run, 10, 3))
    assert S.get_watermark(saved, "p1") == dt.datetime(2024, 4, 1)
    assert S.get_watermark(saved, "p2") == EPOCH  # independent per id
    ids = spark.createDataFrame([("p1",), ("p9",)], "pipeline_id string")
    reset = {r.pipeline_id: r for r in S.reset_state(saved, ids, run).collect()}
    assert reset["p1"].last_watermark == EPOCH and reset["p1"].rows_processed == 10
    assert reset["p9"].last_watermark == EPOCH and reset["p9"].rows_processed is None
    saved2 = S.save_state(saved, S.save_row(spark, "p1", dt.datetime(2024, 4, 2), run, 1, 1))
    assert saved2.count() == 1 and S.get_watermark(saved2, "p1") == dt.datetime(2024, 4, 2)


def test_watermark_of_many(spark):
    st = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), None, None, None)], STATE)
    ids = spark.createDataFrame([("a",), ("b",)], "pipeline_id string")
    got = {r.pipeline_id: r.last_watermark for r in S.watermark_of(st, ids).collect()}
    assert got == {"a": dt.datetime(2024, 1, 1), "b": EPOCH}
