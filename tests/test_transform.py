import datetime as dt
from decimal import Decimal

import pytest
from conftest import order

from dailytally.operators import quality as Q
from dailytally.operators import transform as TR

D = dt.datetime


def test_unique_groups(orders_df):
    df = orders_df(
        [
            order("rest_001", created_at=D(2024, 1, 15, 9)),
            order("rest_001", created_at=D(2024, 1, 15, 18)),
            order("rest_002", created_at=D(2024, 1, 15, 9)),
        ]
    )
    keys = TR.affected_groups(df).collect()
    assert sorted((k.restaurant_id, k.date, k.country) for k in keys) == [
        ("rest_001", dt.date(2024, 1, 15), "IN"),
        ("rest_002", dt.date(2024, 1, 15), "IN"),
    ]


def test_created_date_wins(orders_df):
    df = orders_df([order(created_at=D(2024, 1, 15, 10), updated_at=D(2024, 1, 20, 10))])
    assert TR.affected_groups(df).first().date == dt.date(2024, 1, 15)


def test_counts_and_revenue(orders_df):
    rows = [
        order(status="completed", amount="100.00"),
        order(status="completed", amount="250.50"),
        order(status="completed", amount="75.00"),
        order(status="cancelled", amount="300.00"),
        order(status="placed", amount="150.00"),
        order(status="placed", amount="200.00"),
    ]
    df = orders_df(rows)
    m = TR.recompute_affected(df, df).collect()
    assert len(m) == 1
    r = m[0]
    assert (r.total_orders, r.completed_orders, r.cancelled_orders) == (6, 3, 1)
    assert r.gross_revenue == Decimal("425.50")


def test_cancelled_only_has_zero_revenue(orders_df):
    df = orders_df([order(status="cancelled", amount="999.99")])
    r = TR.recompute_affected(df, df).first()
    assert (r.total_orders, r.completed_orders, r.cancelled_orders) == (1, 0, 1)
    assert r.gross_revenue == Decimal("0.00")


def test_two_groups(orders_df):
    df = orders_df(
        [
            order("rest_001", status="completed", amount="100.00"),
            order("rest_002", status="completed", amount="200.00"),
        ]
    )
    got = {r.restaurant_id: r.gross_revenue for r in TR.recompute_affected(df, df).collect()}
    assert got == {"rest_001": Decimal("100.00"), "rest_002": Decimal("200.00")}


def test_empty_keys_give_empty_result(orders_df, spark):
    df = orders_df([order()])
    keys = TR.keys_from_arrays(spark, [], [], [])
    assert TR.recompute_metrics(df, keys).count() == 0


def test_recompute_reads_all_rows_of_a_group(orders_df):
    old = order("rest_001", status="completed", amount="10.00", created_at=D(2024, 1, 15, 1))
    new = order("rest_001", status="completed", amount="5.00", created_at=D(2024, 1, 15, 2), updated_at=D(2024, 2, 1))
    df = orders_df([old, new])
    changed = df.where("updated_at > timestamp_ntz'2024-01-31 00:00:00'")
    r = TR.recompute_affected(df, changed).first()
    assert r.total_orders == 2 and r.gross_revenue == Decimal("15.00")


def test_broadcast_and_shuffle_paths_agree(orders_df):
    rows = [
        order(f"rest_{i % 4:03d}", status=("completed", "cancelled", "placed")[i % 3], amount=f"{i}.25",
              country=("IN", "US")[i % 2], created_at=D(2024, 1, 1 + i % 9, i % 24))
        for i in range(200)
    ]
    df = orders_df(rows)
    changed = df.where("created_at < timestamp_ntz'2024-01-04 00:00:00'")
    a = TR.recompute_affected(df, changed, broadcast_key_limit=10_000)
    b = TR.recompute_affected(df, changed, broadcast_key_limit=0)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_given_arrays(orders_df, spark):
    df = orders_df([order("rest_001", status="completed", amount="7.00")])
    keys = TR.keys_from_arrays(spark, ["rest_001", "rest_404"], ["2024-01-15", "2024-01-15"], ["IN", "IN"])
    rows = TR.recompute_metrics(df, keys).collect()
    assert [(r.restaurant_id, r.gross_revenue) for r in rows] == [("rest_001", Decimal("7.00"))]


def test_given_arrays_bad_date_raises(orders_df, spark):
    df = orders_df([order()])
    with pytest.raises(Exception):
        TR.recompute_metrics(df, TR.keys_from_arrays(spark, ["rest_001"], ["2024-13-45"], ["IN"])).collect()


def test_lowercase_country_counted_under_upper(orders_df):
    df = Q.normalize_orders(orders_df([order(country="in"), order(country="IN")]))
    rows = TR.recompute_affected(df, df).collect()
    assert [(r.country, r.total_orders) for r in rows] == [("IN", 2)]


def test_consistency_flag(orders_df, spark):
    m = spark.createDataFrame(
        [("r", dt.date(2024, 1, 1), "IN", 3, 2, 1, Decimal("1.00")), ("r", dt.date(2024, 1, 2), "IN", 1, 1, 1, Decimal("1.00"))],
        "restaurant_id string, date date, country string, total_orders long, completed_orders long, "
        "cancelled_orders long, gross_revenue decimal(18,2)",
    )
    flags = {r.date.day: r.is_consistent for r in Q.metrics_consistency(m).collect()}
    assert flags == {1: True, 2: False}


def test_days_recompute_equals_filtered_full(orders_df):
    rows = [order(f"rest_{i % 3}", status="completed", amount="1.00", created_at=D(2024, 1, 1 + i % 20)) for i in range(60)]
    df = orders_df(rows)
    a = TR.recompute_days(df, dt.date(2024, 1, 5), dt.date(2024, 1, 9))
    b = TR.daily_metrics_full(df).where("date between date'2024-01-05' and date'2024-01-09'")
    assert a.count() == 15
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
