import datetime as dt
from decimal import Decimal

from conftest import order

from dailytally.operators import load as L
from dailytally.schemas import METRICS

D = dt.date(2024, 1, 15)


def metric(rest="rest_001", day=D, country="IN", total=10, completed=7, cancelled=2, revenue="4200.00"):
    return (rest, day, country, total, completed, cancelled, Decimal(revenue))


def test_upsert_inserts_into_empty(spark):
    target = spark.createDataFrame([], METRICS)
    new = spark.createDataFrame([metric()], METRICS)
    assert L.upsert(target, new).count() == 1


def test_upsert_replaces_in_place(spark):
    target = spark.createDataFrame([metric(total=5, completed=1, cancelled=1, revenue="10.00")], METRICS)
    new = spark.createDataFrame([metric()], METRICS)
    rows = L.upsert(target, new).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.total_orders, r.completed_orders, r.cancelled_orders, r.gross_revenue) == (10, 7, 2, Decimal("4200.00"))


def test_upsert_empty_changes_nothing(spark):
    target = spark.createDataFrame([metric()], METRICS)
    out = L.upsert(target, spark.createDataFrame([], METRICS))
    assert out.exceptAll(target).count() == 0 and out.count() == 1


def test_upsert_five_groups(spark):
    new = spark.createDataFrame([metric(rest=f"rest_{i}") for i in range(5)], METRICS)
    assert L.upsert(spark.createDataFrame([], METRICS), new).count() == 5


def test_upsert_sets_not_increments(spark):
    m = spark.createDataFrame([metric(total=10, completed=8, cancelled=5, revenue="5000.00")], METRICS)
    once = L.upsert(spark.createDataFrame([], METRICS), m)
    twice = L.upsert(once, m).collect()
    assert len(twice) == 1
    assert (twice[0].total_orders, twice[0].completed_orders, twice[0].gross_revenue) == (10, 8, Decimal("5000.00"))


def test_upsert_counts(spark):
    target = spark.createDataFrame([metric("a"), metric("b"), metric("c", total=1)], METRICS)
    new = spark.createDataFrame([metric("a"), metric("c", total=2), metric("d")], METRICS)
    r = L.upsert_counts(target, new).first()
    assert (r.inserted, r.modified, r.unchanged, r.upserted) == (1, 1, 1, 2)


def test_insert_if_absent_keeps_existing(orders_df):
    a = order(order_id="1", status="placed")
    b = order(order_id="2", status="placed")
    existing = orders_df([a])
    incoming = orders_df([a[:3] + ("completed",) + a[4:], b])
    out = {r.order_id: r.status for r in L.insert_if_absent(existing, incoming).collect()}
    assert out == {"1": "placed", "2": "placed"}


def test_apply_changes_latest_wins(orders_df):
    t0 = dt.datetime(2024, 1, 15, 10)
    a = order(order_id="1", status="placed", created_at=t0)
    snap = orders_df([a, order(order_id="2", created_at=t0)])
    changes = orders_df(
        [
            a[:3] + ("completed",) + a[4:7] + (dt.datetime(2024, 1, 16),),
            a[:3] + ("cancelled",) + a[4:7] + (dt.datetime(2024, 1, 17),),
            order(order_id="3", created_at=t0),
        ]
    )
    out = {r.order_id: r.status for r in L.apply_changes(snap, changes).collect()}
    assert out == {"1": "cancelled", "2": "placed", "3": "placed"}


def test_documents_form(spark):
    m = spark.createDataFrame([metric(revenue="425.50")], METRICS)
    run = dt.datetime(2024, 4, 7, 12)
    r = L.to_documents(m, run).first()
    assert r.date == "2024-01-15" and r.gross_revenue == 425.5 and r.last_updated_at == run
    assert dict(L.to_documents(m, run).dtypes)["gross_revenue"] == "double"


def test_insert_if_absent_on_day_layout(spark, orders_df, workdir):
    from dailytally.sources.orders import read_orders_by_day, write_orders_by_day

    t = dt.datetime(2024, 1, 15, 10)
    a = order(order_id="1", status="placed", created_at=t)
    write_orders_by_day(orders_df([a]), f"{workdir}/o")
    existing = read_orders_by_day(spark, f"{workdir}/o")
    incoming = orders_df([a[:3] + ("completed",) + a[4:], order(order_id="2", created_at=dt.datetime(2024, 1, 16))])
    out = {r.order_id: (r.status, r.order_date) for r in L.insert_if_absent(existing, incoming).collect()}
    assert out == {"1": ("placed", dt.date(2024, 1, 15)), "2": ("placed", dt.date(2024, 1, 16))}
