"""Bucketed orders: joins on the order id leave the table where it is; page bounds by sketch."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import random
import uuid

from conftest import SF001, order

from dailytally.operators import load as L
from dailytally.operators.ledger import page_bounds
from dailytally.plans import scenarios as SC
from dailytally.sources.orders import read_orders_bucketed, write_orders_bucketed

DAY = dt.datetime(2024, 1, 15)


def explained(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def exchanges_above_scan(df, folder: str) -> list[str]:
    """Exchanges by a hash that lie on the way from a scan of ``folder`` to the result."""
    way, found = [], []
    for line in explained(df).splitlines():
        text = line.lstrip(" :+-|")
        depth = len(line) - len(text)
        way = [w for w in way if w[0] < depth] + [(depth, text)]
        if "FileScan" in text and folder in text:
            found += [t for _, t in way if t.startswith("Exchange")]
    return found


def named() -> str:
    return f"orders_{uuid.uuid4().hex}"


def test_changes_move_to_the_tables_buckets(spark, workdir):
    # More shuffle partitions than buckets, and no broadcast of the changes: still no exchange of the table.
    v2 = SC.source(spark, SF001)
    v1 = write_orders_bucketed(SC.snapshot_v1(v2), f"{workdir}/bucketed", named(), 4)
    changes = SC.changes_after(v2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (L.apply_changes_colocated(v1, changes, 4), L.insert_if_absent_colocated(v1, v2, 4)):
            plan = explained(out)
            assert "Bucketed: true" in plan
            assert exchanges_above_scan(out, "bucketed") == []
        # The same join on the plain form of the table moves the table.
        plain = spark.read.parquet(f"{workdir}/bucketed")
        assert exchanges_above_scan(L.insert_if_absent_colocated(plain, v2, 4), "bucketed")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_colocated_forms_equal_the_plain_ones(spark, workdir):
    v2 = SC.source(spark, SF001)
    v1 = write_orders_bucketed(SC.snapshot_v1(v2), f"{workdir}/t", named(), 3)
    versions = SC.changes_after(v2)
    older = versions.withColumn("status", SC.F.lit("placed")).withColumn("updated_at", SC.F.expr("updated_at - interval 30 days"))
    changes = versions.unionByName(older)
    for a, b in (
        (L.apply_changes_colocated(v1, changes, 3), L.apply_changes(v1, changes)),
        (L.insert_if_absent_colocated(v1, changes, 3), L.insert_if_absent(v1, changes)),
        (L.apply_changes_colocated(v1, changes.limit(0), 3), v1),
        (L.insert_if_absent_colocated(v1, changes.limit(0), 3), v1),
    ):
        a, b = a.select(*b.columns), b
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0


def test_older_change_loses_and_equal_stamp_wins(spark, orders_df, workdir):
    at = DAY + dt.timedelta(hours=9)
    rows = [order(order_id=i, created_at=DAY, updated_at=at, status="placed") for i in ("a", "b", "c")]
    table = write_orders_bucketed(orders_df(rows), f"{workdir}/t", named(), 2)
    changes = orders_df([
        order(order_id="a", created_at=DAY, updated_at=at - dt.timedelta(seconds=1), status="cancelled"),
        order(order_id="b", created_at=DAY, updated_at=at, status="completed"),
        order(order_id="d", created_at=DAY, updated_at=at, status="cancelled"),
        order(order_id="d", created_at=DAY, updated_at=at + dt.timedelta(seconds=1), status="completed"),
    ])
    got = {r.order_id: r.status for r in L.apply_changes_colocated(table, changes, 2).collect()}
    assert got == {"a": "placed", "b": "completed", "c": "placed", "d": "completed"}
    got = {r.order_id: r.status for r in L.insert_if_absent_colocated(table, changes, 2).collect()}
    assert got == {"a": "placed", "b": "placed", "c": "placed", "d": "cancelled"}


def test_bucketed_table_is_entered_from_its_files(spark, workdir):
    v1 = SC.snapshot_v1(SC.source(spark, SF001))
    name, path = named(), f"{workdir}/it's"
    write_orders_bucketed(v1, path, name, 4)
    spark.sql(f"DROP TABLE {name}")
    again = read_orders_bucketed(spark, path, name, 4)
    assert again.count() == v1.count()
    assert exchanges_above_scan(again.groupBy("order_id").count(), "it's") == []


def bounds_by_hand(stamps: list[dt.datetime], size: int) -> list[dt.datetime]:
    ordered = sorted(stamps)
    return sorted({ordered[min(i + size, len(ordered)) - 1] for i in range(0, len(ordered), size)})


def test_page_bounds_by_sketch_are_exact(orders_df):
    rnd = random.Random(5)
    for hot in (0.0, 0.35):
        stamps = [DAY if rnd.random() < hot else DAY + dt.timedelta(microseconds=rnd.randrange(-10**10, 10**10)) for _ in range(900)]
        df = orders_df([order(order_id=str(i), created_at=DAY, updated_at=t) for i, t in enumerate(stamps)])
        for size in (1, 130, 900):
            # Cells of 7 rows are uneven under the sketch's error; the result is not.
            for cell_rows in (7, 10**6):
                want = bounds_by_hand(stamps, size)
                assert page_bounds(df, size, cell_rows=cell_rows) == want
                assert page_bounds(df, size, first=True, cell_rows=cell_rows) == want[:1]


def test_first_page_reads_one_cell_by_a_plain_range_and_sorts_nothing(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    plans = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: (plans.append(explained(self)), collect(self))[1])
    df = SC.source(spark, SF001)
    page_bounds(df, 100, first=True, cell_rows=100)
    assert not any("rangepartitioning" in p for p in plans)
    assert "Window" in plans[-1] and " <= " in plans[-1]
