"""The run on a keyed state store."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import order

from dailytally.operators.quality import valid_orders
from dailytally.operators.transform import daily_metrics_full
from dailytally.schemas import ORDERS
from dailytally.sources.metrics_table import read_metrics
from dailytally.streaming.keyedstate import KeyedStateJob

T = dt.datetime


def feed(orders_df, path):
    """Four files: a start, changes of status, group, day and value, a late version, one that turned bad, a tie."""
    a, b, c = (order(order_id=i, status="placed", amount="10.00", created_at=T(2024, 1, 15, 9)) for i in "abc")
    files = [
        [a, b, c],
        [a[:3] + ("completed",) + a[4:7] + (T(2024, 1, 20),), b[:1] + ("rest_x",) + b[2:7] + (T(2024, 1, 20),),
         c[:6] + (T(2024, 1, 17), T(2024, 1, 20)), order(order_id="d", country="us", status="cancelled", created_at=T(2024, 1, 17))],
        [a[:3] + ("cancelled",) + a[4:7] + (T(2024, 1, 18),), c[:3] + ("bogus",) + c[4:6] + (T(2024, 1, 17), T(2024, 1, 21))],  # the first is late
        [b[:1] + ("rest_x",) + b[2:4] + (Decimal("3.00"),) + b[5:7] + (T(2024, 1, 20),), a[:3] + ("completed", Decimal("4.50")) + a[5:7] + (T(2024, 2, 1),)],
    ]
    for i, rows in enumerate(files):
        orders_df(rows).coalesce(1).write.mode("append").parquet(f"{path}/{i}")
    return files


def latest(spark, files):
    best = {}
    for f in files:
        for r in f:
            if r[0] not in best or r[7] >= best[r[0]][7]:
                best[r[0]] = r
    rows = [r[:5] + (r[5].upper(),) + r[6:] for r in best.values()]
    return daily_metrics_full(valid_orders(spark.createDataFrame(rows, ORDERS)))


@pytest.mark.parametrize("step", [None, "written", "committed"])
def test_state_gives_the_metrics_of_the_latest_versions(orders_df, workdir, spark, step):
    files = feed(orders_df, f"{workdir}/c")
    job = KeyedStateJob(spark, f"{workdir}/m")
    died = []

    def die(at):
        if at == step and len(died) < 2:
            died.append(at)
            raise RuntimeError("lost")

    job.after = die
    for _ in range(3):
        try:
            job.run(f"{workdir}/c/*", f"{workdir}/ck", max_files_per_trigger=1)
        except Exception:  # the stream ends with its epoch; the next run replays it
            assert died
    assert len(died) == (2 if step else 0)
    got, exp = read_metrics(spark, f"{workdir}/m"), latest(spark, files)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    # Nothing new: no epoch, no new version.
    job.run(f"{workdir}/c/*", f"{workdir}/ck")
    assert read_metrics(spark, f"{workdir}/m").count() == exp.count()


def test_state_is_kept_by_buckets_of_orders_whose_number_the_checkpoint_notes(orders_df, workdir, spark):
    """a call and a state value per order took most of the time."""
    def row(i, status, day, amount="2.00"):
        return order(order_id=f"o{i}", user_id="u", restaurant_id=f"rest_{i % 3}", status=status, amount=amount, created_at=T(2024, 1, 1 + i % 4), updated_at=T(2024, 2, day))

    # Two versions of an order in an epoch, equal times (the least by columns counts), orders that turn bad and come back.
    start = [row(i, "placed", 1) for i in range(300)] + [row(i, "completed", 2) for i in range(0, 300, 5)]
    then = [row(i, "cancelled", 2) for i in range(0, 300, 10)] + [row(i, s, 3) for i in range(1, 300, 10) for s in ("completed", "bogus")]
    last = [row(i, "completed", 4, "7.00") for i in range(1, 300, 20)] + [row(i, "completed", 1) for i in range(0, 300, 2)]
    for k, rows in enumerate((start, then)):
        orders_df(rows).coalesce(1).write.parquet(f"{workdir}/c/{k}")
    KeyedStateJob(spark, f"{workdir}/m", buckets=5).run(f"{workdir}/c/*", f"{workdir}/ck", max_files_per_trigger=1)
    orders_df(last).coalesce(1).write.parquet(f"{workdir}/c/2")
    KeyedStateJob(spark, f"{workdir}/m", buckets=7).run(f"{workdir}/c/*", f"{workdir}/ck", max_files_per_trigger=1)
    assert spark.read.format("statestore").load(f"{workdir}/ck").count() <= 5
    best: dict = {}
    for rows in (start, then, last):
        own: dict = {}
        for r in rows:
            if r[0] not in own or (r[7], r[3] == "bogus") > (own[r[0]][7], own[r[0]][3] == "bogus"):
                own[r[0]] = r
        for i, r in own.items():
            if i not in best or r[7] >= best[i][7]:
                best[i] = r
    exp, got = daily_metrics_full(valid_orders(spark.createDataFrame(list(best.values()), ORDERS))), read_metrics(spark, f"{workdir}/m")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
