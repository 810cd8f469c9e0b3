import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import SF001, order

from dailytally.config import EPOCH
from dailytally.operators import extract as X
from dailytally.operators.ledger import batch_ledger, number_changes
from dailytally.operators.synth import synth_orders
from dailytally.operators.transform import daily_metrics_full
from dailytally.plans import scenarios as SC
from dailytally.streaming.changefeed import replay_two_snapshots

T = dt.datetime


def brute_ledger(rows, n):
    """Pages of n in (updated_at, order_id) order, computed in plain Python."""
    rows = sorted(rows, key=lambda r: (r[7], r[0]))
    out = {}
    for i, r in enumerate(rows):
        b = i // n
        rows_, mx, keys = out.get(b, (0, None, set()))
        keys.add((r[1], r[6].date(), r[5]))
        out[b] = (rows_ + 1, max(mx, r[7]) if mx else r[7], keys)
    return {b: (v[0], v[1], len(v[2])) for b, v in out.items()}


def test_ledger_matches_brute_force_with_ties(orders_df):
    rnd = random.Random(7)
    hot = T(2024, 2, 1, 12)  # a third of all rows share one change time
    rows = []
    for i in range(300):
        created = T(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(0, 24 * 30))
        upd = hot if i % 3 == 0 else created + dt.timedelta(minutes=rnd.randrange(0, 5000))
        rows.append(order(f"rest_{rnd.randrange(4)}", "completed", "1.00", rnd.choice(["IN", "US"]), created, upd, order_id=f"{i:05d}"))
    df = orders_df(rows)
    for n in (7, 100):
        got = {r.batch_no: (r.batch_rows, r.max_updated_at, r.batch_groups) for r in batch_ledger(df, n, num_slices=5).collect()}
        assert got == brute_ledger(rows, n)


def test_number_changes_is_a_permutation(orders_df):
    rows = [order(order_id=f"{i:03d}", created_at=T(2024, 1, 1, i % 24)) for i in range(50)]
    seq = sorted(r.change_seq for r in number_changes(orders_df(rows), 4).collect())
    assert seq == list(range(50))


def test_synth_distribution(spark):
    df = synth_orders(spark, 20_000, 4).cache()
    assert df.count() == 20_000
    assert df.select("order_id").distinct().count() == 20_000
    st = {r.status: r["count"] for r in df.groupBy("status").count().collect()}
    assert abs(st["placed"] / 20_000 - 0.20) < 0.02
    assert abs(st["completed"] / 20_000 - 0.70) < 0.02
    assert abs(st["cancelled"] / 20_000 - 0.10) < 0.02
    r = df.agg({"amount": "min"}).first()[0], df.agg({"amount": "max"}).first()[0]
    assert Decimal("50.00") <= r[0] and r[1] <= Decimal("5000.00")
    assert df.select("country").distinct().count() == 6
    assert df.select("restaurant_id").distinct().count() == 500
    days = df.selectExpr("to_date(created_at) d").distinct().count()
    assert days == 91
    late = df.where("updated_at > created_at")
    assert late.where("status = 'placed'").count() == 0
    nonplaced = df.where("status <> 'placed'").count()
    assert abs(late.count() / nonplaced - 0.15) < 0.02
    again = synth_orders(spark, 20_000, 7)  # other partitioning, same rows
    assert again.exceptAll(df).count() == 0


def test_stream_equals_batch(spark):
    v2 = SC.source(spark, SF001)
    got = replay_two_snapshots(spark, v2, files=4)
    exp = daily_metrics_full(v2)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_extract_full_is_everything(spark):
    v2 = SC.source(spark, SF001)
    assert X.changed_since(v2, EPOCH).count() == v2.count() == 1500


def test_hot_group_holding_a_third_of_all_rows(spark, workdir):
    """One group with a third of all orders: every path gives the full
    GROUP BY answer, and the recompute never shuffles raw rows."""
    from dailytally.plans.jobs import JobConfig, MetricsJob
    from dailytally.sources.orders import read_orders_by_day, write_orders_by_day

    write_orders_by_day(synth_orders(spark, 30_000, 4, hot_share=1 / 3), f"{workdir}/o")
    o = read_orders_by_day(spark, f"{workdir}/o")
    hot = o.where("restaurant_id = 'rest_0000' AND order_date = date'2024-01-01' AND country = 'IN'").count()
    assert 9_000 < hot < 11_000
    exp = daily_metrics_full(o.drop("order_date"))
    changed = o.where("restaurant_id = 'rest_0000'")
    from dailytally.operators.transform import recompute_affected

    for limit in (10**6, 0):  # broadcast semi-join path, aggregate-then-join path
        got = recompute_affected(o, changed, broadcast_key_limit=limit)
        want = exp.where("restaurant_id = 'rest_0000'")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    job = MetricsJob(spark, o, JobConfig(metrics_path=f"{workdir}/m", state_path=f"{workdir}/s"))
    job.run_full()
    got = job.read_metrics()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


@pytest.mark.parametrize("step", ["rejects", "versions", "metrics"])
def test_stream_batch_killed_after_a_step_is_repaired_by_its_replay(spark, orders_df, workdir, step):
    from dailytally.sources.metrics_table import read_metrics
    from dailytally.streaming.changefeed import ChangeFeedJob

    t = T(2024, 1, 15, 10)
    a = order(order_id="a", status="placed", amount="10.00", created_at=t)
    b = order(order_id="b", status="completed", amount="5.00", created_at=T(2024, 1, 16, 9))
    gone = order(order_id="d", status="completed", amount="7.00", created_at=T(2024, 1, 18))
    job = ChangeFeedJob(spark, f"{workdir}/orders", f"{workdir}/metrics", f"{workdir}/rejects")
    job.load_initial(orders_df([a, b, gone]))
    batch = orders_df([
        a[:3] + ("completed",) + a[4:7] + (T(2024, 1, 20),),
        order(order_id="c", created_at=t, country="in"),
        gone[:3] + ("bogus",) + gone[4:7] + (T(2024, 1, 21),),  # turned bad: its day is left empty
    ])

    def die(at):
        if at == step:
            raise RuntimeError("lost")

    job.after = die
    with pytest.raises(RuntimeError):
        job.process_batch(batch, 0)
    job.after = lambda at: None
    job.process_batch(batch, 0)  # the replay
    got = {(r.restaurant_id, r.date.day, r.country): (r.total_orders, r.completed_orders, r.gross_revenue)
           for r in read_metrics(spark, f"{workdir}/metrics").collect()}
    assert got == {("rest_001", 15, "IN"): (2, 1, Decimal("10.00")), ("rest_001", 16, "IN"): (1, 1, Decimal("5.00"))}
    assert [r.order_id for r in spark.read.parquet(f"{workdir}/rejects").collect()] == ["d"]
    plan = job.current([dt.date(2024, 1, 15), dt.date(2024, 3, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [order_date" in plan and "IN (2024-01-15,2024-03-01)" in plan
