"""Snapshot differences, stored sketches, compaction of the stream's versions, racing runs."""

import datetime as dt
import glob
from decimal import Decimal

import pytest
from conftest import SF001, order

from dailytally.operators import sketches as SK
from dailytally.operators.snapshot import changed_days, day_digests, of_days, snapshot_diff
from dailytally.operators.synth import synth_orders
from dailytally.operators.transform import daily_metrics_full
from dailytally.plans import scenarios as SC
from dailytally.plans.jobs import JobConfig, MetricsJob
from dailytally.sources.metrics_table import read_metrics
from dailytally.sources.orders import read_orders_by_day, write_orders_by_day
from dailytally.sources.state_log import ConcurrentRunError
from dailytally.streaming.changefeed import ChangeFeedJob

T = dt.datetime
RUN = T(2024, 6, 1)


def same(got, exp):
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_snapshot_diff_finds_changes_without_a_stamp(orders_df):
    a, b, c, d = (order(order_id=i, created_at=T(2024, 1, 10 + n)) for n, i in enumerate("abcd"))
    silent = b[:4] + (Decimal("9.00"),) + b[5:]  # no change time tells of it
    moved = c[:6] + (T(2024, 1, 25), c[7])
    new = order(order_id="n", created_at=T(2024, 1, 10))
    got = {(r.change, r.order_id, r.amount, r.created_at.day) for r in snapshot_diff(orders_df([a, b, c, d]), orders_df([a, silent, moved, new])).collect()}
    assert got == {("changed", "b", Decimal("9.00"), 11), ("changed", "c", Decimal("500.00"), 25), ("deleted", "d", Decimal("500.00"), 13),
                   ("inserted", "n", Decimal("500.00"), 10)}
    none = orders_df([])
    assert snapshot_diff(none, none).count() == 0 and snapshot_diff(orders_df([a]), orders_df([a])).count() == 0
    assert [r.change for r in snapshot_diff(none, orders_df([a])).collect()] == ["inserted"]


def test_equal_days_are_not_read_again(spark, workdir):
    write_orders_by_day(synth_orders(spark, 5000, 2), f"{workdir}/o")
    old = read_orders_by_day(spark, f"{workdir}/o")
    day = dt.date(2024, 2, 3)
    new = old.where(f"not (order_date = date'{day}' and pmod(xxhash64(order_id), 3) = 0)")
    digests = day_digests(old).cache()
    assert changed_days(digests, day_digests(new)) == [day]
    assert changed_days(digests, day_digests(old.repartition(5, "user_id"))) == []
    plan = of_days(old, [day])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "order_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    got = snapshot_diff(old, new, digests)
    assert {r.change for r in got.collect()} == {"deleted"} and got.count() == old.count() - new.count()


def test_sketches_are_close_and_merge(spark, workdir):
    o = synth_orders(spark, 60_000, 4).selectExpr(
        "order_id", "concat(restaurant_id, '_', cast(pmod(xxhash64(order_id), 40) as string)) AS restaurant_id", "user_id", "status",
        "amount", "country", "created_at", "updated_at").cache()
    SK.replace_sketches(o, f"{workdir}/s")
    kept = SK.read_sketches(spark, f"{workdir}/s")
    for first, last in ((None, None), (dt.date(2024, 1, 10), dt.date(2024, 1, 20)), (dt.date(2024, 2, 1), dt.date(2024, 2, 1))):
        own = o if first is None else o.where(f"to_date(created_at) between date'{first}' and date'{last}'")
        exact = own.selectExpr("count(*) n", "count(distinct restaurant_id) r", "min(created_at) a", "max(created_at) b").first()
        got = SK.profile_of(kept, first, last).first()
        assert (got[0], got[2], got[3]) == (exact.n, exact.a, exact.b)
        assert abs(got[1] - exact.r) <= 0.02 * exact.r
    assert tuple(SK.profile_of(kept, dt.date(2030, 1, 1)).first()) == (0, 0, None, None)
    SK.replace_sketches(o.where("to_date(created_at) <> date'2024-01-11'"), f"{workdir}/s", [dt.date(2024, 1, 11), dt.date(2024, 1, 12)])
    days = {r.date for r in SK.read_sketches(spark, f"{workdir}/s").collect()}
    assert dt.date(2024, 1, 11) not in days and len(days) == 90


def test_the_job_keeps_sketches_of_touched_days(spark, workdir):
    v2 = SC.source(spark, SF001).cache()
    cfg = JobConfig(metrics_path=f"{workdir}/m", state_path=f"{workdir}/s", sketch_path=f"{workdir}/k")
    MetricsJob(spark, SC.snapshot_v1(v2), cfg).run_full(run_at=RUN)
    job = MetricsJob(spark, v2, cfg)
    job.run_incremental(run_at=RUN)
    exact = v2.selectExpr("count(*)", "count(distinct restaurant_id)", "min(created_at)", "max(created_at)").first()
    assert tuple(job.profile().first()) == tuple(exact)
    assert "restaurant_id" not in job.profile()._jdf.queryExecution().executedPlan().toString()


def test_two_runs_of_one_id_cannot_both_save(orders_df, workdir, spark):
    a = order(order_id="a", status="completed", amount="1.00")
    cfg = JobConfig(metrics_path=f"{workdir}/m", state_path=f"{workdir}/s")
    slow, fast = (MetricsJob(spark, orders_df([a]), cfg) for _ in range(2))
    other = MetricsJob(spark, orders_df([a]), JobConfig(metrics_path=f"{workdir}/m2", state_path=f"{workdir}/s", pipeline_id="another/id"))

    def meanwhile():
        slow.after_write = None
        fast.run_incremental(run_at=RUN)
        other.run_incremental(run_at=RUN)  # an id of its own

    slow.after_write = meanwhile
    with pytest.raises(ConcurrentRunError):
        slow.run_incremental(run_at=RUN)
    assert fast.watermark() == other.watermark() == a[7]
    assert fast.run_incremental(run_at=RUN)["total_rows"] == 0


def epochs(orders_df, n, days=5):
    """Versions of orders on a few days; each epoch changes some of them."""
    for e in range(n):
        yield orders_df([
            (f"{d}-{k}", f"r{k}", "u", ("placed", "completed", "cancelled", "bogus")[(e + k) % 4], Decimal(f"{e + 1}.00"), "IN",
             T(2024, 1, 1 + d, 9), T(2024, 2, 1) + dt.timedelta(minutes=e // 2)) for d in range(days) for k in range(e % 3, 4)])


def check(job, spark, path, batches):
    """The metrics equal those of the latest versions, picked anew from all batches."""
    last = {}
    for e, rows in enumerate(batches):
        for r in rows:
            if r.order_id not in last or (r.updated_at, e) >= last[r.order_id][0]:
                last[r.order_id] = ((r.updated_at, e), r)
    from dailytally.operators.quality import valid_orders
    from dailytally.schemas import ORDERS

    want = daily_metrics_full(valid_orders(spark.createDataFrame([v for _, v in last.values()], ORDERS)))
    same(read_metrics(spark, path), want)


def test_fifty_epochs_leave_a_bounded_number_of_folders(spark, orders_df, workdir):
    job = ChangeFeedJob(spark, f"{workdir}/o", f"{workdir}/m", compact_epochs=4)
    job._refresh = lambda days, run_at: None  # the metrics once, at the end
    seen = []
    for e, batch in enumerate(epochs(orders_df, 50)):
        job.process_batch(batch, e, RUN)
        seen.append(batch.collect())
        for d in range(1, 6):
            assert len(glob.glob(f"{workdir}/o/order_date=2024-01-0{d}/epoch=*")) <= 2 + 2 * 5
    del job._refresh
    job._refresh(None, RUN)
    check(job, spark, f"{workdir}/m", seen)


@pytest.mark.parametrize("step", ["base", "marked"])
def test_compaction_killed_in_between(spark, orders_df, workdir, step):
    job = ChangeFeedJob(spark, f"{workdir}/o", f"{workdir}/m", compact_epochs=3)
    seen = []

    def die(at):
        if at == step:
            raise RuntimeError("lost")

    for e, batch in enumerate(epochs(orders_df, 7, days=2)):
        seen.append(batch.collect())
        job.after = die if e in (3, 6) else lambda at: None
        try:
            job.process_batch(batch, e, RUN)
        except RuntimeError:
            job.after = lambda at: None
            job.process_batch(batch, e, RUN)  # the replay of the epoch
    check(job, spark, f"{workdir}/m", seen)
