"""End-to-end runs of the job on local tables (the reference's e2e and
idempotency cases, plus crash, paging, quarantine and full-rebuild cases)."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import order

from dailytally.config import EPOCH
from dailytally.operators.load import apply_changes
from dailytally.operators.transform import daily_metrics_full
from dailytally.plans.jobs import JobConfig, MetricsJob

T = dt.datetime
RUN = T(2024, 6, 1)


def cfg(workdir, **kw):
    return JobConfig(metrics_path=f"{workdir}/metrics", state_path=f"{workdir}/state", **kw)


def one(job, rest="rest_001", day=dt.date(2024, 1, 15), country="IN"):
    rows = job.read_metrics().where(
        f"restaurant_id = '{rest}' AND date = date'{day.isoformat()}' AND country = '{country}'"
    ).collect()
    assert len(rows) == 1
    r = rows[0]
    return r.total_orders, r.completed_orders, r.cancelled_orders, r.gross_revenue


def same(got, exp):
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_late_completion_corrects_original_day(orders_df, workdir, spark):
    o = order(order_id="1", status="placed", amount="500.00", created_at=T(2024, 1, 15, 10))
    c = cfg(workdir)
    job1 = MetricsJob(spark, orders_df([o]), c)
    job1.run_incremental(run_at=RUN)
    assert one(job1) == (1, 0, 0, Decimal("0.00"))
    done = o[:3] + ("completed",) + o[4:7] + (T(2024, 1, 20, 9),)
    job2 = MetricsJob(job1.spark, orders_df([done]), c)
    s = job2.run_incremental(run_at=RUN)
    assert s["total_rows"] == 1
    assert one(job2) == (1, 1, 0, Decimal("500.00"))
    assert job2.read_metrics().count() == 1


def test_late_cancellation(orders_df, workdir, spark):
    a = order(order_id="a", status="completed", amount="800.00", created_at=T(2024, 1, 15, 9))
    b = order(order_id="b", status="completed", amount="200.00", created_at=T(2024, 1, 15, 11))
    c = cfg(workdir)
    MetricsJob(spark, orders_df([a, b]), c).run_incremental(run_at=RUN)
    assert one(MetricsJob(spark, orders_df([a, b]), c)) == (2, 2, 0, Decimal("1000.00"))
    a2 = a[:3] + ("cancelled",) + a[4:7] + (T(2024, 1, 20),)
    j = MetricsJob(spark, orders_df([a2, b]), c)
    j.run_incremental(run_at=RUN)
    assert one(j) == (2, 1, 1, Decimal("200.00"))


def test_backfill_leaves_mark(orders_df, workdir, spark):
    a = order(order_id="a", status="completed", amount="100.00", created_at=T(2024, 1, 15, 9))
    c = cfg(workdir)
    j = MetricsJob(spark, orders_df([a]), c)
    j.run_incremental(run_at=RUN)
    mark = j.watermark()
    b = order(order_id="b", status="completed", amount="200.00", created_at=T(2024, 1, 16, 9), updated_at=T(2024, 1, 16, 9))
    j2 = MetricsJob(spark, orders_df([a, b]), c)
    s = j2.run_backfill(dt.date(2024, 1, 16), dt.date(2024, 1, 16), run_at=RUN)
    assert s["mode"] == "backfill" and s["total_rows"] == 1
    assert j2.watermark() == mark
    assert one(j2, day=dt.date(2024, 1, 16)) == (1, 1, 0, Decimal("200.00"))
    assert j2.run_backfill(dt.date(2023, 1, 1), dt.date(2023, 1, 2)) == {"mode": "backfill", "total_rows": 0}


def test_dry_run_writes_nothing(orders_df, workdir, spark):
    j = MetricsJob(spark, orders_df([order(status="completed")]), cfg(workdir))
    s = j.run_incremental(dry_run=True, run_at=RUN)
    assert s["dry_run"] and s["total_rows"] == 1 and s["total_upserts"] == 0
    assert j.read_metrics().count() == 0
    assert j.watermark() == EPOCH
    assert j.last_preview.count() == 1


def test_double_run_is_idempotent(orders_df, workdir, spark):
    rows = [
        order(status="completed", amount="500.00"),
        order(status="cancelled", amount="200.00"),
        order(status="placed", amount="300.00"),
    ]
    c = cfg(workdir)
    j = MetricsJob(spark, orders_df(rows), c)
    j.run_incremental(run_at=RUN)
    first = one(j)
    # reset the mark and run again: same numbers, one row
    j.run_full(run_at=RUN)
    assert one(j) == first == (3, 1, 1, Decimal("500.00"))
    assert j.read_metrics().count() == 1


def test_mark_stops_reextraction(orders_df, workdir, spark):
    j = MetricsJob(spark, orders_df([order()]), cfg(workdir))
    assert j.run_incremental(run_at=RUN)["total_rows"] == 1
    assert j.run_incremental(run_at=RUN)["total_rows"] == 0


def test_crash_between_write_and_state_save_is_repaired(orders_df, workdir, spark):
    a = order(order_id="a", status="placed", amount="100.00", created_at=T(2024, 1, 15, 9))
    c = cfg(workdir)
    MetricsJob(spark, orders_df([a]), c).run_incremental(run_at=RUN)
    a2 = a[:3] + ("completed",) + a[4:7] + (T(2024, 1, 18),)
    j = MetricsJob(spark, orders_df([a2]), c)

    def boom():
        raise RuntimeError("executor lost")

    j.after_write = boom
    with pytest.raises(RuntimeError):
        j.run_incremental(run_at=RUN)
    assert j.watermark() == T(2024, 1, 15, 9)  # mark did not move
    j.after_write = None
    s = j.run_incremental(run_at=RUN)
    assert s["total_rows"] == 1
    assert one(j) == (1, 1, 0, Decimal("100.00"))


def test_incremental_equals_full_on_two_snapshots(spark, workdir):
    from conftest import SF001

    from dailytally.plans import scenarios as SC

    v2 = SC.source(spark, SF001).cache()
    v1 = SC.snapshot_v1(v2)
    c = cfg(workdir)
    MetricsJob(spark, v1, c).run_incremental(run_at=RUN)
    s = MetricsJob(spark, v2, c).run_incremental(run_at=RUN)
    assert s["total_rows"] == 763
    got = MetricsJob(spark, v2, c).read_metrics()
    exp = daily_metrics_full(v2)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_paged_run_with_ties_equals_single_pass(orders_df, workdir, spark):
    t = T(2024, 1, 20, 12)
    rows = [order(order_id=f"o{i}", status="completed", amount="1.00", created_at=T(2024, 1, 10 + i % 5), updated_at=t if i < 7 else None)
            for i in range(20)]
    c = cfg(workdir, batch_size=3)
    j = MetricsJob(spark, orders_df(rows), c)
    s = j.run_incremental(run_at=RUN)
    assert s["total_rows"] == 20 and s["batches"] >= 2
    exp = daily_metrics_full(orders_df(rows))
    got = j.read_metrics()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_quarantine_mode(orders_df, workdir, spark):
    rows = [order(order_id="1", status="completed", amount="10.00"), order(order_id="2", amount="-3.00")]
    c = cfg(workdir, quality="quarantine", quarantine_path=f"{workdir}/rejects")
    j = MetricsJob(spark, orders_df(rows), c)
    j.run_incremental(run_at=RUN)
    assert one(j) == (1, 1, 0, Decimal("10.00"))
    rej = spark.read.parquet(f"{workdir}/rejects").collect()
    assert [(r.order_id, r.reject_reason) for r in rej] == [("2", "negative_amount")]


def test_an_order_that_turned_bad_leaves_its_group(orders_df, workdir, spark):
    """The quarantine run equals a full rebuild, the mark passes the bad row, and
    a day left without valid orders goes."""
    a, b = (order(order_id=i, status="completed", amount="500.00", created_at=T(2024, 1, 15, 9)) for i in "ab")
    alone = order(order_id="c", status="completed", amount="1.00", created_at=T(2024, 1, 17))
    c = cfg(workdir, quality="quarantine", quarantine_path=f"{workdir}/rejects")
    MetricsJob(spark, orders_df([a, b, alone]), c).run_incremental(run_at=RUN)
    turned = [x[:4] + (-x[4],) + x[5:7] + (T(2024, 1, 20),) for x in (b, alone)]
    j = MetricsJob(spark, orders_df([a, *turned]), c)
    assert j.run_incremental(run_at=RUN)["total_rows"] == 2
    assert one(j) == (1, 1, 0, Decimal("500.00"))
    assert j.watermark() == T(2024, 1, 20) and j.run_incremental(run_at=RUN)["total_rows"] == 0
    got = j.read_metrics().collect()
    assert len(got) == 1
    j.run_full(run_at=RUN)
    assert j.read_metrics().collect() == got
    # each reject is there once, whatever runs saw it
    j.run_backfill(dt.date(2024, 1, 15), dt.date(2024, 1, 17), run_at=RUN)
    rej = spark.read.parquet(f"{workdir}/rejects").collect()
    assert sorted(r.order_id for r in rej) == ["b", "c"]
    # a row that is good again is no reject any more; its group is back
    j = MetricsJob(spark, orders_df([a, b[:7] + (T(2024, 1, 21),), turned[1]]), c)
    j.run_incremental(run_at=RUN)
    assert one(j)[0] == 2
    assert [r.order_id for r in spark.read.parquet(f"{workdir}/rejects").collect()] == ["c"]


@pytest.mark.parametrize("step", ["written", "committed", "rejects", "state"])
def test_a_crash_after_any_step_is_repaired_by_the_next_run(orders_df, workdir, spark, step):
    """Other groups of a touched day are carried over whatever dies when."""
    day = T(2024, 1, 15, 9)
    rows = [order(order_id=f"{i}", restaurant_id=f"r{i}", status="completed", amount="1.00", created_at=day) for i in range(5)]
    c = cfg(workdir, quality="quarantine", quarantine_path=f"{workdir}/rejects")
    MetricsJob(spark, orders_df(rows), c).run_incremental(run_at=RUN)
    later = [rows[0][:4] + (Decimal("7.00"),) + rows[0][5:7] + (T(2024, 1, 20),), rows[1][:4] + (Decimal("-1"),) + rows[1][5:7] + (T(2024, 1, 21),)]
    j = MetricsJob(spark, orders_df(later + rows[2:]), c)

    def die(at="state"):
        if at == step:
            raise RuntimeError("lost")

    j.after, j.after_write = die, die
    before = j.read_metrics().collect()
    with pytest.raises(RuntimeError):
        j.run_incremental(run_at=T(2024, 6, 2))
    if step == "written":  # not committed: nobody sees it
        assert sorted(j.read_metrics().collect()) == sorted(before)
    assert j.watermark() == day
    j.after, j.after_write = lambda at: None, None
    s = j.run_incremental(run_at=T(2024, 6, 3))
    assert s["total_rows"] == 2 and s["total_groups"] == 2
    got = {r.restaurant_id: (r.gross_revenue, r.last_updated_at) for r in j.read_metrics(stamped=True).collect()}
    assert got == {"r0": (Decimal("7.00"), T(2024, 6, 3)), **{f"r{i}": (Decimal("1.00"), RUN) for i in (2, 3, 4)}}
    assert [r.order_id for r in spark.read.parquet(f"{workdir}/rejects").collect()] == ["1"]


def test_only_touched_groups_are_recomputed(orders_df, workdir, spark):
    """A group that no change touches keeps what the table says, even if its orders say otherwise now."""
    a, b = (order(order_id=i, restaurant_id=i, status="completed", amount="1.00") for i in "ab")
    c = cfg(workdir)
    MetricsJob(spark, orders_df([a, b]), c).run_incremental(run_at=RUN)
    a2 = a[:4] + (Decimal("2.00"),) + a[5:7] + (T(2024, 1, 20),)
    silent = b[:4] + (Decimal("9.00"),) + b[5:]
    j = MetricsJob(spark, orders_df([a2, silent]), c)
    s = j.run_incremental(run_at=T(2024, 6, 2))
    assert (s["total_rows"], s["total_groups"], s["total_upserts"]) == (1, 1, 1)
    got = {r.restaurant_id: (r.gross_revenue, r.last_updated_at) for r in j.read_metrics(stamped=True).collect()}
    assert got == {"a": (Decimal("2.00"), T(2024, 6, 2)), "b": (Decimal("1.00"), RUN)}


def test_versions_of_a_day_do_not_pile_up(orders_df, workdir, spark):
    import glob

    a = order(order_id="a", status="completed", amount="1.00")
    other = order(order_id="o", created_at=T(2024, 1, 10))
    c = cfg(workdir)
    for i in range(5):
        MetricsJob(spark, orders_df([other, a[:7] + (T(2024, 1, 20 + i),)]), c).run_incremental(run_at=RUN)
    assert len(glob.glob(f"{workdir}/metrics/date=2024-01-15/v=*")) == 2
    assert len(glob.glob(f"{workdir}/metrics/date=2024-01-10/v=*")) == 1
    assert len(glob.glob(f"{workdir}/metrics/_commits/[0-9]*")) == 1


def test_a_table_of_plain_day_folders_is_taken_over(orders_df, workdir, spark):
    from dailytally.functions.columns import ts_ntz

    a, b = order(order_id="a", restaurant_id="a"), order(order_id="b", restaurant_id="b", created_at=T(2024, 1, 10))
    old = daily_metrics_full(orders_df([a, b])).withColumn("last_updated_at", ts_ntz(RUN))
    old.write.partitionBy("date").parquet(f"{workdir}/metrics")
    j = MetricsJob(spark, orders_df([a, b]), cfg(workdir))
    assert j.read_metrics().count() == 2
    j.run_backfill(dt.date(2024, 1, 15), dt.date(2024, 1, 15), run_at=RUN)
    same(j.read_metrics(), daily_metrics_full(orders_df([a, b])))


def test_backfill_keeps_its_rejects_once(orders_df, workdir, spark):
    rows = [order(order_id="1", status="completed"), order(order_id="2", amount="-3.00")]
    j = MetricsJob(spark, orders_df(rows), cfg(workdir, quality="quarantine", quarantine_path=f"{workdir}/rejects"))
    for _ in range(2):
        j.run_backfill(dt.date(2024, 1, 15), dt.date(2024, 1, 15), run_at=RUN)
    assert [r.order_id for r in spark.read.parquet(f"{workdir}/rejects").collect()] == ["2"]


def test_dry_runs_write_no_file(orders_df, workdir, spark):
    import os

    rows = [order(order_id=f"{i}", created_at=T(2024, 1, 10 + i), amount="-1.00" if i == 0 else "1.00") for i in range(6)]
    c = cfg(workdir, quality="quarantine", quarantine_path=f"{workdir}/rejects", batch_size=2)
    j = MetricsJob(spark, orders_df(rows), c)
    s = j.run_incremental(dry_run=True, run_at=RUN)
    assert s["batches"] == 3 and s["total_rows"] == 6
    same(j.last_preview, daily_metrics_full(orders_df(rows[1:])))
    j.run_full(dry_run=True, run_at=RUN)
    j.run_backfill(dt.date(2024, 1, 10), dt.date(2024, 1, 12), dry_run=True, run_at=RUN)
    assert os.listdir(workdir) == []


def test_lookback_also_holds_for_the_first_page(orders_df, workdir, spark):
    rows = [order(order_id=f"{i}", created_at=T(2024, 1, 15, 9 + i)) for i in range(4)]
    c = cfg(workdir, lookback=dt.timedelta(days=2))
    MetricsJob(spark, orders_df(rows), c).run_incremental(run_at=RUN)
    c.batch_size = 3
    assert MetricsJob(spark, orders_df(rows), c).run_incremental(run_at=RUN)["total_rows"] == 4


def test_inconsistent_metrics_are_counted(orders_df, workdir, spark, monkeypatch):
    from pyspark.sql import functions as F

    from dailytally.operators import quality as Q

    j = MetricsJob(spark, orders_df([order(status="completed")]), cfg(workdir))
    assert j.run_incremental(run_at=RUN)["inconsistent_metrics"] == 0
    monkeypatch.setattr(Q, "consistency_flag", lambda: F.col("total_orders") > F.col("completed_orders"))
    with pytest.warns(UserWarning):
        assert j.run_full(run_at=RUN)["inconsistent_metrics"] == 1
    monkeypatch.setattr(Q, "contract_violations", lambda: F.col("total_orders") > 0)
    with pytest.raises(ValueError):
        j.run_full(run_at=RUN)


def test_reset_mark(orders_df, workdir, spark):
    j = MetricsJob(spark, orders_df([order()]), cfg(workdir))
    j.run_incremental(run_at=RUN)
    j.reset_mark(RUN)
    assert j.watermark() == EPOCH and j.run_incremental(run_at=RUN)["total_rows"] == 1


def test_overwrite_replaces_the_orders_table(orders_df, workdir, spark):
    from dailytally.sources.orders import read_orders_by_day, replace_order_days, write_orders_by_day

    days = [order(order_id=f"{i}", created_at=T(2024, 1, 15 + i)) for i in range(3)]
    path = f"{workdir}/o"
    write_orders_by_day(orders_df(days), path)
    replace_order_days(orders_df([order(order_id="x", created_at=T(2024, 1, 15))]), path)
    assert sorted(r.order_id for r in read_orders_by_day(spark, path).collect()) == ["1", "2", "x"]
    write_orders_by_day(orders_df(days[:1]), path)
    assert [r.order_id for r in read_orders_by_day(spark, path).collect()] == ["0"]


def test_only_a_missing_path_counts_as_empty(spark, workdir):
    import os

    from dailytally.sources import metrics_table as MT

    assert MT.read_metrics(spark, f"{workdir}/none").count() == 0
    os.makedirs(f"{workdir}/odd/date=2024-01-01/x=1")
    open(f"{workdir}/odd/date=2024-01-01/x=1/a.parquet", "w").write("no parquet")
    with pytest.raises(Exception):
        MT.read_metrics(spark, f"{workdir}/odd").collect()


def test_command_line_reads_touched_days_only(spark, workdir, orders_df):
    """The day layout, a change feed and the lookback, as the command line builds them."""
    from dailytally.__main__ import build_job, parse_args
    from dailytally.operators.transform import recompute_days_of
    from dailytally.sources.orders import write_orders_by_day

    rows = [order(order_id=f"{i}", created_at=T(2024, 1, 1 + i)) for i in range(10)]
    write_orders_by_day(orders_df(rows), f"{workdir}/o")
    orders_df(rows[:1]).write.parquet(f"{workdir}/feed")
    j = build_job(spark, parse_args(["--orders", f"{workdir}/o", "--orders-layout", "day", "--changes", f"{workdir}/feed",
                                     "--metrics", f"{workdir}/m", "--state", f"{workdir}/s", "--lookback-hours", "12"]))
    assert j.cfg.lookback == dt.timedelta(hours=12)
    days = orders_df(rows[:1]).selectExpr("to_date(created_at) AS date")
    plan = recompute_days_of(j.orders(), days)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and "PartitionFilters: [isnotnull(order_date" in plan
    assert j.run_incremental(run_at=RUN)["total_rows"] == 1
    assert j.read_metrics().count() == 1


def test_jdbc_ranges_are_times():
    from dailytally.sources.orders import jdbc_options

    got = jdbc_options("jdbc:x", "orders", T(2024, 1, 1), T(2024, 4, 1, 12), 8)
    assert got["partitionColumn"] == "updated_at" and got["numPartitions"] == "8"
    assert (got["lowerBound"], got["upperBound"]) == ("2024-01-01 00:00:00.000000", "2024-04-01 12:00:00.000000")


def test_strict_mode_keeps_mark_on_bad_row(orders_df, workdir, spark):
    j = MetricsJob(spark, orders_df([order(amount="-3.00")]), cfg(workdir))
    with pytest.raises(Exception):
        j.run_incremental(run_at=RUN)
    assert j.watermark() == EPOCH


def test_full_dry_run_previews_from_epoch(orders_df, workdir, spark):
    c = cfg(workdir)
    j = MetricsJob(spark, orders_df([order()]), c)
    j.run_incremental(run_at=RUN)
    s = j.run_full(dry_run=True, run_at=RUN)
    assert s["mode"] == "full" and s["total_rows"] == 1
    assert j.watermark() != EPOCH


def test_apply_changes_then_job(orders_df, workdir, spark):
    a = order(order_id="a", status="placed", created_at=T(2024, 1, 15))
    snap = orders_df([a])
    ch = orders_df([a[:3] + ("completed",) + a[4:7] + (T(2024, 1, 16),)])
    j = MetricsJob(spark, apply_changes(snap, ch), cfg(workdir))
    j.run_incremental(run_at=RUN)
    assert one(j)[1] == 1


def test_command_line_runs(spark, workdir, capsys):
    import json

    from dailytally.__main__ import main
    from dailytally.operators.synth import synth_orders

    synth_orders(spark, 2000, 2).write.parquet(f"{workdir}/orders")
    base = ["--orders", f"{workdir}/orders", "--metrics", f"{workdir}/m", "--state", f"{workdir}/s"]
    assert main(base + ["--mode", "full"]) == 0
    full = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert full["mode"] == "full" and full["total_rows"] == 2000
    assert main(base) == 0
    inc = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert inc["total_rows"] == 0
    assert main(base + ["--mode", "backfill", "--start-date", "2024-01-01", "--end-date", "2024-01-03"]) == 0
    bf = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert bf["mode"] == "backfill" and bf["total_rows"] > 0


def test_changes_from_a_change_feed(spark, workdir):
    from conftest import SF001

    from dailytally.plans import scenarios as SC

    v2 = SC.source(spark, SF001).cache()
    v1 = SC.snapshot_v1(v2)
    c = cfg(workdir)
    MetricsJob(spark, v1, c).run_incremental(run_at=RUN)
    feed = SC.changes_after(v2)  # only the change versions, not the table
    s = MetricsJob(spark, v2, c, changes=feed).run_incremental(run_at=RUN)
    assert s["total_rows"] == 763
    got = MetricsJob(spark, v2, c).read_metrics()
    exp = daily_metrics_full(v2)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_lookback_never_moves_the_mark_back(orders_df, workdir, spark):
    a = order(order_id="a", status="completed", created_at=T(2024, 1, 15, 9))
    c = cfg(workdir, lookback=dt.timedelta(days=2))
    j = MetricsJob(spark, orders_df([a]), c)
    j.run_incremental(run_at=RUN)
    mark = j.watermark()
    s = j.run_incremental(run_at=RUN)  # re-reads the lookback window
    assert s["total_rows"] == 1
    assert j.watermark() == mark
    assert one(j) == (1, 1, 0, Decimal("500.00"))
