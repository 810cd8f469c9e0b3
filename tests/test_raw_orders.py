"""Orders as text: a malformed line is a reject, and never stops a quarantine run."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from dailytally.operators import quality as Q
from dailytally.plans.jobs import JobConfig, MetricsJob
from dailytally.sources.raw_orders import read_raw_orders

GOOD = ('{"order_id":"1","restaurant_id":"r","user_id":"u","status":"completed","amount":5.25,"country":"in",'
        '"created_at":"2024-01-02T03:04:05.123456","updated_at":"2024-01-02T03:04:05"}')
NO_STAMP = GOOD.replace('"2024-01-02T03:04:05"}', '"soon"}').replace('"order_id":"1"', '"order_id":"4"')


def put(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_json_lines(spark, workdir):
    lines = [GOOD, GOOD.replace("5.25", '"x"'), GOOD[:40], "", "  \t", "garbage", GOOD.replace("5.25", "123456789012.25"), "[1,2]", "{}",
             GOOD.replace("completed", "bogus"), NO_STAMP]
    put(f"{workdir}/o", "a.json", lines)
    df = read_raw_orders(spark, f"{workdir}/o")
    got = sorted((r.raw_line or "", r.reject_reason) for r in Q.rejected_orders(df).collect())
    bad = [lines[i] for i in (1, 2, 5, 6, 7, 10)]
    assert got == sorted([(x, "unparsed") for x in bad] + [("", "missing_field"), ("", "bad_status")])
    assert [(r.order_id, str(r.amount)) for r in Q.valid_orders(df).collect()] == [("1", "5.25")]


def test_csv_lines_whatever_columns_are_read(spark, workdir):
    head = "order_id,restaurant_id,user_id,status,amount,country,created_at,updated_at"
    row = "1,r,u,placed,5.25,IN,2024-01-02T03:04:05.5,2024-01-02T03:04:05.5"
    put(f"{workdir}/o", "a.csv", [head, row, row.replace("5.25", "x"), "1,r", row + ",more", "", '"a b,c'])
    put(f"{workdir}/o", "b.csv", [head, row])
    df = read_raw_orders(spark, f"{workdir}/o", "csv")
    assert df.count() == 6
    # Only two of the columns are asked for: the bad amount is still seen.
    assert df.where("raw_line IS NULL").select("order_id").count() == 2
    assert Q.valid_orders(df).select("order_id").count() == 2
    assert {r.raw_line for r in Q.rejected_orders(df).select("raw_line").collect()} == {row.replace("5.25", "x"), "1,r", row + ",more", '"a b,c'}


def _job(spark, workdir, **config):
    cfg = JobConfig(metrics_path=f"{workdir}/m", state_path=f"{workdir}/s", quarantine_path=f"{workdir}/q", **config)
    return MetricsJob(spark, lambda: read_raw_orders(spark, f"{workdir}/o"), cfg)


def test_quarantine_run_keeps_bad_lines_once(spark, workdir):
    put(f"{workdir}/o", "a.json", [GOOD, GOOD.replace("5.25", '"x"').replace('"order_id":"1"', '"order_id":"2"'), "garbage", NO_STAMP])
    job = _job(spark, workdir, quality="quarantine")
    rejects = lambda: sorted(r.raw_line for r in spark.read.parquet(f"{workdir}/q").collect())
    job.run_incremental()
    assert [(r.country, r.total_orders, str(r.gross_revenue)) for r in job.read_metrics().collect()] == [("IN", 1, "5.25")]
    first = rejects()
    assert len(first) == 3
    job.run_incremental()  # no change: the same rejects
    assert rejects() == first
    job.run_full()
    assert rejects() == first
    # A bad line that comes with no other change is found, and goes when it is good again.
    put(f"{workdir}/o", "b.json", ["more garbage"])
    job.run_incremental()
    assert rejects() == sorted([*first, "more garbage"])
    put(f"{workdir}/o", "b.json", [GOOD.replace('"order_id":"1"', '"order_id":"3"').replace('T03:04:05"}', 'T09:00:00"}')])
    job.run_incremental()
    assert rejects() == first
    assert [r.total_orders for r in job.read_metrics().collect()] == [2]
    assert job.watermark() == dt.datetime(2024, 1, 2, 9)


@pytest.mark.parametrize("bad", ["garbage", GOOD.replace("5.25", '"x"'), NO_STAMP])
@pytest.mark.parametrize("run", ["run_incremental", "run_full"])
def test_strict_run_fails_on_a_bad_line(spark, workdir, bad, run):
    put(f"{workdir}/o", "a.json", [GOOD, bad])
    job = _job(spark, workdir)
    with pytest.raises(Exception, match="unparsed"):
        getattr(job, run)()
    assert job.watermark() == dt.datetime(1970, 1, 1)


@pytest.mark.parametrize("mode", ["incremental", "backfill", "full"])
def test_lines_are_parsed_once_per_run(spark, workdir, mode):
    """each pass of a run parsed all lines again."""
    from dailytally.sources.raw_orders import parse_orders

    put(f"{workdir}/o", "a.json", [GOOD, GOOD.replace("5.25", '"x"').replace('"order_id":"1"', '"order_id":"2"'), "garbage", NO_STAMP])
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    kept = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    cfg = JobConfig(metrics_path=f"{workdir}/m", state_path=f"{workdir}/s", quarantine_path=f"{workdir}/q", quality="quarantine")
    job = MetricsJob(spark, lambda: parse_orders(spark.read.text(f"{workdir}/o").mapInPandas(counted, "value string"), "json"), cfg)
    day = dt.date(2024, 1, 2)
    {"incremental": job.run_incremental, "backfill": lambda: job.run_backfill(day, day), "full": job.run_full}[mode]()
    assert seen.value == 4
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == kept
    assert [(r.total_orders, str(r.gross_revenue)) for r in job.read_metrics().collect()] == [(1, "5.25")]
    assert spark.read.parquet(f"{workdir}/q").count() >= 2
