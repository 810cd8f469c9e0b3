"""The command line's choice of source (no database is started: its options are held, and a text run is made)."""

from __future__ import annotations

import json
import os

import pytest

import dailytally.__main__ as M

BASE = ["--metrics", "m", "--state", "s", "--orders-format", "jdbc", "--orders", "jdbc:x://h/db", "--jdbc-table", "orders"]
SPLIT = ["--jdbc-split", "2024-01-01", "2024-04-01T00:00:00", "16"]


def test_database_options_reach_the_reader(monkeypatch):
    args = M.parse_args([*BASE, *SPLIT, "--jdbc-option", "user=me", "--jdbc-option", "sessionInitStatement=SET a=b"])
    seen = {}
    monkeypatch.setattr(M, "read_orders_jdbc", lambda spark, options: seen.update(options) or "frame")
    job = M.build_job(None, args)
    assert job._source() == "frame"
    assert seen == {
        "url": "jdbc:x://h/db", "dbtable": "orders", "partitionColumn": "updated_at", "lowerBound": "2024-01-01 00:00:00.000000",
        "upperBound": "2024-04-01 00:00:00.000000", "numPartitions": "16", "fetchsize": "10000", "preferTimestampNTZ": "true",
        "user": "me", "sessionInitStatement": "SET a=b"}


@pytest.mark.parametrize("bad", [
    [], ["--jdbc-split", "2024-04-01", "2024-01-01", "4"], ["--jdbc-split", "x", "2024-01-01", "4"],
    ["--jdbc-split", "2024-01-01", "2024-04-01", "0"], [*SPLIT, "--jdbc-option", "user"]])
def test_bad_database_options_are_refused(bad):
    with pytest.raises(SystemExit):
        M.parse_args([*BASE, *bad])


def test_a_text_source_is_parsed_line_by_line(spark, workdir):
    os.makedirs(f"{workdir}/o")
    with open(f"{workdir}/o/a.csv", "w") as f:
        f.write("1,r,u,completed,5.25,IN,2024-01-02T03:04:05,2024-01-02T03:04:05\n1,r,u\n")
    args = M.parse_args(["--orders", f"{workdir}/o", "--orders-format", "csv", "--metrics", f"{workdir}/m", "--state", f"{workdir}/s",
                         "--quality", "quarantine", "--quarantine", f"{workdir}/q"])
    job = M.build_job(spark, args)
    assert json.loads(json.dumps(job.run_incremental()))["total_groups"] == 1
    assert [r.raw_line for r in spark.read.parquet(f"{workdir}/q").collect()] == ["1,r,u"]
