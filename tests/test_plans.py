"""Plan shape checks: pushdown, no Python UDF, one exchange per aggregate,
broadcast semi-join for small key sets, dynamic pruning on the day layout."""

import datetime as dt
import io
import re
from contextlib import redirect_stdout

from conftest import SF001

from dailytally.operators import extract as X
from dailytally.operators import transform as TR
from dailytally.plans import catalog
from dailytally.plans import scenarios as SC
from dailytally.sources.orders import read_orders_by_day, write_orders_by_day


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_mark_filter_is_pushed_to_parquet(spark, workdir):
    write_orders_by_day(SC.source(spark, SF001), f"{workdir}/o")
    o = read_orders_by_day(spark, f"{workdir}/o")
    p = plan(X.changed_since(o, SC.MARK))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(updated_at", p)


def test_full_aggregate_has_one_exchange_and_partial_step(spark, workdir):
    write_orders_by_day(SC.source(spark, SF001), f"{workdir}/o")
    o = read_orders_by_day(spark, f"{workdir}/o")
    p = plan(TR.daily_metrics_full(o))
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1
    assert len(re.findall(r"^\(\d+\) HashAggregate", p, re.M)) == 2  # partial + final
    assert "ReadSchema: struct<restaurant_id:string,status:string,amount:decimal(12,2),country:string" in p


def test_no_python_udf_in_any_registered_query(spark):
    # The stream and job queries run whole jobs to build their result; their
    # operators are the same ones checked here.
    skip = ("stream_", "job_", "quarantine_", "dry_run_", "run_summary")
    for name, q in catalog.QUERIES.items():
        if name.startswith(skip):
            continue
        p = plan(q(spark, SF001))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "FlatMapGroupsInPandas" not in p and "MapInPandas" not in p, name


def test_small_key_set_is_broadcast_semi_join_and_prunes_days(spark, workdir):
    write_orders_by_day(SC.source(spark, SF001), f"{workdir}/o")
    o = read_orders_by_day(spark, f"{workdir}/o")
    changed = X.changed_since(o, SC.MARK)
    p = plan(TR.recompute_affected(o, changed))
    assert "BroadcastHashJoin LeftSemi" in p or "BroadcastHashJoin" in p and "LeftSemi" in p
    assert "PartitionFilters: [isnotnull(order_date" in p
    assert "dynamicpruningexpression" in p


def test_large_key_set_aggregates_before_joining(spark):
    o = SC.source(spark, SF001)
    changed = X.changed_since(o, SC.MARK)
    p = plan(TR.recompute_affected(o, changed, broadcast_key_limit=0))
    # the aggregate's output is joined; raw rows are never joined by shuffle
    assert "LeftSemi" not in p
    assert re.search(r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) Inner", p)


def test_backfill_is_range_filter_without_join(spark):
    p = plan(TR.recompute_days(SC.source(spark, SF001), dt.date(2024, 1, 10), dt.date(2024, 1, 17)))
    assert "LeftSemi" not in p


def test_apply_changes_limits_groups_before_shuffle(spark):
    v2 = SC.source(spark, SF001)
    from dailytally.operators.load import apply_changes

    p = plan(apply_changes(SC.snapshot_v1(v2), SC.changes_after(v2)))
    assert "WindowGroupLimit" in p


def test_apply_changes_moves_only_the_days_of_the_changes(spark, workdir):
    from dailytally.operators.load import apply_changes

    write_orders_by_day(SC.source(spark, SF001), f"{workdir}/o")
    v2 = read_orders_by_day(spark, f"{workdir}/o")
    p = plan(apply_changes(SC.snapshot_v1(v2), v2.where("order_date = date'2024-01-15'")))
    # The other days go straight from the scan through a broadcast join into the union.
    assert re.search(r"Union \(\d+\)\n\s*:- BroadcastHashJoin LeftAnti BuildRight", p)
