"""

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
driver tables (via the ``orders`` adapter). A few run small actions while
building the plan (a key-set size check, a stored mark); none collects
data rows to the driver.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailytally.config import DEFAULT_PIPELINE_ID, EPOCH, KEY_COLS, ORDER_COLS
from dailytally.functions.columns import ceil_millis, day_floor
from dailytally.operators import extract as X
from dailytally.operators import load as L
from dailytally.operators import profile as P
from dailytally.operators import quality as Q
from dailytally.operators import state as S
from dailytally.operators import transform as TR
from dailytally.operators.ledger import batch_ledger, extract_page_bounded, number_changes
from dailytally.operators.snapshot import snapshot_diff
from dailytally.plans import scenarios as SC
from dailytally.session import work_path
from dailytally.sources.orders import materialized_orders, write_orders_bucketed

#: Buckets of the bucketed orders table in the queries.
BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]

# Caller-supplied key arrays of ``recompute_given_groups`` (the last key has
# no orders and must yield no row).
GIVEN_RESTAURANTS = ["rest_0000", "rest_0001", "rest_0002", "rest_0003", "rest_0004", "rest_0009"]
GIVEN_DATES = ["2024-01-15", "2024-02-01", "2024-02-29", "2024-03-10", "2024-03-31", "2024-01-15"]
GIVEN_COUNTRIES = ["IN", "US", "UK", "AE", "SG", "AU"]
LOOKUP_KEY = ("rest_0001", "2024-01-15", "IN")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table (adapted driver tables, day-partitioned; keeps the
    ``order_date`` partition column for pruning)."""
    return materialized_orders(spark, sf_dir)


def _rows(df: DataFrame) -> DataFrame:
    """Order rows in the contract shape (drops the layout column)."""
    return df.select(*ORDER_COLS)


def _mark_of(df: DataFrame) -> _dt.datetime:
    """Stored mark after processing ``df`` completely (its max change time)."""
    row = X.batch_stats(df).first()
    return row["max_updated_at"] or EPOCH


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Run 1 on v1 from epoch, run 2 on v2 from run 1's mark.

    Returns (run-1 metrics, run-2 recompute, v1, v2).
    """
    v2 = _orders(spark, sf_dir)
    v1 = SC.snapshot_v1(v2)
    run1 = TR.daily_metrics_full(v1)
    changed = X.changed_since(v2, _mark_of(v1))
    run2 = TR.recompute_affected(v2, changed)
    return run1, run2, v1, v2


# --- scans / extraction ----------------------------------------------------


def q_scan_orders(spark, sf_dir):
    return _orders(spark, sf_dir).select(*ORDER_COLS)


def q_extract_incremental(spark, sf_dir):
    return _rows(X.extract_incremental(_orders(spark, sf_dir), SC.MARK))


def q_extract_incremental_batch(spark, sf_dir):
    return _rows(X.extract_page(_orders(spark, sf_dir), SC.SPLIT, SC.PAGE_SIZE))


def q_extract_batch_tie_safe(spark, sf_dir):
    o = _orders(spark, sf_dir).withColumn("change_day", day_floor("updated_at"))
    return extract_page_bounded(o, EPOCH, SC.PAGE_SIZE, column="change_day").select(*ORDER_COLS)


def q_extract_ordered(spark, sf_dir):
    """L1: the changes after the mark with their place in (updated_at, order_id) order."""
    rows = X.changed_since(_orders(spark, sf_dir), SC.SPLIT)
    return number_changes(rows.select(*ORDER_COLS)).select(*ORDER_COLS, F.col("change_seq").cast("long").alias("change_seq"))


def q_extract_backfill(spark, sf_dir):
    return _rows(X.extract_backfill(_orders(spark, sf_dir), SC.BACKFILL_START, SC.BACKFILL_END))


def q_extract_full(spark, sf_dir):
    return _rows(X.extract_full(_orders(spark, sf_dir)))


def q_extract_after_hwm(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return _rows(X.changed_since(o, _mark_of(SC.snapshot_v1(o))))


def q_batch_stats(spark, sf_dir):
    return X.batch_stats(X.changed_since(_orders(spark, sf_dir), SC.MARK))


def q_batch_ledger(spark, sf_dir):
    return batch_ledger(X.extract_full(_orders(spark, sf_dir)), SC.PAGE_SIZE)


# --- projections / quality -------------------------------------------------


def q_order_group_keys(spark, sf_dir):
    return TR.group_keys(_orders(spark, sf_dir))


def q_normalize_orders(spark, sf_dir):
    return Q.normalize_orders(SC.with_lowercase_countries(_orders(spark, sf_dir)))


def q_orders_valid(spark, sf_dir):
    return Q.valid_orders(SC.with_defects(_orders(spark, sf_dir)))


def q_orders_rejects(spark, sf_dir):
    return Q.rejected_orders(SC.with_defects(_orders(spark, sf_dir)))


# --- groups and metrics ----------------------------------------------------


def q_affected_groups(spark, sf_dir):
    return TR.affected_groups(X.changed_since(_orders(spark, sf_dir), SC.MARK))


def q_recompute_affected(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return TR.recompute_affected(o, X.changed_since(o, SC.MARK))


def q_recompute_affected_wide(spark, sf_dir):
    """Same answer through the plan used when the touched-key set is above the
    broadcast limit (aggregate first, then join the keys by shuffle)."""
    o = _orders(spark, sf_dir)
    return TR.recompute_affected(o, X.changed_since(o, SC.MARK), broadcast_key_limit=0)


def q_recompute_backfill(spark, sf_dir):
    return TR.recompute_days(_orders(spark, sf_dir), SC.BACKFILL_START, SC.BACKFILL_END)


def q_recompute_given_groups(spark, sf_dir):
    keys = TR.keys_from_arrays(spark, GIVEN_RESTAURANTS, GIVEN_DATES, GIVEN_COUNTRIES)
    return TR.recompute_metrics(_orders(spark, sf_dir), keys)


def q_daily_metrics_full(spark, sf_dir):
    return TR.daily_metrics_full(_orders(spark, sf_dir))


def q_metrics_contract(spark, sf_dir):
    return Q.metrics_contract(SC.with_metric_defects(TR.daily_metrics_full(_orders(spark, sf_dir))))


def q_metrics_consistency(spark, sf_dir):
    return Q.metrics_consistency(SC.with_metric_defects(TR.daily_metrics_full(_orders(spark, sf_dir))))


def q_metrics_documents(spark, sf_dir):
    return L.to_documents(TR.daily_metrics_full(_orders(spark, sf_dir)), SC.RUN_TS)


def q_metric_lookup(spark, sf_dir):
    return P.metric_lookup(TR.daily_metrics_full(_orders(spark, sf_dir)), *LOOKUP_KEY)


def q_profile_from_sketches(spark, sf_dir):
    """The profile of the backfilled days from the sketches that the job keeps: after run 2, no order is read."""
    job = _job_after_v1(spark, sf_dir, sketches=True)
    job.run_incremental(run_at=SC.RUN_TS)
    return job.profile(SC.BACKFILL_START, SC.BACKFILL_END).unionAll(job.profile())


def q_snapshot_diff(spark, sf_dir):
    """What became of v1 by v2, of which some orders are gone: found without a change stamp."""
    v2 = _orders(spark, sf_dir)
    return snapshot_diff(SC.snapshot_v1(v2), SC.with_deletes(v2))


def q_orders_profile(spark, sf_dir):
    return P.orders_profile(_orders(spark, sf_dir))


# --- keyed writes (pure forms) --------------------------------------------


def q_upsert_metrics(spark, sf_dir):
    run1, run2, _, _ = _two_runs(spark, sf_dir)
    return L.upsert(run1, run2)


def q_upsert_counts(spark, sf_dir):
    run1, run2, _, _ = _two_runs(spark, sf_dir)
    return L.upsert_counts(run1, run2)


def q_metrics_key_uniqueness(spark, sf_dir):
    run1, run2, _, _ = _two_runs(spark, sf_dir)
    table = L.upsert(run1, run2)
    # Keys of the 7th are in there twice.
    return P.key_uniqueness(table.unionByName(table.where(F.dayofmonth("date") == 7)))


def q_insert_if_absent(spark, sf_dir):
    v2 = _orders(spark, sf_dir)
    return _rows(L.insert_if_absent(SC.snapshot_v1(v2), v2))


def q_apply_changes(spark, sf_dir):
    v2 = _orders(spark, sf_dir)
    return _rows(L.apply_changes(SC.snapshot_v1(v2), SC.changes_after(v2)))


def _bucketed_v1(spark, v2: DataFrame) -> DataFrame:
    """The first snapshot, written as a table of days and buckets of the order id."""
    path = work_path(spark, "orders_bucketed")
    return write_orders_bucketed(SC.snapshot_v1(v2), path, f"orders_{path.rsplit('/', 1)[1]}", BUCKETS)


def q_apply_changes_bucketed(spark, sf_dir):
    """W6 on a bucketed table: the table's side of the join has no exchange."""
    v2 = _orders(spark, sf_dir)
    return _rows(L.apply_changes_colocated(_bucketed_v1(spark, v2), SC.changes_after(v2), BUCKETS))


def q_insert_if_absent_bucketed(spark, sf_dir):
    """W5 on a bucketed table."""
    v2 = _orders(spark, sf_dir)
    return _rows(L.insert_if_absent_colocated(_bucketed_v1(spark, v2), v2, BUCKETS))


# --- job behaviour ---------------------------------------------------------


def q_incremental_two_runs(spark, sf_dir):
    run1, run2, _, _ = _two_runs(spark, sf_dir)
    return L.upsert(run1, run2)


def _late_before_after(spark, sf_dir, final_status: str | None) -> DataFrame:
    run1, run2, _, v2 = _two_runs(spark, sf_dir)
    late = SC.late_rows(v2)
    if final_status is not None:
        late = late.where(F.col("status") == F.lit(final_status))
    keys = TR.affected_groups(late)
    after = L.upsert(run1, run2)

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            *KEY_COLS,
            *[F.col(c).alias(f"{prefix}_{c}") for c in ("total_orders", "completed_orders", "cancelled_orders", "gross_revenue")],
        )

    before = side(run1.join(keys, list(KEY_COLS), "left_semi"), "before")
    now = side(after.join(keys, list(KEY_COLS), "left_semi"), "after")
    return before.join(now, list(KEY_COLS), "inner")


def q_late_update_corrects_day(spark, sf_dir):
    return _late_before_after(spark, sf_dir, None)


def q_late_cancellation(spark, sf_dir):
    return _late_before_after(spark, sf_dir, "cancelled")


def q_backfill_then_upsert(spark, sf_dir):
    v2 = _orders(spark, sf_dir)
    v1 = SC.snapshot_v1(v2)
    return L.upsert(TR.daily_metrics_full(v1), TR.recompute_days(v2, SC.BACKFILL_START, SC.BACKFILL_END))


def q_rerun_identity(spark, sf_dir):
    run1, run2, _, _ = _two_runs(spark, sf_dir)
    return L.upsert(L.upsert(run1, run2), run2)


def q_dry_run_preview(spark, sf_dir):
    """Every group of the days that run 2 would rewrite."""
    job = _job_after_v1(spark, sf_dir)
    job.run_incremental(dry_run=True, run_at=SC.RUN_TS)
    return job.last_preview


def q_run_summary(spark, sf_dir):
    """The job's own summary of run 2 (all but the time it took)."""
    s = _job_after_v1(spark, sf_dir).run_incremental(run_at=SC.RUN_TS)
    del s["duration_seconds"]
    kinds = {str: "string", bool: "boolean", int: "long"}
    return spark.createDataFrame([tuple(s.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in s.items()))


def _job_after_v1(spark, sf_dir, change=lambda v2: v2, sketches=False, **config):
    """The real job, already run on v1; its source is now v2 (as ``change``
    leaves it). Tables and state log are in the shared work folder."""
    from dailytally.plans.jobs import JobConfig, MetricsJob

    root = work_path(spark, "job")
    cfg = JobConfig(metrics_path=f"{root}/metrics", state_path=f"{root}/state", quarantine_path=f"{root}/rejects",
                    sketch_path=f"{root}/sketches" if sketches else None, **config)
    v2 = _orders(spark, sf_dir)
    MetricsJob(spark, SC.snapshot_v1(v2), cfg).run_incremental(run_at=SC.RUN_TS)
    return MetricsJob(spark, change(v2), cfg)


def q_job_two_runs(spark, sf_dir):
    job = _job_after_v1(spark, sf_dir)
    job.run_incremental(run_at=SC.RUN_TS)
    return job.read_metrics(stamped=True)


def q_job_crash_replay(spark, sf_dir):
    """The second run dies after its write and before its mark is saved; the next one repeats it."""
    job = _job_after_v1(spark, sf_dir)

    class Died(Exception):
        pass

    def die():
        raise Died

    job.after_write = die
    try:
        job.run_incremental(run_at=SC.RUN_TS)
    except Died:
        job.after_write = None
    job.run_incremental(run_at=SC.RUN_TS)
    return job.read_metrics()


def q_job_two_runs_paged(spark, sf_dir):
    """The second run in about five pages, whatever the size of the table."""
    size = SC.changes_after(_orders(spark, sf_dir)).count() // 5 + 1
    job = _job_after_v1(spark, sf_dir)
    job.cfg.batch_size = size
    job.run_incremental(run_at=SC.RUN_TS)
    return job.read_metrics()


def q_job_backfill(spark, sf_dir):
    job = _job_after_v1(spark, sf_dir)
    job.run_backfill(SC.BACKFILL_START, SC.BACKFILL_END, run_at=SC.RUN_TS)
    return job.read_metrics()


def q_job_full(spark, sf_dir):
    job = _job_after_v1(spark, sf_dir)
    job.run_full(run_at=SC.RUN_TS)
    return job.read_metrics()


def q_quarantine_two_runs(spark, sf_dir):
    """Late changes turn rows bad: their groups no longer count them."""
    job = _job_after_v1(spark, sf_dir, SC.with_late_defects, quality="quarantine")
    job.run_incremental(run_at=SC.RUN_TS)
    return job.read_metrics()


def q_quarantine_rejects(spark, sf_dir):
    """Every reject once, though the job runs again over the same source."""
    job = _job_after_v1(spark, sf_dir, SC.with_late_defects, quality="quarantine")
    job.run_incremental(run_at=SC.RUN_TS)
    job.run_incremental(run_at=SC.RUN_TS)
    return spark.read.parquet(job.cfg.quarantine_path).select(*ORDER_COLS, "reject_reason")


def _job_on_text(spark, sf_dir):
    """The job in quarantine mode on JSON lines, of which some are malformed: run on v1, then on v2."""
    from dailytally.plans.jobs import JobConfig, MetricsJob
    from dailytally.sources.raw_orders import read_raw_orders

    root = work_path(spark, "job")
    cfg = JobConfig(metrics_path=f"{root}/metrics", state_path=f"{root}/state", quarantine_path=f"{root}/rejects", quality="quarantine")
    v2 = _orders(spark, sf_dir)
    for name, rows in (("v1", SC.snapshot_v1(v2)), ("v2", v2)):
        SC.as_json_lines(rows).write.text(f"{root}/{name}")
        job = MetricsJob(spark, read_raw_orders(spark, f"{root}/{name}", "json"), cfg)
        job.run_incremental(run_at=SC.RUN_TS)
    return job


def q_raw_metrics(spark, sf_dir):
    return _job_on_text(spark, sf_dir).read_metrics()


def q_raw_rejects(spark, sf_dir):
    """F6 at parse time: each bad line once, with its reason; unparsed ones as they were sent."""
    job = _job_on_text(spark, sf_dir)
    return spark.read.parquet(job.cfg.quarantine_path).select(*ORDER_COLS, "raw_line", "reject_reason")


def q_dry_run_paged_preview(spark, sf_dir):
    job = _job_after_v1(spark, sf_dir)
    job.cfg.batch_size = SC.PAGE_SIZE
    job.run_incremental(dry_run=True, run_at=SC.RUN_TS)
    return job.last_preview


# --- progress state --------------------------------------------------------


def _state_v1(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    v2 = _orders(spark, sf_dir)
    return SC.per_country_state(SC.snapshot_v1(v2)), v2


def q_hwm_get(spark, sf_dir):
    state, v2 = _state_v1(spark, sf_dir)
    ids = v2.select(SC.country_pipeline_id().alias("pipeline_id")).unionByName(
        spark.range(1).select(F.lit(DEFAULT_PIPELINE_ID).alias("pipeline_id"))
    )
    return S.watermark_of(state, ids)


def q_hwm_save(spark, sf_dir):
    state, v2 = _state_v1(spark, sf_dir)
    # One row per job id: broadcast after a size check, so the orders are
    # never shuffled onto the few job ids.
    marks, _ = L.checked_broadcast(S.watermark_of(state, state.select("pipeline_id")), 100_000)
    changed = (
        v2.withColumn("pipeline_id", SC.country_pipeline_id())
        .join(marks, "pipeline_id")
        .where(F.col("updated_at") > F.col("last_watermark"))
        .drop("last_watermark")
    )
    updates = SC.per_country_state(changed)
    return S.save_state(state, updates)


def q_hwm_reset(spark, sf_dir):
    state, _ = _state_v1(spark, sf_dir)
    ids = state.where(F.col("pipeline_id") == F.lit("daily_metrics_in")).select("pipeline_id").unionByName(
        spark.range(1).select(F.lit(DEFAULT_PIPELINE_ID).alias("pipeline_id"))
    )
    return S.reset_state(state, ids, SC.RUN_TS)


def q_ceil_millis(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    return ev.select("event_id", "ts", ceil_millis("ts").alias("ceil_ts"))


# --- streaming -------------------------------------------------------------


def q_stream_foreachbatch(spark, sf_dir):
    from dailytally.streaming.changefeed import replay_two_snapshots

    return replay_two_snapshots(spark, _orders(spark, sf_dir), feed=SC.dirty_feed)


def q_stream_compacted(spark, sf_dir):
    """The same in small epochs, with every day's versions compacted after each few."""
    from dailytally.streaming.changefeed import replay_two_snapshots

    return replay_two_snapshots(spark, _orders(spark, sf_dir), feed=SC.dirty_feed, compact_epochs=2)


def q_stream_stateful(spark, sf_dir):
    """The first snapshot and the changes as one feed, on a keyed state store."""
    from dailytally.streaming.keyedstate import replay_by_state

    return replay_by_state(spark, _orders(spark, sf_dir), feed=SC.dirty_feed)


QUERIES: dict[str, Query] = {
    "scan_orders": q_scan_orders,
    "extract_incremental": q_extract_incremental,
    "extract_incremental_batch": q_extract_incremental_batch,
    "extract_batch_tie_safe": q_extract_batch_tie_safe,
    "extract_backfill": q_extract_backfill,
    "extract_full": q_extract_full,
    "extract_after_hwm": q_extract_after_hwm,
    "batch_stats": q_batch_stats,
    "batch_ledger": q_batch_ledger,
    "order_group_keys": q_order_group_keys,
    "normalize_orders": q_normalize_orders,
    "orders_valid": q_orders_valid,
    "orders_rejects": q_orders_rejects,
    "affected_groups": q_affected_groups,
    "recompute_affected": q_recompute_affected,
    "recompute_affected_wide": q_recompute_affected_wide,
    "recompute_backfill": q_recompute_backfill,
    "recompute_given_groups": q_recompute_given_groups,
    "daily_metrics_full": q_daily_metrics_full,
    "metrics_contract": q_metrics_contract,
    "metrics_consistency": q_metrics_consistency,
    "metrics_documents": q_metrics_documents,
    "metrics_key_uniqueness": q_metrics_key_uniqueness,
    "metric_lookup": q_metric_lookup,
    "upsert_metrics": q_upsert_metrics,
    "upsert_counts": q_upsert_counts,
    "insert_if_absent": q_insert_if_absent,
    "apply_changes": q_apply_changes,
    "apply_changes_bucketed": q_apply_changes_bucketed,
    "insert_if_absent_bucketed": q_insert_if_absent_bucketed,
    "incremental_two_runs": q_incremental_two_runs,
    "job_two_runs": q_job_two_runs,
    "job_two_runs_paged": q_job_two_runs_paged,
    "job_backfill": q_job_backfill,
    "job_full": q_job_full,
    "quarantine_two_runs": q_quarantine_two_runs,
    "quarantine_rejects": q_quarantine_rejects,
    "raw_metrics": q_raw_metrics,
    "raw_rejects": q_raw_rejects,
    "dry_run_paged_preview": q_dry_run_paged_preview,
    "late_update_corrects_day": q_late_update_corrects_day,
    "late_cancellation": q_late_cancellation,
    "backfill_then_upsert": q_backfill_then_upsert,
    "rerun_identity": q_rerun_identity,
    "dry_run_preview": q_dry_run_preview,
    "run_summary": q_run_summary,
    "hwm_get": q_hwm_get,
    "hwm_save": q_hwm_save,
    "hwm_reset": q_hwm_reset,
    "ceil_millis": q_ceil_millis,
    "orders_profile": q_orders_profile,
    "stream_foreachbatch": q_stream_foreachbatch,
    "stream_compacted": q_stream_compacted,
    "stream_stateful": q_stream_stateful,
    "extract_ordered": q_extract_ordered,
    "snapshot_diff": q_snapshot_diff,
    "profile_from_sketches": q_profile_from_sketches,
    "job_crash_replay": q_job_crash_replay,
}
