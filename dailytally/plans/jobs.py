"""The metrics job: incremental, backfill and full runs, dry run (R1-R5, R7,
W4, W8, A9).

1. read the stored mark of this job id (tiny state log);
2. changed rows = ``updated_at > mark`` (pushed to the scan), good and bad
   alike: their distinct group keys, row count and last change time;
3. recompute just these groups from *all* their source rows (in quarantine
   mode from the valid ones); the other groups of their days are carried over
   from the metrics table;
4. write the days as a new version of the table; the write's own job counts
   rows, upserts, and metrics that break their contract (observed metrics);
   commit it; replace the rejects of the same days;
5. only then append the new mark. A crash before the commit leaves the table as
   it was, one before 5 the old mark; the re-run redoes the same (idempotent)
   recompute.

Lines of a text source are parsed once per run: the rows are kept (in memory, else on disk)
until the run ends, so its passes all read the same rows.

A row that turned bad is a change like any other: it touches its group, whose
recompute no longer counts it, and it moves the mark.

``batch_size`` keeps the reference's paging (oldest changes first, mark saved
after each page). One pass numbers the changes and gives all page bounds;
pages are ranges of ``updated_at`` and tie-complete, so no row sharing a
boundary stamp is skipped.
"""

from __future__ import annotations

import datetime as _dt
import time
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dailytally.config import DEFAULT_PIPELINE_ID, EPOCH, KEY_COLS, METRIC_VALUE_COLS
from dailytally.functions.columns import ts_ntz
from dailytally.operators import extract as X
from dailytally.operators import quality as Q
from dailytally.operators import sketches as SK
from dailytally.operators import state as S
from dailytally.operators import transform as TR
from dailytally.operators.ledger import page_bounds
from dailytally.session import materialize
from dailytally.sources import metrics_table as MT
from dailytally.sources import rejects_table as RT
from dailytally.sources import state_log as SL


@dataclass
class JobConfig:
    metrics_path: str
    state_path: str
    pipeline_id: str = DEFAULT_PIPELINE_ID
    quality: str = "strict"  # or "quarantine"
    quarantine_path: str | None = None
    sketch_path: str | None = None  # where given, a profile sketch per day is kept there
    lookback: _dt.timedelta | None = None
    batch_size: int | None = None  # None: all changes in one pass
    count_upserts: bool = True

    def __post_init__(self) -> None:
        if self.quality not in ("strict", "quarantine"):
            raise ValueError(f"unknown quality mode {self.quality!r}")
        if self.batch_size is not None and self.batch_size <= 0:
            raise ValueError("batch_size must be positive")


@dataclass
class Step:
    """What one pass over changed rows did."""

    rows: int = 0
    groups: int = 0
    upserts: int = 0
    invalid: int = 0
    inconsistent: int = 0
    mark: _dt.datetime | None = None

    def add(self, other: Step) -> None:
        for k in ("rows", "groups", "upserts", "invalid", "inconsistent"):
            setattr(self, k, getattr(self, k) + getattr(other, k))


class MetricsJob:
    """Keeps ``daily_metrics`` up to date from a changing orders table."""

    def __init__(
        self,
        spark: SparkSession,
        source: DataFrame | Callable[[], DataFrame],
        config: JobConfig,
        changes: DataFrame | Callable[[], DataFrame] | None = None,
    ):
        """``source``: the current orders table. ``changes`` (optional): a
        change feed of order versions (e.g. CDC files partitioned by change
        time); when given, changed rows are found there instead of by
        scanning ``updated_at`` of the whole orders table."""
        self.spark = spark
        self._source = source
        self._changes = changes
        self.cfg = config
        self.last_preview: DataFrame | None = None
        self._parsed: DataFrame | None = None  # the rows of a text source, while a run reads them
        # Test hooks: called between the metrics write and the state save, and after each step with its name.
        self.after_write: Callable[[], None] | None = None
        self.after: Callable[[str], None] = lambda step: None

    # --- inputs -------------------------------------------------------------

    def _all_orders(self) -> DataFrame:
        if self._parsed is not None:
            return self._parsed
        return Q.normalize_orders(self._source() if callable(self._source) else self._source)

    @contextmanager
    def _parsed_once(self) -> Iterator[None]:
        """Keeps the rows of a text source until the block ends."""
        orders = self._all_orders()
        if self._parsed is not None or Q.RAW_COL not in orders.columns:
            yield
            return
        self._parsed = orders.persist()
        try:
            yield
        finally:
            self._parsed = None
            orders.unpersist()

    def orders(self) -> DataFrame:
        """Source rows that count: normalised, in quarantine mode only valid ones."""
        df = self._all_orders()
        return Q.valid_orders(df) if self.cfg.quality == "quarantine" else df

    def _change_rows(self) -> DataFrame:
        """Where changed rows are looked up: the change feed, or the table."""
        if self._changes is None:
            return self._all_orders()
        return Q.normalize_orders(self._changes() if callable(self._changes) else self._changes)

    def _newer(self, rows: DataFrame, mark: _dt.datetime, lookback: _dt.timedelta | None = None) -> DataFrame:
        """Rows changed after the mark; in strict mode also lines of a text source that hold no change
        time, which nothing else would see: they fail the run."""
        if self.cfg.quality == "strict" and Q.RAW_COL in rows.columns:
            since = ts_ntz((mark or EPOCH) - (lookback or _dt.timedelta()))
            return rows.where(F.coalesce(F.col("updated_at") > since, F.col(Q.RAW_COL).isNotNull()))
        return X.changed_since(rows, mark, lookback)

    def _unstamped_rejects(self) -> None:
        """Rejects of text lines without a change time: no run finds them as changes, so each
        replaces the rejects of their days (bounded by the calendar), and of no day."""
        orders = self._all_orders()
        if self.cfg.quality == "quarantine" and self.cfg.quarantine_path and Q.RAW_COL in orders.columns:
            loose = TR.with_group_key(orders.where(F.col(Q.RAW_COL).isNotNull() & F.col("updated_at").isNull()))
            self._quarantine({r.date for r in loose.select("date").distinct().collect()} | {None})

    def _checked(self, rows: DataFrame) -> DataFrame:
        """Extracted rows under the quality mode (strict: a bad row fails)."""
        return Q.enforce_strict(rows) if self.cfg.quality == "strict" else rows

    def _quarantine(self, days: set | None) -> None:
        """The rejects of the days (None: of all), as their orders give them now."""
        if self.cfg.quality == "quarantine" and self.cfg.quarantine_path:
            rows = RT.all_rejects(self._all_orders()) if days is None else RT.rejects_of_days(self._all_orders(), days)
            RT.replace_rejects(rows, self.cfg.quarantine_path, days)
            self.after("rejects")

    def _sketch(self, days: set[_dt.date] | None) -> None:
        """The profile sketches of the days (None: of all), from all of their orders."""
        if self.cfg.sketch_path:
            SK.replace_sketches(self._all_orders().where(F.col("created_at").isNotNull()), self.cfg.sketch_path, days)
            self.after("sketches")

    def profile(self, first: _dt.date | None = None, last: _dt.date | None = None) -> DataFrame:
        """A8 of some days from the stored sketches; no order is read."""
        return SK.profile_of(SK.read_sketches(self.spark, self.cfg.sketch_path), first, last)

    def read_metrics(self, stamped: bool = False) -> DataFrame:
        return MT.read_metrics(self.spark, self.cfg.metrics_path, stamped)

    def read_state(self) -> DataFrame:
        return SL.read_state(self.spark, self.cfg.state_path)

    def watermark(self) -> _dt.datetime:
        return S.get_watermark(self.read_state(), self.cfg.pipeline_id)

    def _open(self) -> None:
        """Notes the last save of this id, which the next one must follow."""
        self._seq = SL.last_seq(self.spark, self.cfg.state_path, self.cfg.pipeline_id)

    def _append(self, rows: DataFrame) -> None:
        """Saves state rows as the next save of this id; fails if another run has saved since ``_open``."""
        SL.claim_seq(self.spark, self.cfg.state_path, self.cfg.pipeline_id, self._seq + 1)
        self._seq += 1
        SL.append_state(rows, self.cfg.state_path, self._seq)

    def reset_mark(self, run_at: _dt.datetime | None = None) -> None:
        """The stored mark back to the epoch; counters are kept."""
        ids = self.spark.range(1).select(F.lit(self.cfg.pipeline_id).alias("pipeline_id"))
        rows = S.reset_state(self.read_state(), ids, run_at or _now()).where(F.col("pipeline_id") == self.cfg.pipeline_id)
        self._open()
        self._append(rows)

    # --- steps --------------------------------------------------------------

    def _load(self, rows: DataFrame, days: set[_dt.date] | None, carry: bool, run_at: _dt.datetime) -> Step:
        """Writes a recompute: a row per touched group, its metrics (null or zero orders: the group is
        gone), and ``_rows`` and ``_max`` of the rows behind it. ``days``: those that it replaces (None: all);
        with ``carry`` their other groups stay. One Spark job writes, checks and counts."""
        path, values = self.cfg.metrics_path, list(METRIC_VALUE_COLS)
        version = MT.begin(self.spark, path)
        # One exchange, by day: groups meet their stored row in the task that writes their day.
        none = {"_rows": F.lit(None).cast("long"), "_max": F.lit(None).cast("timestamp_ntz")}
        new = rows.select(*KEY_COLS, F.struct(*values).alias("_new"), "_rows", "_max", F.lit(True).alias("_touched"))
        both = new.withColumns({"_old": F.lit(None).cast(new.schema["_new"].dataType), "_stamp": none["_max"]})
        if carry or self.cfg.count_upserts:  # else what is replaced need not be read
            old = MT.read_metrics(self.spark, path, stamped=True, days=days).select(
                *KEY_COLS, F.lit(None).cast(new.schema["_new"].dataType).alias("_new"), *[c.alias(n) for n, c in none.items()],
                F.lit(False).alias("_touched"), F.struct(*values).alias("_old"), F.col("last_updated_at").alias("_stamp"))
            both = both.unionByName(old)
        met = MT.by_day(both).groupBy(*KEY_COLS).agg(
            F.bool_or("_touched").alias("_touched"), F.sum("_rows").alias("_rows"), F.max("_max").alias("_max"),
            F.first("_new", ignorenulls=True).alias("_new"), F.first("_old", ignorenulls=True).alias("_old"), F.max("_stamp").alias("_stamp"))
        kept = F.col("_touched") & (F.coalesce(F.col("_new.total_orders"), F.lit(0)) > 0)
        table = met.select(
            *KEY_COLS, "_rows", "_max", "_touched", (kept | (~F.col("_touched") & F.lit(carry))).alias("_keep"),
            *[F.when(F.col("_touched"), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in values],
            F.when(F.col("_touched"), ts_ntz(run_at)).otherwise(F.col("_stamp")).alias("last_updated_at"),
            (kept & ~F.col("_new").eqNullSafe(F.col("_old"))).alias("_changed"),
        )
        seen, own = Observation(), F.col("_touched") & F.col("_keep")
        MT.write_version(table, path, version, seen, [
            F.count_if("_touched").alias("groups"), F.sum("_rows").alias("rows"), F.max("_max").alias("mark"),
            F.count_if(own & Q.contract_violations()).alias("invalid"), F.count_if(own & ~Q.consistency_flag()).alias("inconsistent"),
            F.count_if("_changed").alias("upserts"),
        ])
        got = seen.get
        out = Step(rows=int(got["rows"] or 0), groups=got["groups"], upserts=got["upserts"] if self.cfg.count_upserts else 0,
                   invalid=got["invalid"], inconsistent=got["inconsistent"], mark=got["mark"])
        self.after("written")
        if out.invalid and self.cfg.quality == "strict":
            raise ValueError(f"{out.invalid} metrics violate their contract")
        if out.inconsistent:
            warnings.warn(f"{out.inconsistent} metrics have fewer orders than completed and cancelled ones", stacklevel=2)
        MT.commit(self.spark, path, version, days)
        self.after("committed")
        return out

    def _save_mark(self, mark: _dt.datetime, rows: int, groups: int, run_at: _dt.datetime) -> None:
        row = S.save_row(self.spark, self.cfg.pipeline_id, mark, run_at, rows, groups)
        self._append(row)

    def _changed_keys(self, changed: DataFrame) -> DataFrame:
        """Key and change time of the changed rows; in strict mode a bad one fails whoever reads it."""
        return TR.with_group_key(self._checked(changed)).select(*KEY_COLS, "updated_at", "order_id")

    def _pass(self, changed: DataFrame, dry_run: bool, run_at: _dt.datetime) -> Step:
        """Touched keys of the changed rows -> recompute of these groups -> write."""
        keyed = _keys_with_stats(changed).persist()
        try:
            r = keyed.agg(F.count("*").alias("n"), F.sum("_rows").alias("rows"), F.max("_max").alias("mark"), F.min("date").alias("first"),
                          F.max("date").alias("last"), F.collect_set("date").alias("days"),  # bounded by the calendar
                          F.count_if(F.col("date").isNull()).alias("dayless")).first()
            if not r.n:
                return Step()
            days = set(r.days)
            if dry_run:
                # The preview outlives this pass: its days are written out.
                self.last_preview = TR.recompute_days_of(self.orders(), self.spark.createDataFrame([(d,) for d in sorted(days)], "date date"))
                return Step(rows=int(r.rows), groups=r.n, mark=r.mark)
            metrics = TR.recompute_known(self.orders(), keyed.select(*KEY_COLS), r.n, r.first, r.last)
            out = self._load(keyed.join(metrics, list(KEY_COLS), "left"), days, True, run_at)
            self._quarantine(days | {None} if r.dayless else days)
            self._sketch(days)
            return out
        finally:
            keyed.unpersist()

    def _groups(self, own: DataFrame) -> DataFrame:
        """Metrics of every group of the rows, with ``_rows`` and ``_max`` of all of them; bad ones count in these alone."""
        good = Q.row_reason(own).isNull() if self.cfg.quality == "quarantine" else None
        return TR.aggregate_metrics(self._checked(own), [F.count("*").alias("_rows"), F.max("updated_at").alias("_max")], good)

    def _summary(self, mode: str, total: Step, dry_run: bool, t0: float, **more) -> dict:  # noqa: ANN003
        return {
            "mode": mode,
            "dry_run": dry_run,
            **more,
            "total_rows": total.rows,
            "total_groups": total.groups,
            "total_upserts": total.upserts,
            "invalid_metrics": total.invalid,
            "inconsistent_metrics": total.inconsistent,
            "duration_seconds": round(time.time() - t0, 2),
        }

    # --- runs ---------------------------------------------------------------

    def run_incremental(self, dry_run: bool = False, run_at: _dt.datetime | None = None) -> dict:
        with self._parsed_once():
            return self._incremental(dry_run, run_at)

    def _incremental(self, dry_run: bool, run_at: _dt.datetime | None) -> dict:
        t0, run_at = time.time(), run_at or _now()
        self._open()
        start = self.watermark()
        changed = self._changed_keys(self._newer(self._change_rows(), start, self.cfg.lookback))
        total, batches, mark, bounds = Step(), 0, start, [None]
        if self.cfg.batch_size:
            # Changes are looked up, checked and stored once; pages are ranges (from, to] of them.
            changed = materialize(changed)
            bounds = page_bounds(changed, self.cfg.batch_size)
        if dry_run:
            total, batches = self._pass(changed, True, run_at), len(bounds)
            return self._summary("incremental", total, True, t0, batches=batches if total.rows else 0)
        for k, bound in enumerate(bounds):
            own = changed if k == 0 else changed.where(F.col("updated_at") > ts_ntz(bounds[k - 1]))
            if bound is not None:
                own = own.where(F.col("updated_at") <= ts_ntz(bound))
            step = self._pass(own, False, run_at)
            if step.rows == 0:
                break
            # With a lookback window all rows may be older than the mark: it never moves back.
            top = max(step.mark or mark, mark)
            if self.after_write:
                self.after_write()
            self._save_mark(top, step.rows, step.groups, run_at)
            total.add(step)
            batches, mark = batches + 1, top
        self._unstamped_rejects()
        return self._summary("incremental", total, False, t0, batches=batches)

    def run_backfill(
        self, start: _dt.date, end: _dt.date, dry_run: bool = False, run_at: _dt.datetime | None = None
    ) -> dict:
        """Recompute the days ``start``..``end``; the mark is not touched."""
        with self._parsed_once():
            return self._backfill(start, end, dry_run, run_at)

    def _backfill(self, start: _dt.date, end: _dt.date, dry_run: bool, run_at: _dt.datetime | None) -> dict:
        t0, run_at = time.time(), run_at or _now()
        if start > end:
            raise ValueError("start date must not be after end date")
        own = X.extract_backfill(self._all_orders(), start, end)
        if not own.take(1):
            return {"mode": "backfill", "total_rows": 0}
        if dry_run:
            total = _totals(_keys_with_stats(TR.with_group_key(self._checked(own))))
            self.last_preview = TR.recompute_days(self.orders(), start, end)
        else:
            days = {start + _dt.timedelta(days=i) for i in range((end - start).days + 1)}
            total = self._load(self._groups(own), days, False, run_at)
            self._quarantine(days)
            self._sketch(days)
        return self._summary("backfill", total, dry_run, t0, start_date=start.isoformat(), end_date=end.isoformat())

    def run_full(self, dry_run: bool = False, run_at: _dt.datetime | None = None) -> dict:
        """Rebuild every group from the epoch in one aggregation.

        Unlike the reference, the mark is not reset to the epoch before the
        run: the run reads from the epoch anyway and saves the new mark only
        after the write, so a crash in the middle leaves the state as it
        was (every day already rewritten is correct, being recomputed from
        the source). A dry run previews from the epoch, touching nothing.
        """
        with self._parsed_once():
            return self._full(dry_run, run_at)

    def _full(self, dry_run: bool, run_at: _dt.datetime | None) -> dict:
        t0, run_at = time.time(), run_at or _now()
        self._open()
        own = self._newer(self._all_orders(), EPOCH)
        if not own.take(1):
            return self._summary("full", Step(), dry_run, t0, batches=0)
        if dry_run:
            total = _totals(_keys_with_stats(TR.with_group_key(self._checked(own))))
            self.last_preview = TR.daily_metrics_full(Q.valid_orders(own) if self.cfg.quality == "quarantine" else own)
        else:
            total = self._load(self._groups(own), None, False, run_at)
            self._quarantine(None)
            self._sketch(None)
            if self.after_write:
                self.after_write()
            self._save_mark(total.mark, total.rows, total.groups, run_at)
        return self._summary("full", total, dry_run, t0, batches=1)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _keys_with_stats(rows: DataFrame) -> DataFrame:
    """Distinct group keys of ``rows`` with their row count and last change
    (partial aggregation: a hot group costs one row per task)."""
    return rows.groupBy(*KEY_COLS).agg(F.count(F.lit(1)).alias("_rows"), F.max("updated_at").alias("_max"))


def _totals(keyed: DataFrame) -> Step:
    """Groups, rows and last change time of a keyed-stats frame."""
    r = keyed.agg(F.count(F.lit(1)), F.sum("_rows"), F.max("_max")).first()
    return Step(rows=int(r[1] or 0), groups=int(r[0]), mark=r[2])


__all__ = ["JobConfig", "MetricsJob"]
