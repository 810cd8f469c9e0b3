"""Incremental run on Structured Streaming (R1 as ``foreachBatch``).

A change feed (files of order row versions) is read with ``readStream``. The
job keeps every row version in an ordinary table partitioned by reporting day
and epoch. Each micro-batch (epoch ``e``):

1. writes its own rows to the partitions ``(day, e)`` by dynamic overwrite: a
   replayed epoch replaces just what it wrote itself, from the batch alone;
2. reads its days (a partition filter), takes the latest version of each order,
   drops those that break a row rule, and replaces these days' metrics.

A crash anywhere is repaired by the replay of the epoch, which never reads what
it overwrites. The stream checkpoint plays the role of the stored mark. No
event-time watermark is used: a change to any old day is applied.

The latest version is picked before the row rules, so an order that turned bad
leaves its group, as in a full rebuild. Versions without an order id or a
creation time have no day; they go to the rejects with all other bad versions.

Compaction: where a day holds versions of ``COMPACT_EPOCHS`` epochs or more, the latest
version of each order is written as the day's base, epochs up to the last one that can't be replayed any more.
The base lies in a partition of its own, ``epoch = -(E + 2)`` for epochs up to E, and counts once its marker
``_bases/<day>/<E>`` exists; before that, a crash leaves files that nobody reads. What a base
replaces is removed by the day's next compaction, so an epoch that has just listed it can still read it. A
day thus holds two bases and the epochs since the older one, however long the stream runs.

Assumption (as in the reference): ``created_at`` of an order never changes,
so all versions of an order live in the same day.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailytally.config import ORDER_COLS
from dailytally.functions.columns import order_date
from dailytally.operators import quality as Q
from dailytally.operators.transform import aggregate_metrics
from dailytally.schemas import ORDERS
from dailytally.session import work_path
from dailytally.sources import metrics_table as MT
from dailytally.sources.orders import ORDER_DATE_COL

EPOCH_COL = "epoch"
INITIAL_EPOCH = -1  # stream epochs start at 0
#: Epochs that a day holds before it is compacted.
COMPACT_EPOCHS = 16
VERSIONS_SCHEMA = T.StructType(
    [*ORDERS.fields, T.StructField(ORDER_DATE_COL, T.DateType(), False), T.StructField(EPOCH_COL, T.LongType(), False)]
)


class ChangeFeedJob:
    """Keeps a metrics table current from a stream of order versions."""

    def __init__(self, spark: SparkSession, orders_path: str, metrics_path: str, rejects_path: str | None = None,
                 compact_epochs: int = COMPACT_EPOCHS):
        self.spark = spark
        self.orders_path = orders_path
        self.metrics_path = metrics_path
        self.rejects_path = rejects_path
        self.compact_epochs = compact_epochs
        # Test hook: called after each step of a batch with its name.
        self.after: callable = lambda step: None

    def write_versions(self, rows: DataFrame, epoch: int) -> None:
        """The rows as versions of one epoch, in the partitions of their days."""
        self._write(rows.select(*ORDER_COLS).withColumns({
            ORDER_DATE_COL: order_date("created_at"), EPOCH_COL: F.lit(epoch).cast("long")}))

    def _write(self, staged: DataFrame) -> None:
        (
            staged.hint("rebalance", ORDER_DATE_COL)
            .sortWithinPartitions(ORDER_DATE_COL, "restaurant_id", "order_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(ORDER_DATE_COL, EPOCH_COL)
            .parquet(self.orders_path)
        )

    def _bases(self) -> dict[_dt.date, list[int]]:
        """The last epoch in each base of each day, ascending (bounded by the calendar)."""
        found: dict[_dt.date, list[int]] = {}
        for name in MT._names(self.spark, f"{self.orders_path.rstrip('/')}/_bases/*/*"):
            day, last = name.rsplit("/", 2)[1:]
            found.setdefault(_dt.date.fromisoformat(day), []).append(int(last))
        return {d: sorted(e) for d, e in found.items()}

    def versions(self, days: list[_dt.date] | None = None) -> DataFrame:
        """Stored versions that count, of some days only by a partition filter: each day's last base, and the epochs since."""
        data = MT.read_or_empty(self.spark, self.orders_path, VERSIONS_SCHEMA)
        if days is not None:
            data = data.where(F.col(ORDER_DATE_COL).isin(days))
        bases = {d: e[-1] for d, e in self._bases().items() if days is None or d in set(days)}
        last = F.lit(INITIAL_EPOCH)
        if bases:
            last = F.coalesce(F.create_map(*[F.lit(x) for kv in bases.items() for x in kv])[F.col(ORDER_DATE_COL)], last)
        return data.where((F.col(EPOCH_COL) > last) | (F.col(EPOCH_COL) == -(last + 2)))

    def compact(self, up_to: int) -> list[_dt.date]:
        """Gives days of many epochs a base of their versions of the epochs up to ``up_to``,
        which must not be replayed any more. Safe beside a running later epoch. Returns the days."""
        top, bases = self.orders_path.rstrip("/"), self._bases()
        held: dict[_dt.date, list[int]] = {}
        for name in MT._names(self.spark, f"{top}/{ORDER_DATE_COL}=*/{EPOCH_COL}=*"):
            day, epoch = (part.split("=", 1)[1] for part in name.rsplit("/", 2)[1:])
            held.setdefault(_dt.date.fromisoformat(day), []).append(int(epoch))
        since = {d: [e for e in own if bases.get(d, [INITIAL_EPOCH])[-1] < e <= up_to] for d, own in held.items()}
        days = sorted(d for d, own in since.items() if len(own) >= self.compact_epochs)
        if not days:
            return []
        rows = self._latest(self.versions(days).where(F.col(EPOCH_COL) <= up_to))
        self._write(rows.withColumn(EPOCH_COL, F.lit(-(up_to + 2)).cast("long")))
        self.after("base")
        fs, make = MT._files(self.spark, top)
        for d in days:
            fs.create(make(f"{top}/_bases/{d.isoformat()}/{up_to}"), True).close()
        self.after("marked")
        for d in days:
            # What the base before the present one replaced, and bases before that one.
            before = bases.get(d, [INITIAL_EPOCH])[-1]
            gone = [e for e in held[d] if (0 <= e <= before) or (e < 0 and e not in (-(before + 2), -(up_to + 2)))]
            for e in gone:
                fs.delete(make(f"{top}/{ORDER_DATE_COL}={d.isoformat()}/{EPOCH_COL}={e}"), True)
            for e in bases.get(d, [])[:-1]:
                fs.delete(make(f"{top}/_bases/{d.isoformat()}/{e}"), False)
        return days

    def current(self, days: list[_dt.date] | None = None) -> DataFrame:
        """The latest version of each order; on equal stamps the later epoch's.
        ``row_number() == 1`` is planned with a group limit per task before the
        shuffle, so an order of very many versions sends one row per task."""
        return self._latest(self.versions(days))

    @staticmethod
    def _latest(versions: DataFrame) -> DataFrame:
        ties = [F.col(c) for c in ORDER_COLS if c not in ("order_id", "updated_at")]
        w = Window.partitionBy("order_id").orderBy(F.col("updated_at").desc(), F.col(EPOCH_COL).desc(), *ties)
        latest = versions.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
        return latest.select(*ORDER_COLS, ORDER_DATE_COL)

    def _refresh(self, days: list[_dt.date] | None, run_at: _dt.datetime) -> None:
        metrics = aggregate_metrics(Q.valid_orders(self.current(days)))
        if days is None:
            MT.replace_days(metrics, self.metrics_path, run_at)
            return
        MT.replace_days(metrics, self.metrics_path, run_at, touched=days)

    def load_initial(self, orders: DataFrame, run_at: _dt.datetime | None = None) -> None:
        """Starting snapshot and its metrics (before the stream starts)."""
        self.write_versions(_placed(Q.normalize_orders(orders)), INITIAL_EPOCH)
        self._refresh(None, run_at or _now())

    def process_batch(self, batch: DataFrame, epoch_id: int, run_at: _dt.datetime | None = None) -> None:
        batch = Q.normalize_orders(batch.select(*ORDER_COLS)).persist()
        try:
            placed = _placed(batch)
            days = [r[0] for r in placed.select(order_date("created_at")).distinct().collect()]  # bounded by the calendar
            if self.rejects_path:
                Q.rejected_orders(batch).write.mode("overwrite").parquet(f"{self.rejects_path}/epoch={epoch_id}")
                self.after("rejects")
            if days:
                self.write_versions(placed, epoch_id)
                self.after("versions")
                self._refresh(days, run_at or _now())
                self.after("metrics")
            # Only this epoch can still be replayed.
            self.compact(epoch_id - 1)
        finally:
            batch.unpersist()

    def run(self, changes_dir: str, checkpoint: str, max_files_per_trigger: int = 8) -> None:
        """Process every change file present now (``availableNow``), then stop."""
        stream = (
            self.spark.readStream.schema(ORDERS)
            .option("maxFilesPerTrigger", str(max_files_per_trigger))
            .parquet(changes_dir)
        )
        q = (
            stream.writeStream.foreachBatch(lambda batch, epoch: self.process_batch(batch, epoch))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def _placed(rows: DataFrame) -> DataFrame:
    """Versions that have an order and a day."""
    return rows.where(F.col("order_id").isNotNull() & F.col("created_at").isNotNull() & F.col("updated_at").isNotNull())


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def write_change_files(changes: DataFrame, path: str, files: int = 16) -> None:
    """Lay a change feed out as files in change-time order (one range of
    change times per file), as a producer would append them."""
    changes.select(*ORDER_COLS).repartitionByRange(files, "updated_at", "order_id").sortWithinPartitions(
        "updated_at", "order_id"
    ).write.mode("overwrite").parquet(path)


def replay_two_snapshots(spark: SparkSession, orders: DataFrame, split=None, files: int = 4, feed=None, compact_epochs: int = COMPACT_EPOCHS) -> DataFrame:  # noqa: ANN001
    """Scenario of the registered query: snapshot v1 and its metrics are the
    starting table; the changes from v1 to v2 (``feed`` turns them into what the
    producer sends) arrive as a stream. Returns the metrics table after it."""
    from dailytally.plans import scenarios as SC

    split = split or SC.SPLIT
    root = work_path(spark, "stream")
    job = ChangeFeedJob(spark, f"{root}/orders", f"{root}/metrics", f"{root}/rejects", compact_epochs)
    job.load_initial(SC.snapshot_v1(orders, split))
    changes = SC.changes_after(orders, split)
    write_change_files(feed(changes) if feed else changes, f"{root}/changes", files)
    job.run(f"{root}/changes", f"{root}/checkpoint", max_files_per_trigger=max(1, files // 2) if compact_epochs == COMPACT_EPOCHS else 1)
    return MT.read_metrics(spark, f"{root}/metrics")
