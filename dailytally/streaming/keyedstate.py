"""Incremental run on a keyed state store (R1): no stored version is read again.

A change feed (files of order row versions) is read with ``readStream``. A stateful operator keeps
the latest version of each order, and only what its group counts of it. Orders are dealt to ``buckets`` by a hash
of their id, and the state has a value per bucket: its orders as a compressed Arrow table, so a call of the operator
works on many orders at once. A version that replaces another
gives two rows: the old contribution taken back, the new one added. ``foreachBatch`` sums these per group, adds
them to the metrics of the touched days and commits the days as version ``epoch + 1`` of the metrics table.

So every epoch counts once: the state store takes an epoch that is replayed back to its start, which gives
the same rows again; of an epoch whose version is committed already only the state is made anew; one that
died before its commit has left nothing that is read. What an epoch reads is its own changes, the state of
their orders' buckets, and the metrics of their days. A bucket should hold some hundred orders (``BUCKET_ORDERS``): its state is
rewritten whole when one of them changes. The number of buckets holds as long as the checkpoint, which notes it.

The order of versions is that of ``ChangeFeedJob``: the latest change time, on equal ones the later epoch's, then the
least by columns. Versions that break a row rule replace older ones and count nowhere. An order may move to
another day or group. Versions without an order id, a creation or a change time are left out. The starting
table is the feed's first files.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailytally.config import KEY_COLS, METRIC_VALUE_COLS, ORDER_COLS
from dailytally.functions.columns import is_cancelled, is_completed, order_date, ts_ntz
from dailytally.operators import quality as Q
from dailytally.schemas import ORDERS
from dailytally.session import work_path
from dailytally.sources import metrics_table as MT

#: Kept per order: when, and what it counts for (``counts`` 0: nothing).
KEPT = ["order_id", "stamp", "restaurant_id", "day", "country", "counts", "completed", "cancelled", "cents"]
GROUP, COUNTED = KEPT[2:5], KEPT[5:]
#: The state of a bucket: its orders, as ``packed``.
STATE = "orders binary"
#: Orders of a bucket, where the number of buckets is chosen from a table.
BUCKET_ORDERS = 1000
LEAST_BUCKETS = 256
#: A contribution, added (1) or taken back (-1) already.
DELTAS = "restaurant_id string, day long, country string, total_orders long, completed_orders long, cancelled_orders long, cents long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def contributions(versions: DataFrame) -> DataFrame:
    """What each version counts for, and ``stamp`` and ``tie``, by which versions of an order are ordered."""
    rows = Q.normalize_orders(versions.select(*ORDER_COLS))
    rows = rows.where(F.col("order_id").isNotNull() & F.col("created_at").isNotNull() & F.col("updated_at").isNotNull())
    good = Q.reject_reason().isNull()
    when = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return rows.select(
        "order_id", F.date_format("updated_at", when).alias("stamp"),
        F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ORDER_COLS])).alias("tie"),
        F.coalesce("restaurant_id", F.lit("")).alias("restaurant_id"), F.unix_date(order_date("created_at")).cast("long").alias("day"),
        F.coalesce("country", F.lit("")).alias("country"), good.cast("long").alias("counts"), (good & is_completed()).cast("long").alias("completed"),
        (good & is_cancelled()).cast("long").alias("cancelled"),
        F.when(good & is_completed(), F.col("amount") * 100).otherwise(0).cast("long").alias("cents"),
    )


def packed(orders: pd.DataFrame) -> bytes:
    """The kept columns as a compressed Arrow stream."""
    rows, sink = pa.Table.from_pandas(orders[KEPT], preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpacked(state: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(pa.py_buffer(bytes(state))) as found:
        return found.read_pandas()


def latest_in_epoch(rows: pd.DataFrame) -> pd.DataFrame:
    """A row per order: its latest version, on equal times the least ``tie``."""
    several = rows["order_id"].duplicated(keep=False)
    if not several.any():
        return rows
    best = rows[several].sort_values("tie", kind="stable").sort_values("stamp", ascending=False, kind="stable").drop_duplicates("order_id")
    return pd.concat([rows[~several], best], ignore_index=True)


def latest_versions(key: tuple, batches: Iterable[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
    """The state of one bucket of orders, and the contributions taken back and added."""
    found = [b for b in batches if len(b)]
    if not found:
        return
    new = latest_in_epoch(pd.concat(found, ignore_index=True))[KEPT]
    old = unpacked(state.get[0]) if state.exists else new.iloc[:0]
    at = pd.Index(old["order_id"]).get_indexer(new["order_id"])
    late = at >= 0
    late[late] = old["stamp"].to_numpy()[at[late]] > new["stamp"].to_numpy()[late]
    new, at = new[~late], at[~late]
    if not len(new):
        return
    gone = at[at >= 0]
    before, after = old.iloc[gone], new[at >= 0]
    state.update((packed(pd.concat([old.drop(index=old.index[gone]), new], ignore_index=True)),))
    # Versions that count alike in the same group change nothing.
    alike = (before[KEPT[2:]].to_numpy() == after[KEPT[2:]].to_numpy()).all(1)
    back, more = before[~alike], pd.concat([new[at < 0], after[~alike]])
    back = back.assign(**{c: -back[c] for c in COUNTED})
    out = pd.concat([back, more], ignore_index=True)
    out = out.loc[out["counts"] != 0, GROUP + COUNTED]
    if len(out):
        yield out.set_axis([f.split()[0] for f in DELTAS.split(", ")], axis=1)


class KeyedStateJob:
    """Keeps a metrics table current from a stream of order versions, by a state per bucket of orders."""

    def __init__(self, spark: SparkSession, metrics_path: str, run_at: Callable[[], _dt.datetime] | None = None, buckets: int = LEAST_BUCKETS):
        self.spark, self.metrics_path, self.buckets = spark, metrics_path, buckets
        self.run_at = run_at or (lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
        # Test hook: called after each step of an epoch with its name.
        self.after: Callable[[str], None] = lambda step: None

    def deltas(self, changes: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64("order_id"), F.lit(self.buckets))
        return contributions(changes).withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(latest_versions, DELTAS, STATE, "update", "NoTimeout")

    def _note_buckets(self, checkpoint: str) -> None:
        """The number of buckets that the checkpoint's state was made with; this job's, if it is new."""
        note = f"{checkpoint.rstrip('/')}/buckets"
        noted = MT._names(self.spark, f"{note}/*")
        if noted:
            self.buckets = int(noted[0].rsplit("/", 1)[1])
            return
        fs, make = MT._files(self.spark, note)
        fs.create(make(f"{note}/{self.buckets}"), False).close()

    def apply(self, deltas: DataFrame, epoch: int) -> None:
        """Adds an epoch's contributions to the table, once."""
        version = epoch + 1
        if (MT.last_commit(self.spark, self.metrics_path) or 0) >= version:
            deltas.write.format("noop").mode("overwrite").save()  # the state is saved as its rows are made
            return
        MT.begin(self.spark, self.metrics_path)  # clears what a dead epoch has left
        # One row per touched group, read twice but made once.
        day = F.date_from_unix_date(F.col("day").cast("int"))
        names = ("total_orders", "completed_orders", "cancelled_orders", "cents")
        change = deltas.groupBy("restaurant_id", day.alias("date"), "country").agg(*[F.sum(c).alias(c) for c in names]).persist()
        try:
            days = {r.date for r in change.select("date").distinct().collect()}  # bounded by the calendar
            if not days:
                return
            stamp = F.lit(None).cast("timestamp_ntz")
            old = MT.read_metrics(self.spark, self.metrics_path, stamped=True, days=days).withColumn("cents", (F.col("gross_revenue") * 100).cast("long"))
            both = change.select(*KEY_COLS, *names, F.lit(True).alias("_new"), stamp.alias("_stamp")).unionByName(
                old.select(*KEY_COLS, *names, F.lit(False).alias("_new"), F.col("last_updated_at").alias("_stamp")))
            met = MT.by_day(both).groupBy(*KEY_COLS).agg(
                *[F.sum(c).alias(c) for c in names], F.bool_or("_new").alias("_new"), F.max("_stamp").alias("_stamp"))
            revenue = (F.col("cents").cast("decimal(22,0)") / 100).cast("decimal(22,2)")
            table = met.withColumn("gross_revenue", revenue).select(
                *KEY_COLS, *METRIC_VALUE_COLS, F.when(F.col("_new"), ts_ntz(self.run_at())).otherwise(F.col("_stamp")).alias("last_updated_at"),
                (F.col("total_orders") > 0).alias("_keep"))
            MT.write_version(table, self.metrics_path, version)
            self.after("written")
            MT.commit(self.spark, self.metrics_path, version, days)
            self.after("committed")
        finally:
            change.unpersist()

    def run(self, changes_dir: str, checkpoint: str, max_files_per_trigger: int = 8) -> None:
        """Processes every change file present now, then stops. The state store is RocksDB: a state that
        grows with the number of orders does not have to fit the executors' memory."""
        name = "spark.sql.streaming.stateStore.providerClass"
        before = self.spark.conf.get(name)
        self._note_buckets(checkpoint)
        self.spark.conf.set(name, ROCKSDB)
        try:
            stream = self.spark.readStream.schema(ORDERS).option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(changes_dir)
            q = (
                self.deltas(stream).writeStream.outputMode("update").foreachBatch(self.apply)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            )
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
        finally:
            self.spark.conf.set(name, before)


def replay_by_state(spark: SparkSession, orders: DataFrame, feed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Scenario of the registered query: the first snapshot, then the changes to the second one, as files of one feed."""
    from dailytally.plans import scenarios as SC

    root = work_path(spark, "keyed")
    changes = SC.changes_after(orders)
    SC.snapshot_v1(orders).select(*ORDER_COLS).write.parquet(f"{root}/changes/first")
    # An epoch for the snapshot, as many files as tasks have written; two for the changes, those of an order in one file.
    files = max(1, len(MT._names(spark, f"{root}/changes/first/*.parquet")))
    (feed(changes) if feed else changes).select(*ORDER_COLS).repartition(2 * files, "order_id").write.parquet(f"{root}/changes/then")
    job = KeyedStateJob(spark, f"{root}/metrics", lambda: SC.RUN_TS, max(LEAST_BUCKETS, orders.count() // BUCKET_ORDERS))
    job.run(f"{root}/changes/*", f"{root}/checkpoint", max_files_per_trigger=files)
    return MT.read_metrics(spark, f"{root}/metrics")
