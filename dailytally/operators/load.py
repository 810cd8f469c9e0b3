"""Keyed writes as DataFrame algebra.

These are the pure forms: the result is the table as it must be after the
write. How it gets to storage (dynamic partition overwrite of the touched
days, or ``MERGE INTO`` on a table format that has it) is in
``dailytally.sources.metrics_table``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailytally.config import DEFAULT_BROADCAST_KEY_LIMIT, KEY_COLS, METRIC_VALUE_COLS
from dailytally.functions.columns import iso_date, ts_ntz
from dailytally.session import materialize


def checked_broadcast(df: DataFrame, limit_rows: int) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only when it has at most ``limit_rows`` rows.

    ``df`` is written once (checkpoint) and counted; the join then reads the
    written rows instead of recomputing them. Above the limit the frame is
    joined by shuffle (AQE may still demote to a broadcast at run time from
    measured sizes).
    """
    df = materialize(df)
    n = df.count()
    return (F.broadcast(df), True) if n <= limit_rows else (df, False)


def upsert(
    target: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = KEY_COLS,
    broadcast_key_limit: int = DEFAULT_BROADCAST_KEY_LIMIT,
    new_is_stored: bool = False,
) -> DataFrame:
    """Insert absent keys, replace present ones (``$set``, not ``$inc``).

    = target rows whose key is not in ``new``, plus all of ``new``.
    ``new`` (a recompute: one row per touched group) is written once, so the
    size check and the two uses below do not recompute it; a caller that
    already persisted it passes ``new_is_stored=True``.
    """
    new = new.select(*target.columns)
    if not new_is_stored:
        new = materialize(new)
    n = new.count()
    new_keys = new.select(*keys)
    if n <= broadcast_key_limit:
        new_keys = F.broadcast(new_keys)
    kept = target.join(new_keys, list(keys), "left_anti")
    return kept.unionByName(new)


def upsert_counts(target: DataFrame, new: DataFrame, keys: Sequence[str] = KEY_COLS) -> DataFrame:
    """Inserted, modified (matched and different), unchanged, total.

    ``modified`` counts matched rows whose metric values differ
    (null-safe), like a document store's modified count; the reference
    reports ``inserted + modified`` as its upsert count.
    """
    values = [c for c in new.columns if c not in keys]
    t = target.select(*keys, F.struct(*values).alias("_old"), F.lit(True).alias("_hit"))
    j = new.select(*keys, F.struct(*values).alias("_new")).join(t, list(keys), "left")
    matched = F.col("_hit").isNotNull()
    changed = matched & ~F.col("_new").eqNullSafe(F.col("_old"))
    return j.agg(
        F.count_if(~matched).alias("inserted"),
        F.count_if(changed).alias("modified"),
        F.count_if(matched & ~changed).alias("unchanged"),
        (F.count_if(~matched) + F.count_if(changed)).alias("upserted"),
    )


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str = "order_id") -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``.

    Existing rows win; among incoming duplicates the first by change time
    is taken. Result = existing plus the new keys.

    On the day-partitioned layout (``order_date`` column on the existing
    side) only the days of the incoming rows are read for the key check: an
    order's creation day never changes, so its key can only exist there.
    """
    seen = existing
    if "order_date" in existing.columns:
        incoming = _with_day(incoming)
        days = incoming.select("order_date").distinct()  # bounded by the calendar
        seen = existing.join(F.broadcast(days), "order_date", "left_semi")
    # Only keys of the existing side move; its rows pass through.
    fresh = incoming.join(seen.select(key), key, "left_anti")
    w = Window.partitionBy(key).orderBy(F.col("updated_at").asc(), *[F.col(c) for c in incoming.columns if c != key])
    first = fresh.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return existing.unionByName(first.select(*existing.columns))


def _with_day(rows: DataFrame) -> DataFrame:
    return rows if "order_date" in rows.columns else rows.withColumn("order_date", F.to_date("created_at"))


def apply_changes(snapshot: DataFrame, changes: DataFrame, key: str = "order_id") -> DataFrame:
    """Current table from a snapshot plus a change feed.

    Keeps the latest version per key by ``updated_at``; on equal stamps the
    change wins over the snapshot. ``row_number() == 1`` is planned with a
    per-task group limit before the shuffle, so a key with very many
    versions sends one row per task, not all of its versions.

    On the day-partitioned layout only the days of the changes are merged;
    all other days pass through without an exchange.
    """
    cols = snapshot.columns
    if "order_date" in cols:
        changes = _with_day(changes)
        days = F.broadcast(changes.select("order_date").distinct())  # bounded by the calendar
        touched = snapshot.join(days, "order_date", "left_semi").select(*cols)
        rest = snapshot.join(days, "order_date", "left_anti").select(*cols)
        return rest.unionByName(_latest(touched, changes, key))
    return _latest(snapshot, changes, key)


def _latest(snapshot: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    cols = snapshot.columns
    both = snapshot.select(*cols, F.lit(0).alias("_src")).unionByName(
        changes.select(*cols, F.lit(1).alias("_src"))
    )
    w = Window.partitionBy(key).orderBy(
        F.col("updated_at").desc(), F.col("_src").desc(), *[F.col(c) for c in cols if c not in (key, "updated_at")]
    )
    return both.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(*cols)


def apply_changes_colocated(snapshot: DataFrame, changes: DataFrame, buckets: int, key: str = "order_id") -> DataFrame:
    """W6 as a join, for a snapshot in ``buckets`` buckets of ``key`` (and laid out by day).

    The latest version of each changed key is found first (a task sends one row of
    each key), then dealt to the snapshot's buckets: the snapshot has no exchange,
    whatever the number of changes. On equal stamps the change wins. ``snapshot`` holds
    each key once, and an order's creation day never changes. Days without changes
    take no part in the join.
    """
    cols = snapshot.columns
    rest = None
    if "order_date" in cols:
        changes = _with_day(changes)
        days = F.broadcast(changes.select("order_date").distinct())  # bounded by the calendar
        rest = snapshot.join(days, "order_date", "left_anti").select(*cols)
        snapshot = snapshot.join(days, "order_date", "left_semi").select(*cols)
    newest = _latest_of(changes.select(*cols), key).repartition(buckets, key)
    old, new = (df.select(F.col(key), F.struct(*cols).alias(name)) for df, name in ((snapshot, "_old"), (newest, "_new")))
    both = old.join(new, key, "full_outer")
    newer = F.col("_old").isNull() | (F.col("_new.updated_at") >= F.col("_old.updated_at"))
    row = F.when(newer, F.col("_new")).otherwise(F.col("_old"))
    merged = both.select(row.alias("_row")).select("_row.*")
    return merged if rest is None else rest.unionByName(merged)


def insert_if_absent_colocated(existing: DataFrame, incoming: DataFrame, buckets: int, key: str = "order_id") -> DataFrame:
    """W5 on a table in ``buckets`` buckets of ``key``: the first version of each incoming key moves to
    the table's buckets, the table's keys stay where they are. All days are looked up,
    so a key is found even if its creation day differs."""
    cols = existing.columns
    if "order_date" in cols:
        incoming = _with_day(incoming)
    first = _latest_of(incoming.select(*cols), key, latest=False).repartition(buckets, key)
    # An outer join: an anti join would be pushed below the dealing, and the table would move.
    both = first.join(existing.select(key, F.lit(True).alias("_hit")), key, "left")
    return existing.unionByName(both.where(F.col("_hit").isNull()).select(*cols))


def _latest_of(rows: DataFrame, key: str, latest: bool = True) -> DataFrame:
    """One version of each key, the last (or first) by ``updated_at``."""
    stamp = F.col("updated_at").desc() if latest else F.col("updated_at").asc()
    w = Window.partitionBy(key).orderBy(stamp, *[F.col(c) for c in rows.columns if c not in (key, "updated_at")])
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def to_documents(metrics: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """Stored form: ISO date text, double revenue, run stamp."""
    return metrics.select(
        "restaurant_id",
        iso_date("date").alias("date"),
        "country",
        *[c for c in METRIC_VALUE_COLS if c != "gross_revenue"],
        F.col("gross_revenue").cast("double").alias("gross_revenue"),
        ts_ntz(run_ts).alias("last_updated_at"),
    )
