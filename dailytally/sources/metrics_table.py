"""The ``daily_metrics`` table: Parquet, one folder per ``date`` and version.

A run writes the days it touches as a new version, ``date=.../v=N``, beside the ones that are
read; the version counts once its marker ``_commits/N`` exists. So a run may carry over
the groups of a day that it has not recomputed: what it reads is never what it writes, and a
run that dies leaves the table as it was. The files of a dead run are removed by the
next one before it begins. A version that was replaced stays until the next write of its day,
for readers that still hold its file list.

One run writes at a time. A table without ``_commits`` is read as it lies; its day folders
count as version 0 when the first version is written.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dailytally.functions.columns import ts_ntz
from dailytally.schemas import METRICS, STORED_METRICS

METRIC_COLS = [f.name for f in METRICS.fields]
STORED_COLS = [f.name for f in STORED_METRICS.fields]


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:  # noqa: ANN001
    """A Parquet table, empty while its path does not exist; any fault is raised."""
    if not _names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _files(spark: SparkSession, path: str):  # noqa: ANN202
    """The file system of a path, and a function that makes paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _names(spark: SparkSession, pattern: str) -> list[str]:
    """Last parts of the paths that fit a pattern (none where the folder is missing)."""
    fs, make = _files(spark, pattern)
    return [st.getPath().toString() for st in fs.globStatus(make(pattern)) or []]


def _versions(spark: SparkSession, path: str) -> dict[_dt.date, list[int]]:
    """Stored versions of each day, ascending; 0 for files that lie in the day's folder itself."""
    found: dict[_dt.date, set[int]] = {}
    for name in _names(spark, f"{path.rstrip('/')}/date=*/*"):
        day, last = name.rsplit("/", 2)[1:]
        own = found.setdefault(_dt.date.fromisoformat(day.removeprefix("date=")), set())
        if last.startswith("v="):
            own.add(int(last[2:]))
        elif last.endswith(".parquet"):
            own.add(0)
    return {d: sorted(v) for d, v in found.items()}


def last_commit(spark: SparkSession, path: str) -> int | None:
    return max((int(n.rsplit("/", 1)[1]) for n in _names(spark, f"{path.rstrip('/')}/_commits/*")), default=None)


def current_days(spark: SparkSession, path: str) -> dict[_dt.date, int] | None:
    """The version that counts for each day (bounded by the calendar); None without any commit."""
    top = last_commit(spark, path)
    if top is None:
        return None
    seen = {d: [v for v in own if v <= top] for d, own in _versions(spark, path).items()}
    return {d: own[-1] for d, own in seen.items() if own}


def read_metrics(spark: SparkSession, path: str, stamped: bool = False, days: Iterable[_dt.date] | None = None) -> DataFrame:
    """Current table, of some days only if given; empty frame when nothing was written yet.
    ``stamped`` adds the time of the run that wrote each row."""
    cols, top = STORED_COLS if stamped else METRIC_COLS, path.rstrip("/")
    current = current_days(spark, path)
    if current is None:
        df = read_or_empty(spark, path, STORED_METRICS).select(*cols)
        return df if days is None else df.where(F.col("date").isin(sorted(days)))
    wanted = sorted(current.keys() if days is None else current.keys() & set(days))
    if not wanted:
        return spark.createDataFrame([], STORED_METRICS).select(*cols)
    def read(days: list[_dt.date], leaf: Callable[[_dt.date], str]) -> DataFrame:
        folders = [f"{top}/date={d.isoformat()}/{leaf(d)}" for d in days]
        return spark.read.schema(STORED_METRICS).option("basePath", top).parquet(*folders).select(*cols)

    versioned, plain = [d for d in wanted if current[d]], [d for d in wanted if not current[d]]
    parts = [read(versioned, lambda d: f"v={current[d]}")] if versioned else []
    parts += [read(plain, lambda d: "*.parquet")] if plain else []
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def by_day(metrics: DataFrame) -> DataFrame:
    """Rows dealt as they are written: a grouping by day and more needs no other exchange."""
    # One task, hence one file, per day. Safe from skew: a day holds at most
    # one metric row per (restaurant, country), a bound set by the dimension
    # sizes, not by the order volume. The partition count is explicit, so
    # adaptive execution keeps the days on parallel tasks even for a small
    # run (instead of coalescing every day into one task).
    n = int(metrics.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return metrics.repartition(n, "date")


def begin(spark: SparkSession, path: str) -> int:
    """The next version; what runs that never committed have left is removed."""
    top = last_commit(spark, path)
    fs, make = _files(spark, path)
    for day, own in _versions(spark, path).items():
        for v in own:
            if v > (top or 0):
                fs.delete(make(f"{path.rstrip('/')}/date={day.isoformat()}/v={v}"), True)
    return (top or 0) + 1


def write_version(rows: DataFrame, path: str, version: int, observed: Observation | None = None, metrics: Sequence[Column] = ()) -> None:
    """Writes rows dealt ``by_day`` (columns of ``STORED_METRICS``, and ``_keep``: whether to write it) as a version, uncommitted.

    The metrics are observed in the stage that writes, behind the last shuffle, so each row
    counts once even if an executor is lost.
    """
    laid = rows if observed is None else rows.observe(observed, *metrics)
    (
        laid.where("_keep").select(*STORED_COLS, F.lit(version).cast("long").alias("v"))
        .sortWithinPartitions("date", "v", "restaurant_id", "country")
        .write.mode("append").partitionBy("date", "v").parquet(path)
    )


def commit(spark: SparkSession, path: str, version: int, touched: Iterable[_dt.date] | None = None) -> None:
    """Lets a version count. ``touched`` days (None: all) that it doesn't hold are dropped."""
    top = path.rstrip("/")
    fs, make = _files(spark, path)
    before, stored = current_days(spark, path) or {}, _versions(spark, path)
    fs.create(make(f"{top}/_commits/{version}"), False).close()  # fails if another run has committed it
    for name in _names(spark, f"{top}/_commits/*"):
        if int(name.rsplit("/", 1)[1]) < version:
            fs.delete(make(name), False)
    gone = set(stored) if touched is None else set(touched)
    for day, own in stored.items():
        folder = f"{top}/date={day.isoformat()}"
        if version in own:
            for v in own:
                if 0 < v < version and v != before.get(day):
                    fs.delete(make(f"{folder}/v={v}"), True)
                if v == 0 and before.get(day, 0) != 0:
                    for file in _names(spark, f"{folder}/*.parquet"):
                        fs.delete(make(file), False)
        elif day in gone:
            fs.delete(make(folder), True)


def replace_days(metrics: DataFrame, path: str, run_at: _dt.datetime, touched: Iterable[_dt.date] = ()) -> None:
    """Replace the days present in ``metrics`` and drop those of ``touched`` that aren't (others stay)."""
    spark = metrics.sparkSession
    version = begin(spark, path)
    write_version(by_day(metrics).withColumns({"last_updated_at": ts_ntz(run_at), "_keep": F.lit(True)}), path, version)
    commit(spark, path, version, touched)


def stored_days(spark: SparkSession, path: str) -> list[_dt.date]:
    """Days that the table holds (bounded by the calendar; a listing of folders)."""
    return sorted(current_days(spark, path) or _versions(spark, path))
