"""Batch ledger (L3): the changed rows cut into consecutive pages of
``batch_size`` in (updated_at, order_id) order, with per-page row count,
last change time and number of groups touched.

The reference walks the pages in a loop. Here it is one distributed pass
and no single-partition window over the rows:

1. range-partition the rows on the total order (the unique ``order_id``
   breaks ties, so even one timestamp holding a third of all rows is spread
   over many slices) and sort inside each slice;
2. number rows inside a slice (``monotonically_increasing_id`` keeps the
   slice index in its upper bits and the position in its lower 33 bits);
3. slice sizes -> prefix offsets: a window over one row per slice, so its
   size is bounded by the slice count, not by the data, and broadcast back;
4. global position = offset + position; page = position div batch_size;
   group by page.

Steps 3 and 4 read the numbered slices twice. A range exchange samples its
input with a seed tied to the RDD id, so two executions of it may cut the
slices differently; the numbered slices are therefore written once with a
reliable ``checkpoint()`` (to the shared ``spark.checkpoint.dir``), which
also cuts the lineage and survives lost executors.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailytally.config import EPOCH, KEY_COLS
from dailytally.functions.columns import ts_ntz
from dailytally.operators.extract import changed_since
from dailytally.operators.transform import with_group_key
from dailytally.session import ensure_checkpoint_dir

_POS_BITS = 33


def number_changes(changed: DataFrame, num_slices: int | None = None) -> DataFrame:
    """Adds ``change_seq`` (0-based) = rank of each row in (updated_at, order_id)."""
    spark = changed.sparkSession
    n = num_slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    ranged = (
        changed.repartitionByRange(n, "updated_at", "order_id")
        .sortWithinPartitions("updated_at", "order_id")
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
        .withColumn("_slice", F.shiftright("_mid", _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
    )
    sizes = ranged.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        ranged.join(F.broadcast(offsets), "_slice")
        .withColumn("change_seq", F.col("_off") + F.col("_pos"))
        .drop("_mid", "_slice", "_pos", "_off")
    )


#: KLL sketch: its size parameter (about 0.1 % of rank error, some 100 KB), the
#: most cells it is asked for, and the rows a cell should hold.
SKETCH_K = 4096
MAX_CELLS = 1000
CELL_ROWS = 100_000


def _cell_of(value: Column, cuts: Column, n_cuts: int) -> Column:
    """How many of the ascending cuts lie below the value: a binary search, by column functions."""
    steps = [1 << b for b in reversed(range(n_cuts.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]) if steps else F.array().cast("array<int>"),
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at),
    )


def page_bounds(
    changed: DataFrame,
    batch_size: int,
    column: str = "updated_at",
    first: bool = False,
    cell_rows: int = CELL_ROWS,
) -> list[_dt.datetime]:
    """L4: the last change time of every page of ``batch_size`` changes, ascending
    (``first``: of the first page alone). Rows without a change time are in no page.

    Neither sorts nor stores the changes. A mergeable quantile sketch cuts the
    change times into cells of about ``cell_rows`` rows; exact counts per cell
    (one row a cell on the driver) tell in which cells pages end; only there
    are changes counted by change time and added up. The sketch decides how even the
    cells are, never the result. One value per page reaches the driver. Pages
    are the ranges between neighbouring bounds, so a run of equal stamps that
    crosses a page's end belongs whole to the first page it is in.

    ``changed`` is read three times: it must not change meanwhile.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    stamps = changed.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    micros = F.unix_micros(F.col("v").cast("timestamp"))
    ranks = F.array(*[F.lit(i / MAX_CELLS) for i in range(1, MAX_CELLS)])
    seen = stamps.agg(
        F.count("v").alias("n"), F.max("v").alias("top"), F.kll_sketch_agg_bigint(micros, F.lit(SKETCH_K)).alias("s")
    ).select("n", "top", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("s", ranks)).alias("q")).first()
    if not seen.n:
        return []
    cells = max(1, min(MAX_CELLS, seen.n // cell_rows))
    cuts = sorted({EPOCH + _dt.timedelta(microseconds=seen.q[i * MAX_CELLS // cells - 1]) for i in range(1, cells)})
    cell = _cell_of(F.col("v"), F.array(*[ts_ntz(c) for c in cuts]), len(cuts)) if cuts else F.lit(0)

    size = {r.cell: r.n for r in stamps.groupBy(cell.alias("cell")).agg(F.count("v").alias("n")).collect()}
    before, ends = [0], []
    for c in range(len(cuts) + 1):
        before.append(before[-1] + size.get(c, 0))
        if before[-1] // batch_size > before[-2] // batch_size and not (first and ends):
            ends.append(c)
    bounds = set()
    if ends:
        # A plain range, which a scan of the changes can use, and the cells in it.
        if ends[0] > 0:
            stamps = stamps.where(F.col("v") > ts_ntz(cuts[ends[0] - 1]))
        if ends[-1] < len(cuts):
            stamps = stamps.where(F.col("v") <= ts_ntz(cuts[ends[-1]]))
        counted = stamps.groupBy(cell.alias("cell"), "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("cell").isin(ends))
        upto = F.get(F.array(*[F.lit(n) for n in before]), F.col("cell")) + F.sum("n").over(Window.partitionBy("cell").orderBy("v"))
        added = counted.withColumn("upto", upto)
        last = F.col("upto") % batch_size < F.col("n")  # a multiple of the page's size is among its places
        bounds = {r.v for r in added.where(last).select("v").collect()}
    found = sorted(bounds | {seen.top})
    return found[:1] if first else found


def extract_page_bounded(
    orders: DataFrame, mark: _dt.datetime | None, batch_size: int, column: str = "updated_at"
) -> DataFrame:
    """L4: the first page, complete with every row that shares its last change
    time, as a pushed range of the change time."""
    changed = changed_since(orders, mark, column=column)
    bounds = page_bounds(changed, batch_size, column, first=True)
    return changed.where(F.col(column) <= ts_ntz(bounds[0]) if bounds else F.lit(False))


def batch_ledger(changed: DataFrame, batch_size: int, num_slices: int | None = None) -> DataFrame:
    """Per page: ``batch_no``, ``batch_rows``, ``max_updated_at``, ``batch_groups``."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    keyed = with_group_key(changed).select("order_id", "updated_at", *KEY_COLS)
    numbered = number_changes(keyed, num_slices).withColumn(
        "batch_no", F.floor(F.col("change_seq") / F.lit(batch_size)).cast("long")
    )
    # Groups per page: distinct (page, key) first, so a page never holds
    # more than batch_size rows in any task.
    per_key = numbered.groupBy("batch_no", *KEY_COLS).agg(
        F.count(F.lit(1)).alias("_rows"), F.max("updated_at").alias("_max")
    )
    return per_key.groupBy("batch_no").agg(
        F.sum("_rows").cast("long").alias("batch_rows"),
        F.max("_max").alias("max_updated_at"),
        F.count(F.lit(1)).alias("batch_groups"),
    )
