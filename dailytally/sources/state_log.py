"""Progress state store: an append-only Parquet log of state rows.

Every save appends one small file (one row per job id, stamped with a
sequence number); the current state is the latest row per ``pipeline_id``.
An append either lands as a whole file or not at all, so a crash never
leaves a half-written state, and nothing is ever rewritten in place.

Saves of one job id are numbered. A save first claims its number by creating the file
``_seq/<id>/<number>``, which fails where it exists: of two runs of one id that started
from the same save only one can save; the other one's mark is never written over it.
"""

from __future__ import annotations

from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailytally.operators.state import STATE_COLS
from dailytally.schemas import STATE
from dailytally.sources.metrics_table import _files, _names, read_or_empty

LOG_SCHEMA = T.StructType([*STATE.fields, T.StructField("seq", T.LongType(), False)])


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Current state: the latest logged row of every ``pipeline_id``."""
    log = read_or_empty(spark, path, LOG_SCHEMA)
    latest = log.groupBy("pipeline_id").agg(F.max_by(F.struct(*STATE_COLS), "seq").alias("s"))
    return latest.select("s.*")


def append_state(state_rows: DataFrame, path: str, seq: int) -> None:
    """Log new state rows (already computed, e.g. by ``save_state``)."""
    (
        state_rows.select(*STATE_COLS, F.lit(seq).cast("long").alias("seq"))
        .coalesce(1)  # a handful of rows: one file, one commit
        .write.mode("append")
        .parquet(path)
    )


class ConcurrentRunError(RuntimeError):
    """Another run of the same job id has saved its state meanwhile."""


def _claims(path: str, pipeline_id: str) -> str:
    return f"{path.rstrip('/')}/_seq/{quote(pipeline_id, safe='')}"


def last_seq(spark: SparkSession, path: str, pipeline_id: str) -> int:
    """The number of the id's last save (of one whose rows were lost, too)."""
    claimed = [int(n.rsplit("/", 1)[1]) for n in _names(spark, f"{_claims(path, pipeline_id)}/*")]
    if claimed:
        return max(claimed)
    # A log from before saves were claimed.
    log = read_or_empty(spark, path, LOG_SCHEMA).where(F.col("pipeline_id") == pipeline_id)
    return (log.agg(F.max("seq")).first()[0] or 0) if _names(spark, path) else 0


def claim_seq(spark: SparkSession, path: str, pipeline_id: str, seq: int) -> None:
    """Takes a number for a save; numbers before it need not be kept."""
    fs, make = _files(spark, path)
    top = _claims(path, pipeline_id)
    try:
        fs.create(make(f"{top}/{seq}"), False).close()
    except Py4JJavaError as e:
        if fs.exists(make(f"{top}/{seq}")):
            raise ConcurrentRunError(f"{pipeline_id}: save {seq} was made by another run") from e
        raise
    for name in _names(spark, f"{top}/*"):
        if int(name.rsplit("/", 1)[1]) < seq - 1:
            fs.delete(make(name), False)
