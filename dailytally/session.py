"""Session settings and the shared work folder.

On a cluster the work folder is the shared location named by
``spark.checkpoint.dir``; it is read from the session and never replaced.
Only when it is unset (local tests, the bench) a folder is made and set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should carry. NTZ timestamps do not
# depend on the zone, but pinning it keeps any LTZ value readable.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Checkpoint files of frames no longer referenced are removed (the key
    # sets, upsert inputs and ledger slices are checkpointed).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "dailytally",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench (UI off, no server opened)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names, or None when unset."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set a scratch one only where unset."""
    d = checkpoint_dir(spark)
    if d is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="dailytally-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared folder (tables, stream checkpoints)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "dailytally", *parts, uuid.uuid4().hex])


def materialize(df):
    """Write a (small) frame once to the shared checkpoint folder and read it
    back: later actions reuse it instead of recomputing its lineage, and a
    lost executor does not force a recompute either."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
