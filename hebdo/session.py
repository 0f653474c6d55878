"""Session defaults for the weekly-count jobs.

On a cluster the session comes from the launcher; ``build_session`` is for
tests, benches and local runs.  ``checkpoint_dir`` honours a cluster-provided
``spark.checkpoint.dir`` and only falls back to a scratch folder when none is
set (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on: UTC so that date casts of instants are
# stable, ANSI so bad casts fail loudly unless a try_* form is used, AQE for
# partition coalescing and skew splitting at run time.  Broadcasts are never
# chosen from plan-time size estimates (static threshold off); AQE may still
# turn a join into a broadcast from the measured size of a finished shuffle
# stage, and the library broadcasts explicitly only behind a row-count check.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hebdo", extra: dict | None = None,
                  partition_bytes: str | None = None) -> SparkSession:
    """Session with ``SESSION_DEFAULTS``.  ``partition_bytes`` (e.g. "256m")
    sizes both scan splits and AQE's post-shuffle partitions, so every task's
    input fits executor memory without spilling at any scale."""
    builder = SparkSession.builder.appName(app_name)
    if partition_bytes:
        builder = (builder.config("spark.sql.files.maxPartitionBytes", partition_bytes)
                   .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", partition_bytes))
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, SESSION_DEFAULTS[key])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the context's, else ``spark.checkpoint.dir``
    from the session.  When neither is set, a session with a local master (tests,
    local runs) gets a fresh local folder and any other raises: executors of a
    cluster could not read each other's checkpoints there."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif not re.match(r"local(\[[^\]]*\])?$", getattr(sc, "master", "local")):
        raise RuntimeError("set spark.checkpoint.dir (or --checkpoint-dir) to a folder that all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="hebdo-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    Used for small aggregated results that are read more than once (e.g. the
    weekly series, scanned for its latest week and then filtered), so the
    large upstream plan runs once and survives executor loss.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder; its maker removes it with ``remove_folder``."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller made, with the file system that holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
