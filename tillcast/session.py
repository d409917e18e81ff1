"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins and coalesces small
# shuffles at runtime, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tillcast", extra: dict | None = None) -> SparkSession:
    """Return a session; local test defaults when no master is configured."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system). Only when it is unset and the master is local (tests) is a
    fresh scratch folder made and registered; on a cluster a machine-local
    folder would not be seen by the other nodes, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        path = tempfile.mkdtemp(prefix="tillcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context.

    Python closures name its modules; a zip added by ``addPyFile`` makes them
    importable in every worker, wherever the driver was started.
    """
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_tillcast_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tillcast-ship-")) / "tillcast_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    sc.addPyFile(str(target))
    sc._tillcast_shipped = True


def reliable_checkpoint(df):
    """``df.checkpoint()`` (eager, reliable) into the session's shared folder.

    Works with any session: the checkpoint folder is taken from
    ``spark.checkpoint.dir`` and only created when the session has none.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


# Upper bound for an explicit broadcast hint; above it the join is left to the
# planner (sort-merge / shuffled hash) and to AQE's runtime conversion.
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def checked_broadcast(df, max_bytes: int | None = None, measure_row_bytes: int | None = None):
    """``F.broadcast(df)`` only when ``df`` is known to be at most ``max_bytes``
    (session conf ``tillcast.broadcast.maxBytes``, else 256 MiB); otherwise
    ``df`` unchanged, so a side that outgrows the bound falls back to a
    shuffle join instead of overloading the driver and every executor.

    The size is the optimizer's estimate. Where that estimate cannot see a
    structural bound (a small table aggregated out of a large one), pass
    ``measure_row_bytes``: the side is then checkpointed into the shared
    folder, its rows counted (a pass over the checkpoint only), and
    ``rows * measure_row_bytes`` decides; the join reads the checkpoint.
    """
    from pyspark.sql import functions as F

    if max_bytes is None:
        max_bytes = int(df.sparkSession.conf.get("tillcast.broadcast.maxBytes", str(BROADCAST_MAX_BYTES)))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > max_bytes and measure_row_bytes is not None:
        df = reliable_checkpoint(df)
        size = df.count() * measure_row_bytes
    return F.broadcast(df) if size <= max_bytes else df
