"""Session settings and the place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the joins in this package rely on; all may be set on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot name, owner or parent may hold a third of all rows. Splitting its
    # partition is worth an extra exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A generated method over 8,000 bytes is never compiled by the JVM; operators
    # that would need one run as methods of their own.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive-execution settings to a session someone else made."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "stewardry", cpus: int | str = "*") -> SparkSession:
    """A local session for tests and the benchmark."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master, where driver and
    executors share one machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    active = context.getCheckpointDir()
    if active:
        return active
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="stewardry-")


def stage(rows: DataFrame) -> DataFrame:
    """Write ``rows`` to reliable storage and go on from there.

    The result survives the loss of executors, and nothing upstream is
    computed again.
    """
    _checkpoint_folder(rows.sparkSession)
    return rows.checkpoint(eager=True)


def stage_table(rows: DataFrame) -> DataFrame:
    """:func:`stage` for wide rows: as Parquet, of which each reader takes the
    columns it needs."""
    spark = rows.sparkSession
    path = f"{_checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _checkpoint_folder(spark: SparkSession) -> str:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return spark.sparkContext.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def close(spark: SparkSession) -> None:
    """Remove what :func:`stage` and :func:`stage_table` have written in this application.

    The last step of a load, once its results are written: tables that were
    staged can't be read any more, and new ones can be staged.
    """
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        remove(spark, folder)
