"""Tables and files between two steps, kept where all executors reach them."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import stewardry
from pyspark.sql import DataFrame, SparkSession
from stewardry.session import remove, shared_folder, tune

# Rows handed to Python at once. Texts may be long, so batches are kept small.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on; ships the package where workers lack it."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(stewardry.__file__).resolve().parents[1])
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in [*known, os.path.realpath(os.getcwd())]:
        _ship(spark, root)
    return spark


_shipped: set[str] = set()


def _ship(spark: SparkSession, root: str) -> None:
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    _shipped.add(application)
    package = Path(root, stewardry.__name__)
    archive = Path(tempfile.mkdtemp(prefix="stewardry-"), "stewardry.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))


_made: dict[str, list[str]] = {}


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, below the folder of ``spark.checkpoint.dir``."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def made(spark: SparkSession) -> list[str]:
    """The folders made here by this application so far."""
    return list(_made.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Remove folders made here by this application: all, or the given ones.

    Archives and shards are among them. Results read these folders when they
    run, so write results elsewhere first.
    """
    own = _made.get(spark.sparkContext.applicationId, [])
    for path in made(spark) if folders is None else folders:
        if path in own:
            own.remove(path)
            remove(spark, path)


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` as Parquet to the shared folder and go on from the files.

    Lineage ends there, so a lost executor costs a read and nothing upstream.
    """
    path = run_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def hidden(documents: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows under names that no added column has, and those names."""
    names = {c: f"_given{i}" for i, c in enumerate(documents.columns)}
    return documents.toDF(*names.values()), names


def file_system(uri: str):
    """The store of ``uri`` for tasks that write bytes: ``(store, path)``."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


