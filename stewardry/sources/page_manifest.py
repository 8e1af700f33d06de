"""A manifest of list documents, and lists packed into few files.

A catalog list may come as a hundred thousand small files. The manifest tells each
file's page and size without opening it, and the pages that aren't there. With it a
list is packed once into files of about equal size, in page order, so that later
loads read few large files in tasks of equal weight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.operators.ordering import running_total
from stewardry.session import stage
from stewardry.sources.snapshots import page_number, read_documents

HELD, REPEATED, MISSING = "held", "repeated", "missing"
TASK_BYTES = 64 << 20


def manifest(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``page, path, bytes, task, status`` of every file, and a row for every page
    number between the first and the last that no file has.

    ``task`` numbers runs of about ``task_bytes`` in page order; a file is never cut.
    Of several files of one page all are told as repeated. No file is opened.
    """
    listed = spark.read.format("binaryFile").load(path)
    page = F.col("page").cast("long") if "page" in listed.columns else page_number(F.col("path"))
    files = stage(listed.select(page.alias("page"), "path", F.col("length").alias("bytes")))
    placed = running_total(files, [], [F.col("page"), F.col("path")], F.col("bytes"), "_before")
    counts = files.groupBy(F.col("page").alias("_page")).agg(F.count(F.lit(1)).alias("_files"))
    placed = placed.join(counts, F.col("page") == F.col("_page")).select(
        "page",
        "path",
        "bytes",
        F.floor(F.col("_before") / task_bytes).alias("task"),
        F.when(F.col("_files") > 1, REPEATED).otherwise(HELD).alias("status"),
    )
    first, last = files.agg(F.min("page"), F.max("page")).first()
    numbers = spark.range(0) if first is None else spark.range(first, last + 1)
    absent = numbers.join(counts, F.col("id") == F.col("_page"), "left_anti")
    none = F.lit(None)
    return placed.unionByName(
        absent.select(
            F.col("id").alias("page"),
            none.cast("string").alias("path"),
            none.cast("long").alias("bytes"),
            none.cast("long").alias("task"),
            F.lit(MISSING).alias("status"),
        )
    )


def pack(spark: SparkSession, path: str, out: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Write the documents under ``path`` to Parquet files of about ``task_bytes`` of
    text, in page order within a file; the written table, as ``document, page``.

    Every document is read once, by the scan that reads many files in one task; the
    manifest's ``task`` of its page says which file it goes to.
    """
    told = manifest(spark, path, task_bytes).where(F.col("status") != MISSING)
    tasks = told.groupBy(F.col("page").alias("_page")).agg(F.min("task").alias("task"))
    documents = read_documents(spark, path).join(tasks, F.col("page") == F.col("_page")).drop("_page")
    n = tasks.agg(F.coalesce(F.max("task"), F.lit(0))).first()[0] + 1
    dealt = documents.repartitionByRange(n, "task").sortWithinPartitions("task", "page")
    dealt.select("document", "page").write.mode("errorifexists").parquet(out)
    return spark.read.parquet(out)
