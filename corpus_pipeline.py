"""The corpus pipeline: from raw documents to token files, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again for the next one. All but the last return the columns
of the documents they get. As a stage's result is written by the time the next
stage begins, that one first removes the tables the stage before it staged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from stewardry.llm import decontaminate, jaccard_join, mixing, quality_rules, token_files
from stewardry.llm.queries import table, tokenizer_file
from stewardry.llm.staging import made, prepare, release, run_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

END_ID = 2
# SQL can't express the similarity join, the edit distance and the tokenizer.
ORACLE_SQL = None


_left: dict[str, list[str]] = {}


def clearing(stage: Stage) -> Stage:
    """A stage that removes what the stage before it left, and no more than that."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        application = spark.sparkContext.applicationId
        release(spark, _left.pop(application, []))
        before = set(made(spark))
        out = stage(spark, docs, sf_dir)
        # The last stage's files are the pipeline's product.
        if stage.__name__ != STAGES[-1][1].__name__:
            _left[application] = [p for p in made(spark) if p not in before]
        return out

    return run_stage


@clearing
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither they nor their host fail the quality rules."""
    return quality_rules.keep(docs)


@clearing
def keep_first_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the one of the least id."""
    return jaccard_join.keep_first(docs)


@clearing
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


@clearing
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, once for each epoch."""
    return mixing.take(docs)


@clearing
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: a row for each document in them."""
    return token_files.write_and_read(spark, docs, tokenizer_file(), END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("jaccard_join", keep_first_of_similar),
    ("decontamination", drop_benchmark),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
