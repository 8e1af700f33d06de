"""One query per operator of this folder, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.llm import (
    decontaminate,
    hard_negatives,
    jaccard_join,
    merkle,
    mixing,
    packing,
    quality_cnn,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    warc,
)
from stewardry.llm.staging import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(prepare(spark), sf_dir)

    QUERIES[run.__name__] = prepared
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_quality_rules(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "source")
    judged = quality_rules.judge(documents, keep_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op6_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"), tokenizer_file(), 1024)


@query
def op9_source_mix(spark, sf):
    return mixing.mixed(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_token_files(spark, sf):
    return token_files.write_and_read(spark, table(spark, sf, "documents"), tokenizer_file(), end_id=2)


@query
def op1_warc_chunks(spark, sf):
    records = warc.write_and_read(spark, table(spark, sf, "pages"))
    return records.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


@query
def op5_substring_dedup(spark, sf):
    return substring_dedup.remove_repeats(table(spark, sf, "documents"))


@query
def op3_jaccard_join(spark, sf):
    joined = jaccard_join.join_similar(table(spark, sf, "documents"))
    return joined.select(F.col("doc").alias("doc_id"), "class_id", "n_copies", "n_links")


@query
def op2_decontamination(spark, sf):
    return decontaminate.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op10_suffix_dedup(spark, sf):
    return suffix_dedup.remove_repeats(table(spark, sf, "documents"))


@query
def op8_quality_cnn(spark, sf):
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    examples, counts = quality_cnn.sample(documents, labels, fold != 2, "text", "doc_id", "quality")
    scored = quality_cnn.score(documents, quality_cnn.fit(examples, counts))
    return scored.select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op11_best_fit_packing(spark, sf):
    return packing.pack_documents(spark, table(spark, sf, "documents"), tokenizer_file("word_bpe_49k.json"))


@query
def op12_hard_negatives(spark, sf):
    rows = table(spark, sf, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark, rows.withColumn("label", noisy), F.col("vec_id") % 50 == 0)


@query
def op13_merkle_manifest(spark, sf):
    named = [merkle.field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.digest(*named, merkle.field(F.col("text")))
    lowered = merkle.digest(*named, merkle.field(merkle.lower_ascii(F.col("text"))))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    proven = merkle.manifest(table(spark, sf, "documents"), "doc_id", "lang", leaf, F.when(tampered, lowered).otherwise(leaf))
    return proven.drop("lang")
