"""The operators' queries over the whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm import sql
from lociweave.llm.decontamination import find_benchmark
from lociweave.llm.exact_dedup import exact_dedup
from lociweave.llm.jaccard_join import near_duplicate_components
from lociweave.llm.licences import scan_documents
from lociweave.llm.line_dedup import dedup_lines
from lociweave.llm.mixing import mix_sources
from lociweave.llm.quality import score_documents
from lociweave.llm.sharding import shard_documents
from lociweave.llm.substring_dedup import remove_repeats
from lociweave.llm.token_shards import write_shards
from lociweave.llm.tokenizer_alignment import align_documents
from lociweave.llm.vector_codes import encode_vectors
from lociweave.llm.warc import archive_pages
from lociweave.storage import read_table


def _sha(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", _sha("text").alias("kept_sha256"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(read_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_shards(read_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read_table(spark, sf_dir, "pages"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_components(read_table(spark, sf_dir, "documents"), words=4, percent=85)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(read_table(spark, sf_dir, "documents"), window=50)
    return cut.select("doc_id", "n_words", "n_removed", _sha("kept_text").alias("kept_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_vectors(read_table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [op1_line_dedup, op2_quality_classifier, op3_license_scan, op4_exact_dedup, op5_token_shards, op6_warc, op7_ngram_jaccard_join, op8_source_mixing, op9_decontamination, op10_sharding]
    made += [op11_tokenizer_alignment, op12_substring_dedup, op13_vector_codes]
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": sql.LINE_DEDUP,
        "op4_exact_dedup": sql.EXACT_DEDUP,
        "op6_warc": sql.WARC,
        "op9_decontamination": sql.DECONTAMINATION,
        "op12_substring_dedup": sql.SUBSTRING_DEDUP,
        "op13_vector_codes": sql.VECTOR_CODES,
    }
