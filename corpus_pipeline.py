"""From raw documents to training shards: each stage works on what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.  A
stage's result is written as Parquet to the shared folder and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lociweave.llm.decontamination import decontaminate
from lociweave.llm.jaccard_join import one_of_each
from lociweave.llm.mixing import mixed
from lociweave.llm.quality import keep_good
from lociweave.llm.token_shards import write_shards
from lociweave.storage import read_table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of every group linked by five-word shingles at a Jaccard similarity of 0.8."""
    return one_of_each(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word benchmark window occurs."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture; sources below their target weight come again in later epochs."""
    return mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard files of token ids in a permuted training order; one row a sequence.

    Texts are joined in the order of the mixture, which is that of the files which the stage before wrote.
    """
    return write_shards(docs, order="files" if docs.inputFiles() else "content")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_output),
]
#: SQL can express neither the classifier nor the permutation; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.partition(" ")[0])
    return STAGES[-1][1](spark, docs, sf_dir)
