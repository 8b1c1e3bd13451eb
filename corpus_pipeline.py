"""From raw documents to token shards: the operators of ``tallyframe.llm`` in a row.

Every stage takes the documents that the stage before has kept, and all but the last give documents again, with
the columns of the table. Stages hand over Parquet tables in the shared folder, so a lost executor
costs no finished stage.

Rows without a value are documents too: a null text is empty, a null source is a source, a null id sorts
last. A table without rows passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontamination, mixing, neardup, quality, tokens
from tallyframe.llm.common import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return quality.classify(docs, "text").where(F.col("quality") >= quality.KEEP).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, 80% alike."""
    return neardup.keep_one(docs, "doc_id", "text", shingle=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    found = decontamination.find_contamination(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.where(F.col("n_hit") == 0).select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once, or twice."""
    mixed = mixing.mix(docs, "source", mixing.word_count(docs["text"]), docs.columns)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).select("row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, read back: one row per document taken."""
    return tokens.op5_token_planes(spark, sf_dir, docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: A trained classifier and a tokenizer have no SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
