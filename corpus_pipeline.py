"""The corpus pipeline: quality, near duplicates, benchmark decontamination, personal data, packing; each stage is one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peakledger.llm import decontaminate, packing, pii, quality, simhash
from peakledger.llm.common import fresh_folder, table
from peakledger.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; common lines are taken out of the others."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark windows are taken out; documents that are mostly benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked."""
    return pii.clean(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and places."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("simhash near duplicates", near_duplicates), ("benchmark decontamination", decontamination),
          ("personal data", personal_data), ("best-fit packing", packed)]

#: SimHash and the tokenizer have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        folder = fresh_folder(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
