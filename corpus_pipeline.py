"""The corpus pipeline: from raw documents to shards.

Each stage takes (spark, docs, folder) and works on all that its predecessor kept. What
a stage returns is written as Parquet and read again as the next one's documents. All
stages but the last return the columns of documents; the last one tells for each row of
the mix its shard.
"""

from pyspark.sql import DataFrame, SparkSession

from loadglass.llm import decontamination, line_frequency, mixing, sharding, simhash
from loadglass.llm.common import read_table, written


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rejected documents go, and so do lines that are boilerplate of their source."""
    return line_frequency.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.without_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    return decontamination.without_contaminated(docs, read_table(spark, folder, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents are repeated or left out until sources have their target weights."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each row of the mix gets its shard."""
    return sharding.assign(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# Fingerprints and the rounding of rates are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
