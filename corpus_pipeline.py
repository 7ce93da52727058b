"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import decontaminate, mixing, quality_rules, secrets, simhash
from marketlake.llm.shared import scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line-first cleaning; rejected documents go, failing lines of the others too."""
    return quality_rules.clean_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their share and its pieces."""
    return mixing.mixed_documents(docs)


STAGES = [("quality_rules", quality_stage), ("near_dedup", near_dedup_stage),
          ("decontamination", decontamination_stage), ("secrets", secrets_stage), ("mixing", mixing_stage)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each result is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
