"""Cleaned-table scan (S3) with entity / date-range slicing pushed to the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import bucket_key


def read_cleaned(spark: SparkSession, path: str, codes: Sequence[str] | None = None, start=None, end=None,
                 bucket_mode: str | None = None, code_col: str = "code", date_col: str = "date") -> DataFrame:
    """Scan a bucketed table.  The date range is also turned into a bucket
    range (bucket keys sort like their dates), so whole partitions are pruned
    and the rest of the predicate is pushed into the Parquet reader."""
    df = spark.read.parquet(path)
    if "bucket" in df.columns:
        df = df.withColumn("bucket", F.col("bucket").cast("string"))
    cond = F.lit(True)
    if bucket_mode and bucket_mode != "all":
        if start is not None:
            cond = cond & (F.col("bucket") >= bucket_key(F.to_date(F.lit(start)), bucket_mode))
        if end is not None:
            cond = cond & (F.col("bucket") <= bucket_key(F.to_date(F.lit(end)), bucket_mode))
    if codes is not None:
        cond = cond & F.col(code_col).isin(list(codes))
    if start is not None:
        cond = cond & (F.col(date_col) >= F.to_date(F.lit(start)))
    if end is not None:
        cond = cond & (F.col(date_col) <= F.to_date(F.lit(end)))
    return df.where(cond)
