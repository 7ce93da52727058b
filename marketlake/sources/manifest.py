"""File manifest (S2): recursive listing below ``base/<item>/...``.

Uses the ``binaryFile`` source with the content column pruned, so only file
metadata is read - listing is distributed by Spark's file index.
Output: layer, item, subitem, path, size_bytes, size_mb, mtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = ("layer string, item string, subitem string, path string, size_bytes bigint, "
                   "size_mb double, mtime timestamp")


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MANIFEST_SCHEMA)


def scan_manifest(spark: SparkSession, base: str, layer: str = "", suffix: str = ".parquet") -> DataFrame:
    """Missing base -> empty frame with the fixed columns."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return empty_manifest(spark)  # any other failure to look rises
    raw = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
           .option("pathGlobFilter", f"*{suffix}").load(base))
    return manifest_from_paths(raw.select("path", "length", "modificationTime"), base, layer, suffix)


def manifest_from_paths(df: DataFrame, base: str, layer: str, suffix: str) -> DataFrame:
    root = base.rstrip("/").split("://", 1)[-1]
    rel = F.substring_index(F.col("path"), root + "/", -1)
    item = F.regexp_extract(rel, r"^([^/]+)/", 1)
    stem = F.regexp_extract(F.regexp_extract(F.col("path"), r"([^/]+)$", 1), r"^(.*?)" + _esc(suffix) + "$", 1)
    return (df.select(F.lit(layer).alias("layer"), item.alias("item"), stem.alias("subitem"), "path",
                      F.col("length").alias("size_bytes"),
                      (F.col("length") / F.lit(1024 * 1024)).alias("size_mb"),
                      F.col("modificationTime").cast("timestamp").alias("mtime"))
              .where(F.col("item") != ""))


def _esc(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in s)
