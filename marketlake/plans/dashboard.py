"""Warehouse status bundle (D3): named frames over two manifests.

Each manifest is scanned once, into a table below the shared folder (the reference walks each
tree five times per dashboard).  One aggregate over both gives all item summaries, one join the
reconciled pairs; both are stored too, and every member is a lazy plan over these tables.
``close`` (or leaving a ``with`` block) deletes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog
from ..operators import inventory as inv
from ..operators.keyed_log import delete_folder
from ..operators.store import scratch_path


class Dashboard(dict):
    """Frames by name; they can be read until ``close``."""

    def __init__(self, spark: SparkSession):
        super().__init__()
        self.spark, self.folder = spark, scratch_path(spark, "dashboard")

    def store(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def close(self) -> None:
        self.clear()
        delete_folder(self.spark, self.folder)

    def __enter__(self) -> Dashboard:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def build_dashboard(spark: SparkSession, source_manifest: DataFrame, cleaned_manifest: DataFrame,
                    catalogue: DataFrame, today, error_cells: DataFrame | None = None,
                    item_top_n: int = 20, top_rows: int = 50, cleaning_log: DataFrame | None = None) -> Dashboard:
    def sized(m):
        return m if "size_mb" in m.columns else m.withColumn("size_mb", F.col("size_bytes") / F.lit(1024 * 1024))
    out = Dashboard(spark)
    sd = out.store("source", inv.with_freshness(sized(source_manifest), today, detect_schema=False))
    cd = out.store("cleaned", inv.with_freshness(sized(cleaned_manifest), today))
    rel = out.store("pairs", inv.merge_source_cleaned(sd, cd, validate=False))
    ssum, csum, schema_items = inv.summaries_of(out.store("items", inv.item_rows(sd, cd)))
    orphan_true, orphan_all = inv.split_orphan_pairs_by_item(rel)
    missing = inv.find_missing_cleaned(rel)
    expected = catalog.expected_items(catalogue)
    est = inv.expected_item_status(expected, ssum, csum)
    unexp = inv.unexpected_items(expected, ssum, csum)
    out.update({
        "source_detail": sd, "cleaned_detail": cd, "item_summary": csum, "relation_status": rel,
        "missing": missing, "orphan": orphan_true, "orphan_candidate": orphan_all,
        "source_item_summary": ssum, "cleaned_item_summary": csum,
        "relation_counts": inv.relation_counts(rel),
        "lag_item": csum.orderBy(F.desc_nulls_last("max_days_lag"), F.asc("item")),
        "lag_item_top": inv.top_lagging_items(csum, item_top_n),
        "missing_top": inv.head_pairs(missing, top_rows), "orphan_top": inv.head_pairs(orphan_true, top_rows),
        "schema_detail": cd.where("is_schema"), "schema_item_summary": schema_items,
        "expected_item_master": expected, "expected_item_status": est, "unexpected_items": unexp,
        "overall_summary": inv.overall_summary(today, sd, cd, expected),
    })
    out["today"] = spark.range(1).select(F.to_date(F.lit(str(today))).alias("today"))
    if cleaning_log is not None:
        out["log_summary"] = inv.summarize_cleaning_log(cleaning_log)
    if error_cells is not None:
        out["error_log"] = error_cells
        flat = inv.flatten_error_log(error_cells)
        out.update({"error_log_flat": flat, "error_reason_summary": inv.error_reason_stats(flat),
                    "error_date_summary": inv.error_date_stats(flat),
                    "error_item_summary": inv.error_item_stats(flat),
                    "error_profile": inv.error_profile_by_item(flat)})
    return out
