"""Warehouse health: freshness, reconciliation, coverage and error statistics
(D2, D4, D5, L5, P8, N8-N10, A1-A10, J4-J7, J10, T1-T3, U6).

Inputs are manifests ``(layer, item, subitem, path, size_bytes|size_mb, mtime)``
from ``sources.manifest`` (or any frame of that shape).  All summaries are
group-bys with conditional counts; the catalogue side is configuration and
is the only side that gets broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S

RELATIONS = ("both", "source_only", "cleaned_only", "none")
STATUSES = (S.STATUS_OK, S.STATUS_LAGGING, S.STATUS_STALE)
SUMMARY_COLS = ["n_subitems", "n_files", "min_mtime", "max_mtime", "max_days_lag", "n_ok", "n_lagging", "n_stale"]


# L5 ----------------------------------------------------------------------
def is_schema_path(path: Column | str) -> Column:
    """'schema' in the lower-cased file stem, or a path part equal to 'schema'."""
    p = F.col(path) if isinstance(path, str) else path
    name = F.regexp_extract(p, r"([^/]+)$", 1)
    stem = F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1)
    return F.lower(stem).contains("schema") | F.array_contains(F.split(p, "/"), "schema")


# D4 ----------------------------------------------------------------------
def with_freshness(manifest: DataFrame, today, ok_days: int = S.DEFAULT_OK_DAYS,
                   warn_days: int = S.DEFAULT_WARN_DAYS, detect_schema: bool = True) -> DataFrame:
    """Adds is_schema, file_role, days_lag, status."""
    schema = is_schema_path("path") if detect_schema else F.lit(False)
    out = manifest.withColumn("is_schema", schema)
    out = out.withColumn("file_role", F.when(F.col("is_schema"), F.lit("schema")).otherwise(F.lit("data")))
    out = out.withColumn("days_lag", S.days_lag(F.col("mtime"), today))
    return out.withColumn("status", S.status_by_lag(F.col("days_lag"), ok_days, warn_days))


# A1 / A2 / A3 / A8 ----------------------------------------------------------
def _summary_aggs(of: Column | None = None) -> list[Column]:
    """The summary columns over the rows that fit ``of`` (default: all)."""
    of = F.lit(True) if of is None else of

    def own(c: str) -> Column:
        return F.when(of, F.col(c))
    return [F.countDistinct(own("subitem")).alias("n_subitems"), F.count(own("path")).alias("n_files"),
            F.to_date(F.min(own("mtime"))).alias("min_mtime"), F.to_date(F.max(own("mtime"))).alias("max_mtime"),
            F.max(own("days_lag")).alias("max_days_lag"),
            *[F.count_if(of & (F.col("status") == x)).alias(f"n_{x.lower()}") for x in STATUSES]]


def summarize_source_by_item(detail: DataFrame) -> DataFrame:
    """A1: per item: distinct sub-items, files, min/max mtime (date), max lag, status counts."""
    return detail.where(F.col("item").isNotNull()).groupBy("item").agg(*_summary_aggs())


def _cleaned_aggs() -> list[Column]:
    schema = F.col("is_schema")
    return [*_summary_aggs(~schema), F.count(F.when(schema, F.col("path"))).alias("n_schema_files"),
            (F.count_if(~schema) > 0).alias("_data")]


def _cleaned_items(per: DataFrame) -> DataFrame:
    any_data = F.max("_data").over(Window.partitionBy(F.lit(1)))  # one row an item
    return (per.withColumn("_any", any_data).where("_data or not _any").drop("_data", "_any")
            .withColumn("has_schema", F.col("n_schema_files") > 0))


def summarize_cleaned_by_item(detail: DataFrame) -> DataFrame:
    """A2: as A1 over data files plus n_schema_files / has_schema.

    Items holding only schema files appear only when no data file exists at
    all (then with zero counts); that is decided on the rows per item."""
    return _cleaned_items(detail.where(F.col("item").isNotNull()).groupBy("item").agg(*_cleaned_aggs()))


def item_rows(source_detail: DataFrame, cleaned_detail: DataFrame) -> DataFrame:
    """One aggregate over both manifests: a row per (layer, item) from which A1, A2 and A8 follow."""
    cols = ["item", "subitem", "path", "mtime", "days_lag", "status", "is_schema"]
    # schema files are told apart on the cleaned side only
    both = source_detail.select(*cols[:-1], F.lit(False).alias("is_schema"), F.lit("source").alias("side")).unionByName(
        cleaned_detail.select(*cols, F.lit("cleaned").alias("side")))
    return both.where(F.col("item").isNotNull()).groupBy("side", "item").agg(*_cleaned_aggs())


def summaries_of(items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(source summary, cleaned summary, schema files by item) of ``item_rows``."""
    cleaned = items.where("side = 'cleaned'").drop("side")
    return (items.where("side = 'source'").drop("side", "n_schema_files", "_data"), _cleaned_items(cleaned),
            cleaned.where("n_schema_files > 0").select("item", "n_schema_files"))


def schema_count_by_item(detail: DataFrame) -> DataFrame:
    """A8."""
    return detail.where(F.col("is_schema") & F.col("item").isNotNull()) \
                 .groupBy("item").agg(F.count("path").alias("n_schema_files"))


def status_counts(detail: DataFrame) -> DataFrame:
    """A3: (item, OK, LAGGING, STALE) counts, zero-filled."""
    return (detail.where(F.col("item").isNotNull()).groupBy("item").pivot("status", list(STATUSES))
                  .agg(F.count("path")).fillna(0, subset=list(STATUSES)))


# J4 / P8 ---------------------------------------------------------------------
_SIDE_COLS = ["path", "size_mb", "mtime", "days_lag", "status"]


def assert_unique_pairs(df: DataFrame, keys: Sequence[str] = ("item", "subitem"), side: str = "") -> None:
    dup = df.groupBy(*keys).count().where("count > 1")
    if not dup.isEmpty():
        raise ValueError(f"{side} files are not unique on {list(keys)}")


def merge_source_cleaned(source_detail: DataFrame, cleaned_detail: DataFrame, validate: bool = True) -> DataFrame:
    """1:1 full outer reconciliation on (item, subitem), data files only.

    relation: both / source_only / cleaned_only / none; mtime_diff_days =
    cleaned - source in fractional days."""
    src = source_detail.where(F.col("file_role") != "schema")
    cln = cleaned_detail.where(F.col("file_role") != "schema")
    if validate:
        assert_unique_pairs(src, side="source")
        assert_unique_pairs(cln, side="cleaned")
    s2 = src.select("item", "subitem", *[F.col(c).alias(f"source_{c}") for c in _SIDE_COLS])
    c2 = cln.select("item", "subitem", *[F.col(c).alias(f"cleaned_{c}") for c in _SIDE_COLS])
    m = s2.join(c2, ["item", "subitem"], "full_outer")
    has_src = F.coalesce(F.col("source_path") != "", F.lit(False))
    has_cln = F.coalesce(F.col("cleaned_path") != "", F.lit(False))
    rel = (F.when(has_src & has_cln, F.lit("both")).when(has_src, F.lit("source_only"))
            .when(has_cln, F.lit("cleaned_only")).otherwise(F.lit("none")))
    return m.withColumn("relation", rel).withColumn(
        "mtime_diff_days", S.fractional_days(F.col("cleaned_mtime"), F.col("source_mtime")))


# J5 / D5 ---------------------------------------------------------------------
def find_missing_cleaned(relation_status: DataFrame) -> DataFrame:
    return relation_status.where(F.col("relation") == "source_only")


def find_orphan_cleaned(relation_status: DataFrame) -> DataFrame:
    return relation_status.where(F.col("relation") == "cleaned_only")


def prune_plan(relation_status: DataFrame) -> DataFrame:
    """The cleaned files a prune would delete (plan only, nothing deleted)."""
    return find_orphan_cleaned(relation_status).select("item", "subitem", "cleaned_path")


# J6 -------------------------------------------------------------------------
def split_orphan_pairs_by_item(relation_status: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orphan_true, orphan_all): cleaned-only pairs flagged by whether their
    item has any source file at all."""
    items_src = (relation_status.where(F.coalesce(F.col("source_path") != "", F.lit(False)))
                 .select("item").distinct().withColumn("has_source_for_item", F.lit(True)))
    orphan_all = (find_orphan_cleaned(relation_status).join(items_src, "item", "left")
                  .withColumn("has_source_for_item", F.coalesce("has_source_for_item", F.lit(False))))
    return orphan_all.where(~F.col("has_source_for_item")), orphan_all


# A4 -------------------------------------------------------------------------
def relation_counts(relation_status: DataFrame) -> DataFrame:
    return (relation_status.where(F.col("item").isNotNull()).groupBy("item")
            .pivot("relation", list(RELATIONS)).count().fillna(0, subset=list(RELATIONS)))


# J7 / U6 / A5 / A10 -----------------------------------------------------------
def _prefixed(summary: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return summary.select("item", *[F.col(c).alias(f"{prefix}_{c}") for c in SUMMARY_COLS],
                          *[F.col(c) for c in keep])


def expected_item_status(expected: DataFrame, source_summary: DataFrame, cleaned_summary: DataFrame) -> DataFrame:
    """Catalogue ⟕ source summary ⟕ cleaned summary, with has_/missing_ flags."""
    src = _prefixed(source_summary, "source")
    cln = _prefixed(cleaned_summary, "cleaned").join(
        cleaned_summary.select("item", F.col("n_schema_files").alias("cleaned_n_schema_files"), "has_schema"), "item")
    out = expected.join(src, "item", "left").join(cln, "item", "left")
    return (out.withColumn("has_source", F.coalesce(F.col("source_n_files"), F.lit(0)) > 0)
               .withColumn("has_cleaned", F.coalesce(F.col("cleaned_n_files"), F.lit(0)) > 0)
               .withColumn("missing_source", ~F.col("has_source"))
               .withColumn("missing_cleaned", ~F.col("has_cleaned"))
               .withColumn("has_schema", F.coalesce(F.col("has_schema"), F.lit(False)))
               .withColumn("missing_schema", ~F.col("has_schema")))


def unexpected_items(expected: DataFrame, source_summary: DataFrame, cleaned_summary: DataFrame) -> DataFrame:
    """Items seen in source or cleaned but not in the catalogue."""
    s = source_summary.select("item", F.lit(True).alias("in_source"))
    c = cleaned_summary.select("item", F.lit(True).alias("in_cleaned"))
    seen = s.join(c, "item", "full_outer")
    return (seen.join(expected.select("item"), "item", "left_anti")
                .select("item", F.coalesce("in_source", F.lit(False)).alias("in_source"),
                        F.coalesce("in_cleaned", F.lit(False)).alias("in_cleaned")))


def item_kpis(source_detail: DataFrame, cleaned_detail: DataFrame) -> DataFrame:
    """One row per item: files and reconciled pairs of both layers (one scan of each manifest).

    Both manifests are reduced together, first per (item, sub-item), then per
    item.  Data files are unique per pair, as J4 demands; NULL keys match nothing.
    """
    def side(detail: DataFrame, layer: str) -> DataFrame:
        data = F.col("file_role") != "schema"
        return detail.select(
            "item", "subitem", F.lit(layer).alias("layer"), data.alias("data"), F.col("path").isNotNull().alias("named"),
            F.coalesce(data & (F.col("path") != ""), F.lit(False)).alias("there"))
    both = side(source_detail, "source").unionByName(side(cleaned_detail, "cleaned"))
    alone = F.when(F.col("item").isNull() | F.col("subitem").isNull(), F.col("layer"))
    src, cln = F.col("layer") == "source", F.col("layer") == "cleaned"
    pairs = both.groupBy("item", "subitem", alone.alias("alone")).agg(
        F.count_if(src).alias("source_rows"), F.count_if(cln).alias("cleaned_rows"),
        F.count_if(src & F.col("named")).alias("source_files"),
        F.count_if(cln & F.col("data")).alias("data_rows"),
        F.count_if(cln & F.col("data") & F.col("named")).alias("data_files"),
        F.count_if(cln & ~F.col("data") & F.col("named")).alias("schema_files"),
        F.count_if(cln & ~F.col("data")).alias("schema_rows"),
        F.max("data").alias("is_pair"), F.max(src & F.col("there")).alias("in_src"), F.max(cln & F.col("there")).alias("in_cln"))
    sums = ("source_rows", "cleaned_rows", "source_files", "data_rows", "data_files", "schema_files", "schema_rows")
    return pairs.groupBy("item").agg(
        *[F.sum(c).alias(c) for c in sums], F.count_if("is_pair").alias("pairs"),
        F.count_if("in_src").alias("pairs_source"), F.count_if("in_cln").alias("pairs_cleaned"),
        F.count_if(F.col("in_src") & F.col("in_cln")).alias("pairs_both"),
        F.count_if(F.col("in_src") & ~F.col("in_cln")).alias("pairs_source_only"),
        F.count_if(~F.col("in_src") & F.col("in_cln")).alias("pairs_cleaned_only"))


def overall_summary(today, source_detail: DataFrame, cleaned_detail: DataFrame,
                    expected: DataFrame | None = None) -> DataFrame:
    """A5: one KPI row, derived from one row per item; ``expected`` (catalogue) adds the coverage columns."""
    items = item_kpis(source_detail, cleaned_detail)
    if expected is not None:
        items = items.join(expected.select("item", F.lit(True).alias("listed")), "item", "full_outer")
    known = F.col("item").isNotNull()
    with_data, with_schema = (F.coalesce(known & (F.col(c) > 0), F.lit(False)) for c in ("data_rows", "schema_rows"))

    def count_cleaned(count) -> Column:
        """Items that hold schema files only count where no item has a data file (A2)."""
        return F.when(F.max(with_data), count(with_data)).otherwise(count(with_schema))
    orphans = F.col("pairs_cleaned_only")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    kpis = [count_cleaned(F.count_if).alias("n_items_cleaned"),
            total("source_rows").alias("n_source_files"), total("cleaned_rows").alias("n_cleaned_files"),
            total("pairs").alias("n_pairs_total"), total("pairs_source").alias("n_pairs_source"),
            total("pairs_cleaned").alias("n_pairs_cleaned"), total("pairs_both").alias("n_pairs_both"),
            total("pairs_source_only").alias("n_pairs_source_only"), total("pairs_cleaned_only").alias("n_pairs_cleaned_only"),
            total("pairs_source_only").alias("n_missing_pairs"), total(orphans).alias("n_orphan_pairs"),
            total(F.when(~known | (F.col("pairs_source") == 0), orphans)).alias("n_true_orphan_pairs")]
    if expected is not None:
        listed = F.coalesce("listed", F.lit(False))
        in_source = F.coalesce(F.col("source_files") > 0, F.lit(False))
        in_cleaned = with_data & F.coalesce(F.col("data_files") > 0, F.lit(False))
        schema = F.coalesce(F.col("schema_files") > 0, F.lit(False))
        kpis += [F.count_if(listed).alias("n_items_expected")]
        for name, flag in (("in_source", in_source), ("in_cleaned", in_cleaned), ("missing_source", ~in_source),
                           ("missing_cleaned", ~in_cleaned)):
            kpis.append(F.count_if(listed & flag).alias(f"n_items_expected_{name}"))
        kpis += [count_cleaned(lambda held: F.count_if(listed & held & schema)).alias("n_items_expected_with_schema"),
                 count_cleaned(lambda held: F.count_if(listed & ~(held & schema))).alias("n_items_expected_missing_schema"),
                 F.count_if(~listed & known & F.coalesce(F.col("source_rows") > 0, F.lit(False))).alias("n_items_unexpected_source"),
                 count_cleaned(lambda held: F.count_if(~listed & held)).alias("n_items_unexpected_cleaned")]
    return items.agg(*kpis).withColumn("as_of", today if isinstance(today, Column) else F.to_date(F.lit(str(today))))


def schema_coverage(cleaned_summary: DataFrame) -> DataFrame:
    """A10: cleaned items with / without schema files."""
    return cleaned_summary.agg(F.count(F.lit(1)).alias("n_items"),
                               F.count_if("has_schema").alias("n_items_with_schema"),
                               F.count_if(~F.col("has_schema")).alias("n_items_without_schema"))


# T1 / T2 / J10 ---------------------------------------------------------------
def top_lagging_items(summary: DataFrame, n: int = 20) -> DataFrame:
    """Items by max_days_lag descending, NULLs last (top-n report)."""
    return summary.orderBy(F.desc_nulls_last("max_days_lag"), F.asc("item")).limit(n)


def head_pairs(pairs: DataFrame, n: int = 50) -> DataFrame:
    """First n pairs in (item, subitem) order (top-n report)."""
    return pairs.orderBy("item", "subitem").limit(n)


def lag_ranking_with_backlog(summary: DataFrame, relation_status: DataFrame, n: int = 20) -> DataFrame:
    """The top lagging items with their count of source-only pairs."""
    backlog = (find_missing_cleaned(relation_status).groupBy("item")
               .agg(F.count(F.lit(1)).alias("n_source_only")))
    top = top_lagging_items(summary, n)
    return (top.join(backlog, "item", "left")
               .withColumn("n_source_only", F.coalesce("n_source_only", F.lit(0))))


# D2 / A6 / A9 -------------------------------------------------------------------
def flatten_error_log(cells: DataFrame, date_col: str = "date", item_col: str = "item",
                      errors_col: str = "errors", order_field: str | None = None) -> DataFrame:
    """(date, item, errors ARRAY<STRUCT>) -> one row per error, with the
    reason / message coalesced over the record generations (N17).  With ``order_field`` (a field of the
    records that orders the lists of a day) the rows carry ``arrival``: date, that field, place in the list."""
    kind = cells.schema[errors_col].dataType
    one = kind.elementType if isinstance(kind, T.ArrayType) else kind
    listed = F.col(errors_col) if isinstance(kind, T.ArrayType) else F.array(F.col(errors_col))
    e = cells.select(F.col(date_col).alias("date"), F.col(item_col).alias("item"), F.posexplode(listed).alias("at", "e"))
    arrival = [F.struct("date", F.col(f"e.{order_field}").alias("order"), "at").alias("arrival")] if order_field else []
    fields = set(one.fieldNames()) if isinstance(one, T.StructType) else set()  # bare values name no reason

    def f(name):
        return F.col(f"e.{name}") if name in fields else F.lit(None).cast("string")
    reason = S.first_nonblank(*[f(n) for n in S.ERROR_REASON_FIELDS], default="unknown")
    message = S.first_nonblank(*[f(n) for n in S.ERROR_MESSAGE_FIELDS], default="")
    log_time = f("log_time")
    return e.select("date", "item", reason.alias("error_reason"), message.alias("error_message"),
                    f("requeststatus").alias("requeststatus"), f("exception_type").alias("exception_type"),
                    log_time.alias("log_time"), F.to_date(log_time).alias("log_date"), *arrival)


def error_reason_stats(flat: DataFrame) -> DataFrame:
    """A6 by (reason, item), most frequent first (T3); NULL groups kept."""
    return (flat.groupBy("error_reason", "item").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "error_reason", "item"))


def error_date_stats(flat: DataFrame) -> DataFrame:
    """A6 by date, oldest first, NULL last."""
    return flat.groupBy("date").agg(F.count(F.lit(1)).alias("n_errors")).orderBy(F.asc_nulls_last("date"))


def error_item_stats(flat: DataFrame) -> DataFrame:
    """A6 by item, most errors first."""
    return flat.groupBy("item").agg(F.count(F.lit(1)).alias("n_errors")).orderBy(F.desc("n_errors"), "item")


def error_profile_by_item(flat: DataFrame, max_reasons: int = 1000) -> DataFrame:
    """Count, distinct reasons and first / last date: of the item's log dates if it has any, else of its data dates.

    Reasons stand in the order of their first arrival (by date where the rows carry no ``arrival``, equal ones
    by name); those beyond ``max_reasons``, a limit of the report, are counted in ``n_more_reasons``.  Reasons are free text:
    each (item, reason) is one row before an item's rows meet, and no more than ``max_reasons`` of them make its list.
    """
    arrival = F.col("arrival") if "arrival" in flat.columns else F.struct(F.coalesce("date", "log_date"))
    each = flat.groupBy("item", "error_reason").agg(
        F.min(arrival).alias("first"), F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{name}_{c}") for name, f in (("min", F.min), ("max", F.max)) for c in ("log_date", "date")])
    place = F.row_number().over(Window.partitionBy("item").orderBy("first", "error_reason"))
    listed = (F.col("place") <= max_reasons) & F.col("error_reason").isNotNull()
    reasons = F.array_sort(F.collect_list(F.when(listed, F.struct("place", "error_reason"))))
    return each.withColumn("place", place).groupBy("item").agg(
        F.coalesce(F.min("min_log_date"), F.min("min_date")).alias("first_date"),
        F.coalesce(F.max("max_log_date"), F.max("max_date")).alias("last_date"), F.sum("n").alias("n_errors"),
        F.transform(reasons, lambda r: r["error_reason"]).alias("reasons"),
        F.count_if(F.col("place") > max_reasons).alias("n_more_reasons"))


# A7 -------------------------------------------------------------------------
def summarize_cleaning_log(log: DataFrame | None) -> DataFrame | None:
    """Counts by (item, subitem, status) when those columns exist, else the
    log itself; no log -> None."""
    if log is None:
        return None
    if {"item", "subitem", "status"} <= set(log.columns):
        return log.groupBy("item", "subitem", "status").agg(F.count(F.lit(1)).alias("count"))
    return log
