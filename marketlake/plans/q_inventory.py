"""Registered warehouse-health queries over the manifests F4 and the error log F6."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import catalog
from ..functions import scalars as S
from ..operators import inventory as inv
from ..operators import store as st
from ..sources.manifest import scan_manifest
from . import fixtures as fx
from .q_store import SRC_CTE
from .registry import register

TODAY = fx.INVENTORY_TODAY
# The catalogue the manifests are checked against.
INVENTORY_CATALOGUE = [
    ("1-URGENT", "D", "1995-01-01", ["urgent orders"], "U"),
    ("2-HIGH", "D", "1995-1-1", ["high orders", "high lines"], "H"),
    ("3-MEDIUM", "ME", "1995-01-31", [], "M"),
    ("6-NEVER", "D", "2000-01-01", ["never"], "N"),
    ("7-BROKEN", "D", "not a date", [], "B"),
]


# Spark side -------------------------------------------------------------------
def source_detail(spark, base, gaps=False):
    m = fx.source_manifest(spark, base, gaps).withColumn("size_mb", F.col("size_bytes") / F.lit(1024 * 1024))
    return inv.with_freshness(m, TODAY, detect_schema=False)


def cleaned_detail(spark, base):
    m = fx.cleaned_manifest(spark, base).withColumn("size_mb", F.col("size_bytes") / F.lit(1024 * 1024))
    return inv.with_freshness(m, TODAY)


def relation(spark, base):
    return inv.merge_source_cleaned(source_detail(spark, base, gaps=True), cleaned_detail(spark, base), validate=False)


def expected(spark):
    return catalog.expected_items(catalog.catalogue_frame(spark, INVENTORY_CATALOGUE))


# SQL side -----------------------------------------------------------------------
_LAG = f"CAST(FLOOR((epoch_us(TIMESTAMP '{TODAY}') - epoch_us(mtime)) / 86400000000) AS BIGINT)"
_STATUS = ("CASE WHEN days_lag IS NULL THEN 'STALE' WHEN days_lag <= 1 THEN 'OK' "
           "WHEN days_lag <= 5 THEN 'LAGGING' ELSE 'STALE' END")
_SCHEMA = ("(lower(regexp_extract(regexp_extract(path, '([^/]+)$', 1), '^(.+?)(\\.[^.]*)?$', 1)) LIKE '%schema%' "
           "OR list_contains(string_split(path, '/'), 'schema'))")
DETAIL_CTE = f"""{SRC_CTE},
sd0 AS (SELECT *, CAST(size_bytes AS DOUBLE) / 1048576 AS size_mb, FALSE AS is_schema, 'data' AS file_role,
        {_LAG} AS days_lag FROM src),
sd AS (SELECT *, {_STATUS} AS status FROM sd0),
per AS (SELECT o.o_orderpriority AS item, l.l_orderkey, MAX(l.l_shipdate) AS mtime,
               SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS amt
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderpriority, l.l_orderkey),
cl AS (SELECT 'cleaned' AS layer, item, CAST(l_orderkey AS VARCHAR) AS subitem,
              'cleaned/' || item || '/' || CAST(l_orderkey AS VARCHAR) || '.parquet' AS path,
              CAST(FLOOR(amt * 10) AS BIGINT) AS size_bytes, mtime FROM per
       UNION ALL
       SELECT 'cleaned', item, '_schema', 'cleaned/' || item || '/schema/_schema.json', COUNT(*) * 64, MAX(mtime)
       FROM per GROUP BY item),
cd0 AS (SELECT *, CAST(size_bytes AS DOUBLE) / 1048576 AS size_mb, {_SCHEMA} AS is_schema, {_LAG} AS days_lag FROM cl),
cd AS (SELECT *, CASE WHEN is_schema THEN 'schema' ELSE 'data' END AS file_role, {_STATUS} AS status FROM cd0)"""

REL_CTE = f"""{DETAIL_CTE},
rel0 AS (SELECT COALESCE(s.item, c.item) AS item, COALESCE(s.subitem, c.subitem) AS subitem,
                s.path AS source_path, s.size_mb AS source_size_mb, s.mtime AS source_mtime,
                s.days_lag AS source_days_lag, s.status AS source_status,
                c.path AS cleaned_path, c.size_mb AS cleaned_size_mb, c.mtime AS cleaned_mtime,
                c.days_lag AS cleaned_days_lag, c.status AS cleaned_status
         FROM (SELECT * REPLACE (CASE WHEN landed THEN path END AS path) FROM sd WHERE file_role <> 'schema') s
         FULL OUTER JOIN (SELECT * FROM cd WHERE file_role <> 'schema') c ON s.item = c.item AND s.subitem = c.subitem),
rel AS (SELECT *, CASE WHEN COALESCE(source_path <> '', FALSE) AND COALESCE(cleaned_path <> '', FALSE) THEN 'both'
                       WHEN COALESCE(source_path <> '', FALSE) THEN 'source_only'
                       WHEN COALESCE(cleaned_path <> '', FALSE) THEN 'cleaned_only' ELSE 'none' END AS relation,
               CAST(epoch_us(cleaned_mtime) - epoch_us(source_mtime) AS DOUBLE) / 86400000000.0 AS mtime_diff_days
        FROM rel0)"""

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def _summary_sql(src: str) -> str:
    return f"""SELECT item, COUNT(DISTINCT subitem) AS n_subitems, COUNT(path) AS n_files,
       CAST(CAST(MIN(mtime) AS DATE) AS VARCHAR) AS min_mtime, CAST(CAST(MAX(mtime) AS DATE) AS VARCHAR) AS max_mtime,
       MAX(days_lag) AS max_days_lag, COUNT(*) FILTER (WHERE status = 'OK') AS n_ok,
       COUNT(*) FILTER (WHERE status = 'LAGGING') AS n_lagging, COUNT(*) FILTER (WHERE status = 'STALE') AS n_stale
FROM {src} WHERE item IS NOT NULL GROUP BY item"""


CSUM_CTE = f"""{REL_CTE},
csum0 AS ({_summary_sql("(SELECT * FROM cd WHERE NOT is_schema)")}),
sch AS (SELECT item, COUNT(path) AS n_schema_files FROM cd WHERE is_schema GROUP BY item),
csum AS (SELECT csum0.*, CAST(COALESCE(sch.n_schema_files, 0) AS BIGINT) AS n_schema_files,
                COALESCE(sch.n_schema_files, 0) > 0 AS has_schema FROM csum0 LEFT JOIN sch USING (item)),
ssum AS ({_summary_sql("sd")})"""

_CAT_VALUES = ", ".join(
    f"('{i}', '{f}', TRY_CAST(TRY_STRPTIME('{d}', '%Y-%m-%d') AS DATE), {len(s)}, '{c}')"
    for i, f, d, s, c in INVENTORY_CATALOGUE)
EXP_CTE = f"""{CSUM_CTE},
ex(item, freq, datemin, n_expected_subitems, code) AS (VALUES {_CAT_VALUES}),
est AS (SELECT ex.*, s.n_subitems AS source_n_subitems, s.n_files AS source_n_files,
               s.min_mtime AS source_min_mtime, s.max_mtime AS source_max_mtime, s.max_days_lag AS source_max_days_lag,
               s.n_ok AS source_n_ok, s.n_lagging AS source_n_lagging, s.n_stale AS source_n_stale,
               c.n_subitems AS cleaned_n_subitems, c.n_files AS cleaned_n_files, c.min_mtime AS cleaned_min_mtime,
               c.max_mtime AS cleaned_max_mtime, c.max_days_lag AS cleaned_max_days_lag, c.n_ok AS cleaned_n_ok,
               c.n_lagging AS cleaned_n_lagging, c.n_stale AS cleaned_n_stale,
               c.n_schema_files AS cleaned_n_schema_files,
               COALESCE(s.n_files, 0) > 0 AS has_source, COALESCE(c.n_files, 0) > 0 AS has_cleaned,
               NOT (COALESCE(s.n_files, 0) > 0) AS missing_source, NOT (COALESCE(c.n_files, 0) > 0) AS missing_cleaned,
               COALESCE(c.has_schema, FALSE) AS has_schema, NOT COALESCE(c.has_schema, FALSE) AS missing_schema
        FROM ex LEFT JOIN ssum s USING (item) LEFT JOIN csum c USING (item)),
unexp AS (SELECT COALESCE(s.item, c.item) AS item, s.item IS NOT NULL AS in_source, c.item IS NOT NULL AS in_cleaned
          FROM (SELECT item FROM ssum) s FULL OUTER JOIN (SELECT item FROM csum) c ON s.item = c.item
          WHERE COALESCE(s.item, c.item) NOT IN (SELECT item FROM ex))"""

_DETAIL_COLS = "item, subitem, path, size_mb, {ts} AS mtime, days_lag, status, is_schema, file_role"


@register("d4_source_freshness", f"WITH {DETAIL_CTE} SELECT {_DETAIL_COLS.format(ts=TS.format('mtime'))} FROM sd")
def d4_source_freshness(spark, base):
    """Source files with day lag (floor) and OK / LAGGING / STALE status."""
    return source_detail(spark, base).select(*_DETAIL_COLS.replace("{ts} AS mtime", "mtime").split(", "))


@register("d4_cleaned_freshness", f"WITH {DETAIL_CTE} SELECT {_DETAIL_COLS.format(ts=TS.format('mtime'))} FROM cd")
def d4_cleaned_freshness(spark, base):
    """Cleaned files with lag, status and the schema-file flag."""
    return cleaned_detail(spark, base).select(*_DETAIL_COLS.replace("{ts} AS mtime", "mtime").split(", "))


@register("a1_source_summary", f"WITH {DETAIL_CTE} {_summary_sql('sd')}")
def a1_source_summary(spark, base):
    return inv.summarize_source_by_item(source_detail(spark, base))


@register("a2_cleaned_summary", f"WITH {CSUM_CTE} SELECT * FROM csum")
def a2_cleaned_summary(spark, base):
    return inv.summarize_cleaned_by_item(cleaned_detail(spark, base))


@register("a3_status_counts", f"""WITH {DETAIL_CTE}
SELECT item, COUNT(*) FILTER (WHERE status = 'OK') AS "OK", COUNT(*) FILTER (WHERE status = 'LAGGING') AS "LAGGING",
       COUNT(*) FILTER (WHERE status = 'STALE') AS "STALE" FROM sd GROUP BY item""")
def a3_status_counts(spark, base):
    return inv.status_counts(source_detail(spark, base))


@register("a8_schema_files_by_item", f"WITH {DETAIL_CTE} SELECT item, COUNT(path) AS n_schema_files FROM cd "
                                     "WHERE is_schema GROUP BY item")
def a8_schema_files_by_item(spark, base):
    return inv.schema_count_by_item(cleaned_detail(spark, base))


_REL_OUT = (f"item, subitem, source_path, source_size_mb, {TS.format('source_mtime')} AS source_mtime, "
            f"source_days_lag, source_status, cleaned_path, cleaned_size_mb, {TS.format('cleaned_mtime')} AS cleaned_mtime, "
            "cleaned_days_lag, cleaned_status, relation, mtime_diff_days")


@register("j4_reconciliation", f"WITH {REL_CTE} SELECT {_REL_OUT} FROM rel")
def j4_reconciliation(spark, base):
    """1:1 full outer source-vs-cleaned reconciliation per (item, subitem)."""
    return inv.merge_source_cleaned(source_detail(spark, base, gaps=True), cleaned_detail(spark, base), validate=True)


@register("j5_missing_cleaned", f"WITH {REL_CTE} SELECT item, subitem, source_path FROM rel WHERE relation = 'source_only'")
def j5_missing_cleaned(spark, base):
    return inv.find_missing_cleaned(relation(spark, base)).select("item", "subitem", "source_path")


@register("j5_orphan_cleaned", f"WITH {REL_CTE} SELECT item, subitem, cleaned_path FROM rel WHERE relation = 'cleaned_only'")
def j5_orphan_cleaned(spark, base):
    return inv.find_orphan_cleaned(relation(spark, base)).select("item", "subitem", "cleaned_path")


@register("d5_prune_plan", f"WITH {REL_CTE} SELECT item, subitem, cleaned_path FROM rel WHERE relation = 'cleaned_only'")
def d5_prune_plan(spark, base):
    """Files a prune would delete (dry run: only the plan)."""
    return inv.prune_plan(relation(spark, base))


@register("j6_orphan_split", f"""WITH {REL_CTE},
its AS (SELECT DISTINCT item FROM rel WHERE COALESCE(source_path <> '', FALSE))
SELECT rel.item, rel.subitem, rel.cleaned_path, its.item IS NOT NULL AS has_source_for_item
FROM rel LEFT JOIN its ON rel.item = its.item WHERE relation = 'cleaned_only'""")
def j6_orphan_split(spark, base):
    """Cleaned-only pairs flagged by whether their item has any source file."""
    _, orphan_all = inv.split_orphan_pairs_by_item(relation(spark, base))
    return orphan_all.select("item", "subitem", "cleaned_path", "has_source_for_item")


@register("a4_relation_counts", f"""WITH {REL_CTE}
SELECT item, COUNT(*) FILTER (WHERE relation = 'both') AS both, COUNT(*) FILTER (WHERE relation = 'source_only') AS source_only,
       COUNT(*) FILTER (WHERE relation = 'cleaned_only') AS cleaned_only, COUNT(*) FILTER (WHERE relation = 'none') AS "none"
FROM rel GROUP BY item""")
def a4_relation_counts(spark, base):
    return inv.relation_counts(relation(spark, base))


@register("s7_expected_items", f"""WITH ex(item, freq, datemin, n_expected_subitems, code) AS (VALUES {_CAT_VALUES}),
o AS (SELECT o_orderpriority AS item, COUNT(*) AS n_orders, MIN(CAST(o_orderdate AS DATE)) AS first_order FROM orders GROUP BY 1)
SELECT ex.item, freq, CAST(datemin AS VARCHAR) AS datemin, n_expected_subitems, code, COALESCE(n_orders, 0) AS n_orders,
       first_order < datemin AS starts_early FROM ex LEFT JOIN o USING (item)""")
def s7_expected_items(spark, base):
    """The dataset catalogue (unparsable first dates become NULL) beside what the orders table holds of each item."""
    o = spark.read.parquet(f"{base}/orders.parquet").groupBy(F.col("o_orderpriority").alias("item")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.min(F.to_date("o_orderdate")).alias("first_order"))
    return expected(spark).join(o, "item", "left").select(
        "item", "freq", "datemin", "n_expected_subitems", "code", F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        (F.col("first_order") < F.col("datemin")).alias("starts_early"))


@register("j7_expected_coverage", f"""WITH {EXP_CTE}
SELECT item, freq, CAST(datemin AS VARCHAR) AS datemin, n_expected_subitems, code, source_n_files, cleaned_n_files,
       source_max_days_lag, cleaned_max_days_lag, cleaned_n_schema_files, has_source, has_cleaned,
       missing_source, missing_cleaned, has_schema, missing_schema FROM est""")
def j7_expected_coverage(spark, base):
    """Catalogue ⟕ source summary ⟕ cleaned summary with coverage flags."""
    s = inv.summarize_source_by_item(source_detail(spark, base))
    c = inv.summarize_cleaned_by_item(cleaned_detail(spark, base))
    out = inv.expected_item_status(expected(spark), s, c)
    return out.select("item", "freq", "datemin", "n_expected_subitems", "code", "source_n_files", "cleaned_n_files",
                      "source_max_days_lag", "cleaned_max_days_lag", "cleaned_n_schema_files", "has_source",
                      "has_cleaned", "missing_source", "missing_cleaned", "has_schema", "missing_schema")


@register("u6_unexpected_items", f"WITH {EXP_CTE} SELECT item, in_source, in_cleaned FROM unexp")
def u6_unexpected_items(spark, base):
    s = inv.summarize_source_by_item(source_detail(spark, base))
    c = inv.summarize_cleaned_by_item(cleaned_detail(spark, base))
    return inv.unexpected_items(expected(spark), s, c)


@register("a5_overall_summary", f"""WITH {EXP_CTE},
its AS (SELECT DISTINCT item FROM rel WHERE COALESCE(source_path <> '', FALSE)),
orph AS (SELECT rel.item, its.item IS NOT NULL AS hs FROM rel LEFT JOIN its ON rel.item = its.item
         WHERE relation = 'cleaned_only')
SELECT '{TODAY}' AS as_of,
  (SELECT COUNT(DISTINCT item) FROM csum) AS n_items_cleaned,
  (SELECT COUNT(*) FROM sd) AS n_source_files, (SELECT COUNT(*) FROM cd) AS n_cleaned_files,
  (SELECT COUNT(*) FROM rel) AS n_pairs_total,
  (SELECT COUNT(*) FILTER (WHERE COALESCE(source_path <> '', FALSE)) FROM rel) AS n_pairs_source,
  (SELECT COUNT(*) FILTER (WHERE COALESCE(cleaned_path <> '', FALSE)) FROM rel) AS n_pairs_cleaned,
  (SELECT COUNT(*) FILTER (WHERE relation = 'both') FROM rel) AS n_pairs_both,
  (SELECT COUNT(*) FILTER (WHERE relation = 'source_only') FROM rel) AS n_pairs_source_only,
  (SELECT COUNT(*) FILTER (WHERE relation = 'cleaned_only') FROM rel) AS n_pairs_cleaned_only,
  (SELECT COUNT(*) FILTER (WHERE relation = 'source_only') FROM rel) AS n_missing_pairs,
  (SELECT COUNT(*) FROM orph) AS n_orphan_pairs, (SELECT COUNT(*) FILTER (WHERE NOT hs) FROM orph) AS n_true_orphan_pairs,
  (SELECT COUNT(*) FROM est) AS n_items_expected,
  (SELECT COUNT(*) FILTER (WHERE has_source) FROM est) AS n_items_expected_in_source,
  (SELECT COUNT(*) FILTER (WHERE has_cleaned) FROM est) AS n_items_expected_in_cleaned,
  (SELECT COUNT(*) FILTER (WHERE missing_source) FROM est) AS n_items_expected_missing_source,
  (SELECT COUNT(*) FILTER (WHERE missing_cleaned) FROM est) AS n_items_expected_missing_cleaned,
  (SELECT COUNT(*) FILTER (WHERE has_schema) FROM est) AS n_items_expected_with_schema,
  (SELECT COUNT(*) FILTER (WHERE missing_schema) FROM est) AS n_items_expected_missing_schema,
  (SELECT COUNT(*) FILTER (WHERE in_source) FROM unexp) AS n_items_unexpected_source,
  (SELECT COUNT(*) FILTER (WHERE in_cleaned) FROM unexp) AS n_items_unexpected_cleaned""")
def a5_overall_summary(spark, base):
    """One KPI row of the warehouse."""
    return inv.overall_summary(TODAY, source_detail(spark, base, gaps=True), cleaned_detail(spark, base), expected(spark))


@register("a10_schema_coverage", f"""WITH {CSUM_CTE}
SELECT COUNT(*) AS n_items, COUNT(*) FILTER (WHERE has_schema) AS n_items_with_schema,
       COUNT(*) FILTER (WHERE NOT has_schema) AS n_items_without_schema FROM csum""")
def a10_schema_coverage(spark, base):
    return inv.schema_coverage(inv.summarize_cleaned_by_item(cleaned_detail(spark, base)))


@register("t1_top_lagging_items", f"""WITH {CSUM_CTE}
SELECT item, max_days_lag, n_files FROM csum ORDER BY max_days_lag DESC NULLS LAST, item LIMIT 3""")
def t1_top_lagging_items(spark, base):
    """Top-3 cleaned items by maximum lag (top-k report)."""
    return inv.top_lagging_items(inv.summarize_cleaned_by_item(cleaned_detail(spark, base)), 3) \
        .select("item", "max_days_lag", "n_files")


@register("t2_head_missing", f"""WITH {REL_CTE}
SELECT item, subitem, source_path FROM rel WHERE relation = 'source_only' ORDER BY item, subitem LIMIT 50""")
def t2_head_missing(spark, base):
    """First 50 missing pairs in (item, subitem) order (head report)."""
    return inv.head_pairs(inv.find_missing_cleaned(relation(spark, base)), 50).select("item", "subitem", "source_path")


@register("j10_lag_with_backlog", f"""WITH {CSUM_CTE},
top AS (SELECT item, max_days_lag FROM csum ORDER BY max_days_lag DESC NULLS LAST, item LIMIT 4),
bl AS (SELECT item, COUNT(*) AS n FROM rel WHERE relation = 'source_only' GROUP BY item)
SELECT top.item, top.max_days_lag, COALESCE(bl.n, 0) AS n_source_only FROM top LEFT JOIN bl USING (item)""")
def j10_lag_with_backlog(spark, base):
    """Top lagging items with their count of pairs still waiting to be cleaned."""
    summ = inv.summarize_cleaned_by_item(cleaned_detail(spark, base))
    return inv.lag_ranking_with_backlog(summ, relation(spark, base), 4).select("item", "max_days_lag", "n_source_only")


# error log -----------------------------------------------------------------------
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_STATUS_LIST = "[" + ", ".join("NULL" if x is None else str(x) for x in fx.ERROR_STATUS_CYCLE) + "]"
_EXC_LIST = "[" + ", ".join(f"'{x}'" for x in fx.ERROR_EXCEPTION_CYCLE) + "]"
ERR_CTE = f"""
r0 AS (SELECT event_id, CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS item, ts AS log_time, {_K} AS k
       FROM events WHERE event_type = 'error'),
r1 AS (SELECT *, ({_STATUS_LIST})[k % {len(fx.ERROR_STATUS_CYCLE)} + 1] AS status_code FROM r0),
r AS (SELECT *, CASE WHEN status_code IS NULL THEN ({_EXC_LIST})[k % {len(fx.ERROR_EXCEPTION_CYCLE)} + 1] END
              AS exception_type,
             CASE WHEN k % 3 = 0 THEN 'OK' ELSE 'NO DATA' END AS stat FROM r1),
rc AS (SELECT *, CASE WHEN status_code BETWEEN 500 AND 599 THEN 'http_5xx' WHEN status_code = 404 THEN 'http_404'
                      WHEN status_code = 403 THEN 'http_403' WHEN status_code BETWEEN 400 AND 499 THEN 'http_4xx_other'
                      WHEN exception_type IN ('Timeout', 'ReadTimeout', 'ConnectTimeout') THEN 'timeout'
                      WHEN exception_type = 'ConnectionError' THEN 'connection_error'
                      WHEN exception_type = 'JSONDecodeError' THEN 'json_decode_error' ELSE 'unknown' END AS reason
       FROM r),
flat AS (SELECT date, item, reason AS error_reason,
                CASE WHEN k % 2 = 0 THEN 'k=' || CAST(k AS VARCHAR) ELSE 'old k=' || CAST(k AS VARCHAR) END AS error_message,
                status_code AS requeststatus, exception_type,
                CASE WHEN k % 2 = 0 THEN log_time END AS log_time,
                CASE WHEN k % 2 = 0 THEN CAST(log_time AS DATE) END AS log_date FROM rc)"""


def error_flat(spark, base):
    return inv.flatten_error_log(fx.error_log_cells(spark, base))


@register("d2_error_log_flat", f"""WITH {ERR_CTE}
SELECT CAST(date AS VARCHAR) AS date, item, error_reason, error_message, requeststatus, exception_type,
       {TS.format('log_time')} AS log_time, CAST(log_date AS VARCHAR) AS log_date FROM flat""")
def d2_error_log_flat(spark, base):
    """Nested error log (lists per date x item, two record generations) -> one row per error."""
    return error_flat(spark, base)


@register("a6_error_reason_stats", f"WITH {ERR_CTE} SELECT error_reason, item, COUNT(*) AS count FROM flat GROUP BY ALL")
def a6_error_reason_stats(spark, base):
    return inv.error_reason_stats(error_flat(spark, base))


@register("a6_error_date_stats", f"WITH {ERR_CTE} SELECT CAST(date AS VARCHAR) AS date, COUNT(*) AS n_errors FROM flat GROUP BY date")
def a6_error_date_stats(spark, base):
    return inv.error_date_stats(error_flat(spark, base))


@register("a6_error_item_stats", f"WITH {ERR_CTE} SELECT item, COUNT(*) AS n_errors FROM flat GROUP BY item")
def a6_error_item_stats(spark, base):
    return inv.error_item_stats(error_flat(spark, base))


@register("a9_error_profile", f"""WITH {ERR_CTE}
SELECT item, CAST(COALESCE(MIN(log_date), MIN(date)) AS VARCHAR) AS first_date,
       CAST(COALESCE(MAX(log_date), MAX(date)) AS VARCHAR) AS last_date, COUNT(*) AS n_errors,
       array_to_string(list_sort(list_distinct(list(error_reason))), ',') AS reasons
FROM flat GROUP BY item""")
def a9_error_profile(spark, base):
    p = inv.error_profile_by_item(error_flat(spark, base))
    return p.withColumn("reasons", F.array_join(F.array_sort("reasons"), ",")).drop("n_more_reasons")


@register("a9_first_seen_reasons", f"""WITH {ERR_CTE},
each AS (SELECT item, reason, MIN((date, event_id)) AS first FROM rc GROUP BY item, reason),
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY item ORDER BY first) AS place FROM each)
SELECT item, string_agg(reason, ',' ORDER BY place) FILTER (place <= 3) AS reasons,
       COUNT(*) FILTER (place > 3) AS n_more_reasons FROM placed GROUP BY item""")
def a9_first_seen_reasons(spark, base):
    """Reasons of each item in the order in which they first came up, three at most (a report), the others counted."""
    flat = inv.flatten_error_log(fx.error_log_cells(spark, base), order_field="event_id")
    p = inv.error_profile_by_item(flat, max_reasons=3)
    return p.select("item", F.array_join("reasons", ",").alias("reasons"), "n_more_reasons")


@register("n12_n13_response_classes", f"""WITH {ERR_CTE}
SELECT event_id, reason AS error_class,
       CASE WHEN exception_type IS NOT NULL THEN 'request error' WHEN status_code = 200 AND stat = 'OK' THEN 'succeed'
            WHEN status_code = 200 THEN 'close' ELSE 'result error' END AS outcome FROM rc""")
def n12_n13_response_classes(spark, base):
    """Error class (HTTP status, then exception kind) and request outcome per response."""
    r = fx.response_log(spark, base)
    return r.select("event_id", S.classify_error(F.col("status_code"), F.col("exception_type")).alias("error_class"),
                    S.response_outcome(F.col("status_code"), F.col("stat"), F.col("exception_type")).alias("outcome"))


@register("a7_cleaning_log_summary", f"""WITH {SRC_CTE}
SELECT item, CAST(year(mtime) AS VARCHAR) AS subitem,
       CASE WHEN item = '1-URGENT' THEN 'failed' ELSE 'success' END AS status, COUNT(*) AS count
FROM src WHERE year(mtime) >= 1996 GROUP BY ALL""")
def a7_cleaning_log_summary(spark, base):
    """Cleaning-log counts by (item, subitem, status); here the log is the job state by year."""
    js = fx.job_state(spark, base).withColumn("subitem", F.substring("date", 1, 4))
    return inv.summarize_cleaning_log(js)


@register("s2_table_file_manifest", """
SELECT DISTINCT 'source' AS layer, 'item=' || o_orderpriority AS item, TRUE AS has_content FROM orders""")
def s2_table_file_manifest(spark, base):
    """File manifest (listing, no content read) of a folder that the orders table was landed in, a folder an item."""
    path = st.scratch_path(spark, "manifest")
    (spark.read.parquet(f"{base}/orders.parquet").withColumn("item", F.col("o_orderpriority"))
     .write.partitionBy("item").parquet(path))
    m = scan_manifest(spark, path, layer="source", suffix=".parquet")
    return m.groupBy("layer", "item").agg((F.sum("size_bytes") > 0).alias("has_content"))


# the bundle (D3): several members as (frame, key, metric, value) rows
_D3 = [("source_item_summary", "ssum2", "item", ["n_subitems", "n_files", "max_days_lag", "n_ok", "n_stale"]),
       ("cleaned_item_summary", "csum", "item", ["n_subitems", "n_files", "max_days_lag", "n_lagging", "n_schema_files"]),
       ("lag_item", "csum", "item", ["max_days_lag"]),
       ("schema_item_summary", "sch", "item", ["n_schema_files"]),
       ("relation_counts", "relc", "item", ["both", "source_only", "cleaned_only"]),
       ("missing", "rel_m", "item", ["n"]), ("orphan", "orph_t", "item", ["n"]), ("orphan_candidate", "orph_a", "item", ["n"]),
       ("expected_item_status", "est", "item", ["has_source", "has_cleaned", "missing_source", "missing_schema"]),
       ("unexpected_items", "unexp", "item", ["in_source", "in_cleaned"]),
       ("overall_summary", "kpi", "as_of", ["n_source_files", "n_cleaned_files", "n_pairs_total", "n_orphan_pairs"]),
       ("error_item_summary", "err_i", "item", ["n_errors"]), ("error_reason_summary", "err_r", "item", ["count"]),
       ("error_date_summary", "err_d", "date", ["n_errors"])]
_D3_SQL = " UNION ALL ".join(f"SELECT '{f}' AS frame, CAST({k} AS VARCHAR) AS key, '{m}' AS metric, CAST(\"{m}\" AS BIGINT) AS value FROM {t}"
                             for f, t, k, ms in _D3 for m in ms)


@register("d3_dashboard_frames", f"""WITH {EXP_CTE}, {ERR_CTE},
ssum2 AS ({_summary_sql("(SELECT * REPLACE (CASE WHEN landed THEN path END AS path) FROM sd)")}),
relc AS (SELECT item, COUNT(*) FILTER (WHERE relation = 'both') AS both, COUNT(*) FILTER (WHERE relation = 'source_only') AS source_only,
                COUNT(*) FILTER (WHERE relation = 'cleaned_only') AS cleaned_only FROM rel GROUP BY item),
rel_m AS (SELECT item, COUNT(*) AS n FROM rel WHERE relation = 'source_only' GROUP BY item),
its AS (SELECT DISTINCT item FROM rel WHERE COALESCE(source_path <> '', FALSE)),
orph_a AS (SELECT item, COUNT(*) AS n FROM rel WHERE relation = 'cleaned_only' GROUP BY item),
orph_t AS (SELECT * FROM orph_a WHERE item NOT IN (SELECT item FROM its)),
kpi AS (SELECT '{TODAY}' AS as_of, (SELECT COUNT(*) FROM sd) AS n_source_files, (SELECT COUNT(*) FROM cd) AS n_cleaned_files,
               (SELECT COUNT(*) FROM rel) AS n_pairs_total, (SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM orph_a) AS n_orphan_pairs),
err_i AS (SELECT item, COUNT(*) AS n_errors FROM flat GROUP BY item),
err_r AS (SELECT item || '/' || error_reason AS item, COUNT(*) AS count FROM flat GROUP BY ALL),
err_d AS (SELECT date, COUNT(*) AS n_errors FROM flat GROUP BY date)
{_D3_SQL}""")
def d3_dashboard_frames(spark, base):
    """Fourteen members of the dashboard bundle, one row per (frame, key, metric)."""
    from .dashboard import build_dashboard
    dash = build_dashboard(spark, fx.source_manifest(spark, base, gaps=True), fx.cleaned_manifest(spark, base),
                           catalog.catalogue_frame(spark, INVENTORY_CATALOGUE), TODAY, error_cells=fx.error_log_cells(spark, base))
    for pairs in ("missing", "orphan", "orphan_candidate"):
        dash[pairs] = dash[pairs].groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    dash["error_reason_summary"] = dash["error_reason_summary"].withColumn("item", F.concat_ws("/", "item", "error_reason"))
    out = None
    for frame, _, key, metrics in _D3:
        values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("bigint").alias("value")) for m in metrics])
        rows = dash[frame].select(F.lit(frame).alias("frame"), F.col(key).cast("string").alias("key"), F.explode(values).alias("m"))
        rows = rows.select("frame", "key", "m.metric", "m.value")
        out = rows if out is None else out.unionByName(rows)
    return out
