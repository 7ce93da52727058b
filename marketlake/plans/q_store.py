"""Registered store queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import store as st
from ..sources import tables as tb
from . import fixtures as fx
from .catalog_frames import fact_items
from .q_signals import PANEL_CTE
from .registry import register

FACT_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
ORDER_DESC = ", ".join(f"{c} DESC" for c in fx.FACT_ORDER)
SEL = ", ".join(FACT_COLS) + ", CAST(date AS VARCHAR) AS date"
FACTS_CTE = "facts AS (SELECT * EXCLUDE (l_shipdate), CAST(l_shipdate AS DATE) AS date FROM lineitem)"
BATCH_CTE = f"""{FACTS_CTE},
ex AS (SELECT * FROM facts WHERE date < DATE '{fx.STORE_SPLIT_DATE}'),
nw AS (SELECT * FROM facts WHERE date >= DATE '{fx.STORE_SPLIT_DATE}')"""
TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"

SRC_CTE = """src AS (
  SELECT 'source' AS layer, o_orderpriority AS item, CAST(o_orderkey AS VARCHAR) AS subitem,
         'source/' || o_orderpriority || '/' || CAST(o_orderkey AS VARCHAR) || '.json' AS path, o_orderstatus <> 'P' AS landed,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS size_bytes,
         o_orderdate + to_seconds(CAST(FLOOR(o_totalprice) AS BIGINT) % 86400) AS mtime
  FROM orders)"""
FP = "CAST({0} AS VARCHAR) || '-' || CAST(CAST(FLOOR(epoch_us({1}) / 1000000) AS BIGINT) AS VARCHAR)"
STATE_CTE = f"""state AS (
  SELECT path,
         {FP.format('size_bytes', "CASE WHEN year(mtime) < 1997 THEN mtime - INTERVAL 1 DAY ELSE mtime END")} AS hash,
         CASE WHEN year(mtime) < 1997 THEN mtime - INTERVAL 1 DAY ELSE mtime END AS source_mtime,
         size_bytes AS source_size,
         CASE WHEN item = '1-URGENT' THEN 'failed' ELSE 'success' END AS status,
         strftime(mtime, '%Y-%m-%d') AS date, item
  FROM src WHERE year(mtime) >= 1996)"""


def _dedup_sql(src: str, order: str = ORDER_DESC, key: str = "l_orderkey, l_linenumber") -> str:
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1"


@register("w7_dedup_keep_last", f"WITH {FACTS_CTE}, d AS ({_dedup_sql('facts')}) SELECT {SEL} FROM d")
def w7_dedup_keep_last(spark, base):
    """Keep the last-arrived row per (l_orderkey, l_linenumber)."""
    return st.dedup_keep_last(fx.keyed_facts(spark, base), fx.FACT_KEY, fx.FACT_ORDER)


@register("a12_duplicate_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def a12_duplicate_keys(spark, base):
    return st.duplicate_keys(fx.keyed_facts(spark, base), fx.FACT_KEY)


@register("a12_key_diagnostics", """
WITH per AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_keys, COUNT(*) FILTER (WHERE n > 1) AS n_duplicated_keys,
       CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS n_duplicated_rows FROM per""")
def a12_key_diagnostics(spark, base):
    return st.key_diagnostics(fx.keyed_facts(spark, base), fx.FACT_KEY)


@register("j3_insert_only_new_keys", f"""
WITH {BATCH_CTE}
SELECT {SEL} FROM nw WHERE NOT EXISTS (
  SELECT 1 FROM ex WHERE ex.l_orderkey IS NOT DISTINCT FROM nw.l_orderkey
                     AND ex.l_linenumber IS NOT DISTINCT FROM nw.l_linenumber)""")
def j3_insert_only_new_keys(spark, base):
    """Arriving rows whose key (NULL-safe) is not stored yet."""
    ex, nw = fx.fact_batches(spark, base)
    return st.insert_only_new_keys(ex, nw, fx.FACT_KEY)


@register("u2_upsert_new_wins", f"""
WITH {BATCH_CTE},
u AS (SELECT *, 0 AS src FROM ex UNION ALL SELECT *, 1 AS src FROM nw),
d AS ({_dedup_sql('u', 'src DESC, ' + ORDER_DESC)})
SELECT {SEL} FROM d""")
def u2_upsert_new_wins(spark, base):
    """Stored ∪ arriving batch, keep last per key with the batch winning."""
    ex, nw = fx.fact_batches(spark, base)
    return st.upsert(ex, nw, fx.FACT_KEY, fx.FACT_ORDER)


@register("u2_upsert_moved_date", f"""
WITH {FACTS_CTE},
u AS (SELECT *, 0 AS src FROM facts
      UNION ALL SELECT * REPLACE (CAST(date + INTERVAL 366 DAY AS DATE) AS date), 1 FROM facts WHERE l_returnflag = 'R'),
d AS ({_dedup_sql('u', 'src DESC, ' + ORDER_DESC)})
SELECT {SEL}, strftime(date, '%Y') AS bucket FROM d""")
def u2_upsert_moved_date(spark, base):
    """A batch that corrects the dates of returned lines against the stored, year-bucketed table:
    the key does not hold the date, so its rows move over a year's border and leave no old row behind."""
    facts, path = fx.keyed_facts(spark, base), st.scratch_path(spark, "moved")
    st.upsert_into_table(spark, facts, path, fx.FACT_KEY, fx.FACT_ORDER)
    batch = facts.where("l_returnflag = 'R'").withColumn("date", F.date_add("date", 366))
    return st.upsert_into_table(spark, batch, path, fx.FACT_KEY, fx.FACT_ORDER).select(*FACT_COLS, "date", F.col("bucket").cast("string").alias("bucket"))


_FREQ_CASE = "CASE l_returnflag " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fx.FACT_ITEM_FREQ) + " END"


@register("u3_write_policy_by_item", f"""
WITH {BATCH_CTE},
u AS (SELECT *, 0 AS src FROM ex WHERE {_FREQ_CASE} = 'D' UNION ALL SELECT *, 1 AS src FROM nw WHERE {_FREQ_CASE} = 'D'),
daily AS (SELECT * EXCLUDE (src) FROM ({_dedup_sql('u', 'src DESC, ' + ORDER_DESC)})),
exo AS (SELECT * FROM ex WHERE {_FREQ_CASE} IS DISTINCT FROM 'D'),
nwo AS (SELECT * FROM nw WHERE {_FREQ_CASE} IS DISTINCT FROM 'D'),
fresh AS (SELECT * FROM nwo WHERE NOT EXISTS (SELECT 1 FROM exo WHERE exo.l_orderkey = nwo.l_orderkey
                                              AND exo.l_linenumber = nwo.l_linenumber)),
other AS (SELECT * FROM exo UNION ALL {_dedup_sql('fresh')})
SELECT {SEL} FROM daily UNION ALL SELECT {SEL} FROM other""")
def u3_write_policy_by_item(spark, base):
    """Daily datasets upsert, monthly ones only insert keys not stored yet."""
    ex, nw = fx.fact_batches(spark, base)
    return st.apply_write_policy_by_item(ex, nw, fx.FACT_KEY, fact_items(spark), item_col="l_returnflag",
                                         order_cols=fx.FACT_ORDER)


@register("u1_union_by_name", f"""
WITH {BATCH_CTE}
SELECT l_orderkey, l_linenumber, l_quantity, l_tax, CAST(date AS VARCHAR) AS date FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, date FROM ex
  UNION ALL BY NAME
  SELECT date, l_tax, l_orderkey, l_linenumber FROM nw)""")
def u1_union_by_name(spark, base):
    """Union of two batches whose columns drifted (missing -> NULL)."""
    ex, nw = fx.fact_batches(spark, base)
    return st.union_by_name([ex.select("l_orderkey", "l_linenumber", "l_quantity", "date"),
                             nw.select("date", "l_tax", "l_orderkey", "l_linenumber")])


@register("l2_latest_date_only", f"""
WITH {FACTS_CTE},
f AS (SELECT *, {_FREQ_CASE} AS freq, MAX(date) OVER (PARTITION BY l_orderkey, l_returnflag) AS mx FROM facts)
SELECT {SEL} FROM f WHERE freq = 'D' OR freq IS NULL OR date = mx""")
def l2_latest_date_only(spark, base):
    """Monthly datasets keep only each document's latest date."""
    facts = fx.keyed_facts(spark, base)
    cat = F.broadcast(fact_items(spark).select(F.col("item").alias("l_returnflag"), "freq"))
    out = st.latest_date_only(facts.join(cat, "l_returnflag", "left"), freq_col="freq",
                              doc_cols=("l_orderkey", "l_returnflag"))
    return out.drop("freq")


@register("l3_dataset_subset", f"""
WITH {SRC_CTE}
SELECT item, path FROM src WHERE item IN ('1-URGENT', '3-MEDIUM')""")
def l3_dataset_subset(spark, base):
    """Dataset subset given by a blank-tolerant list."""
    return st.dataset_subset(fx.source_manifest(spark, base), ["1-URGENT", " 3-MEDIUM ", "", None]) \
        .select("item", "path")


@register("w8_latest_file_per_month", f"""
WITH {SRC_CTE},
m AS (SELECT item, strftime(mtime, '%Y-%m') AS month, path, mtime FROM src)
SELECT item, month, path, {TS.format('mtime')} AS mtime FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY item, month ORDER BY mtime DESC, path DESC) AS rn FROM m)
WHERE rn = 1""")
def w8_latest_file_per_month(spark, base):
    """Only the latest file of each (dataset, month)."""
    src = fx.source_manifest(spark, base).select("item", F.date_format("mtime", "yyyy-MM").alias("month"),
                                                 "path", "mtime")
    return st.latest_in_group(src, ["item", "month"], ["mtime", "path"])


@register("j1_pending_work", f"""
WITH {SRC_CTE}, {STATE_CTE}
SELECT COUNT(*) AS n_files, COUNT(*) FILTER (WHERE state.status IS NULL OR state.status <> 'success') AS n_pending
FROM src LEFT JOIN state USING (path)""")
def j1_pending_work(spark, base):
    return st.pending_work(fx.source_manifest(spark, base), fx.job_state(spark, base))


@register("j2_change_detection", f"""
WITH {SRC_CTE}, {STATE_CTE},
j AS (SELECT src.path, {FP.format('src.size_bytes', 'src.mtime')} AS fingerprint, state.status, state.hash,
             state.source_mtime, src.mtime FROM src LEFT JOIN state USING (path)),
k AS (SELECT *, COALESCE(status = 'success' AND hash IS NOT NULL AND hash = fingerprint
                         AND source_mtime IS NOT NULL AND source_mtime = mtime, FALSE) AS unchanged FROM j)
SELECT path, fingerprint, NOT unchanged AS needs_processing,
       COALESCE(status = 'success', FALSE) AND NOT unchanged AS changed_since_success FROM k""")
def j2_change_detection(spark, base):
    """Exact change detection of every source file against the job state."""
    return st.needs_processing(fx.source_manifest(spark, base), fx.job_state(spark, base)) \
        .select("path", "fingerprint", "needs_processing", "changed_since_success")


U4_SQL = f"""
WITH {SRC_CTE}, {STATE_CTE},
nw AS (SELECT path, {FP.format('size_bytes', 'mtime')} AS hash, mtime AS source_mtime, size_bytes AS source_size,
              'success' AS status,
              CASE WHEN year(mtime) = 2001 THEN NULL ELSE strftime(mtime, '%Y-%m-%d') END AS date,
              CASE WHEN year(mtime) = 2001 THEN NULL ELSE item END AS item
       FROM src WHERE year(mtime) >= 2000)
SELECT regexp_extract(COALESCE(nw.path, state.path), '[^/]+$') AS file, COALESCE(nw.path, state.path) AS path,
       CASE WHEN nw.path IS NOT NULL THEN 'source/' || regexp_extract(nw.path, '^source/([^/]+)/', 1) END AS dir,
       CASE WHEN nw.path IS NOT NULL THEN nw.hash ELSE state.hash END AS hash,
       {TS.format("CASE WHEN nw.path IS NOT NULL THEN nw.source_mtime ELSE state.source_mtime END")} AS source_mtime,
       CASE WHEN nw.path IS NOT NULL THEN nw.source_size ELSE state.source_size END AS source_size,
       CASE WHEN nw.path IS NOT NULL THEN nw.status ELSE state.status END AS status,
       CASE WHEN nw.path IS NOT NULL THEN COALESCE(nw.date, state.date) ELSE state.date END AS date,
       CASE WHEN nw.path IS NOT NULL THEN COALESCE(nw.item, state.item) ELSE state.item END AS item
FROM state FULL OUTER JOIN nw ON state.path = nw.path"""


def _u4_frames(spark, base):
    """(stored state, the state rows of a run over the files of 2000-2001, some with NULL date and item)."""
    src = fx.source_manifest(spark, base)
    old = fx.job_state(spark, base).select(
        F.regexp_extract("path", "[^/]+$", 0).alias("file"), "path", F.lit(None).cast("string").alias("dir"),
        "hash", "source_mtime", "source_size", "status", "date", "item", F.lit(None).cast("timestamp").alias("last_processed_at"))
    new = src.where(F.year("mtime") >= 2000).select(
        F.regexp_extract("path", "[^/]+$", 0).alias("file"), "path",
        F.concat(F.lit("source/"), F.regexp_extract("path", "^source/([^/]+)/", 1)).alias("dir"),
        st.S.file_fingerprint(F.col("size_bytes"), F.col("mtime")).alias("hash"),
        F.col("mtime").alias("source_mtime"), F.col("size_bytes").alias("source_size"),
        F.lit("success").alias("status"),
        F.when(F.year("mtime") != 2001, F.date_format("mtime", "yyyy-MM-dd")).alias("date"),
        F.when(F.year("mtime") != 2001, F.col("item")).alias("item"), F.lit(None).cast("timestamp").alias("last_processed_at"))
    return old, new


@register("u4_job_state_upsert", U4_SQL)
def u4_job_state_upsert(spark, base):
    """A run over the files of 2000-2001 upserts their state; a NULL date or
    item in the batch keeps the stored one."""
    return st.upsert_job_state(*_u4_frames(spark, base)).drop("last_processed_at")


@register("u4_job_state_log", U4_SQL)
def u4_job_state_log(spark, base):
    """The same through the stored state: the run appends its own rows, readers take the latest of a file."""
    log = st.job_state_log(spark, st.scratch_path(spark, "state"))
    for rows in _u4_frames(spark, base):
        log.append(rows)
    return log.read().drop("last_processed_at")


@register("n7_bucket_keys", f"""
WITH {PANEL_CTE}, d AS (SELECT DISTINCT date FROM panel)
SELECT CAST(date AS VARCHAR) AS date, strftime(date, '%Y') AS b_year,
       strftime(date, '%Y') || 'Q' || CAST(quarter(date) AS VARCHAR) AS b_quarter,
       strftime(date, '%Y-%m') AS b_month, strftime(date, '%Y-%m-%d') AS b_day, 'ALL' AS b_all FROM d""")
def n7_bucket_keys(spark, base):
    d = fx.entity_day_panel(spark, base).select("date").distinct()
    return d.select("date", *[st.S.bucket_key(F.col("date"), m).alias(f"b_{m}") for m in st.S.BUCKET_MODES])


@register("s4_bucket_layout", f"""
WITH {PANEL_CTE}
SELECT strftime(date, '%Y') || 'Q' || CAST(quarter(date) AS VARCHAR) AS bucket, COUNT(*) AS n_rows,
       COUNT(DISTINCT code) AS n_codes, CAST(SUM(value) AS DOUBLE) AS value FROM panel GROUP BY 1""")
def s4_bucket_layout(spark, base):
    """Rows, entities and value per quarter bucket of the bucketed sink."""
    b = st.with_bucket(fx.entity_day_panel(spark, base), "quarter")
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("code").alias("n_codes"),
                                   F.sum("value").alias("value"))


@register("s3_store_roundtrip", f"""
WITH {PANEL_CTE}
SELECT code, CAST(date AS VARCHAR) AS date, CAST(value AS DOUBLE) AS value, n_events,
       strftime(date, '%Y-%m') AS bucket
FROM panel WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'""")
def s3_store_roundtrip(spark, base):
    """Write the panel as a month-bucketed table, then scan it back with a
    date range that prunes buckets and pushes the filter into Parquet."""
    path = st.scratch_path(spark, "panel")
    st.write_bucketed(fx.entity_day_panel(spark, base), path, bucket_mode="month")
    return tb.read_cleaned(spark, path, start="2024-01-08", end="2024-01-21", bucket_mode="month")
