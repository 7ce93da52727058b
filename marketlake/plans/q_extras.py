"""Registered queries: security master (S6, D7, N11, U5), driver tree (D1),
monthly history (S5), scalar functions (N1-N5, N10, N16, N17), streaming
ingest (ST1-ST3) and the dashboard bundle (D3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import catalog
from ..functions import scalars as S
from ..operators import drivers as drv
from ..operators import store as st
from ..operators.ingest import TableSpec
from ..sources import documents as docsrc
from ..sources.pages import scan_listing_pages
from ..streaming.ingest_stream import start_ingest_stream
from . import fixtures as fx
from .dashboard import build_dashboard
from .history import assemble_history
from .q_ingest import DOC_CATALOGUE, DOC_SPECS
from .registry import register
from .security_master import build_security_master, renew_master

PART_CTE = """
p AS (SELECT *, CAST(FLOOR(p_partkey / 250) AS BIGINT) AS page, CAST(FLOOR(p_partkey / 250) AS BIGINT) % 3 + 1 AS model
      FROM part),
i AS (SELECT *, 'TW' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || '00' ||
                substr(regexp_replace(p_brand, '[^0-9]', '', 'g'), 1, 1) || '0' AS isin,
             CAST(ROW_NUMBER() OVER (PARTITION BY page ORDER BY p_partkey) AS INTEGER) AS row_no FROM p)"""


def _master_sql(type_expr: str = "p_type") -> str:
    slices = " ".join(f"WHEN {m} THEN substr(isin, {a + 1}, {b - a})"
                      for m, (a, b) in catalog.ISIN_CODE_SLICE.items() if m <= fx.LIST_MODELS)
    return f"""WITH {PART_CTE}
SELECT page AS page_id, row_no, CAST(model AS INTEGER) AS model,
       lpad(CAST(p_partkey AS VARCHAR), 6, '0') || p_name AS "名稱", isin AS "ISINCode", '2001/01/01' AS "發行日",
       CAST(model AS VARCHAR) AS "市場別", {type_expr} AS "產業別", 'ESVUFR' AS "CFICode", p_brand AS "備註",
       CASE model {slices} END AS "代號"
FROM i"""


@register("s6_listing_rows", f"""WITH {PART_CTE}
SELECT page AS page_id, row_no, 7 AS n_cells, lpad(CAST(p_partkey AS VARCHAR), 6, '0') || '　' || p_name AS first_cell
FROM i""")
def s6_listing_rows(spark, base):
    """Rows of the second <table> with as many cells as its header."""
    rows = scan_listing_pages(fx.listing_pages(spark, base))
    return rows.select("page_id", "row_no", F.size("cells").alias("n_cells"), F.get("cells", 0).alias("first_cell"))


@register("s6_supplied_pages", """
SELECT page_id, url, CAST(0 AS INTEGER) AS row_no, CAST(NULL AS VARCHAR) AS first_cell FROM pages
WHERE (length(lower(html)) - length(replace(lower(html), '<table', ''))) / 6 >= 2""")
def s6_supplied_pages(spark, base):
    """The supplied web pages hold no listing table: nothing is extracted."""
    pages = spark.read.parquet(f"{base}/pages.parquet")
    rows = scan_listing_pages(pages)
    return rows.select("page_id", "url", "row_no", F.get("cells", 0).alias("first_cell"))


@register("d7_security_master", _master_sql())
def d7_security_master(spark, base):
    """Renamed, U+3000-free listing of every market model with the code sliced from the ISIN."""
    return build_security_master(fx.listing_pages(spark, base))


@register("u5_master_renew", _master_sql("CASE WHEN model = 2 THEN lower(p_type) ELSE p_type END"))
def u5_master_renew(spark, base):
    """A later crawl of one market overwrites the master's rows by ISIN."""
    old = build_security_master(fx.listing_pages(spark, base))
    crawl = fx.listing_pages(spark, base, lower_type_model="2")
    new = build_security_master(crawl.where(F.col("url").rlike("strMode=2(&|$)")))  # pages of one market, before parsing
    return renew_master(old, new)


_DIMS_SQL = " UNION ALL ".join(f"SELECT '{d}' AS dim, {d} AS value, period, amount FROM f" for d in fx.DRIVER_DIMS)


@register("d1_driver_pivots_root", f"""
WITH f AS (SELECT year(o_orderdate) AS period, c_mktsegment, o_orderpriority, r_name, l_returnflag,
                  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
           WHERE year(o_orderdate) IN (1998, 1999)),
u AS ({_DIMS_SQL}),
g AS (SELECT dim, value, SUM(CASE WHEN period = 1998 THEN amount ELSE 0 END) AS base,
             SUM(CASE WHEN period = 1999 THEN amount ELSE 0 END) AS comp FROM u GROUP BY dim, value)
SELECT 'root' AS node_id, dim, value, CAST(base AS DOUBLE) AS base, CAST(comp AS DOUBLE) AS comp,
       CAST(comp - base AS DOUBLE) AS delta, CAST(abs(comp - base) AS DOUBLE) AS abs_delta FROM g""")
def d1_driver_pivots_root(spark, base):
    """Root pivots of the 1998 -> 1999 revenue change by segment, priority, region, return flag."""
    tree = drv.driver_tree(fx.two_period_fact(spark, base), 1998, 1999, fx.DRIVER_DIMS, "amount", "period",
                           max_depth=1)
    return tree.pivots.where(F.col("node_id") == drv.ROOT)


def _tree_sql(depth: int, top_k: int, share: float) -> str:
    """The driver tree as one CTE chain a level (r: rows of a node, p: pivots, b: best dimension, c: children)."""
    dims, cols = fx.DRIVER_DIMS, ", ".join(fx.DRIVER_DIMS)
    of_split = "CASE c.split_dim " + " ".join(f"WHEN '{d}' THEN r.{d}" for d in dims) + " END"
    ctes = [f"""g AS (SELECT {cols}, SUM(CASE WHEN period = 1998 THEN amount ELSE 0 END) AS base,
       SUM(CASE WHEN period = 1999 THEN amount ELSE 0 END) AS comp FROM f GROUP BY {cols})""",
            "t AS (SELECT SUM(base) AS base, SUM(comp) AS comp, SUM(comp) - SUM(base) AS delta FROM g)",
            f"r0 AS (SELECT 'root' AS node_id, CAST([] AS VARCHAR[]) AS used, {cols}, base, comp FROM g)"]
    for k in range(depth):
        pivots = " UNION ALL ".join(
            f"SELECT node_id, '{d}' AS dim, {d} AS value, SUM(base) AS base, SUM(comp) AS comp, SUM(comp) - SUM(base) AS delta "
            f"FROM r{k} WHERE NOT list_contains(used, '{d}') GROUP BY node_id, {d}" for d in dims)
        ctes += [f"p{k} AS ({pivots})",
                 f"""b{k} AS (SELECT node_id, dim AS split_dim FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY node_id ORDER BY abs(delta) DESC, dim) AS rn FROM p{k}) WHERE rn = 1)""",
                 f"""c{k} AS (SELECT x.node_id AS parent_id, split_dim, value, x.base, x.comp, x.delta,
  CASE x.node_id WHEN 'root' THEN '' ELSE x.node_id || '/' END || split_dim || '=' || value AS node_id
  FROM (SELECT p.*, split_dim, ROW_NUMBER() OVER (PARTITION BY p.node_id ORDER BY abs(delta) DESC, value) AS rn
        FROM p{k} p JOIN b{k} b ON p.node_id = b.node_id AND p.dim = b.split_dim) x, t
  WHERE rn <= {top_k} AND abs(x.delta) >= abs(CAST(t.delta AS DOUBLE)) * {share})""",
                 f"""r{k + 1} AS (SELECT c.node_id, list_append(r.used, c.split_dim) AS used, {', '.join('r.' + d for d in dims)},
  r.base, r.comp FROM r{k} r JOIN c{k} c ON c.parent_id = r.node_id AND {of_split} = c.value)"""]
    ctes.append("n AS (SELECT 'root' AS node_id, NULL AS parent_id, 0 AS depth, base, comp, delta FROM t" + "".join(
        f" UNION ALL SELECT node_id, parent_id, {k + 1}, base, comp, delta FROM c{k}" for k in range(depth)) + ")")
    ctes.append("s AS (" + " UNION ".join(f"SELECT parent_id AS node_id, split_dim FROM c{k}" for k in range(depth)) + ")")
    return ",\n".join(ctes) + """
SELECT n.node_id, parent_id, depth, s.split_dim, CASE n.node_id WHEN 'root' THEN '' ELSE n.node_id END AS path,
       CAST(n.base AS DOUBLE) AS base, CAST(n.comp AS DOUBLE) AS comp, CAST(n.delta AS DOUBLE) AS delta,
       CAST(n.delta AS DOUBLE) / CAST(t.delta AS DOUBLE) AS share_of_root
FROM n LEFT JOIN s ON n.node_id = s.node_id, t"""


@register("d1_driver_tree_nodes", f"""
WITH f AS (SELECT year(o_orderdate) AS period, c_mktsegment, o_orderpriority, r_name, l_returnflag,
                  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
           WHERE year(o_orderdate) IN (1998, 1999)),
{_tree_sql(3, 5, 0.05)}""")
def d1_driver_tree_nodes(spark, base):
    """Nodes of the driver tree (depth <= 3, top 5 children, 5% of the root change)."""
    tree = drv.driver_tree(fx.two_period_fact(spark, base), 1998, 1999, fx.DRIVER_DIMS, "amount", "period",
                           max_depth=3, min_node_share=0.05, top_k=5)
    return tree.nodes


HIST_START, HIST_END = "1997-03-15", "1998-02-10"


@register("s5_monthly_history", f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS "日期", CAST(o_custkey AS VARCHAR) AS symbol, o_totalprice AS "成交金額",
       o_orderkey AS "成交筆數",
       CASE WHEN o_orderstatus = 'F' THEN -(FLOOR(o_totalprice) / 100) ELSE FLOOR(o_totalprice) / 100 END AS "漲跌價差"
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{HIST_START}' AND DATE '{HIST_END}'""")
def s5_monthly_history(spark, base):
    """Every security's daily history over a date range, assembled from monthly documents."""
    docs = docsrc.documents_from_text(fx.monthly_history_docs(spark, base))
    h = assemble_history(docs, HIST_START, HIST_END, fx.HISTORY_HEADER, int_cols=["成交筆數"],
                         float_cols=["成交金額", "漲跌價差"], sign=("漲跌價差", "漲跌(+/-)"))
    return h.select("日期", "symbol", "成交金額", "成交筆數", "漲跌價差")


@register("n_scalar_functions", """
SELECT o_orderkey, replace(o_orderpriority, '-', ' ') AS n1_priority, o_orderpriority AS n2_priority,
       o_totalprice AS n3_total, o_orderkey AS n3_key, strftime(o_orderdate, '%Y-%m-%d') AS n4_iso,
       CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS n5_signed,
       CAST(epoch_us(o_orderdate + to_seconds(CAST(FLOOR(o_totalprice) AS BIGINT) % 86400)) - epoch_us(o_orderdate)
            AS DOUBLE) / 86400000000.0 AS n10_days,
       CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS VARCHAR) || '-' ||
       CAST(CAST(FLOOR(epoch_us(o_orderdate) / 1000000) AS BIGINT) AS VARCHAR) AS n16_fingerprint,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE 'none' END AS n17_first_nonblank
FROM orders""")
def n_scalar_functions(spark, base):
    """Text replace, U+3000 removal, comma numbers, Minguo dates, sign merge,
    fractional days, file fingerprint, first non-blank."""
    o = spark.read.parquet(f"{base}/orders.parquet")
    d = F.to_date("o_orderdate")
    minguo = F.format_string("%d/%02d/%02d", F.year(d) - 1911, F.month(d), F.dayofmonth(d))
    later = F.timestamp_add("SECOND", F.floor("o_totalprice") % F.lit(86400), F.col("o_orderdate"))
    return o.select(
        "o_orderkey",
        S.replace_text("o_orderpriority", "-", " ").alias("n1_priority"),
        S.strip_ideographic_space(F.concat(F.lit("　"), "o_orderpriority", F.lit("　"))).alias("n2_priority"),
        S.parse_number(F.format_number("o_totalprice", 2), "double").alias("n3_total"),
        S.parse_number(F.format_number("o_orderkey", 0), "bigint").alias("n3_key"),
        S.minguo_to_iso_text(minguo).alias("n4_iso"),
        S.apply_sign(F.col("o_totalprice"), F.when(F.col("o_orderstatus") == "F", F.lit(" - "))
                     .otherwise(F.lit("+"))).alias("n5_signed"),
        S.fractional_days(later, F.col("o_orderdate")).alias("n10_days"),
        S.file_fingerprint((F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint"),
                           F.col("o_orderdate")).alias("n16_fingerprint"),
        S.first_nonblank(F.when(F.col("o_orderstatus") == "F", F.lit("")),
                         F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")),
                         default="none").alias("n17_first_nonblank"))


@register("st1_stream_clean_orders", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(o_orderkey AS VARCHAR) AS "代號",
       o_custkey AS "客戶代號", o_orderstatus AS "狀態", o_totalprice AS "總金額", o_orderpriority AS "優先序"
FROM orders""")
def st1_stream_clean_orders(spark, base):
    """Landed documents drained by an availableNow stream into the bucketed
    table; the table equals the batch result."""
    root = st.scratch_path(spark, "stream")
    # as many files as tasks wrote; the stream's own default bounds a round
    fx.landed_documents(spark, base).write.parquet(f"{root}/landing")
    q = start_ingest_stream(spark, f"{root}/landing", f"{root}/tables", f"{root}/checkpoint",
                            DOC_CATALOGUE, DOC_SPECS, layout="records", bucket_mode="year")
    q.awaitTermination()
    t = spark.read.parquet(f"{root}/tables/{fx.DOC_ITEM}/訂單彙總")
    return t.select("date", "代號", "客戶代號", "狀態", "總金額", "優先序")


# Catalogue and spec of the monthly documents (F3d).
MONTHLY_CATALOGUE = [(fx.MONTHLY_ITEM, "ME", "1992-01-01", [fx.MONTHLY_TABLE], "M")]
MONTHLY_SPECS = {fx.MONTHLY_TABLE: TableSpec(item=fx.MONTHLY_ITEM, subitem=fx.MONTHLY_TABLE, float_cols=["金額"],
                                             rename={"日期": "date", "客戶代號": "代號"})}
_ROUNDS_SQL = " UNION ALL ".join(f"SELECT *, {k} AS r FROM m WHERE month >= DATE '{a}' AND month < DATE '{b}'"
                                 for k, (a, b) in enumerate(fx.MONTHLY_ROUNDS))


@register("st2_stream_late_monthly", f"""
WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n,
                  SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1, 2),
r AS ({_ROUNDS_SQL}),
v AS (SELECT o_custkey, last_day(month) AS date, CAST(total + r * n AS DOUBLE) AS amount, r, TRUE AS month_end FROM r
      UNION ALL SELECT o_custkey, CAST(month + INTERVAL 14 DAY AS DATE), CAST(n AS DOUBLE), r, FALSE FROM r)
SELECT 'insert' AS policy, CAST(date AS VARCHAR) AS date, CAST(o_custkey AS VARCHAR) AS code, arg_min(amount, r) AS amount
FROM v WHERE month_end GROUP BY o_custkey, date
UNION ALL
SELECT 'upsert', CAST(date AS VARCHAR), CAST(o_custkey AS VARCHAR), arg_max(amount, r) FROM v GROUP BY o_custkey, date""")
def st2_stream_late_monthly(spark, base):
    """Monthly documents of three rounds through two streams over one landing folder: late months are
    dropped (and only a document's latest date kept), or upserted by the stream with the backfill flag."""
    root = st.scratch_path(spark, "late")
    policies = {"insert": False, "upsert": True}
    for number in range(len(fx.MONTHLY_ROUNDS)):
        fx.monthly_documents(spark, base, number).write.mode("append").parquet(f"{root}/landing")
        for policy, backfill in policies.items():
            start_ingest_stream(spark, f"{root}/landing", f"{root}/{policy}", f"{root}/checkpoint-{policy}", MONTHLY_CATALOGUE,
                                MONTHLY_SPECS, update_old_non_daily=backfill).awaitTermination()
    return st.union_by_name([spark.read.parquet(f"{root}/{policy}/{fx.MONTHLY_ITEM}/{fx.MONTHLY_TABLE}").select(
        F.lit(policy).alias("policy"), "date", F.col("代號").alias("code"), F.col("金額").alias("amount")) for policy in policies])


@register("d3_dashboard_lag_top", """
WITH per AS (SELECT o.o_orderpriority AS item, MAX(l.l_shipdate) AS mtime
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderpriority, l.l_orderkey),
s AS (SELECT item, MAX(CAST(FLOOR((epoch_us(TIMESTAMP '2001-08-03') - epoch_us(mtime)) / 86400000000) AS BIGINT))
             AS max_days_lag FROM per GROUP BY item)
SELECT item, max_days_lag FROM s ORDER BY max_days_lag DESC NULLS LAST, item LIMIT 20""")
def d3_dashboard_lag_top(spark, base):
    """One member of the dashboard bundle: the lagging-item ranking."""
    from .q_inventory import INVENTORY_CATALOGUE
    dash = build_dashboard(spark, fx.source_manifest(spark, base), fx.cleaned_manifest(spark, base),
                           catalog.catalogue_frame(spark, INVENTORY_CATALOGUE), fx.INVENTORY_TODAY,
                           error_cells=fx.error_log_cells(spark, base))
    return dash["lag_item_top"].select("item", "max_days_lag")
