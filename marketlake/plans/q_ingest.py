"""Registered ingest queries (S1, X1, X5, X6, X8, N15, P*, Q4, D6) over the
landed documents F3 and the messy titles F9."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import catalog
from ..functions import scalars as S
from ..operators import ingest as ig
from ..sources import documents as docsrc
from . import fixtures as fx
from .clean_job import clean_documents
from .registry import register

# Catalogue and sub-table specs of the landed order documents.
DOC_CATALOGUE = [(fx.DOC_ITEM, "D", "1995-01-01", ["訂單彙總", "明細", "退貨統計"], "O")]
DOC_SPECS = {
    "訂單彙總": ig.TableSpec(item=fx.DOC_ITEM, subitem="訂單彙總", rename={"訂單編號": "代號"},
                          int_cols=["客戶代號"], float_cols=["總金額"]),
    "明細": ig.TableSpec(item=fx.DOC_ITEM, subitem="明細", rename={"訂單編號": "代號"}, int_cols=["項次"],
                       float_cols=["數量", "金額", "折扣"], date_cols=["date", "出貨日期"], pk=["代號", "項次"]),
    "退貨統計": ig.TableSpec(item=fx.DOC_ITEM, subitem="退貨統計", rename={"訂單編號": "代號"}, int_cols=["筆數"],
                          float_cols=["數量"], pk=["代號", "退貨"]),
}
# Configured sub-table titles matched against the part titles.
PART_SUBTITLES = ["plate", "widget", "ring", "rod", "bolt", "gizmo", "gear", "anvil", "hot"]

MINGUO_SQL = ("CAST(year({0}) - 1911 AS VARCHAR) || '年' || lpad(CAST(month({0}) AS VARCHAR), 2, '0') || '月' "
              "|| lpad(CAST(day({0}) AS VARCHAR), 2, '0') || '日'")
DOC_KEY_SQL = ("'source/orders_daily/orders_daily_' || strftime({d}, '%Y%m%d') || '_p' || "
               "CAST(CAST(FLOOR({k} / 1000) AS BIGINT) AS VARCHAR) || '.json'")


def documents(spark, base):
    return docsrc.documents_from_text(fx.landed_documents(spark, base))


def _clean(spark, base, cat_rows=DOC_CATALOGUE):
    return clean_documents(documents(spark, base), catalog.catalogue_frame(spark, cat_rows), DOC_SPECS)


@register("s1_document_scan", f"""
SELECT DISTINCT 'orders_daily' AS item, {DOC_KEY_SQL.format(d='o_orderdate', k='o_orderkey')} AS source_file,
       strftime(o_orderdate, '%Y%m%d') AS date_key, TRUE AS is_object FROM orders""")
def s1_document_scan(spark, base):
    """Raw documents: dataset, file, date key from the request metadata."""
    return documents(spark, base).drop("doc")


_DOCS_CTE = f"""
o AS (SELECT CAST(o_orderdate AS DATE) AS d, {DOC_KEY_SQL.format(d='o_orderdate', k='o_orderkey')} AS f,
             o_orderkey FROM orders),
docs AS (SELECT f, d, COUNT(*) AS n_orders FROM o GROUP BY f, d),
ln AS (SELECT o.f, COUNT(*) AS n_lines, COUNT(DISTINCT (l.l_orderkey, l.l_returnflag)) AS n_flags
       FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey GROUP BY o.f)"""


@register("x1_subtable_blocks", f"""
WITH {_DOCS_CTE}
SELECT docs.f AS source_file, 0 AS container, 'main' AS kind, CAST(0 AS BIGINT) AS k, {MINGUO_SQL.format('docs.d')} || ' 訂單彙總' AS title,
       5 AS n_fields, n_orders AS n_rows FROM docs
UNION ALL
SELECT docs.f, 0, 'main', 1, {MINGUO_SQL.format('docs.d')} || ' 明細', 7, COALESCE(ln.n_lines, 0)
FROM docs LEFT JOIN ln ON docs.f = ln.f
UNION ALL
SELECT docs.f, 1, 'main', 0, {MINGUO_SQL.format('docs.d')} || ' 退貨統計', 4, COALESCE(ln.n_flags, 0)
FROM docs LEFT JOIN ln ON docs.f = ln.f""")
def x1_subtable_blocks(spark, base):
    """Every sub-table block found in every document (numbered and nested)."""
    b = ig.extract_subtables(documents(spark, base))
    return b.select("source_file", "container", "kind", "k", "title",
                    F.size("fields").alias("n_fields"), F.size("data").alias("n_rows"))


@register("x5_non_empty_blocks", f"""
WITH {_DOCS_CTE}
SELECT docs.f AS source_file, CAST(1 + CASE WHEN ln.f IS NOT NULL THEN 2 ELSE 0 END AS BIGINT) AS n_blocks
FROM docs LEFT JOIN ln ON docs.f = ln.f""")
def x5_non_empty_blocks(spark, base):
    """Blocks left per document after skipping empty ones."""
    b = ig.skip_empty(ig.extract_subtables(documents(spark, base)))
    return b.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_blocks"))


@register("d6_clean_orders", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(o_orderkey AS VARCHAR) AS "代號",
       o_custkey AS "客戶代號", o_orderstatus AS "狀態", o_totalprice AS "總金額", o_orderpriority AS "優先序"
FROM orders""")
def d6_clean_orders(spark, base):
    """Cleaned main table of the documents = the orders table."""
    t = _clean(spark, base).tables[fx.DOC_ITEM, "訂單彙總"]
    return t.select("date", "代號", "客戶代號", "狀態", "總金額", "優先序")


@register("d6_clean_lines", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(l_orderkey AS VARCHAR) AS "代號",
       CAST(l_linenumber AS BIGINT) AS "項次", l_quantity AS "數量", l_extendedprice AS "金額",
       l_discount AS "折扣", l_returnflag AS "退貨", CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "出貨日期"
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_returnflag DESC) AS rn
      FROM lineitem) l
JOIN orders ON l_orderkey = o_orderkey WHERE rn = 1""")
def d6_clean_lines(spark, base):
    """Numbered sub-table: comma numbers, Minguo ship dates, keep-last on the declared key."""
    t = _clean(spark, base).tables[fx.DOC_ITEM, "明細"]
    return t.select("date", "代號", "項次", "數量", "金額", "折扣", "退貨", "出貨日期")


@register("d6_clean_flags", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(l_orderkey AS VARCHAR) AS "代號",
       l_returnflag AS "退貨", CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS "數量",
       COUNT(*) AS "筆數"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_orderdate, l_orderkey, l_returnflag""")
def d6_clean_flags(spark, base):
    """Sub-table nested in ``tables``; its date comes from the request metadata."""
    t = _clean(spark, base).tables[fx.DOC_ITEM, "退貨統計"]
    return t.select("date", "代號", "退貨", "數量", "筆數")


@register("q4_quarantine_unconfigured", f"""
WITH {_DOCS_CTE}
SELECT ln.f AS source_file, 'no configured subtitle in title' AS message,
       {MINGUO_SQL.format('docs.d')} || ' 退貨統計' AS value
FROM ln JOIN docs ON ln.f = docs.f""")
def q4_quarantine_unconfigured(spark, base):
    """Sub-tables whose title matches no configured subtitle go to quarantine."""
    cat = [(fx.DOC_ITEM, "D", "1995-01-01", ["訂單彙總", "明細"], "O")]
    err = _clean(spark, base, cat).errors
    return err.select("source_file", F.col("error.message").alias("message"), F.col("error.value").alias("value"))


@register("x6_key_classes", f"""
WITH {_DOCS_CTE}, k(key, key_class) AS (VALUES ('title', 'title'), ('fields', 'col'), ('data', 'value'),
  ('subtitle1', 'title'), ('fields1', 'col'), ('data1', 'value'))
SELECT docs.f AS source_file, key, key_class FROM docs, k""")
def x6_key_classes(spark, base):
    """Top-level keys classed by substring (col / value / title)."""
    return ig.classify_keys(documents(spark, base)).select("source_file", "key", "key_class")


@register("x6_tables_by_key_class", f"""
WITH {_DOCS_CTE}
SELECT docs.f AS source_file, 1 AS n, {MINGUO_SQL.format('docs.d')} || ' 明細' AS title, 5 AS n_fields,
       n_orders AS n_rows FROM docs
UNION ALL
SELECT docs.f, 2, {MINGUO_SQL.format('docs.d')} || ' 訂單彙總', 7, ln.n_lines FROM docs JOIN ln ON docs.f = ln.f""")
def x6_tables_by_key_class(spark, base):
    """The n-th col, value and title keys (sorted) form the n-th table."""
    t = ig.tables_by_key_class(documents(spark, base))
    return t.select("source_file", "n", "title", F.size("fields").alias("n_fields"), F.size("data").alias("n_rows"))


_TITLES_SQL = f"""
t AS (SELECT p_partkey, p_name,
        CASE p_size % 3 WHEN 0 THEN translate(p_name, '{''.join(chr(i) for i in range(0x21, 0x7F)).replace("'", "''")} ',
                                              '{''.join(chr(i + 0xFEE0) for i in range(0x21, 0x7F))}　')
                        WHEN 1 THEN '　' || p_name || ' ' ELSE upper(p_name) END AS raw_title,
        CASE p_size % 3 WHEN 0 THEN p_name WHEN 1 THEN ' ' || p_name || ' ' ELSE upper(p_name) END AS nfkc_title
      FROM part)"""


@register("n15_nfkc", f"WITH {_TITLES_SQL} SELECT p_partkey, raw_title, nfkc_title FROM t")
def n15_nfkc(spark, base):
    """NFKC normalisation (full-width forms, ideographic space)."""
    t = fx.messy_titles(spark, base)
    return t.select("p_partkey", "raw_title", S.nfkc("raw_title").alias("nfkc_title"))


@register("x8_title_match", f"""
WITH {_TITLES_SQL},
s(subtitle) AS (VALUES {", ".join(f"('{x}')" for x in PART_SUBTITLES)}),
d AS (SELECT DISTINCT raw_title, trim(nfkc_title) AS title_norm FROM t),
h AS (SELECT d.raw_title, d.title_norm, COUNT(s.subtitle) AS n_hits, MIN(s.subtitle) AS any_hit
      FROM d LEFT JOIN s ON contains(d.title_norm, s.subtitle) GROUP BY d.raw_title, d.title_norm)
SELECT 'parts' AS item, raw_title AS title, title_norm, n_hits,
       CASE WHEN n_hits = 1 THEN any_hit END AS subitem,
       CASE WHEN n_hits = 0 THEN 'no configured subtitle in title'
            WHEN n_hits > 1 THEN 'several configured subtitles in title' END AS match_error
FROM h""")
def x8_title_match(spark, base):
    """Exactly one configured subtitle must be contained in the normalised title."""
    t = fx.messy_titles(spark, base).select(F.lit("parts").alias("item"), F.col("raw_title").alias("title"))
    return ig.match_titles(t.distinct(), {"parts": PART_SUBTITLES})


_MARGIN_COLS = ["date", "代號", "名稱"] + [f"{g}_{h}" for g, hs in (
    ("融資", ["買進", "賣出", "現金償還", "前日餘額", "今日餘額", "限額"]),
    ("融券", ["買進", "賣出", "現券償還", "前日餘額", "今日餘額", "限額"])) for h in hs] + ["資券互抵", "註記"]


@register("x4_grouped_header", """
SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, CAST(l_orderkey AS VARCHAR) AS "代號",
  CAST(l_linenumber AS VARCHAR) AS "名稱",
  l_quantity AS "融資_買進", l_extendedprice AS "融資_賣出", l_discount AS "融資_現金償還", l_tax AS "融資_前日餘額",
  CAST(l_partkey AS DOUBLE) AS "融資_今日餘額", CAST(l_suppkey AS DOUBLE) AS "融資_限額",
  CAST(l_suppkey AS DOUBLE) AS "融券_買進", CAST(l_partkey AS DOUBLE) AS "融券_賣出", l_tax AS "融券_現券償還",
  l_discount AS "融券_前日餘額", l_extendedprice AS "融券_今日餘額", l_quantity AS "融券_限額",
  l_returnflag AS "資券互抵", l_linestatus AS "註記"
FROM lineitem""")
def x4_grouped_header(spark, base):
    """Grouped header (repeated names) resolved by the configured column spans;
    the exchange catalogue identifies the sub-table; global rename gives the key names."""
    docs = docsrc.documents_from_text(fx.grouped_header_docs(spark, base), plain=True)
    num = [c for c in _MARGIN_COLS if c.startswith(("融資_", "融券_"))]
    spec = ig.TableSpec(item=fx.MARGIN_ITEM, subitem=fx.MARGIN_SUBTITLE, float_cols=num,
                        spans=catalog.FIELD_SPANS[fx.MARGIN_SUBTITLE], pk=list(_MARGIN_COLS))
    res = clean_documents(docs, catalog.catalogue_frame(spark), {fx.MARGIN_SUBTITLE: spec},
                          global_rename=catalog.GLOBAL_RENAME)
    return res.tables[fx.MARGIN_ITEM, fx.MARGIN_SUBTITLE].select(*_MARGIN_COLS)


def _margin_clean(spark, base, pk):
    docs = docsrc.documents_from_text(fx.grouped_header_docs(spark, base), plain=True)
    num = [c for c in _MARGIN_COLS if c.startswith(("融資_", "融券_"))]
    spec = ig.TableSpec(item=fx.MARGIN_ITEM, subitem=fx.MARGIN_SUBTITLE, float_cols=num,
                        spans=catalog.FIELD_SPANS[fx.MARGIN_SUBTITLE], pk=pk)
    res = clean_documents(docs, catalog.catalogue_frame(spark), {fx.MARGIN_SUBTITLE: spec})
    return res.tables[fx.MARGIN_ITEM, fx.MARGIN_SUBTITLE]


@register("x4_grouped_header_keyed", """
WITH l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CAST(l_shipdate AS DATE) DESC,
             CAST(l_quantity AS VARCHAR) DESC, format('{:,.2f}', l_extendedprice) DESC, CAST(l_discount AS VARCHAR) DESC,
             CAST(l_tax AS VARCHAR) DESC, CAST(l_partkey AS VARCHAR) DESC, CAST(l_suppkey AS VARCHAR) DESC, l_returnflag DESC) AS rn
           FROM lineitem)
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, CAST(l_orderkey AS VARCHAR) AS "代號", CAST(l_linenumber AS VARCHAR) AS "名稱",
       l_quantity AS "融資_買進", l_extendedprice AS "融資_賣出", l_extendedprice AS "融券_今日餘額", l_returnflag AS "資券互抵" FROM l WHERE rn = 1""")
def x4_grouped_header_keyed(spark, base):
    """The grouped header under the key of its rows: the last document's, and in it the last, row of a key stays."""
    t = _margin_clean(spark, base, ["代號", "名稱"])
    return t.select("date", "代號", "名稱", "融資_買進", "融資_賣出", "融券_今日餘額", "資券互抵")


@register("p_old_layout", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(o_orderkey AS VARCHAR) AS "代號", o_totalprice AS "金額",
       o_custkey AS "金額__2", CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS "新名",
       'date,代號,金額,金額__2,新名' AS column_order FROM orders""")
def p_old_layout(spark, base):
    """Documents of an old layout: high-numbered table found by the legacy scan, repeated name repaired, shipped
    column dropped, dataset rename, surplus cells unread and missing ones null, key columns in front."""
    spec = ig.TableSpec(item=fx.OLD_ITEM, subitem=fx.OLD_TABLE, rename={"舊名": "新名"}, float_cols=["金額"], int_cols=["金額__2"])
    cat = catalog.catalogue_frame(spark, [(fx.OLD_ITEM, "D", "1992-01-01", [fx.OLD_TABLE], "X")])
    docs = docsrc.documents_from_text(fx.old_layout_documents(spark, base))
    t = clean_documents(docs, cat, {fx.OLD_TABLE: spec}).tables[fx.OLD_ITEM, fx.OLD_TABLE]
    body = t.drop("item", "source_file", "date_key", "subitem", "container", "block_k", "row_pos")
    return body.withColumn("column_order", F.lit(",".join(body.columns)))
