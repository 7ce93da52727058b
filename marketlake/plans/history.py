"""Monthly single-security history assembly.

Monthly documents are scanned together (one plan, no per-month loop); a
document without ``fields`` uses the default header.  Minguo dates become ISO
text (N4), rows outside [start, end] are dropped, numbers are parsed (N3) and
the sign column is merged into the change (N5).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def month_keys(start: str, end: str):
    """The months a date range touches, as a column of 'yyyyMM' keys."""
    return F.transform(F.sequence(F.trunc(F.to_date(F.lit(start)), "MM"), F.trunc(F.to_date(F.lit(end)), "MM"),
                                  F.expr("INTERVAL 1 MONTH")), lambda m: F.date_format(m, "yyyyMM"))


def assemble_history(docs: DataFrame, start: str, end: str, default_header: Sequence[str],
                     date_col: str = "日期", int_cols: Sequence[str] = (), float_cols: Sequence[str] = (),
                     sign: tuple[str, str] | None = None, symbol_path: str = "$.crawlerdic.payload.stockNo",
                     month_path: str = "$.crawlerdic.payload.date") -> DataFrame:
    """docs: S1 output of monthly documents.  Months outside [start, end] are
    skipped before their rows are exploded."""
    wanted = month_keys(start, end)
    d = docs.select(
        "source_file",
        F.try_variant_get("doc", symbol_path, "string").alias("symbol"),
        F.substring(F.try_variant_get("doc", month_path, "string"), 1, 6).alias("ym"),
        F.coalesce(F.try_variant_get("doc", "$.fields", "array<string>"),
                   F.array(*[F.lit(h) for h in default_header])).alias("header"),
        F.try_variant_get("doc", "$.data", "array<array<string>>").alias("data"))
    d = d.where(F.array_contains(wanted, F.col("ym")))
    rows = d.select("source_file", "symbol", "header", F.posexplode("data").alias("row_pos", "row"))
    cols = {h: F.get(F.col("row"), F.array_position("header", F.lit(h)).cast("int") - 1) for h in default_header}
    t = rows.select("source_file", "symbol", "row_pos", *[c.alias(h) for h, c in cols.items()])
    t = t.withColumn(date_col, S.minguo_to_iso_text(F.col(date_col)))
    t = t.where((F.col(date_col) >= F.lit(start)) & (F.col(date_col) <= F.lit(end)))
    casts = {c: S.parse_number(c, "bigint") for c in int_cols}
    casts.update({c: S.parse_number(c, "double") for c in float_cols})
    t = t.withColumns(casts)
    if sign:
        value, sign_col = sign
        t = t.withColumn(value, S.apply_sign(F.col(value), F.col(sign_col))).drop(sign_col)
    front = [date_col, "symbol"]
    return t.select(*front, *[c for c in t.columns if c not in front])
