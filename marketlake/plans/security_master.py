"""Security master (D7, N11, U5): listing pages -> one table of securities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import catalog
from ..functions import scalars as S
from ..operators import store as st
from ..sources.pages import scan_listing_pages


def _map(d: dict):
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def build_security_master(pages: DataFrame, rename: dict | None = None, slices: dict | None = None) -> DataFrame:
    """S6 -> P1 rename -> N2 (U+3000 removed from every cell) -> N11 code
    slice by market model -> one frame for every model.

    Output columns are the renamed listing headers (only their distinct names reach the
    driver, in the order of the least header that has them) plus model, 代號, page_id, row_no.
    """
    rename = catalog.GLOBAL_RENAME if rename is None else rename
    slices = catalog.ISIN_CODE_SLICE if slices is None else slices
    # the pages are parsed once; headers and cells are then read from this table
    path = st.scratch_path(pages.sparkSession, "listing")
    parsed = scan_listing_pages(pages)
    parsed.write.parquet(path)
    rows = pages.sparkSession.read.schema(parsed.schema).parquet(path)
    rows = rows.withColumn("header", F.transform("header", lambda h: F.coalesce(F.try_element_at(_map(rename), h), h)))
    places = rows.select("header").distinct().select("header", F.posexplode("header").alias("at", "name"))
    first = places.groupBy("name").agg(F.min(F.struct("header", "at")).alias("first"))
    names = [r["name"] for r in first.orderBy("first").select("name").collect()]
    cells = [S.strip_ideographic_space(F.get(F.col("cells"), F.array_position("header", F.lit(c)).cast("int") - 1)).alias(c)
             for c in names]
    model = F.regexp_extract("url", r"strMode=(\d+)", 1).try_cast("int")
    out = rows.select("page_id", "row_no", model.alias("model"), *cells)
    if "ISINCode" in names:
        start = F.try_element_at(_map({k: v[0] for k, v in slices.items()}), F.col("model"))
        stop = F.try_element_at(_map({k: v[1] for k, v in slices.items()}), F.col("model"))
        out = out.withColumn("代號", F.when(start.isNotNull(), S.slice_code(F.col("ISINCode"), start, stop)))
    return out


def renew_master(old: DataFrame | None, new: DataFrame, key: str = "ISINCode") -> DataFrame:
    """New rows overwrite old ones by key; no old list -> new only; a crawl without any listing changes nothing."""
    if old is not None and set(new.columns) <= {"page_id", "row_no", "model"}:  # no header was seen
        return old
    return st.upsert(old, new, [key])
