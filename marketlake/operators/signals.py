"""Time-series signals over an entity-day panel.

The panel is unique on (code, date), so a window partition holds at most one
row per calendar day of one entity: its size is bounded by the calendar, not
by the data volume, and a hot entity cannot produce a skewed window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("raw", "previous", "diff", "diff_percent")
REASON_THRESHOLD, REASON_END, REASON_EXHAUSTED = "threshold", "end_date", "exhausted"


def _date(x) -> Column:
    return F.to_date(F.lit(x)) if not isinstance(x, Column) else x


# L1 ----------------------------------------------------------------------
def slice_range(df: DataFrame, start=None, end=None, codes: Sequence[str] | None = None,
                code_col: str = "code", date_col: str = "date") -> DataFrame:
    """Entity + closed date-range slice; both ends inclusive.  Stays a scan filter."""
    cond = F.lit(True)
    if codes is not None:
        cond = cond & F.col(code_col).isin(list(codes))
    if start is not None:
        cond = cond & (F.col(date_col) >= _date(start))
    if end is not None:
        cond = cond & (F.col(date_col) <= _date(end))
    return df.where(cond)


# W1 ----------------------------------------------------------------------
def diff_previous(df: DataFrame, value_cols: Sequence[str], code_col: str = "code",
                  date_col: str = "date", percent: bool = True) -> DataFrame:
    """previous_c, diff_c and (optionally) diff_percent_c for every column present.

    previous = value of the same entity at its preceding date; rows with a
    NULL entity have no predecessor.  diff_percent = diff / previous as a
    DOUBLE, NULL when previous is 0 or NULL.
    """
    w = Window.partitionBy(code_col).orderBy(date_col)
    present = [c for c in value_cols if c in df.columns]
    out = {}
    for c in present:
        prev = F.when(F.col(code_col).isNotNull(), F.lag(c).over(w))
        out[f"previous_{c}"] = prev
        out[f"diff_{c}"] = F.col(c) - prev
    df = df.withColumns(out)
    if percent:
        df = df.withColumns({
            f"diff_percent_{c}": F.try_divide(F.col(f"diff_{c}").cast("double"),
                                              F.nullif(F.col(f"previous_{c}").cast("double"), F.lit(0.0)))
            for c in present})
    return df


# W2 ----------------------------------------------------------------------
def diff_for_entities(df: DataFrame, value_cols: Sequence[str], start=None, end=None,
                      codes: Sequence[str] | None = None, percent: bool = True) -> DataFrame:
    """Slice first, then lag: the first row inside the range has no previous."""
    return diff_previous(slice_range(df, start, end, codes), value_cols, percent=percent)


# W3 ----------------------------------------------------------------------
def signal_column(value_col: str, mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    return {"raw": value_col, "previous": f"previous_{value_col}", "diff": f"diff_{value_col}",
            "diff_percent": f"diff_percent_{value_col}"}[mode]


def build_signal(df: DataFrame, value_col: str, mode: str = "diff", start=None, end=None,
                 codes: Sequence[str] | None = None) -> DataFrame:
    """(code, date, value) of one signal, slice before lag."""
    target = signal_column(value_col, mode)
    if value_col not in df.columns:
        raise KeyError(f"column {target} is not produced for this table")
    d = diff_for_entities(df, [value_col], start, end, codes)
    return d.select("code", "date", F.col(target).alias("value"))


# J8 ----------------------------------------------------------------------
def align_pair(df: DataFrame, code_a: Column | str, code_b: Column | str, value_col: str,
               mode: str = "diff", start=None, end=None) -> DataFrame:
    """Outer alignment of two entities' signals on date; all-null rows dropped.

    ``code_a`` / ``code_b`` may be literals or single-row columns derived by
    Spark (e.g. from a ranking); output columns are ``a_value``, ``b_value``.
    """
    sig = build_signal(df, value_col, mode, start, end)
    a = sig.where(F.col("code") == (F.lit(code_a) if isinstance(code_a, str) else code_a))
    b = sig.where(F.col("code") == (F.lit(code_b) if isinstance(code_b, str) else code_b))
    out = (a.select("date", F.col("code").alias("a_code"), F.col("value").alias("a_value"))
            .join(b.select("date", F.col("code").alias("b_code"), F.col("value").alias("b_value")),
                  "date", "full_outer"))
    return out.dropna(how="all", subset=["a_value", "b_value"])


def align_pair_ranked(df: DataFrame, pair: DataFrame, value_col: str, mode: str = "diff",
                      start=None, end=None) -> DataFrame:
    """Like ``align_pair`` with the two codes given by a one-row frame (a_code, b_code).

    Only the pair's rows enter the lag; the two sides meet in one aggregation
    by date (each code has one row a date)."""
    side = F.broadcast(pair.limit(1).select(F.explode(F.array(
        F.struct(F.lit("a").alias("side"), F.col("a_code").alias("code")),
        F.struct(F.lit("b").alias("side"), F.col("b_code").alias("code")))).alias("s")).select("s.*"))
    codes = side.groupBy("code").agg(F.collect_list("side").alias("sides"))
    signal = build_signal(df.join(F.broadcast(codes).drop("sides"), "code", "left_semi"), value_col, mode, start, end)
    signal = signal.join(F.broadcast(codes), "code")

    def of(side_name: str, c: str) -> Column:
        return F.max(F.when(F.array_contains("sides", side_name), F.col(c)))
    out = signal.groupBy("date").agg(of("a", "code").alias("a_code"), of("a", "value").alias("a_value"),
                                     of("b", "code").alias("b_code"), of("b", "value").alias("b_value"))
    return out.dropna(how="all", subset=["a_value", "b_value"])


def align_entities_wide(df: DataFrame, codes: Sequence[str], value_col: str, mode: str = "diff",
                        start=None, end=None) -> DataFrame:
    """n-entity alignment: one scan, pivot on the given codes (date, <code>...)."""
    sig = build_signal(df, value_col, mode, start, end, codes)
    wide = sig.groupBy("date").pivot("code", list(codes)).agg(F.first("value"))
    return wide.dropna(how="all", subset=list(codes))


# J9 ----------------------------------------------------------------------
def align_indicators(df: DataFrame, value_cols: Sequence[str], mode: str = "diff", start=None, end=None,
                     codes: Sequence[str] | None = None) -> DataFrame:
    """Several indicators of the same entity side by side; no join needed."""
    for c in value_cols:
        if c not in df.columns:
            raise KeyError(f"column {c} is not in the table")
    d = diff_for_entities(df, value_cols, start, end, codes)
    cols = [F.col(signal_column(c, mode)).alias(c) for c in value_cols]
    return d.select("code", "date", *cols).dropna(how="all", subset=list(value_cols))


# A11 ---------------------------------------------------------------------
def reference_sum(df: DataFrame, value_col: str, start, end, strict: bool = False) -> DataFrame:
    """Per entity: sum over the closed range (NULLs skipped) and row count.

    With ``strict`` an empty range raises, as the single-series matcher does.
    """
    out = (slice_range(df, start, end).groupBy("code")
           .agg(F.sum(value_col).alias("reference_sum"), F.count(F.lit(1)).alias("reference_rows")))
    if strict and out.isEmpty():
        raise ValueError("the reference range holds no rows")
    return out


# W4 ----------------------------------------------------------------------
def cumulative_to_threshold(df: DataFrame, value_col: str, start_date, threshold=None, end_date=None,
                            direction: str = "forward", entities: DataFrame | None = None,
                            threshold_col: str | None = None) -> DataFrame:
    """Per entity: (stop_date, cumulative, reason).

    forward: dates >= start ascending (<= end); backward: dates <= start
    descending (>= end).  NULL values are skipped.  The first running sum >=
    threshold stops with 'threshold'; otherwise the last row of the range
    (NULL values included) with 'end_date' when an end was given, else
    'exhausted'.  An entity without rows gets (NULL, 0.0, 'exhausted') when
    ``entities`` lists it.  ``threshold_col`` names a per-entity threshold.
    """
    if threshold is None and end_date is None and threshold_col is None:
        raise ValueError("give a threshold or an end date")
    if direction not in ("forward", "backward"):
        raise ValueError("direction must be 'forward' or 'backward'")
    fwd = direction == "forward"
    d = F.col("date")
    start = _date(start_date)
    cond = (d >= start) if fwd else (d <= start)
    if end_date is not None:
        cond = cond & ((d <= _date(end_date)) if fwd else (d >= _date(end_date)))
    rows = df.where(cond)
    if threshold_col is not None:
        rows = rows.join(entities.select("code", threshold_col), "code")
    order = d.asc() if fwd else d.desc()
    w = Window.partitionBy("code").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    kind = df.schema[value_col].dataType
    v = F.col(value_col).cast(f"decimal(38,{kind.scale})" if isinstance(kind, T.DecimalType) else "double")
    rows = rows.withColumn("_cum", F.sum(F.coalesce(v, F.lit(0))).over(w))
    rows = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("code").orderBy(order)))
    t = F.col(threshold_col) if threshold_col is not None else (F.lit(threshold) if threshold is not None else None)
    hit = (F.col(value_col).isNotNull() & (F.col("_cum") >= t)) if t is not None else F.lit(False)
    agg = (rows.groupBy("code")
               .agg(F.min_by(F.struct(d.alias("date"), F.col("_cum").alias("cum")),
                             F.when(hit, F.col("_rn"))).alias("hit"),
                    F.max_by(F.struct(d.alias("date"), F.col("_cum").alias("cum")), F.col("_rn")).alias("last")))
    # min_by ignores rows whose ordering value is NULL, so "hit" is the first qualifying row
    hit_found = F.col("hit").isNotNull() & F.col("hit.date").isNotNull()
    res = agg.select(
        "code",
        F.when(hit_found, F.col("hit.date")).otherwise(F.col("last.date")).alias("stop_date"),
        F.when(hit_found, F.col("hit.cum")).otherwise(F.col("last.cum")).cast("double").alias("cumulative"),
        F.when(hit_found, F.lit(REASON_THRESHOLD))
         .otherwise(F.lit(REASON_END if end_date is not None else REASON_EXHAUSTED)).alias("reason"))
    if entities is not None:
        res = (entities.select("code").distinct().join(res, "code", "left")
               .select("code", "stop_date",
                       F.coalesce("cumulative", F.lit(0.0)).alias("cumulative"),
                       F.coalesce("reason", F.lit(REASON_EXHAUSTED)).alias("reason")))
    return res


# W5 ----------------------------------------------------------------------
def match_reference_period(df: DataFrame, value_col: str, ref_start, ref_end, start_date=None,
                           direction: str = "forward", threshold=None, end_date=None) -> DataFrame:
    """Threshold defaults to each entity's reference-period sum; start to the
    reference end (inclusive)."""
    ref = reference_sum(df, value_col, ref_start, ref_end)
    start = ref_end if start_date is None else start_date
    if threshold is not None:
        return cumulative_to_threshold(df, value_col, start, threshold, end_date, direction, entities=ref)
    res = cumulative_to_threshold(df, value_col, start, None, end_date, direction,
                                  entities=ref, threshold_col="reference_sum")
    return res.join(ref, "code", "left")


# W6 ----------------------------------------------------------------------
def compare_threshold_dates(df: DataFrame, value_col: str, codes: DataFrame, threshold, start_date,
                            direction: str = "forward") -> DataFrame:
    """W4 for several entities in one plan; one row per entity."""
    sub = df.join(codes.select("code"), "code", "left_semi")  # any number of codes
    return cumulative_to_threshold(sub, value_col, start_date, threshold, None, direction, entities=codes)


def top_entities(df: DataFrame, n: int, weight_col: str = "n_events") -> DataFrame:
    """Top-n entities by total weight (ties by code) with their rank: a top-k report."""
    tot = df.groupBy("code").agg(F.sum(weight_col).alias("weight"))
    return (tot.orderBy(F.desc("weight"), F.asc("code")).limit(n)
               .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("weight"), F.asc("code")))))
