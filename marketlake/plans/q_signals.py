"""Registered signal queries (W1-W6, J8, J9, A11, L1, L4) over the panel F1."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import signals as sig
from .fixtures import entity_day_panel
from .registry import register

PANEL_CTE = """
panel AS (
  SELECT CAST(user_id AS VARCHAR) AS code, CAST(ts AS DATE) AS date,
         SUM(CAST(value AS DECIMAL(18,2))) AS value, COUNT(*) AS n_events
  FROM events GROUP BY 1, 2)
"""

TOP_CTE = """
tot AS (SELECT code, SUM(n_events) AS weight FROM panel GROUP BY code),
top AS (SELECT code, ROW_NUMBER() OVER (ORDER BY weight DESC, code ASC) AS rank FROM tot
        QUALIFY rank <= {n})
"""

# Date windows used by the registered signal queries.
RANGE_START, RANGE_END = "2024-01-10", "2024-01-20"
REF_START, REF_END = "2024-01-01", "2024-01-05"


def _diff_sql(src: str, cols=("value", "n_events")) -> str:
    lags = ", ".join(f"LAG({c}) OVER (PARTITION BY code ORDER BY date) AS previous_{c}" for c in cols)
    outs = []
    for c in cols:
        outs.append(f"CAST(previous_{c} AS DOUBLE) AS previous_{c}" if c == "value" else f"previous_{c}")
        outs.append(f"CAST({c} - previous_{c} AS DOUBLE) AS diff_{c}" if c == "value" else f"{c} - previous_{c} AS diff_{c}")
        outs.append(f"CAST({c} - previous_{c} AS DOUBLE) / NULLIF(CAST(previous_{c} AS DOUBLE), 0) AS diff_percent_{c}")
    return f"""
WITH {PANEL_CTE}, d AS (SELECT *, {lags} FROM {src})
SELECT code, CAST(date AS VARCHAR) AS date, CAST(value AS DOUBLE) AS value, n_events, {", ".join(outs)}
FROM d"""


@register("w1_diff_previous", _diff_sql("panel"))
def w1_diff_previous(spark, base):
    """previous / diff / percent diff of every measure, every entity, every date."""
    return sig.diff_previous(entity_day_panel(spark, base), ["value", "n_events"])


@register("w2_diff_in_range", _diff_sql(f"(SELECT * FROM panel WHERE date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}')"))
def w2_diff_in_range(spark, base):
    """Slice before lag: the first date inside the range has no previous."""
    return sig.diff_for_entities(entity_day_panel(spark, base), ["value", "n_events"], RANGE_START, RANGE_END)


@register("w3_signal_diff_percent", f"""
WITH {PANEL_CTE}, d AS (SELECT code, date, value, LAG(value) OVER (PARTITION BY code ORDER BY date) AS p FROM panel)
SELECT code, CAST(date AS VARCHAR) AS date,
       CAST(value - p AS DOUBLE) / NULLIF(CAST(p AS DOUBLE), 0) AS value FROM d""")
def w3_signal_diff_percent(spark, base):
    return sig.build_signal(entity_day_panel(spark, base), "value", "diff_percent")


@register("w3_signal_previous", f"""
WITH {PANEL_CTE}
SELECT code, CAST(date AS VARCHAR) AS date,
       CAST(LAG(value) OVER (PARTITION BY code ORDER BY date) AS DOUBLE) AS value
FROM panel WHERE date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'""")
def w3_signal_previous(spark, base):
    return sig.build_signal(entity_day_panel(spark, base), "value", "previous", RANGE_START, RANGE_END)


@register("l1_slice_top_entities", f"""
WITH {PANEL_CTE}, {TOP_CTE.format(n=3)}
SELECT p.code, CAST(p.date AS VARCHAR) AS date, CAST(p.value AS DOUBLE) AS value, p.n_events
FROM panel p JOIN top USING (code)
WHERE p.date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'""")
def l1_slice_top_entities(spark, base):
    """Closed date-range slice of the three busiest entities (top-k report)."""
    panel = entity_day_panel(spark, base)
    top = sig.top_entities(panel, 3)
    return sig.slice_range(panel, RANGE_START, RANGE_END).join(F.broadcast(top.select("code")), "code")


@register("j8_align_top_pair", f"""
WITH {PANEL_CTE}, {TOP_CTE.format(n=2)},
s AS (SELECT code, date, CAST(value - LAG(value) OVER (PARTITION BY code ORDER BY date) AS DOUBLE) AS v FROM panel),
a AS (SELECT s.* FROM s JOIN top USING (code) WHERE rank = 1),
b AS (SELECT s.* FROM s JOIN top USING (code) WHERE rank = 2)
SELECT CAST(COALESCE(a.date, b.date) AS VARCHAR) AS date, a.code AS a_code, a.v AS a_value,
       b.code AS b_code, b.v AS b_value
FROM a FULL OUTER JOIN b ON a.date = b.date
WHERE a.v IS NOT NULL OR b.v IS NOT NULL""")
def j8_align_top_pair(spark, base):
    """Daily change of the two busiest entities aligned on date (outer)."""
    panel = entity_day_panel(spark, base)
    top = sig.top_entities(panel, 2)
    pair = top.agg(F.max(F.when(F.col("rank") == 1, F.col("code"))).alias("a_code"),
                   F.max(F.when(F.col("rank") == 2, F.col("code"))).alias("b_code"))
    return sig.align_pair_ranked(panel, pair, "value", "diff")


@register("j9_align_indicators", f"""
WITH {PANEL_CTE},
d AS (SELECT code, date,
        CAST(value - LAG(value) OVER (PARTITION BY code ORDER BY date) AS DOUBLE) AS value,
        n_events - LAG(n_events) OVER (PARTITION BY code ORDER BY date) AS n_events FROM panel)
SELECT code, CAST(date AS VARCHAR) AS date, value, n_events FROM d
WHERE value IS NOT NULL OR n_events IS NOT NULL""")
def j9_align_indicators(spark, base):
    """Both indicators' daily change per entity, all-null rows dropped."""
    return sig.align_indicators(entity_day_panel(spark, base), ["value", "n_events"], "diff")


@register("a11_reference_sum", f"""
WITH {PANEL_CTE}
SELECT code, CAST(SUM(value) AS DOUBLE) AS reference_sum, COUNT(*) AS reference_rows
FROM panel WHERE date BETWEEN DATE '{REF_START}' AND DATE '{REF_END}' GROUP BY code""")
def a11_reference_sum(spark, base):
    return sig.reference_sum(entity_day_panel(spark, base), "value", REF_START, REF_END)


def _cum_sql(start: str, threshold, end: str | None, direction: str, thr_expr: str | None = None,
             entities: str = "(SELECT DISTINCT code FROM panel)", extra_cte: str = "",
             extra_select: str = "", extra_join: str = "") -> str:
    fwd = direction == "forward"
    cond = f"date >= DATE '{start}'" if fwd else f"date <= DATE '{start}'"
    if end is not None:
        cond += f" AND date <= DATE '{end}'" if fwd else f" AND date >= DATE '{end}'"
    order = "date ASC" if fwd else "date DESC"
    thr = thr_expr if thr_expr is not None else (str(threshold) if threshold is not None else None)
    hit = f"MIN(rn) FILTER (WHERE value IS NOT NULL AND cum >= {thr})" if thr is not None else "CAST(NULL AS BIGINT)"
    fallback = "end_date" if end is not None else "exhausted"
    return f"""
WITH {PANEL_CTE}{extra_cte},
r AS (SELECT p.code, p.date, p.value,
        SUM(COALESCE(p.value, 0)) OVER (PARTITION BY p.code ORDER BY p.{order}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
        ROW_NUMBER() OVER (PARTITION BY p.code ORDER BY p.{order}) AS rn
      FROM panel p {extra_join} WHERE p.{cond}),
h AS (SELECT code, {hit} AS hit_rn, MAX(rn) AS last_rn FROM r GROUP BY code),
res AS (SELECT h.code, COALESCE(rh.date, rl.date) AS stop_date,
               CAST(COALESCE(rh.cum, rl.cum) AS DOUBLE) AS cumulative,
               CASE WHEN rh.rn IS NOT NULL THEN 'threshold' ELSE '{fallback}' END AS reason
        FROM h LEFT JOIN r rh ON rh.code = h.code AND rh.rn = h.hit_rn
               JOIN r rl ON rl.code = h.code AND rl.rn = h.last_rn)
SELECT e.code, CAST(res.stop_date AS VARCHAR) AS stop_date, COALESCE(res.cumulative, 0.0) AS cumulative,
       COALESCE(res.reason, 'exhausted') AS reason{extra_select}
FROM {entities} e LEFT JOIN res USING (code)"""


@register("w4_cumulative_forward", _cum_sql("2024-01-05", 150, None, "forward"))
def w4_cumulative_forward(spark, base):
    panel = entity_day_panel(spark, base)
    return sig.cumulative_to_threshold(panel, "value", "2024-01-05", 150, None, "forward", entities=panel)


@register("w4_cumulative_backward_end", _cum_sql("2024-01-25", 300, "2024-01-15", "backward"))
def w4_cumulative_backward_end(spark, base):
    panel = entity_day_panel(spark, base)
    return sig.cumulative_to_threshold(panel, "value", "2024-01-25", 300, "2024-01-15", "backward", entities=panel)


@register("w4_cumulative_end_only", _cum_sql("2024-01-12", None, "2024-01-18", "forward"))
def w4_cumulative_end_only(spark, base):
    panel = entity_day_panel(spark, base)
    return sig.cumulative_to_threshold(panel, "value", "2024-01-12", None, "2024-01-18", "forward", entities=panel)


_REF_CTE = f""",
ref AS (SELECT code, SUM(value) AS reference_sum, COUNT(*) AS reference_rows FROM panel
        WHERE date BETWEEN DATE '{REF_START}' AND DATE '{REF_END}' GROUP BY code)"""


@register("w5_match_reference_period", _cum_sql(
    REF_END, None, None, "forward", thr_expr="reference_sum", entities="ref",
    extra_cte=_REF_CTE, extra_select=", CAST(e.reference_sum AS DOUBLE) AS reference_sum, e.reference_rows",
    extra_join="JOIN ref ON ref.code = p.code").replace(
        "MIN(rn) FILTER (WHERE value IS NOT NULL AND cum >= reference_sum)",
        "MIN(rn) FILTER (WHERE value IS NOT NULL AND cum >= reference_sum)").replace(
        "SELECT p.code, p.date, p.value,", "SELECT p.code, p.date, p.value, ref.reference_sum,"))
def w5_match_reference_period(spark, base):
    """Per entity: from the reference end (inclusive) forward until the
    reference-period sum is matched again."""
    return sig.match_reference_period(entity_day_panel(spark, base), "value", REF_START, REF_END)


@register("w6_compare_top_pair", _cum_sql(
    "2024-01-10", 100, None, "forward", entities="top",
    extra_cte=",\n" + TOP_CTE.format(n=2), extra_join="JOIN top t ON t.code = p.code"))
def w6_compare_top_pair(spark, base):
    """Threshold dates of the two busiest entities, one row each."""
    panel = entity_day_panel(spark, base)
    top = sig.top_entities(panel, 2)
    return sig.compare_threshold_dates(panel, "value", top, 100, "2024-01-10")
