"""Registered calendar / status / key-quality queries over the event tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import catalog
from ..functions import scalars as S
from ..operators import calendar as cal
from . import fixtures as fx
from .catalog_frames import event_catalogue
from .registry import register

ITEMS = [i for i, *_ in fx.EVENT_CATALOGUE]
PREVIOUS_RUN_END = "2024-01-15"


def expected_with_today(spark, base):
    """Catalogue rows with ``today`` = the last event date (derived from the data)."""
    ex = catalog.expected_items(event_catalogue(spark))
    ev = spark.read.parquet(f"{base}/events.parquet")
    return ex.crossJoin(F.broadcast(ev.agg(F.max(F.to_date("ts")).alias("today"))))  # one row


def status_matrix(spark, base):
    cells = cal.scaffold(expected_with_today(spark, base), F.col("today"))
    return cal.mark_present(cells, fx.present_cells(spark, base))


_CAT_VALUES = ", ".join(f"('{i}', '{f}', TRY_CAST(TRY_STRPTIME('{d}', '%Y-%m-%d') AS DATE))"
                        for i, f, d, _ in fx.EVENT_CATALOGUE)
SCAFFOLD_CTE = f"""
t AS (SELECT MAX(CAST(ts AS DATE)) AS today FROM events),
ex(item, freq, datemin) AS (VALUES {_CAT_VALUES}),
c0 AS (SELECT item, freq, CAST(unnest(generate_series(datemin, today, INTERVAL 1 DAY)) AS DATE) AS date
       FROM ex, t WHERE datemin IS NOT NULL AND datemin <= today),
c AS (SELECT date, item, 'wait' AS status FROM c0 WHERE freq <> 'ME' OR last_day(date) = date),
pres AS (SELECT DISTINCT CAST(ts AS DATE) AS date, event_type AS item FROM events WHERE value >= {fx.PRESENT_MIN_VALUE}),
m AS (SELECT c.date, c.item, CASE WHEN p.item IS NOT NULL THEN 'succeed' ELSE c.status END AS status
      FROM c LEFT JOIN pres p ON c.date = p.date AND c.item = p.item)"""


@register("c1_scaffold", f"WITH {SCAFFOLD_CTE} SELECT CAST(date AS VARCHAR) AS date, item, status FROM c")
def c1_scaffold(spark, base):
    """Expected work: calendar x dataset from each first date to the last event date."""
    return cal.scaffold(expected_with_today(spark, base), F.col("today"))


@register("c2_extend_scaffold", f"""WITH {SCAFFOLD_CTE},
old AS (SELECT * FROM c WHERE date <= DATE '{PREVIOUS_RUN_END}')
SELECT CAST(date AS VARCHAR) AS date, item, status FROM old
UNION ALL
SELECT CAST(c.date AS VARCHAR), c.item, c.status FROM c
LEFT JOIN (SELECT item, MAX(date) AS last FROM old GROUP BY item) l ON c.item = l.item
WHERE c.date > COALESCE(l.last, DATE '1900-01-01')""")
def c2_extend_scaffold(spark, base):
    """An older scaffold (up to the previous run) extended to today."""
    ex = expected_with_today(spark, base)
    old = cal.scaffold(ex, F.to_date(F.lit(PREVIOUS_RUN_END)))
    return cal.extend_scaffold(old, ex, F.col("today"))


@register("c3_status_matrix", f"WITH {SCAFFOLD_CTE} SELECT CAST(date AS VARCHAR) AS date, item, status FROM m")
def c3_status_matrix(spark, base):
    """Scaffold cells with a landed file marked 'succeed'."""
    return status_matrix(spark, base)


@register("l6_work_queue", f"WITH {SCAFFOLD_CTE} SELECT CAST(date AS VARCHAR) AS date, item, status FROM m WHERE status = 'wait'")
def l6_work_queue(spark, base):
    return cal.work_queue(status_matrix(spark, base))


@register("p7_status_wide", f"""WITH {SCAFFOLD_CTE}
SELECT CAST(date AS VARCHAR) AS date, {", ".join(f"MAX(CASE WHEN item = '{i}' THEN status END) AS {i}" for i in ITEMS)}
FROM m GROUP BY date""")
def p7_status_wide(spark, base):
    """The long status table pivoted to the date x dataset matrix for display."""
    return cal.to_wide(status_matrix(spark, base), ITEMS)


@register("p7_status_roundtrip", f"WITH {SCAFFOLD_CTE} SELECT CAST(date AS VARCHAR) AS date, item, status FROM m")
def p7_status_roundtrip(spark, base):
    """Wide matrix back to long (unpivot) gives the long table again."""
    return cal.to_long(cal.to_wide(status_matrix(spark, base), ITEMS), items=ITEMS)


_KEY_SQL = ("CASE item WHEN 'error' THEN NULL ELSE strftime(d, '%Y-%m-%d') END")
LOG_CTE = f"""
per AS (SELECT CAST(ts AS DATE) AS d, event_type AS item, MAX(value) AS mv FROM events GROUP BY 1, 2),
lg AS (SELECT CASE item WHEN 'click' THEN strftime(d, '%Y-%m-%d') WHEN 'view' THEN strftime(d, '%Y/%m/%d')
                       WHEN 'purchase' THEN strftime(d, '%Y%m%d')
                       WHEN 'signup' THEN CAST(year(d) AS VARCHAR) || '-' || CAST(month(d) AS VARCHAR) || '-' || CAST(day(d) AS VARCHAR)
                       WHEN 'error' THEN year(d) || '年' || month(d) || '月' || day(d) || '日' END AS label,
              item, CASE WHEN mv >= {fx.PRESENT_MIN_VALUE} THEN 'succeed' ELSE 'wait' END AS status,
              {_KEY_SQL} AS key, d FROM per)"""


# the waiting cells a second time: labels that stand in several matrix rows
_TWICE_CTE = """
tw AS (SELECT label, item, key FROM lg UNION ALL SELECT label, item, key FROM lg WHERE status = 'wait'),
cell AS (SELECT label, item, ANY_VALUE(key) AS key, COUNT(*) AS n FROM tw GROUP BY label, item),
l AS (SELECT label, ANY_VALUE(key) AS key, MAX(n) AS n_rows FROM cell GROUP BY label)"""


def _log_with_repeats(spark, base):
    log = fx.raw_status_log(spark, base)
    return log.unionByName(log.where("status = 'wait'"))


@register("q1_key_audit", f"""WITH {LOG_CTE}, {_TWICE_CTE}
SELECT CAST(SUM(n_rows) AS BIGINT) AS total, CAST(COALESCE(SUM(n_rows) FILTER (WHERE key IS NULL), 0) AS BIGINT) AS bad_count,
       CAST(COALESCE(SUM(n_rows) FILTER (WHERE n_rows > 1), 0) AS BIGINT) AS duplicate_count,
       (SELECT COUNT(*) FROM (SELECT key FROM l WHERE key IS NOT NULL GROUP BY key HAVING COUNT(*) > 1)) AS n_key_collisions
FROM l""")
def q1_key_audit(spark, base):
    """Matrix rows of a status log in all, with unparsable and with repeated labels, and key collisions."""
    return cal.key_audit(_log_with_repeats(spark, base))


@register("q1_key_problems", f"""WITH {LOG_CTE}, {_TWICE_CTE}
SELECT label, key, n_rows, key IS NULL AS bad, n_rows > 1 AS duplicated FROM l""")
def q1_key_problems(spark, base):
    """The labels behind the audit."""
    return cal.key_problems(_log_with_repeats(spark, base))


@register("q2_invalid_labels", f"""WITH {LOG_CTE}
SELECT label, '''' || label || '''' AS label_repr, 'str' AS type, TRUE AS is_str,
       regexp_matches(label, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AS matches_ymd, FALSE AS valid_date,
       COALESCE(array_to_string(list_sort(list(item) FILTER (WHERE status = 'wait')), ','), '') AS wait_cols
FROM lg WHERE item <> 'click' GROUP BY label""")
def q2_invalid_labels(spark, base):
    """Labels that are not valid 'yyyy-mm-dd' text, with the datasets waiting on them."""
    return cal.list_invalid_labels(fx.raw_status_log(spark, base))


@register("q2_normalized_labels", f"""WITH {LOG_CTE}
SELECT COALESCE(key, label) AS label, item, status, label AS orig_label, COALESCE(key, label) <> label AS changed FROM lg""")
def q2_normalized_labels(spark, base):
    return cal.normalize_labels(fx.raw_status_log(spark, base))


@register("q2_delete_bad_labels", f"WITH {LOG_CTE} SELECT label, item, status FROM lg WHERE key IS NOT NULL")
def q2_delete_bad_labels(spark, base):
    return cal.delete_bad_labels(fx.raw_status_log(spark, base))


@register("q2_delete_given_labels", f"""WITH {LOG_CTE}
SELECT label, item, status FROM lg
WHERE label NOT IN ('2024-01-05', '20240106', '2024-01-06') AND key IS NOT NULL""")
def q2_delete_given_labels(spark, base):
    """Given labels are removed raw and by key; a NaN-like one drops every unparsable label."""
    spark_labels = spark.createDataFrame([("2024-01-05",), ("20240106",), ("nan",)], "label string")
    return cal.delete_labels(fx.raw_status_log(spark, base), spark_labels)


@register("l7_show_rows", f"""WITH {LOG_CTE}
SELECT label, item, status FROM lg WHERE label IN (
  SELECT CASE WHEN g.raw IN (SELECT label FROM lg) THEN g.raw ELSE g.key END
  FROM (VALUES ('2024-01-05', '2024-01-05'), ('20240106', '2024-01-06')) g(raw, key))""")
def l7_show_rows(spark, base):
    """Rows of the given labels, matched raw, else through their normalised key."""
    return cal.show_rows(fx.raw_status_log(spark, base), ["2024-01-05", "20240106"])


@register("n14_label_checks", f"""WITH {LOG_CTE}
SELECT DISTINCT label, FALSE AS nan_like, key, item = 'click' AS valid_key FROM lg""")
def n14_label_checks(spark, base):
    """Per label: NaN-like test, normalised key, strict validity."""
    return cal.label_checks(fx.raw_status_log(spark, base))


_SPELLED = ["%Y-%m-%d", "%Y.%-m.%-d", "%Y%m%d", "%Y-%m-%dT09:08:07", "%Y-%-m-%-d 9:08", "%Y/%m/%dT23:59:59Z", "%b %-d, %Y",
            "%-d %B %Y", "%A, %d %b %Y", "%Y-%b-%d 11:59 PM", "%d.%m.%Y", "%-d/%-m/%Y 08:00"]
_SPELLED_SQL = " UNION ALL ".join(f"SELECT d, {i} AS spelling, strftime(d, '{f}') AS label FROM days" for i, f in enumerate(_SPELLED))


@register("n14_label_spellings", f"""
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), s AS ({_SPELLED_SQL})
SELECT CAST(d AS VARCHAR) AS date, spelling, label,
       CASE WHEN spelling >= {len(_SPELLED) - 2} AND day(d) <= 12 THEN strftime(make_date(year(d), day(d), month(d)), '%Y-%m-%d')
            ELSE strftime(d, '%Y-%m-%d') END AS key FROM s""")
def n14_label_spellings(spark, base):
    """Normalised key of every event day in a dozen spellings: dotted, packed, ISO with time and zone, month names."""
    return fx.spelled_dates(spark, base).withColumn("key", S.normalize_key("label"))


DECLARED_PANEL = T.StructType([T.StructField("code", T.StringType()), T.StructField("date", T.DateType()),
                               T.StructField("value", T.DoubleType()), T.StructField("n_events", T.IntegerType()),
                               T.StructField("note", T.StringType())])


@register("q3_schema_drift", """
WITH p AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events))
SELECT c AS "column", expected, actual, state, n AS n_rows, CAST(0 AS BIGINT) AS n_lost
FROM (VALUES ('code', 'string', 'string', 'ok'), ('date', 'date', 'date', 'ok'),
             ('value', 'double', 'decimal(28,2)', 'mismatch'), ('n_events', 'int', 'bigint', 'mismatch'),
             ('note', 'string', NULL, 'missing')) v(c, expected, actual, state), p""")
def q3_schema_drift(spark, base):
    """Declared vs actual column types of the panel, with the rows that the declared type cannot hold."""
    return cal.drift_losses(fx.entity_day_panel(spark, base), DECLARED_PANEL)


@register("q3_cast_to_declared", """
SELECT CAST(user_id AS VARCHAR) AS code, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value, CAST(COUNT(*) AS INTEGER) AS n_events,
       CAST(NULL AS VARCHAR) AS note
FROM events GROUP BY 1, 2""")
def q3_cast_to_declared(spark, base):
    """The panel migrated to the declared types (missing columns added as NULL)."""
    return cal.cast_to_declared(fx.entity_day_panel(spark, base), DECLARED_PANEL)


@register("q2_renamed_label", f"""WITH {LOG_CTE}
SELECT CASE WHEN label = '2024/01/05' THEN '2023-12-31' ELSE label END AS label, item, status FROM lg""")
def q2_renamed_label(spark, base):
    """A slashed label gets a key that no row bears yet."""
    return cal.rename_label(fx.raw_status_log(spark, base), "2024/01/05", "2023-12-31").select("label", "item", "status")
