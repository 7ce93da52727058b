"""Work calendar, status matrix and key quality.

The status matrix is kept long - (date, item, status) - and only pivoted for
display; every operation is a filter, join or group-by on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S

MONTH_END = "ME"


def _d(x) -> Column:
    return x if isinstance(x, Column) else F.to_date(F.lit(x))


# C1 ------------------------------------------------------------------------
def scaffold(expected: DataFrame, today, status: str = S.OUTCOME_WAIT, start: Column | None = None) -> DataFrame:
    """Calendar x dataset cells from each dataset's first date (or ``start``)
    to ``today``; month-end datasets only on month ends.  ``today`` may be a
    literal or a column (e.g. joined from a one-row frame)."""
    first = start if start is not None else F.col("datemin")
    days = F.sequence(first, _d(today), F.expr("INTERVAL 1 DAY"))
    cells = (expected.where(first.isNotNull() & (first <= _d(today)))
             .select("item", "freq", F.explode(days).alias("date")))
    keep = (F.col("freq") != MONTH_END) | (F.last_day("date") == F.col("date"))
    return cells.where(keep).select("date", "item", F.lit(status).alias("status"))


# C2 ------------------------------------------------------------------------
def extend_scaffold(existing: DataFrame, expected: DataFrame, today) -> DataFrame:
    """Cells from each dataset's last known date + 1 (else its first date) to today."""
    last = existing.groupBy("item").agg(F.max("date").alias("_last"))
    e = expected.join(last, "item", "left")
    start = F.coalesce(F.date_add("_last", 1), F.col("datemin"))
    new = scaffold(e.withColumn("_start", start), today, start=F.col("_start"))
    return existing.unionByName(new)


# C3 ------------------------------------------------------------------------
def mark_present(cells: DataFrame, present: DataFrame, status: str = S.OUTCOME_SUCCEED) -> DataFrame:
    """Cells that already have a landed file become ``status``."""
    p = present.select("date", "item").distinct().withColumn("_found", F.lit(True))
    return (cells.join(p, ["date", "item"], "left")
                 .withColumn("status", F.when(F.col("_found"), F.lit(status)).otherwise(F.col("status")))
                 .drop("_found"))


# L6 ------------------------------------------------------------------------
def work_queue(cells: DataFrame, statuses: Sequence[str] = (S.OUTCOME_WAIT,)) -> DataFrame:
    """Remaining cells; error cells are not retried unless listed."""
    return cells.where(F.col("status").isin(list(statuses)))


# P7 ------------------------------------------------------------------------
def to_wide(cells: DataFrame, items: Sequence[str], index: str = "date") -> DataFrame:
    return cells.groupBy(index).pivot("item", list(items)).agg(F.first("status"))


def to_long(wide: DataFrame, index: str = "date", items: Sequence[str] | None = None) -> DataFrame:
    cols = list(items) if items is not None else [c for c in wide.columns if c != index]
    return wide.unpivot([index], cols, "item", "status").where(F.col("status").isNotNull())


# N14 / Q1 / Q2 ----------------------------------------------------------------
def label_checks(log: DataFrame, label_col: str = "label") -> DataFrame:
    """Per distinct label: nan-like, normalised key, strict validity."""
    lab = F.col(label_col)
    return log.select(label_col).distinct().select(
        label_col, S.is_nan_like(lab).alias("nan_like"), S.normalize_key(lab).alias("key"),
        S.is_valid_key(lab).alias("valid_key"))


def key_problems(log: DataFrame, label_col: str = "label", item_col: str = "item") -> DataFrame:
    """Q1 labels: (label, key, n_rows, bad, duplicated).

    The rows of the wide matrix are its labels; a label stands there as often
    as its most frequent (label, item) cell is repeated."""
    cells = log.groupBy(label_col, item_col).agg(F.count(F.lit(1)).alias("_n"))
    per = cells.groupBy(label_col).agg(F.max("_n").alias("n_rows"))
    key = S.normalize_key(F.col(label_col))
    return per.select(label_col, key.alias("key"), "n_rows", key.isNull().alias("bad"), (F.col("n_rows") > 1).alias("duplicated"))


def key_audit(log: DataFrame, label_col: str = "label", item_col: str = "item") -> DataFrame:
    """Q1: matrix rows in all, with an unparsable label, with a repeated label; keys that several labels share.

    The labels themselves are rows of ``key_problems``."""
    rows = key_problems(log, label_col, item_col)
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    per_key = rows.groupBy("key").agg(
        F.sum("n_rows").alias("total"), F.sum(F.when(F.col("bad"), F.col("n_rows"))).alias("bad"),
        F.sum(F.when(F.col("duplicated"), F.col("n_rows"))).alias("dup"), F.count(F.lit(1)).alias("labels"))
    return per_key.agg(count("total").alias("total"), count("bad").alias("bad_count"),
                       count("dup").alias("duplicate_count"),
                       F.count_if(F.col("key").isNotNull() & (F.col("labels") > 1)).alias("n_key_collisions"))


def normalize_labels(log: DataFrame, label_col: str = "label") -> DataFrame:
    """Q2 normalize_index: parsable labels -> 'YYYY-MM-DD', others unchanged; plus a changed flag."""
    key = S.normalize_key(F.col(label_col))
    return log.withColumn("orig_label", F.col(label_col)) \
              .withColumn(label_col, F.coalesce(key, F.col(label_col))) \
              .withColumn("changed", F.col(label_col) != F.col("orig_label"))


def list_invalid_labels(log: DataFrame, label_col: str = "label", item_col: str = "item",
                        status_col: str = "status") -> DataFrame:
    """Q2 list_invalid_index: labels that are not valid 'yyyy-mm-dd' text, with
    the datasets still waiting on them; invalid kinds first."""
    lab = F.col(label_col)
    is_str = lab.isNotNull()
    m = S.matches_ymd(lab)
    valid = m & S.is_valid_key(lab)
    waits = F.array_join(F.array_sort(F.collect_set(F.when(F.col(status_col) == S.OUTCOME_WAIT, F.col(item_col)))), ",")
    rep = log.groupBy(label_col).agg(waits.alias("wait_cols"))
    rep = rep.select(label_col,
                     F.when(is_str, F.concat(F.lit("'"), lab, F.lit("'"))).otherwise(F.lit("nan")).alias("label_repr"),
                     F.when(is_str, F.lit("str")).otherwise(F.lit("float")).alias("type"),
                     is_str.alias("is_str"), m.alias("matches_ymd"), valid.alias("valid_date"), "wait_cols")
    return (rep.where(~(F.col("is_str") & F.col("matches_ymd") & F.col("valid_date")))
            .orderBy("is_str", "matches_ymd", "valid_date", "label_repr"))


def delete_labels(log: DataFrame, labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Q2 delete_labels: rows whose label equals a given label or its key;
    a NaN-like given label removes every unparsable label."""
    given = labels.select(F.col(label_col).alias("_g"))
    keys = given.select(F.coalesce(S.normalize_key(F.col("_g")), F.col("_g")).alias("_g"))
    drop_bad = given.where(S.is_nan_like(F.col("_g"))).limit(1).withColumn("_bad", F.lit(True)).select("_bad")
    to_drop = given.unionByName(keys).distinct()
    out = log.join(to_drop, log[label_col].eqNullSafe(to_drop["_g"]), "left_anti")
    drop_bad = drop_bad.agg(F.count(F.lit(1)).alias("_bad"))  # one row
    flagged = out.crossJoin(F.broadcast(drop_bad))
    return flagged.where(~((F.col("_bad") > 0) & S.normalize_key(F.col(label_col)).isNull())).drop("_bad")


def delete_bad_labels(log: DataFrame, label_col: str = "label") -> DataFrame:
    return log.where(S.normalize_key(F.col(label_col)).isNotNull())


def rename_label(log: DataFrame, old_label: str, new_key: str, label_col: str = "label",
                 overwrite: bool = False) -> DataFrame:
    """Q2 rename_label: the target must be a valid key; an existing target
    needs ``overwrite`` (checked with a one-row probe)."""
    import re
    import datetime as _dt
    if not re.match(r"^\d{4}-\d{2}-\d{2}$", new_key or ""):
        raise ValueError(f"not a valid 'YYYY-MM-DD' key: {new_key!r}")
    _dt.date.fromisoformat(new_key)
    lab = F.col(label_col)
    candidates = [lab == F.lit(old_label), lab == S.normalize_key(F.lit(old_label))]
    hit = next((c for c in candidates if not log.where(c).isEmpty()), None)
    if hit is None and (old_label is None or old_label.strip().lower() in ("", "nan", "nat")):
        # a NaN-like label names the only unparsable one
        bad = log.select(lab).distinct().where(S.normalize_key(lab).isNull()).limit(2).collect()
        if len(bad) > 1:
            raise KeyError("several unparsable labels; name one")
        hit = lab.eqNullSafe(F.lit(bad[0][0])) if bad else None
    if hit is None:
        raise KeyError(f"label not found: {old_label!r}")
    hit = F.coalesce(hit, F.lit(False))
    if not overwrite and not log.where(lab == F.lit(new_key)).isEmpty():
        raise KeyError(f"target label exists: {new_key!r}")
    kept = log.where(~hit & ~F.coalesce(lab == F.lit(new_key), F.lit(False))) if overwrite else log.where(~hit)
    return kept.unionByName(log.where(hit).withColumn(label_col, F.lit(new_key)))


def show_rows(log: DataFrame, labels: Sequence[str], label_col: str = "label") -> DataFrame:
    """Rows of the given labels; a label that no row bears as it stands is matched by its normalised key."""
    spark = log.sparkSession
    g = spark.createDataFrame([(x,) for x in labels], "_g string")
    g = g.select("_g", S.normalize_key(F.col("_g")).alias("_gk"))
    borne = log.select(F.col(label_col).alias("_g"), F.lit(True).alias("_raw")).distinct()
    sought = g.join(borne, "_g", "left").select(F.when(F.col("_raw"), F.col("_g")).otherwise(F.col("_gk")).alias("_sought"))
    return log.join(sought, log[label_col] == F.col("_sought"), "left_semi")


# Q3 -------------------------------------------------------------------------
def schema_drift(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Expected vs actual type per column (metadata of the plan, no data read)."""
    spark = df.sparkSession
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for f in declared.fields:
        a = actual.get(f.name)
        e = f.dataType.simpleString()
        rows.append((f.name, e, a, "missing" if a is None else ("ok" if a == e else "mismatch")))
    for name, a in actual.items():
        if name not in declared.fieldNames():
            rows.append((name, None, a, "extra"))
    return spark.createDataFrame(rows, "column string, expected string, actual string, state string")


def drift_losses(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Q3: ``schema_drift`` with the rows of each column and how many of them the declared type cannot hold."""
    held = [f for f in declared.fields if f.name in df.columns]
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in held])
    lost = counted.select("_n", F.map_from_arrays(F.array(*[F.lit(f.name) for f in held]), F.array(*[F.col(f.name) for f in held])).alias("_lost"))
    return schema_drift(df, declared).crossJoin(F.broadcast(lost)).select(
        "column", "expected", "actual", "state", F.col("_n").alias("n_rows"),
        F.coalesce(F.try_element_at("_lost", F.col("column")), F.lit(0)).cast("bigint").alias("n_lost"))


def cast_to_declared(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Migrate drifted columns to the declared types (e.g. int -> double,
    date text -> DATE); missing declared columns are added as NULL."""
    cols = []
    for f in declared.fields:
        if f.name in df.columns:
            src = df.schema[f.name].dataType
            c = F.col(f.name)
            if isinstance(f.dataType, T.DateType) and isinstance(src, T.StringType):
                c = S.parse_date_tolerant(c)
            cols.append(c.cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    rest = [F.col(c) for c in df.columns if c not in declared.fieldNames()]
    return df.select(*cols, *rest)
