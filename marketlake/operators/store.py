"""Keyed store operators: keep-last dedup, upsert, insert-only, write policy,
bucketed sink and the per-file job state (W7, W8, U1-U4, J1-J3, L2, L3, S4, A12).

Keep-last is an aggregation (``max`` of an ordering struct), not a window:
the hash aggregate combines map-side, so a key that holds a third of all rows
is reduced to one row per map task before it is shuffled.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import ensure_checkpoint_dir
from .keyed_log import KeyedLog, child_names, delete_folder, file_system, move_folder

DAILY = "D"
#: spellings of a daily frequency, in any case
DAILY_NAMES = ("D", "1D", "DAY", "DAILY")
JOB_STATE_COLUMNS = ["file", "path", "dir", "hash", "source_mtime", "source_size", "status", "date", "item",
                     "last_processed_at"]


# W7 ----------------------------------------------------------------------
def infer_key(columns: Sequence[str], code_col: str = "code", name_col: str = "name",
              date_col: str = "date") -> list[str]:
    """(code, date) else (name, date) else (date); [] when no date column."""
    cols = set(columns)
    if date_col not in cols:
        return []
    if code_col in cols:
        return [code_col, date_col]
    if name_col in cols:
        return [name_col, date_col]
    return [date_col]


def dedup_keep_last(df: DataFrame, pk: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Keep the last-arrived row per key; arrival order = ``order_cols`` ascending.

    No-op when the key is empty or not fully present.  NULL keys form one group.
    """
    pk = list(pk or [])
    if not pk or any(k not in df.columns for k in pk):
        return df
    # each value travels once: in the order if it is part of it, else in the payload behind
    order = [c for c in dict.fromkeys(order_cols) if c not in pk]
    payload = [c for c in df.columns if c not in pk and c not in order]
    behind = [F.struct(*[F.col(c) for c in payload]).alias("_p")] if payload else []
    if not order and not behind:
        return df.select(*pk).distinct().select(*df.columns)
    out = df.groupBy(*pk).agg(F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *behind)).alias("_m"))
    place = {**{c: f"_m._o{i}" for i, c in enumerate(order)}, **{c: f"_m._p.`{c}`" for c in payload}}
    return out.select(*[F.col(place[c]).alias(c) if c in place else F.col(c) for c in df.columns])


# W8 ----------------------------------------------------------------------
def latest_in_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per group: the row with the greatest ``order_cols``."""
    return dedup_keep_last(df, group_cols, order_cols)


# U1 ----------------------------------------------------------------------
def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union with schema drift: missing columns become NULL."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# U2 ----------------------------------------------------------------------
def upsert(existing: DataFrame | None, new: DataFrame, pk: Sequence[str],
           order_cols: Sequence[str] = ()) -> DataFrame:
    """existing ∪ new, keep last per key; new rows win, then arrival order."""
    pk = list(pk or [])
    if existing is None or not pk or any(k not in new.columns for k in pk):
        return new
    both = union_by_name([existing.withColumn("_src", F.lit(0)), new.withColumn("_src", F.lit(1))])
    return dedup_keep_last(both, pk, ["_src", *order_cols]).drop("_src")


# J3 ----------------------------------------------------------------------
def null_safe_key_match(left: DataFrame, right: DataFrame, pk: Sequence[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in pk])


def insert_only_new_keys(existing: DataFrame, new: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key (NULL-safe) is not stored yet."""
    ex = existing.select(*pk).distinct()
    return new.join(ex, null_safe_key_match(new, ex, pk), "left_anti")


# U3 ----------------------------------------------------------------------
def is_daily(freq: str | None) -> bool:
    return freq is not None and freq.strip().upper() in DAILY_NAMES


def is_daily_col(freq: Column) -> Column:
    """Null-free: an unknown frequency is not daily."""
    return F.coalesce(F.upper(F.trim(freq)).isin(*DAILY_NAMES), F.lit(False))


def apply_write_policy(existing: DataFrame | None, new: DataFrame, pk: Sequence[str], freq: str,
                       update_old_non_daily: bool = False, order_cols: Sequence[str] = ()) -> DataFrame:
    """daily -> upsert; unknown frequency (None) or the flag -> upsert; other frequencies insert-only."""
    if existing is None:
        return dedup_keep_last(new, pk, order_cols)
    if freq is None or is_daily(freq) or update_old_non_daily:
        return upsert(existing, new, pk, order_cols)
    fresh = dedup_keep_last(insert_only_new_keys(existing, new, pk), pk, order_cols)
    return union_by_name([existing, fresh])


def apply_write_policy_by_item(existing: DataFrame, new: DataFrame, pk: Sequence[str], dim_item: DataFrame,
                               item_col: str = "item", update_old_non_daily: bool = False,
                               order_cols: Sequence[str] = ()) -> DataFrame:
    """U3 for a frame holding several datasets: the frequency comes from the
    (small, fixed) catalogue, broadcast; both policies run in one plan.  Items
    that the catalogue does not know (null frequency) are upserted."""
    cat = F.broadcast(dim_item.select(F.col("item").alias(item_col), "freq"))
    upd = (is_daily_col(F.col("freq")) | F.col("freq").isNull()) if not update_old_non_daily else F.lit(True)
    ex = existing.join(cat, item_col, "left")
    nw = new.join(cat, item_col, "left")
    daily = upsert(ex.where(upd).drop("freq"), nw.where(upd).drop("freq"), pk, order_cols)
    ex_o, nw_o = ex.where(~upd).drop("freq"), nw.where(~upd).drop("freq")
    other = union_by_name([ex_o, dedup_keep_last(insert_only_new_keys(ex_o, nw_o, pk), pk, order_cols)])
    return union_by_name([daily, other])


# L2 ----------------------------------------------------------------------
def latest_date_only(df: DataFrame, freq_col: Column | str | None = None, freq: str | None = None,
                     doc_cols: Sequence[str] = ("source_file",), date_col: str = "date",
                     update_old_non_daily: bool = False) -> DataFrame:
    """Non-daily data: keep only the rows of each document's latest date.

    Daily, flagged or date-less frames pass through.  The per-document maximum
    is a group-by joined back (documents are bounded; no window buffer).
    """
    if update_old_non_daily or date_col not in df.columns or (freq_col is None and (freq is None or is_daily(freq))):
        return df
    f = F.col(freq_col) if isinstance(freq_col, str) else (freq_col if freq_col is not None else F.lit(freq))
    doc_names = [f"_doc_{c}" for c in doc_cols]
    mx = df.groupBy(*[F.col(c).alias(n) for c, n in zip(doc_cols, doc_names)]).agg(F.max(date_col).alias("_max_date"))
    same = F.lit(True)
    for c, n in zip(doc_cols, doc_names):  # rows of a null document are one document
        same = same & df[c].eqNullSafe(mx[n])
    keep = is_daily_col(f) | f.isNull() | F.col(date_col).eqNullSafe(F.col("_max_date"))
    return df.join(mx, same, "left").where(keep).drop("_max_date", *doc_names)


# L3 ----------------------------------------------------------------------
def dataset_subset(df: DataFrame, items: Sequence[str] | None, item_col: str = "item") -> DataFrame:
    """Keep the listed datasets; blanks are ignored, an empty list keeps all."""
    wanted = [s.strip() for s in (items or []) if s is not None and s.strip()]
    return df.where(F.col(item_col).isin(wanted)) if wanted else df


# A12 ---------------------------------------------------------------------
def duplicate_keys(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def key_diagnostics(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys duplicated, rows in duplicated keys."""
    per = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                   F.count_if(F.col("n") > 1).alias("n_duplicated_keys"),
                   F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_duplicated_rows"))


# S4 ----------------------------------------------------------------------
def with_bucket(df: DataFrame, bucket_mode: str = "year", freq: str = DAILY, date_col: str = "date") -> DataFrame:
    """Bucket partition column; only daily datasets (in any spelling) are split by date."""
    mode = bucket_mode if (is_daily(freq) and date_col in df.columns) else "all"
    return df.withColumn("bucket", S.bucket_key(F.col(date_col), mode))


def write_bucketed(df: DataFrame, path: str, bucket_mode: str = "year", freq: str = DAILY,
                   date_col: str = "date", mode: str = "overwrite", max_records_per_file: int = 5_000_000,
                   key_cols: Sequence[str] = ()) -> None:
    """Parquet sink partitioned by bucket.

    Range partitioning on (bucket, date, all other plain columns named in
    ``key_cols``) splits a hot bucket, and a batch of one date, over several
    tasks; dynamic partition overwrite rewrites only the buckets present in ``df``.
    """
    out = with_bucket(df, bucket_mode, freq, date_col) if "bucket" not in df.columns else df
    order = list(dict.fromkeys(["bucket", *([date_col] if date_col in out.columns else []), *key_cols]))
    n = int(out.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (out.repartitionByRange(n, *order)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("bucket")
        .parquet(path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds buckets; any other failure to look rises."""
    return any(n.startswith("bucket=") for n in child_names(spark, path))


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace a whole small table: the new copy is complete beside the old one
    before that goes, and ``read_replaced`` finds it if a run ends in between."""
    fresh = path.rstrip("/") + ".next"
    df.write.mode("overwrite").parquet(fresh)
    move_folder(spark, fresh, path)


def read_replaced(spark: SparkSession, path: str) -> DataFrame | None:
    """The table kept by ``replace_table``; None before the first run."""
    fresh = path.rstrip("/") + ".next"
    if child_names(spark, path):
        return spark.read.parquet(path)
    if "_SUCCESS" in child_names(spark, fresh):
        return spark.read.parquet(fresh)
    return None


# U2 / U3 against a stored table --------------------------------------------
# Everything a write needs is complete in <table>/_staging/<numbers>-<id> before the
# first file of the table changes:
#   new/bucket=*      the batch, one row per key
#   rows/bucket=*     the new content of each touched bucket that still has rows; ``new`` itself, moved there, if the
#                     table has nothing in the buckets of the batch and the files are large enough
#   emptied/bucket=*  buckets that lose their last row (empty folders)
#   keys              keys that are new or have moved, with the bucket they leave, for the key index
#   ledger            what is known of the batch, for the batch ledger
#   READY             all of it is there
# ``finish_staged`` puts it in place and can be repeated; a write that was cut
# off after READY is finished by the next one, before READY it is thrown away.
# A table has one writer at a time.
LEDGER_SCHEMA = "stream string, batch bigint, policy string, n_rows bigint, n_late bigint, n_stored bigint"
MAX_RECORDS_PER_FILE = 5_000_000
#: rows a file on average from which the files of a first batch stay as they are, if they are as many as the ranges would be;
#: smaller or fewer ones (a batch in one bucket) are laid out by range
MOVE_ROWS = 10_000
NULL_BUCKET = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class BatchId:
    """A micro-batch of a stream, or a round of a job."""

    stream: str
    batch: int


def batch_ledger(spark: SparkSession, path: str) -> KeyedLog:
    """The batches a table holds: late rows (their key was stored before), rows stored after the policy."""
    return KeyedLog(spark, f"{path.rstrip('/')}/_index/ledger", ["stream", "batch"], LEDGER_SCHEMA)


def key_index(spark: SparkSession, path: str, pk: Sequence[str], like: DataFrame) -> KeyedLog:
    """The bucket of every stored key, kept with the table (types of the key as in ``like``)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.select(*pk).schema)
    return KeyedLog(spark, f"{path.rstrip('/')}/_index/keys", pk, f"{schema}, `bucket` string")


def _buckets(spark: SparkSession, path: str) -> list[str]:
    return [n for n in child_names(spark, path) if n.startswith("bucket=")]


def _read_buckets(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Some buckets of a table; columns that only some files have are kept, an unreadable file raises."""
    df = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*[f"{path}/{n}" for n in names])
    return df.withColumn("bucket", F.col("bucket").cast("string"))


def finish_staged(spark: SparkSession, path: str, pk: Sequence[str] = ()) -> None:
    """Complete a staged write of the table, or drop one that never was ready."""
    for name in child_names(spark, f"{path}/_staging"):
        stage = f"{path}/_staging/{name}"
        there = child_names(spark, stage)
        if "READY" in there:
            for bucket in _buckets(spark, f"{stage}/rows"):
                move_folder(spark, f"{stage}/rows/{bucket}", f"{path}/{bucket}")
            for bucket in _buckets(spark, f"{stage}/emptied"):
                delete_folder(spark, f"{path}/{bucket}")
            # the generations are part of the name: a repetition writes the same ones
            keys_gen, ledger_gen, _ = name.split("-", 2)
            if "keys" in there:
                index = key_index(spark, path, pk, spark.read.parquet(f"{stage}/keys"))
                index.append_folder(f"{stage}/keys", int(keys_gen))
            if "ledger" in there:
                batch_ledger(spark, path).append(spark.read.schema(LEDGER_SCHEMA).parquet(f"{stage}/ledger"), int(ledger_gen))
        delete_folder(spark, stage)


def _key_changes(spark: SparkSession, path: str, batch: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Keys of the batch that are new or move, with their bucket and the one they leave (``was``)."""
    index = key_index(spark, path, pk, batch)
    place = F.coalesce(F.col("bucket"), F.lit(NULL_BUCKET)).alias("bucket")
    if not index.exists():  # a table from before it had an index
        stored = _read_buckets(spark, path, _buckets(spark, path)).select(*pk, place)
        index.append(dedup_keep_last(stored, pk, ["bucket"]))
    now = batch.select(*pk, place)
    before = index.read().withColumnsRenamed({"bucket": "was", **{k: f"_{k}" for k in pk}})
    same = functools.reduce(lambda a, b: a & b, [now[k].eqNullSafe(before[f"_{k}"]) for k in pk])
    return now.join(before, same, "left").where(~F.col("was").eqNullSafe(F.col("bucket"))).select(*pk, "bucket", "was")


def upsert_into_table(spark: SparkSession, new: DataFrame, path: str, pk: Sequence[str],
                      order_cols: Sequence[str] = (), bucket_mode: str = "year", freq: str = DAILY,
                      update_old_non_daily: bool = False, date_col: str = "date",
                      batch_id: BatchId | None = None, one_row_per_key: bool = False) -> DataFrame:
    """U2/U3 against a stored table: only the buckets touched by ``new`` are read, merged and rewritten.

    Where the key does not hold the date, a key's bucket can change; a key index kept with the table
    names the bucket it leaves, which is rewritten without it.  The batch is computed once; the merged
    rows are written once, beside the table, and their folders moved in.  A ``batch_id`` that the
    table's ledger knows already changes nothing.  ``one_row_per_key`` says that ``new`` has been
    through keep-last by the same key.
    """
    path, pk = path.rstrip("/"), list(pk or [])
    finish_staged(spark, path, pk)
    ledger = batch_ledger(spark, path)
    if batch_id and not ledger.read().where((F.col("stream") == batch_id.stream) & (F.col("batch") == batch_id.batch)).isEmpty():
        return spark.read.option("mergeSchema", "true").parquet(path)
    new_b = with_bucket(new, bucket_mode, freq, date_col)
    keyed = bool(pk) and all(k in new.columns for k in pk)
    may_move = keyed and date_col in new.columns and date_col not in pk and is_daily(freq) and bucket_mode != "all"
    keys_gen = key_index(spark, path, pk, new_b).next_generation() if may_move else 0
    stage = f"{path}/_staging/{keys_gen}-{ledger.next_generation() if batch_id else 0}-{uuid.uuid4().hex[:12]}"
    # in the order of the buckets and their dates: a table's first rows can stay as they are written here
    by = ["bucket", *([date_col] if date_col in new_b.columns else [])]
    last = new_b if one_row_per_key else dedup_keep_last(new_b, pk, order_cols)
    last.sortWithinPartitions(*by).write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("bucket").parquet(f"{stage}/new")
    touched = set(_buckets(spark, f"{stage}/new"))
    if not touched:  # an empty batch
        delete_folder(spark, stage)
        return spark.read.option("mergeSchema", "true").parquet(path) if table_exists(spark, path) else new_b
    batch = spark.read.schema(new_b.schema).parquet(f"{stage}/new")
    existing = set(_buckets(spark, path))
    if may_move:
        changed = _key_changes(spark, path, batch, pk) if existing else (
            batch.select(*pk, F.coalesce("bucket", F.lit(NULL_BUCKET)).alias("bucket"), F.lit(None).cast("string").alias("was")))
        # read back, not computed again: the key index is read and joined once a batch
        changed.write.parquet(f"{stage}/keys")
        gone = spark.read.schema(changed.schema).parquet(f"{stage}/keys").where("was is not null").select("was").distinct()
        # bucket keys are years, months or days: a short list
        touched |= {f"bucket={r['was']}" for r in gone.collect()}
    # the batch can meet rows of the touched buckets only
    stored = _read_buckets(spark, path, sorted(touched & existing)) if touched & existing else None
    n = batch.count() if batch_id or stored is None else None
    if stored is None and _stays(spark, f"{stage}/new", n):
        # nothing to merge with: the batch, a row per key and in files worth having, is the content of its buckets
        move_folder(spark, f"{stage}/new", f"{stage}/rows")
    else:
        merged = batch if stored is None else apply_write_policy(stored, batch, pk, freq, update_old_non_daily, order_cols)
        _write_range(merged, f"{stage}/rows", date_col, pk)
    for bucket in touched - set(_buckets(spark, f"{stage}/rows")):
        _mark(spark, f"{stage}/emptied/{bucket}")
    if batch_id:
        late = batch.join(stored.select(*pk).distinct().withColumnsRenamed({k: f"_{k}" for k in pk}),
                          functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in pk]),
                          "left_semi").count() if keyed and stored is not None else 0
        insert_only = freq is not None and not is_daily(freq) and not update_old_non_daily
        row = (batch_id.stream, batch_id.batch, "insert" if insert_only else "upsert", n, late, n - late if insert_only else n)
        spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1).write.parquet(f"{stage}/ledger")
    _mark(spark, f"{stage}/READY")
    finish_staged(spark, path, pk)
    return spark.read.option("mergeSchema", "true").parquet(path)


def _mark(spark: SparkSession, folder: str) -> None:
    fs, where = file_system(spark, folder)
    fs.mkdirs(where)


def _stays(spark: SparkSession, folder: str, n_rows: int) -> bool:
    """Whether the files of a first batch are large enough, and enough to hold a hot bucket apart, without a layout by range."""
    fs, where = file_system(spark, folder)
    files = fs.getContentSummary(where).getFileCount()
    return files >= int(spark.conf.get("spark.sql.shuffle.partitions")) and n_rows >= MOVE_ROWS * files


def _write_range(df: DataFrame, path: str, date_col: str, pk: Sequence[str], max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """A bucket, or a batch of one date, over several tasks: range partitions on bucket, date and key."""
    order = dict.fromkeys(["bucket", *([date_col] if date_col in df.columns else []), *[k for k in pk if k in df.columns]])
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *order).write.option("maxRecordsPerFile", max_records_per_file)
       .partitionBy("bucket").parquet(path))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# J1 ----------------------------------------------------------------------
def pending_work(files: DataFrame, state: DataFrame | None) -> DataFrame:
    """One row (n_files, n_pending): files with no state or status != success."""
    if state is None:
        return files.agg(F.count(F.lit(1)).alias("n_files"), F.count(F.lit(1)).alias("n_pending"))
    st = state.select("path", "status")
    j = files.select("path").join(st, "path", "left")
    return j.agg(F.count(F.lit(1)).alias("n_files"),
                 F.count_if(F.col("status").isNull() | (F.col("status") != "success")).alias("n_pending"))


# J2 ----------------------------------------------------------------------
def needs_processing(files: DataFrame, state: DataFrame, size_col: str = "size_bytes",
                     mtime_col: str = "mtime") -> DataFrame:
    """Per file: skip only when status = success, the fingerprint
    'size-int(mtime)' is unchanged and the recorded mtime is equal."""
    fp = S.file_fingerprint(F.col(size_col), F.col(mtime_col))
    st = state.select("path", F.col("status").alias("state_status"), F.col("hash").alias("state_hash"),
                      F.col("source_mtime").alias("state_mtime"))
    j = files.join(st, "path", "left")
    unchanged = ((F.col("state_status") == "success") & F.col("state_hash").isNotNull()
                 & (F.col("state_hash") == fp) & F.col("state_mtime").isNotNull()
                 & (F.col("state_mtime").cast("timestamp") == F.col(mtime_col).cast("timestamp")))
    return j.select(
        files["*"], fp.alias("fingerprint"),
        (~F.coalesce(unchanged, F.lit(False))).alias("needs_processing"),
        (F.coalesce(F.col("state_status") == "success", F.lit(False)) & ~F.coalesce(unchanged, F.lit(False)))
        .alias("changed_since_success"))


def any_pending(files: DataFrame, state: DataFrame, **kw) -> bool:
    """Exists-style check: stops at the first file that needs work."""
    return not needs_processing(files, state, **kw).where("needs_processing").isEmpty()


# U4 ----------------------------------------------------------------------
def job_state_log(spark: SparkSession, path: str) -> KeyedLog:
    """The stored job state: a round adds its own rows, a NULL date / item keeps the earlier one."""
    types = {"source_mtime": "timestamp", "source_size": "bigint", "last_processed_at": "timestamp"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in JOB_STATE_COLUMNS)
    return KeyedLog(spark, path, ["path"], schema, keep_non_null=["date", "item"])


def upsert_job_state(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Insert or update by path; a NULL date / item in the batch never
    overwrites a stored one.  Output in the fixed column order."""
    def full(df):
        for c in JOB_STATE_COLUMNS:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
        return df.select(*JOB_STATE_COLUMNS)
    new = full(new)
    if old is None:
        return new
    old = full(old)
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in JOB_STATE_COLUMNS], F.lit(True).alias("_hit"))
    j = old.join(n, old["path"] == n["n_path"], "full_outer")
    cols = []
    for c in JOB_STATE_COLUMNS:
        if c in ("date", "item"):
            cols.append(F.when(F.col("_hit"), F.coalesce(F.col(f"n_{c}"), F.col(c))).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.when(F.col("_hit"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c))
    return j.select(*cols)
