"""End-to-end clean job (D6): landed documents -> typed, keyed, bucketed tables.

S1 -> X1/X2/X5 -> X8 -> X3/X4/P* -> N* -> L2 -> W7 -> U3 -> S4 -> U4.
Data is written before the job state (a lost run never marks files done).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog
from ..operators import headers
from ..operators import ingest as ig
from ..operators import store as st
from ..operators.keyed_log import KeyedLog
from ..sources import documents as docsrc
from ..sources import manifest as mf

ARRIVAL_ORDER = ["source_file", "container", "block_k", "row_pos"]


QUARANTINE = "quarantine"


@dataclass
class CleanResult:
    tables: dict[tuple[str, str], DataFrame]  # (item, subitem) -> cleaned frame
    errors: DataFrame
    keys: dict[tuple[str, str], list[str]]
    registry: DataFrame  # header variants


def block_table(docs: DataFrame, catalogue: DataFrame, global_rename: dict) -> DataFrame:
    """Non-empty blocks with their sub-table, or the reason why they have none (documents without
    any block included), written once as Parquet in the shared folder, one partition per sub-table:
    a table's scan reads its own partition only and a lost executor recomputes no document."""
    blocks = ig.extract_subtables(docs, keep_bare=True)
    bare = F.col("kind").isNull()
    blocks = ig.match_titles(blocks.where(bare | (F.size("fields") > 0) & (F.size("data") > 0)),
                             ig.subtitle_config(catalogue), rename=global_rename)
    blocks = blocks.select(
        *ig.IDS, "container", "kind", "k", "title", "fields", "data", "subitem",
        F.when(bare, ig.no_table_error()).otherwise(F.col("match_error")).alias("reason"))
    kept = blocks.withColumns({
        "p_item": F.coalesce(F.nullif("item", F.lit("")), F.lit("-")),
        "p_subitem": F.coalesce(F.when(F.col("reason").isNull(), F.nullif("subitem", F.lit(""))), F.lit("-"))})
    path = st.scratch_path(docs.sparkSession, "blocks")
    kept.write.partitionBy("p_item", "p_subitem").parquet(path)
    return docs.sparkSession.read.schema(kept.schema).parquet(path)


def header_registry(spark: SparkSession, root: str) -> KeyedLog:
    """The header variants that a target has seen, by table and id."""
    return KeyedLog(spark, f"{root.rstrip('/')}/headers", ["item", "subitem", "variant"],
                    "item string, subitem string, variant string, fields array<string>, final array<string>, "
                    "n_blocks bigint")


def clean_documents(docs: DataFrame, catalogue: DataFrame, specs: dict[str, ig.TableSpec] | None = None,
                    global_rename: dict | None = None, strict: bool = False,
                    update_old_non_daily: bool = False) -> CleanResult:
    """Clean a frame of documents (S1 output) into one frame per (item, sub-table).

    ``specs`` holds the TableSpecs to use (each names its item and sub-table);
    other sub-tables take the shipped configuration.  Errors of every kind land
    in one quarantine frame; ``strict`` raises on the first one instead.
    """
    by_table = {(x.item, x.subitem): x for x in (specs or {}).values()}
    # the global rename of headers and sub-tables always applies (pass {} to switch it off)
    global_rename = catalog.GLOBAL_RENAME if global_rename is None else global_rename
    spec_of = lambda item, subitem: by_table.get((item, subitem)) or ig.default_spec(item, subitem)
    blocks = block_table(docs, catalogue, global_rename)

    def error(reason: Column, bad_header: bool) -> Column:
        value = F.array_join("fields", ",", "") if bad_header else F.col("title")
        return ig.error_struct(reason, file=F.col("source_file"), item=F.col("item"), subitem=F.col("subitem") if bad_header else None,
                               value=value, value_type="string", date=F.col("date_key")).alias("error")
    errors = [blocks.where("p_subitem = '-' and reason is not null").select(*ig.IDS, error(F.col("reason"), False))]
    path = st.scratch_path(docs.sparkSession, "headers")
    headers.registry_of(blocks.where("p_subitem <> '-'"), lambda fields: ig.header_of(
        fields, F.col("item"), F.col("subitem"), list(by_table.values()), global_rename)).write.parquet(path)
    seen = docs.sparkSession.read.parquet(path)
    registry = seen.where(F.col("final").isNotNull())
    names, usual, bad = headers.column_names(registry), headers.usual_headers(registry), headers.tables_with_bad_headers(seen)
    of_table = lambda item, subitem: blocks.where((F.col("p_item") == item) & (F.col("p_subitem") == subitem))
    for item, subitem in sorted(bad):
        final = headers.final_names(F.col("fields"), spec_of(item, subitem).spans, global_rename)
        errors.append(of_table(item, subitem).where(final.isNull()).select(*ig.IDS, error(F.lit(headers.BAD_HEADER), True)))
    # configuration rows (bounded by the catalogue, not by the data)
    freq = {r["item"]: r["freq"] for r in catalogue.select("item", "freq").collect()}
    tables, keys = {}, {}
    for item, subitem in sorted(names):
        spec = spec_of(item, subitem)
        t, e = ig.frame_up(of_table(item, subitem), spec, names[item, subitem], global_rename, usual[item, subitem])
        errors.append(e)
        t = st.latest_date_only(t, freq=freq.get(item, st.DAILY), doc_cols=("source_file", "subitem"),
                                update_old_non_daily=update_old_non_daily)
        keys[item, subitem] = spec.pk or st.infer_key(t.columns, code_col="代號", name_col="名稱")
        # item and sub-table are the same in every row: keep-last does not carry them through its sorts and shuffle
        same = {c: F.lit(v) for c, v in (("item", item), ("subitem", subitem))
                if c not in keys[item, subitem] and t.columns.count(c) == 1}
        tables[item, subitem] = (st.dedup_keep_last(t.drop(*same), keys[item, subitem], ARRIVAL_ORDER)
                                 .withColumns(same).select(*t.columns))
    err = st.union_by_name(errors)
    if strict:
        ig.raise_first_error(err)
    return CleanResult(tables, err, keys, registry)


def store_result(spark: SparkSession, res: CleanResult, target_root: str, freq: dict[str, str],
                 batch: str, bucket_mode: str = "year", update_old_non_daily: bool = False,
                 batch_id: st.BatchId | None = None) -> DataFrame:
    """Write a batch's quarantine, then upsert its tables (U3 + S4).

    The quarantine is partitioned by batch, so a batch that runs again replaces
    its own errors.  With ``batch_id`` each table's ledger notes the batch, and a
    table that has it already is left as it is.  Returns the batch's stored errors.
    """
    root = target_root.rstrip("/")
    (res.errors.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(f"{root}/{QUARANTINE}"))
    for (item, subitem), t in res.tables.items():
        body = t.drop("item", "date_key", "subitem", "container", "block_k")
        st.upsert_into_table(spark, body, f"{root}/{item}/{subitem}", res.keys[item, subitem],
                             order_cols=["source_file", "row_pos"], bucket_mode=bucket_mode,
                             freq=freq.get(item, st.DAILY), update_old_non_daily=update_old_non_daily,
                             batch_id=batch_id, one_row_per_key=True)
    seen = header_registry(spark, root)
    fresh = res.registry.join(seen.read().select(*seen.key), seen.key, "left_anti") if seen.exists() else res.registry
    if not fresh.isEmpty():
        seen.append(fresh)
    error = ",".join(f"{c}:string" for c in ig.ERROR_FIELDS)
    stored = spark.read.schema(f"item string, source_file string, date_key string, error struct<{error}>, "
                               "batch string").parquet(f"{root}/{QUARANTINE}")
    return stored.where(F.col("batch") == batch)


def run_clean_job(spark: SparkSession, source_root: str, target_root: str, state_path: str,
                  catalogue: DataFrame, specs: dict[str, ig.TableSpec] | None = None,
                  items: Sequence[str] | None = None, batch_size: int = 10_000,
                  bucket_mode: str = "year", update_old_non_daily: bool = False,
                  strict: bool = True) -> dict:
    """One incremental round: files new or changed since the last success
    (J2), at most ``batch_size`` of them (the others wait for the next round),
    cleaned and upserted per sub-table (U3 + S4), then their job state (U4).
    Without ``strict``, files with quarantined errors get the status 'failed'
    and come up again; all others are marked 'success'.  Returns counters."""
    files = mf.scan_manifest(spark, source_root, layer="source", suffix=".json")
    files = st.dataset_subset(files, items)
    log = st.job_state_log(spark, state_path)
    if log.exists():
        pending = st.needs_processing(files, log.read()).where("needs_processing").drop("needs_processing")
    else:
        pending = files
    # the batch's file list (bounded by batch_size) becomes the read list
    pending = pending.orderBy("path").limit(batch_size)
    batch = [r["path"] for r in pending.select("path").collect()]
    if not batch:
        return {"files": 0, "tables": 0, "errors": 0}
    raw = (spark.read.option("wholetext", True).text(batch)
           .select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("json")))
    raw = raw.withColumn("item", F.regexp_extract("source_file", r"/([^/]+)/[^/]+$", 1))
    docs = docsrc.documents_from_text(raw, plain=True)
    res = clean_documents(docs, catalogue, specs, strict=strict, update_old_non_daily=update_old_non_daily)
    freq = {r["item"]: r["freq"] for r in catalogue.select("item", "freq").collect()}
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    # a round that was cut off before its state comes again under the same number
    generation = log.next_generation()
    errors = store_result(spark, res, target_root, freq, f"round-{generation}", bucket_mode, update_old_non_daily)
    bad = errors.select(F.col("source_file").alias("path"), F.lit("failed").alias("bad")).distinct()
    new_state = pending.join(bad, "path", "left").select(
        F.regexp_extract("path", r"[^/]+$", 0).alias("file"), "path",
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"),
        st.S.file_fingerprint(F.col("size_bytes"), F.col("mtime")).alias("hash"),
        F.col("mtime").alias("source_mtime"), F.col("size_bytes").alias("source_size"),
        F.coalesce("bad", F.lit("success")).alias("status"), F.lit(None).cast("string").alias("date"),
        F.col("item"), F.lit(now).alias("last_processed_at"))
    log.append(new_state, generation)
    return {"files": len(batch), "tables": len(res.tables), "errors": errors.count()}
