"""Incremental ingest as Structured Streaming (ST1-ST3).

New landed files are picked up once each (file-source checkpoint),
``maxFilesPerTrigger`` bounds a round (the batch size), ``availableNow``
drains everything present and stops.  Each micro-batch is cleaned with the
batch plan and upserted per sub-table under the write policy - keyed and
keep-last, so replaying a batch after a failure writes the same rows.

Two landing layouts are read:
* ``records``: Parquet/JSON-lines records (item, source_file, json) - splittable;
* ``files``: one JSON document per file below ``root/<item>/`` (whole text).
A changed file under the same path is not re-read by the file source; such
files go through the batch job's change detection (J2) instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import documents as docsrc

RECORD_SCHEMA = "item string, source_file string, json string"


def document_stream(spark: SparkSession, root: str, layout: str = "records",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if layout == "records":
        raw = reader.schema(RECORD_SCHEMA).parquet(root)
    elif layout == "files":
        raw = (reader.option("wholetext", True).text(f"{root.rstrip('/')}/*/*.json")
               .select(F.input_file_name().alias("source_file"), F.col("value").alias("json"))
               .withColumn("item", F.regexp_extract("source_file", r"/([^/]+)/[^/]+$", 1)))
    else:
        raise ValueError("layout must be 'records' or 'files'")
    return raw


def stream_id(checkpoint: str) -> str:
    """A stream is known by its checkpoint folder, also after a restart."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def clean_batch_writer(target_root: str, catalogue_rows, specs: dict, bucket_mode: str = "year",
                       update_old_non_daily: bool = False, stream: str = "stream") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: clean the batch's documents and upsert every
    sub-table into ``target_root/<item>/<subitem>``; errors go to
    ``target_root/quarantine``.

    Late data of datasets that are not daily (keys that are stored already)
    follows the write policy: dropped, or upserted with ``update_old_non_daily``.
    Each table keeps a ledger of (stream, batch): a batch that is run again, perhaps
    after batches of another stream, does not touch a table that has it.
    """
    from .. import catalog
    from ..operators.store import BatchId
    from ..plans.clean_job import clean_documents, store_result

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        cat = catalog.catalogue_frame(spark, catalogue_rows)
        freq = {r[0]: r[1] for r in catalogue_rows}
        docs = docsrc.documents_from_text(batch, text_tables=True)
        res = clean_documents(docs, cat, specs, strict=False, update_old_non_daily=update_old_non_daily)
        # errors are stored before the batch is committed; a replay replaces them
        store_result(spark, res, target_root, freq, f"stream-{stream}-{batch_id}", bucket_mode, update_old_non_daily,
                     BatchId(stream, batch_id))
    return run


def start_ingest_stream(spark: SparkSession, landing_root: str, target_root: str, checkpoint: str,
                        catalogue_rows, specs: dict, layout: str = "records",
                        max_files_per_trigger: int | None = 500, bucket_mode: str = "year",
                        update_old_non_daily: bool = False, available_now: bool = True) -> StreamingQuery:
    stream = document_stream(spark, landing_root, layout, max_files_per_trigger)
    w = (stream.writeStream.foreachBatch(clean_batch_writer(target_root, catalogue_rows, specs, bucket_mode,
                                                            update_old_non_daily, stream_id(checkpoint)))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
