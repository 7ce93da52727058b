"""Deterministic sharded WARC writer and reader.

Records are sorted by page id into shards of about SHARD_BYTES, whose borders
come from an exact histogram of ids (ranges that are too heavy are divided again),
so the same table always gives the same files.  Every record is a gzip member
with regenerated headers and digests; a file is rolled when its compressed size
reaches ROLL_BYTES.  Tasks write under temporary names of their own attempt and
report them; the report is a table that Spark commits (one attempt per task),
the files it names are then renamed, and only files in the manifest count, so a
lost executor or a second attempt leaves nothing in the result.

Equal payloads of at least DEDUP_BYTES are written once, with the largest page
id; the others are revisit records.  The largest id per digest is a partial
aggregate; payloads cross one shuffle, by shard, and stream through the writer.

Defined results: null html: empty payload; null url: a urn of the page id; null
page ids come first, are always responses and refer to nothing; rows repeated
under one id are written each (equal ones as the same type); ties cannot arise
(largest id); empty table: no files, no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .shared import col, scratch_dir, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEDUP_BYTES = 1000
SHARD_BYTES = 16 << 20
#: shard borders are broadcast: at most this many, larger shards beyond
MAX_SHARDS = 16384
ROLL_BYTES = 4 << 20
BINS = 4096
RECORD_OVERHEAD = 800
DATE = "2020-01-01T00:00:00Z"
LEVEL = 6

MANIFEST = "shard int, part int, file string, temporary string, records long, compressed long, sha1 string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """A pyarrow file system and path for the folder's URI."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def record_id(page_id, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}').urn}>"


def _b32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit that refers to the response's page."""
    digest = hashlib.sha1(payload).hexdigest()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    uri = url.encode("utf-8", "replace").replace(b"\r", b"%0D").replace(b"\n", b"%0A").decode() if url \
        else f"urn:page:{page_id}"
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)),
              ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", _b32(digest)),
              ("WARC-Block-Digest", _b32(hashlib.sha1(block).hexdigest())),
              ("Content-Type", "application/http;msgtype=response")]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member that depends on the data alone (no time, no name)."""
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class ShardFiles:
    """Writes the files of one shard under temporary names."""

    def __init__(self, folder: str, roll_bytes: int):
        (self.fs, self.path), self.roll = file_system(folder), roll_bytes
        self.out, self.shard, self.part, self.done = None, None, 0, []

    def _open(self):
        self.name = f"shard-{self.shard:05d}-{self.part:04d}.warc.gz"
        self.temporary = f".{self.name}.{uuid.uuid4().hex}.tmp"
        self.out, self.records, self.size, self.sha = self.fs.open_output_stream(f"{self.path}/{self.temporary}"), 0, 0, hashlib.sha1()

    def close(self):
        if self.out:
            self.out.close()
            self.done.append((self.shard, self.part, self.name, self.temporary, self.records, self.size, self.sha.hexdigest()))
            self.out, self.part = None, self.part + 1

    def write(self, shard: int, record: bytes):
        if shard != self.shard:
            self.close()
            self.shard, self.part = shard, 0
        if not self.out:
            self._open()
        data = _member(record)
        self.out.write(data)
        self.sha.update(data)
        self.records, self.size = self.records + 1, self.size + len(data)
        if self.size >= self.roll:
            self.close()


def _writer(folder: str, roll_bytes: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, at, revisits = ShardFiles(folder, roll_bytes), None, {}
        for batch in batches:
            for shard, known, page, is_payload, digest, refers, url, html in zip(*(batch[c] for c in batch.columns)):
                page = int(page) if known else None
                if page != at:
                    at, revisits = page, {}
                if not is_payload:
                    revisits[digest] = int(refers)
                    continue
                payload = bytes(html)
                refers = revisits.get(hashlib.sha1(payload).hexdigest()) if revisits else None
                files.write(int(shard), record_bytes(page, url, payload, refers))
        files.close()
        yield pd.DataFrame(files.done, columns=[c.split()[0] for c in MANIFEST.split(", ")])
    return write


def _committer(folder: str):
    def commit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = file_system(folder)
        for batch in batches:
            for name, temporary in zip(batch["file"], batch["temporary"]):
                # a second attempt finds the file already in place
                if fs.get_file_info(f"{path}/{temporary}").type == pafs.FileType.File:
                    fs.move(f"{path}/{temporary}", f"{path}/{name}")
            yield batch
    return commit


def shard_borders(narrow: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[int]:
    """First page id of every shard but the first, from exact weights of id ranges.

    Ids fall into BINS equal ranges; ranges heavier than a shard are divided again, all of them in one
    join on the range's first id.  Weights are summed up over the ranges where they lie; only
    the borders reach the driver.
    """
    weight = (F.col("n_bytes") + RECORD_OVERHEAD).alias("weight")
    low, high, total = narrow.agg(F.min("page_id"), F.max("page_id"), F.sum(weight)).first()
    if low is None:
        return []
    target, width = max(shard_bytes, -(-total // MAX_SHARDS)), high - low + 1
    live = narrow.where(F.col("page_id").isNotNull()).select("page_id", weight, F.lit(low).cast("long").alias("begin"))
    ranges = None
    while True:
        width = max(1, -(-width // BINS))
        live = live.withColumn("begin", F.col("begin") + F.expr(f"((page_id - begin) div {width})") * width)
        bins = stored(live.groupBy("begin").agg(F.sum("weight").alias("weight")), "warc-bins")
        heavy = bins.where(F.col("weight") > target)
        done = width == 1 or heavy.isEmpty()
        found = bins if done else bins.where(F.col("weight") <= target)
        ranges = found if ranges is None else ranges.unionByName(found)
        if done:
            break
        live = live.join(heavy.select("begin"), "begin", "left_semi")
    placed = stored(ranges.repartitionByRange("begin").sortWithinPartitions("begin")
                    .withColumn("place", F.monotonically_increasing_id()), "warc-ranges").withColumn("task", F.shiftright("place", 33))
    earlier = lambda w: F.coalesce(F.sum("weight").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = placed.groupBy("task").agg(F.sum("weight").alias("weight"))  # a row a task
    tasks = tasks.select("task", earlier(Window.partitionBy(F.lit(0)).orderBy("task")).alias("before"))
    summed = placed.withColumn("inside", earlier(Window.partitionBy("task").orderBy("place"))).join(tasks, "task")
    shard = F.floor((F.col("before") + F.col("inside")) / target)
    first = summed.groupBy(shard.alias("shard")).agg(F.min("begin").alias("begin"))
    return sorted(r.begin for r in first.select("begin").collect())[1:]


def _shard_udf(borders: list[int]):
    edges = np.array(borders, dtype=np.int64)

    @F.pandas_udf(IntegerType())
    def shard_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        return pd.Series(np.where(known, np.searchsorted(edges, ids.fillna(0).astype("int64"), side="right"), 0), dtype="int32")
    return shard_of


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   dedup_bytes: int = DEDUP_BYTES, shard_bytes: int = SHARD_BYTES,
                   roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write all pages as WARC files in ``folder``; returns the committed manifest (also stored there)."""
    spark = pages.sparkSession
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    body = F.encode(F.coalesce(col(html), F.lit("")), "utf-8")
    narrow = stored(pages.select(col(page_id).alias("page_id"), F.sha1(body).alias("digest"),
                                 F.octet_length(body).cast("long").alias("n_bytes")), "payloads")
    kept = (narrow.where((F.col("n_bytes") >= dedup_bytes) & F.col("page_id").isNotNull()).groupBy("digest")
            .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to"))
    revisits = (narrow.where(F.col("n_bytes") >= dedup_bytes).join(kept, "digest").where("page_id < refers_to")
                .select("page_id", "digest", "refers_to").distinct())
    borders = shard_borders(narrow, shard_bytes)
    shard = _shard_udf(borders)
    records = pages.select(
        col(page_id).alias("page_id"), F.lit(True).alias("is_payload"), F.lit("").alias("digest"),
        F.lit(None).cast("long").alias("refers_to"), col(url).alias("url"), body.alias("html")).unionByName(revisits.select(
            "page_id", F.lit(False).alias("is_payload"), "digest", "refers_to", F.lit(None).cast("string").alias("url"),
            F.lit(None).cast("binary").alias("html")))
    records = records.select(shard("page_id").alias("shard"), F.col("page_id").isNotNull().alias("known"), "page_id",
                             "is_payload", "digest", "refers_to", "url", "html")
    # equal rows (same id and payload) in a fixed order: the payload's hash decides
    placed = (records.repartitionById(len(borders) + 1, "shard")
              .sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "is_payload", "digest", F.xxhash64("html"), "url"))
    columns = placed.columns
    if columns != ["shard", "known", "page_id", "is_payload", "digest", "refers_to", "url", "html"]:
        raise ValueError(columns)
    report = stored(placed.mapInPandas(_writer(folder, roll_bytes), MANIFEST), "warc-report")
    manifest_path = f"{folder}/_manifest"
    report.repartition(max(1, min(report.count(), MAX_SHARDS)), "file").mapInPandas(_committer(folder), MANIFEST).write.parquet(manifest_path)
    for info in fs.get_file_info(pafs.FileSelector(path)):
        if info.base_name.startswith(".shard-") and info.base_name.endswith(".tmp"):
            fs.delete_file(info.path)  # of attempts that were lost
    return spark.read.schema(MANIFEST).parquet(manifest_path)


def _records(stream) -> Iterator[tuple]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record of a gzip stream."""
    with gzip.GzipFile(fileobj=stream) as f:
        while line := f.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            fields = {}
            while (line := f.readline().rstrip(b"\r\n")):
                name, _, value = line.partition(b":")
                fields[name.decode().lower()] = value.strip().decode()
            block = f.read(int(fields["content-length"]))
            if f.read(4) != b"\r\n\r\n" or _b32(hashlib.sha1(block).hexdigest()) != fields["warc-block-digest"]:
                raise ValueError(f"damaged record {fields['warc-record-id']}")
            head, _, payload = block.partition(b"\r\n\r\n")
            size = int(head.rpartition(b"Content-Length:")[2])
            digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
            if fields["warc-type"] == "response" and (size != len(payload) or hashlib.sha1(payload).hexdigest() != digest):
                raise ValueError(f"damaged payload {fields['warc-record-id']}")
            page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
            yield (page and int(page), size, digest, fields["warc-type"], refers and int(refers), fields["warc-target-uri"])


def _reader(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = file_system(folder)
        names = [c.split()[0] for c in READ.split(", ")]
        for batch in batches:
            for name in batch["file"]:
                rows = []
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for r in _records(stream):
                        rows.append((*r, name))
                        if len(rows) == 5000:
                            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                            rows = []
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
    return read


def read_archives(folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record of the manifest's files; block and payload digests are checked."""
    # a number, so that adaptive execution does not gather the few bytes of file names in one task
    return manifest.select("file").repartition(max(1, min(manifest.count(), MAX_SHARDS)), "file").mapInPandas(
        _reader(folder), READ)


def archive_pages(pages: DataFrame, **params) -> DataFrame:
    """Write the pages to a new folder of the shared checkpoint folder and read them back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    return read_archives(folder, write_archives(pages, folder, **params))
