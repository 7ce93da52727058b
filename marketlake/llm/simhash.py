"""SimHash near-duplicates through an inverted index on positional bytes.

A fingerprint is 8 bytes.  Two fingerprints at most 2 bits apart differ in at
most 2 bytes, so they share at least 6 of the 8 (position, byte) pairs.  The
index keeps one posting list per choice of 6 positions and their 6 byte values:
a pair's tally of shared positional bytes reaches the guaranteed minimum of 6
exactly when the two meet in some list.  (Lists on one single byte would hold
1/256 of all fingerprints each, i.e. a quadratic number of tallied pairs.)
Equal fingerprints are one entry, and a list leaves 2 bytes free, so a list
holds at most 65,536 entries whatever the data.

Inside a list, entries are linked without forming all pairs: each entry stands
under its own value and under the 16 values one free bit away; entries that meet under
one value (17 at most) are pairwise at most 2 bits apart and hang on the least of
them.  Any two entries at distance 1 or 2 do meet under a value.  Tally and
distance of every link are verified again before components are formed.

Defined results: null or empty text and texts without words: fingerprint 0, linked like any other;
repeated rows and repeated ids keep one result row each; null ids count as no
candidate for ``component_id`` (null if a component has only null ids); ties
cannot arise (least id); empty table: no rows; other columns are not read.
"""

from __future__ import annotations

import sys
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .components import connected_components
from .shared import col, stored, whole_row

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BYTES = 8
#: hashes whose bits are counted at once; bounds memory for very long texts
CHUNK = 1 << 16


def text_fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit majority fingerprint of a text's word shingles."""
    if not text:
        return 0
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lens + 1) - 1
    n = max(1, len(words) - width + 1)
    begins = (ends - lens)[:n].tolist()
    stops = ends[min(width, len(words)) - 1:].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(begins[at:at + CHUNK], stops[at:at + CHUNK])],
                     dtype=">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, BYTES), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big", signed=True)


def _fingerprint_udf(width: int):
    @F.pandas_udf(LongType())
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, width) for t in texts], dtype="int64")
    return fingerprint


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def posting_masks(max_bits: int = MAX_BITS) -> list[tuple[int, list[int]]]:
    """(mask of the fixed bytes, free bits) for each choice of positions a linked pair must share."""
    out = []
    for free in combinations(range(BYTES), max_bits):
        bits = [8 * p + b for p in free for b in range(8)]
        mask = ((1 << 64) - 1) & ~sum(1 << b for b in bits)
        out.append((_signed(mask), [_signed(1 << b) for b in bits]))
    return out


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b) links between different values of column ``fp``; at most 2 bits apart.

    ``fps`` holds each fingerprint once.
    """
    masks = posting_masks(MAX_BITS)
    postings = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
        for i, (m, _) in enumerate(masks)])).alias("p")).select("p.list", "p.bytes", "fp")
    lists = postings.groupBy("list", "bytes").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    free = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(b).cast("long") for b in bits]) for _, bits in masks])
    stands = (lists.select("list", F.explode("members").alias("fp"))
              .select("list", "fp", F.explode(F.element_at(free, F.col("list") + 1)).alias("flip"))
              .select("list", F.col("fp").bitwiseXOR(F.col("flip")).alias("under"), "fp"))
    meets = stands.groupBy("list", "under").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    links = (meets.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct())
    apart = F.col("a").bitwiseXOR(F.col("b"))
    shared = sum((F.shiftrightunsigned(apart, 8 * p).bitwiseAND(F.lit(255)) == 0).cast("int") for p in range(BYTES))
    return links.where((shared >= BYTES - MAX_BITS) & (F.bit_count(apart) <= MAX_BITS))


def near_duplicate_groups(rows: DataFrame, doc_id: str = "doc_id", fp: str = "fp") -> DataFrame:
    """(fp, component_id): the least id among all documents reachable from each fingerprint."""
    fps = rows.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("least_id"))
    fps = stored(fps, "fingerprints")
    groups = connected_components(fingerprint_links(fps), "a", "b")
    labelled = fps.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return labelled.join(least, "component").select("fp", "component_id")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       width: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: doc_id, text_hash, fp (long), fingerprint (16 hex digits), component_id."""
    rows = docs.select(col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"),
                       _fingerprint_udf(width)(col(text)).alias("fp"))
    rows = stored(rows, "simhash")
    return rows.join(near_duplicate_groups(rows), "fp").select(
        "doc_id", "text_hash", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       width: int = SHINGLE_WORDS) -> DataFrame:
    """The documents without near-duplicates: of each component the row of the least id stays.

    Rows repeated under that id are one document (the least text hash stays).
    """
    found = simhash_components(docs, doc_id, text, width)
    keep = (found.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
            .where("k.doc_id is not null").select("k.doc_id", "k.text_hash"))
    only_null = found.where("component_id is null").select("doc_id", "text_hash").distinct()
    keep = keep.unionAll(only_null).select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    wide = docs.select(whole_row(docs).alias("row"), col(doc_id).alias("id"), F.xxhash64(col(text)).alias("h"))
    hit = wide.join(keep, wide["id"].eqNullSafe(F.col("k_id")) & (wide["h"] == F.col("k_hash")), "left_semi")
    return hit.dropDuplicates(["id", "h"]).select("row.*")
