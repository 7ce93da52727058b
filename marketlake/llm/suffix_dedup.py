"""Exact substring dedup: bytes covered by a LENGTH-byte string that occurs anywhere else are removed.

The suffixes of the whole corpus cannot cross a shuffle (LENGTH bytes for every
byte), so they are dealt to suffix arrays by content:

1. Every LENGTH-byte window is filed under the least hash of its GRAM-byte grams.
   Equal windows have equal keys; neighbouring windows mostly share one, so a
   run of them is one row (key, hash of the run's text, place).
2. Keys with one occurrence are dropped: nothing under them repeats.
3. Runs whose whole text recurs are removed whole.  Where a key's runs differ, one run
   of each different text goes, with its text, to the key's suffix array.
4. Suffix arrays are built by two-stage sorting: only suffixes smaller than their
   successors are sorted directly (by 8 bytes at a time, ties going on); the
   others are induced from their successors by scanning the buckets of first
   bytes upwards.  Neighbours with a common prefix of LENGTH bytes are repeats.

Tasks gather whole keys into arrays of about ARRAY_BYTES.  A key whose different runs
hold more than HOT_BYTES is not gathered: its windows are spread by 128-bit
hashes of their text and counted (the exact way for hot groups).  Documents'
texts cross one shuffle; only texts that wait for a suffix array cross another.

Defined results: null text = empty text; texts under LENGTH bytes keep
everything; repeated rows are copies of each other; null ids are documents like others; ties (equal
windows) are all removed, the first one too; empty table: no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .shared import col, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 200
GRAM = 40
#: windows that are looked at together; bounds memory for very long texts
STRETCH = 1 << 20
ARRAY_BYTES = 1 << 20
HOT_BYTES = 16 << 20
#: separates runs in a suffix array; no byte of UTF-8
BORDER = 0xFF

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xD6E8FEB86659FD93)
MIX2 = np.uint64(0xA0761D6478BD642F)


def _byte_codes(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class RollingHash:
    """Hash of any stretch of a text from prefix sums (powers of an odd base, modulo 2**64)."""

    codes = {}
    up = down = np.zeros(0, dtype=np.uint64)

    def __init__(self, data: np.ndarray, seed: int = 1):
        cls = RollingHash
        if len(cls.up) <= len(data):
            size = 2 * len(data)
            cls.up, cls.down = _powers(BASE, size), _powers(BASE_INVERSE, size)
        if seed not in cls.codes:
            cls.codes[seed] = _byte_codes(seed)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(cls.codes[seed][data] * cls.up[:len(data)], out=self.sums[1:])

    def of(self, begin, end) -> np.ndarray:
        h = (self.sums[end] - self.sums[begin]) * RollingHash.down[begin]
        h ^= h >> np.uint64(31)
        return h * MIX

    def grams(self, size: int) -> np.ndarray:
        n = max(0, len(self.sums) - size)
        h = (self.sums[size:] - self.sums[:n]) * RollingHash.down[:n]
        h ^= h >> np.uint64(31)
        return h * MIX2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, m = 1, x
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    n = len(x) - width + 1
    return np.minimum(m[:n], m[width - size:width - size + n])


def runs_of(data: bytes, length: int = LENGTH, gram: int = GRAM):
    """(key, text hash, start, windows, occurrences of the key's gram: 1 or 2 = more) of a text's runs of windows."""
    parts = []
    width = length - gram + 1
    whole = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, len(whole) - length + 1, STRETCH):
        hashes = RollingHash(whole[at:at + STRETCH + length - 1])
        grams = hashes.grams(gram)
        least = sliding_min(grams, width)
        start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        count = np.diff(np.append(start, len(least)))
        if count.max() > width:  # periodic text: long runs in pieces
            pieces = -(-count // width)
            step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            end = np.repeat(start + count, pieces)
            start = np.repeat(start, pieces) + step * width
            count = np.minimum(end - start, width)
        view = np.lib.stride_tricks.sliding_window_view(grams, width)
        last = start + count - 1
        first_place = start + view[start].argmin(axis=1)
        last_place = last + width - 1 - view[last][:, ::-1].argmin(axis=1)
        parts.append((least[start].view(np.int64), hashes.of(start, last + length).view(np.int64), start + at, count,
                      1 + (first_place != last_place)))
    if not parts:
        return [np.zeros(0, dtype=np.int64)] * 5
    return [np.concatenate(p).astype(np.int64) for p in zip(*parts)]


RUNS = "a long, b long, key long, seg long, start long, n long, seen long"
#: bytes of text whose runs are handed on at once
BATCH_BYTES = 4 << 20


def _emit_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in RUNS.split(", ")]
    for batch in batches:
        rows, size = [], 0
        for a, b, text in zip(batch["a"], batch["b"], batch["body"]):
            found = runs_of(bytes(text))
            rows.append([np.full(len(found[0]), a), np.full(len(found[0]), b), *found])
            size += len(text)
            if size >= BATCH_BYTES:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*rows)))))
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*rows)))))


def eight_bytes(data: np.ndarray, after: int) -> np.ndarray:
    """The 8 bytes from each position on, in text order; zeros after the end."""
    padded = np.concatenate([data, np.zeros(after + 8, dtype=np.uint8)])
    return np.ndarray((len(data) + after,), dtype=">u8", buffer=padded.tobytes(), strides=(1,)).astype(np.uint64)


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of at least their first ``depth`` bytes, by two-stage sorting."""
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    # a suffix is smaller than its successor if the first byte that differs from the next is smaller;
    # the last suffix is larger than its empty successor
    differs = np.flatnonzero(data[1:] != data[:-1])
    next_change = np.full(n, n - 1, dtype=np.int64)
    if len(differs):
        where = np.searchsorted(differs, np.arange(n))
        next_change = np.where(where < len(differs), differs[np.minimum(where, len(differs) - 1)], n - 1)
    smaller = np.zeros(n, dtype=bool)
    inner = next_change < n - 1
    smaller[inner] = data[next_change[inner]] < data[next_change[inner] + 1]

    # first stage: sort those directly, 8 bytes at a time; only ties go on
    words = eight_bytes(data, depth + 16)
    order = np.flatnonzero(smaller)
    order = order[np.argsort(words[order], kind="stable")]
    group = np.concatenate([[0], np.cumsum(words[order[1:]] != words[order[:-1]])]) if len(order) else order
    for at in range(8, depth + 8, 8):
        tied = np.zeros(len(order), dtype=bool)
        equal = group[1:] == group[:-1]
        tied[1:] |= equal
        tied[:-1] |= equal
        places = np.flatnonzero(tied)
        if not len(places):
            break
        own = words[order[places] + at]
        sort = np.lexsort((own, group[places]))
        order[places] = order[places][sort]
        own = own[sort]
        fresh = np.zeros(len(order), dtype=np.int64)
        changed = np.concatenate([[False], (group[places][1:] == group[places][:-1]) & (own[1:] != own[:-1])])
        fresh[places] = changed
        group = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]) + fresh) if len(group) else group

    # second stage: buckets by first byte, upwards; in a bucket the larger ones come first, by their successors' rank
    rank = np.full(n + 1, -1, dtype=np.int64)
    rank[n] = 0  # the empty suffix
    by_byte = np.argsort(data, kind="stable")
    edges = np.searchsorted(data[by_byte], np.arange(257))
    direct = np.searchsorted(data[order], np.arange(257)) if len(order) else np.zeros(257, dtype=np.int64)
    suffixes, filled = np.empty(n, dtype=np.int64), 0
    for byte in range(256):
        own = by_byte[edges[byte]:edges[byte + 1]]
        if not len(own):
            continue
        larger = own[~smaller[own]]
        while len(larger):
            ready = rank[larger + 1] >= 0
            wave = larger[ready]
            wave = wave[np.argsort(rank[wave + 1], kind="stable")]
            suffixes[filled:filled + len(wave)] = wave
            rank[wave] = np.arange(filled + 1, filled + 1 + len(wave))
            filled += len(wave)
            larger = larger[~ready]
        mine = order[direct[byte]:direct[byte + 1]]
        suffixes[filled:filled + len(mine)] = mine
        rank[mine] = np.arange(filled + 1, filled + 1 + len(mine))
        filled += len(mine)
    return suffixes


def common_prefix_reaches(data: np.ndarray, suffixes: np.ndarray, length: int) -> np.ndarray:
    """For each suffix but the last: does it share ``length`` bytes with the next in order?"""
    words = eight_bytes(data, length + 16)
    alive = np.arange(len(suffixes) - 1)
    steps = [*range(0, length - 7, 8), length - 8]
    for at in steps:
        alive = alive[words[suffixes[alive] + at] == words[suffixes[alive + 1] + at]]
    out = np.zeros(max(0, len(suffixes) - 1), dtype=bool)
    out[alive] = True
    return out


def repeated_windows(segments: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per segment: starts of its ``length``-byte strings that also start elsewhere in the segments."""
    border = bytes([BORDER])
    data = np.frombuffer(border.join(segments), dtype=np.uint8)
    begins = np.cumsum([0] + [len(s) + 1 for s in segments])
    valid = np.zeros(len(data) + 1, dtype=bool)
    for b, s in zip(begins, segments):
        valid[b:b + max(0, len(s) - length + 1)] = True
    suffixes = suffix_array(data, length)
    # suffixes that cross a border are no windows; windows of equal text stay neighbours without them
    suffixes = suffixes[valid[suffixes]]
    same = common_prefix_reaches(data, suffixes, length)
    twice = np.zeros(len(suffixes), dtype=bool)
    twice[:-1] |= same
    twice[1:] |= same
    hit = np.sort(suffixes[twice])
    cut = np.searchsorted(hit, begins)
    return [hit[cut[i]:cut[i + 1]] - begins[i] for i in range(len(segments))]


def _spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of consecutive starts as covered spans."""
    new = np.concatenate([[True], np.diff(starts) > 1])
    end = np.concatenate([new[1:], [True]])
    return starts[new], starts[end] + length


SEGMENTS = "key long, a long, b long, start long, body binary"
SPANS = "a long, b long, start long, stop long"
WINDOWS = "a long, b long, start long, h1 long, h2 long"


def _emit_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for a, b, body, keys, starts, counts, kinds in zip(*(batch[c] for c in ("a", "b", "body", "keys", "starts", "counts", "kinds"))):
            body = bytes(body)
            rows += [(k, a, b, s, body[s:s + n + LENGTH - 1]) for k, s, n, kind in zip(keys, starts, counts, kinds) if kind == 1]
        yield pd.DataFrame(rows, columns=["key", "a", "b", "start", "body"])


def _emit_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for a, b, body, starts, counts, kinds in zip(*(batch[c] for c in ("a", "b", "body", "starts", "counts", "kinds"))):
            body = np.frombuffer(bytes(body), dtype=np.uint8)
            for s, n, kind in zip(starts, counts, kinds):
                if kind == 2:
                    part = body[s:s + n + LENGTH - 1]
                    yield pd.DataFrame({"a": a, "b": b, "start": s + np.arange(n),
                                        "h1": RollingHash(part).grams(LENGTH).view(np.int64),
                                        "h2": RollingHash(part, 2).grams(LENGTH).view(np.int64)})


def _sort_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by key; whole keys are gathered into one suffix array."""
    def found(rows):
        out = []
        for (_, a, b, start, _), hits in zip(rows, repeated_windows([r[4] for r in rows])):
            if len(hits):
                out += [(a, b, start + x, start + z) for x, z in zip(*map(np.ndarray.tolist, _spans(hits, LENGTH)))]
        return pd.DataFrame(out, columns=["a", "b", "start", "stop"])

    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch[c] for c in ("key", "a", "b", "start", "body"))):
            if size >= ARRAY_BYTES and row[0] != held[-1][0]:
                yield found(held)
                held, size = [], 0
            held.append((*row[:4], bytes(row[4])))
            size += len(row[4])
    if held:
        yield found(held)


RESULT = StructType([StructField("n_removed", LongType()), StructField("n_spans", LongType()),
                     StructField("kept_sha256", StringType()), StructField("kept", BinaryType())])


def cut_spans(body: bytes, starts, stops, keep_bytes: bool) -> tuple[int, int, str, bytes | None]:
    """Remove the union of the spans."""
    kept, at, spans = [], 0, 0
    if starts is not None and len(starts):
        begin = stop = None
        for s, z in sorted(zip(starts, stops)):
            if stop is not None and s <= stop:
                stop = max(stop, z)
                continue
            if stop is not None:
                kept.append(body[at:begin])
                at, spans = stop, spans + 1
            begin, stop = s, z
        kept.append(body[at:begin])
        at, spans = stop, spans + 1
    kept.append(body[at:])
    rest = b"".join(kept)
    return len(body) - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest if keep_bytes else None


def _cut_udf(keep_bytes: bool):
    @F.pandas_udf(RESULT)
    def cut(body: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut_spans(bytes(t), s, z, keep_bytes) if t is not None else (None, None, None, None)
                             for t, s, z in zip(body, starts, stops)], columns=["n_removed", "n_spans", "kept_sha256", "kept"])
    return cut


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the bytes kept."""
    body = F.encode(F.coalesce(col(text), F.lit("")), "utf-8")
    d = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("a"),
                    F.xxhash64(col(text)).alias("b"), body.alias("body"))
    long_ones = d.where(F.octet_length("body") >= LENGTH).select("a", "b", "body")
    runs = stored(long_ones.mapInPandas(_emit_runs, RUNS), "runs")
    again = runs.groupBy("key").agg(F.sum("seen").alias("seen")).where("seen > 1").select("key")
    # the runs of equal rows (same id and text) stand once, with the number of the rows
    equal = stored(long_ones.groupBy("a", "b").agg(F.count("*").alias("rows")).where("rows > 1"), "equal")
    told_again = runs.join(again, "key", "left_semi").join(equal.select("a", "b"), ["a", "b"], "left_semi")
    names = runs.columns
    told_again = told_again.groupBy(*names).agg(F.count("*").alias("times"))
    alone = runs.join(again, "key", "left_semi").join(equal.select("a", "b"), ["a", "b"], "left_anti")
    runs = stored(alone.withColumn("times", F.lit(1).cast("long")).unionByName(told_again), "candidates")
    texts = runs.groupBy("key", "seg", "n").agg(F.sum("times").alias("copies"), F.max("seen").alias("seen"))
    keys = texts.groupBy("key").agg(
        F.count("*").alias("different"), F.sum(F.col("n") + LENGTH - 1).alias("bytes"),
        F.max((F.col("copies") == 1).cast("int")).alias("any_single"), F.max("seen").alias("any_seen"))
    keys = keys.select("key", F.when((F.col("any_single") == 1) & ((F.col("different") > 1) | (F.col("any_seen") > 1)),
                                     F.when(F.col("bytes") > HOT_BYTES, 2).otherwise(1)).otherwise(0).alias("kind"))
    told = runs.drop("times").join(texts.select("key", "seg", "n", "copies"), ["key", "seg", "n"]).join(keys, "key")
    # 0: repeats as a whole; 1, 2: to be sorted or counted.  Of a repeated text one run goes along for the others
    told = stored(told.where("copies > 1 or kind > 0"), "told")
    first = told.where("copies > 1 and kind > 0").groupBy("key", "seg", "n", "kind").agg(
        F.min(F.struct("a", "b", "start")).alias("r")).select("r.a", "r.b", "key", "r.start", "n", "kind")
    listed = (told.where("copies > 1").select("a", "b", "key", "start", "n", F.lit(0).alias("kind"))
              .unionByName(told.where("copies = 1").select("a", "b", "key", "start", "n", "kind")).unionByName(first))
    lists = listed.groupBy("a", "b").agg(F.collect_list(F.struct("key", "start", "n", "kind")).alias("runs"))
    whole = F.filter("runs", lambda r: r["kind"] == 0)
    joined = (d.join(lists, ["a", "b"], "left")
              .withColumn("waits", F.coalesce(F.exists("runs", lambda r: r["kind"] > 0), F.lit(False)))
              .withColumns({"starts": F.transform(whole, lambda r: r["start"]),
                            "stops": F.transform(whole, lambda r: r["start"] + r["n"] + LENGTH - 1)}))
    now = F.when(~F.col("waits"), F.col("body"))
    half = stored(joined.select(
        "doc_id", "a", "b", F.octet_length("body").cast("long").alias("n_bytes"),
        _cut_udf(keep_bytes)(now, "starts", "stops").alias("done"), F.when(F.col("waits"), F.col("body")).alias("body"),
        "starts", "stops", F.when(F.col("waits"), F.col("runs")).alias("runs"), F.monotonically_increasing_id().alias("row_no")), "half")
    # of equal rows one goes to the suffix arrays, for all of them
    kept = half.where("body is not null").join(equal.select("a", "b"), ["a", "b"], "left_semi").select("a", "b", "row_no")
    least = kept.groupBy("a", "b").agg(F.min("row_no").alias("least"))
    others = kept.join(least, ["a", "b"]).where("row_no > least").select("row_no")
    waiting = half.where("body is not null").join(others, "row_no", "left_anti").select(
        "a", "b", "body", *[F.expr(f"transform(runs, r -> r.{f})").alias(n)
                            for f, n in (("key", "keys"), ("start", "starts"), ("n", "counts"), ("kind", "kinds"))])
    sorted_ = (waiting.mapInPandas(_emit_segments, SEGMENTS).repartition("key").sortWithinPartitions("key")
               .mapInPandas(_sort_segments, SPANS))
    counted = stored(waiting.where("exists(kinds, k -> k = 2)").mapInPandas(_emit_windows, WINDOWS), "windows")
    twice = counted.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2")
    counted = counted.join(twice, ["h1", "h2"], "left_semi").select(
        "a", "b", "start", (F.col("start") + LENGTH).alias("stop"))
    more = sorted_.unionByName(counted).groupBy("a", "b").agg(F.collect_list(F.struct("start", "stop")).alias("more"))
    late = half.where("body is not null").select("doc_id", "a", "b", "n_bytes", "body", "starts", "stops").join(more, ["a", "b"], "left")
    extra = F.coalesce("more", F.array().cast("array<struct<start:bigint,stop:bigint>>"))
    late = late.select("doc_id", "n_bytes", _cut_udf(keep_bytes)(
        "body", F.concat("starts", F.transform(extra, lambda x: x["start"])),
        F.concat("stops", F.transform(extra, lambda x: x["stop"]))).alias("done"))
    out = half.where("body is null").select("doc_id", "n_bytes", "done").unionByName(late)
    return out.select("doc_id", "n_bytes", "done.n_removed", "done.n_spans", "done.kept_sha256",
                      *(["done.kept"] if keep_bytes else []))
