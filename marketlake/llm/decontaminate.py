"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared case-folded, with every run of ASCII non-alphanumerics as one
blank.  Items are cut into overlapping pieces of two lengths, a quarter of a
piece apart, and into 80 to 160 characters end to end (bytes of the normal
form).  A piece of m characters may occur with up to k = m * MAX_EDITS edits.
Such an occurrence keeps at least m - Q + 1 - k * Q of the piece's q-grams, on
diagonals (text position - piece position) at most k apart.  Shared q-grams are
counted per piece in overlapping diagonal bands (each band spans two strides of
k + 1, so any k + 1 neighbouring diagonals lie in one band whole); a gram counts once per
place in the piece and in the text.  Bands that reach the bound are verified by a
banded edit-distance alignment, and grow at both ends as far as item and text
agree.  A document is contaminated by an item when the characters of the item
that lie in any verified piece make up at least MIN_COVERED of it.  ``edits`` is
the sum over the fewest pieces that cover these characters.

The benchmark is the stated query set: it is read in blocks of about BLOCK_BYTES
of text (whole items), each block's q-gram index (some 170 bytes per byte of
items) goes to the tasks, and every whole document is scanned once per block.
With several blocks each one's finds are stored before the next is built.  No
document is shuffled; a very long text is scanned in overlapping stretches, and
shared grams are followed to at most SLICE of their places at a time.

Defined results: null or empty texts match nothing; items under MIN_ITEM
characters of normal form or with a null id are not searched; repeated items and documents
are matched each for themselves; ties: of equally good alignments the first in
the text is reported; empty tables: no rows; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .shared import col, scratch_dir, whole_row

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Q = 10
MAX_EDITS = 0.08
MIN_SHARED = 8
MIN_ITEM = 40
#: a piece of an end-to-end cut has PIECE to 2 * PIECE characters; lengths of the overlapping ones
PIECE = 80
OVERLAPPING = (40, 80)
MIN_COVERED = 0.5
BLOCK_BYTES = 1 << 19
#: characters of normal form scanned at once
STRETCH = 1 << 20
#: places of shared grams in pieces held at once
SLICE = 1 << 20

KEEP = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SPREAD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def normal_form(text: str) -> bytes:
    return b" ".join(text.casefold().encode("utf-8", "replace").translate(KEEP).split())


def original_offsets(text: str) -> np.ndarray:
    """Code point in ``text`` of every byte of its normal form."""
    if text.isascii():
        kept = np.frombuffer(text.encode().translate(KEEP), dtype=np.uint8) != 32
        gap = ~kept & np.concatenate([[False], kept[:-1]])  # the first blank after a word
        if kept.any():
            gap[np.flatnonzero(kept)[-1]:] = False
        return np.flatnonzero(kept | gap)
    out, gap, any_yet = [], None, False
    for i, ch in enumerate(text):
        for b in ch.casefold().encode("utf-8", "replace").translate(KEEP):
            if b == 32:
                gap = i if gap is None else gap
            else:
                if gap is not None and any_yet:
                    out.append(gap)
                gap, any_yet = None, True
                out.append(i)
    return np.array(out, dtype=np.int64)


def piece_borders(n: int) -> list[tuple[int, int]]:
    """The pieces (begin, end) of an item of ``n`` characters."""
    cuts = np.linspace(0, n, max(1, n // PIECE) + 1).astype(int).tolist()
    out = set(zip(cuts[:-1], cuts[1:]))
    for size in OVERLAPPING:
        if size < n:
            out.update((a, a + size) for a in [*range(0, n - size, size // 4), n - size])
    return sorted(out)


class PieceIndex:
    """q-grams of the pieces of a block of items."""

    def __init__(self, items: Iterable[tuple[int, str]]):
        self.pieces, self.owner, self.begin, self.forms, self.item_chars = [], [], [], {}, {}
        for n, (item, text) in enumerate(items):
            form = normal_form(text or "")
            if item is None or len(form) < MIN_ITEM:
                continue
            self.item_chars[n], self.forms[n] = (item, len(form)), form
            for a, z in piece_borders(len(form)):
                self.pieces.append(form[a:z])
                self.owner.append(n)
                self.begin.append(a)
        sizes = np.array([len(p) for p in self.pieces], dtype=np.int64)
        self.edits = np.minimum((sizes * MAX_EDITS).astype(np.int64), (sizes - Q + 1 - MIN_SHARED) // Q)
        self.bound = sizes - Q + 1 - self.edits * Q
        self.reach = int((sizes + self.edits).max(initial=0))
        self.stride = self.edits + 1
        grams, piece, at = [np.zeros(0, dtype="<u8")], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for i, p in enumerate(self.pieces):
            g = windows(p)
            grams.append(g), piece.append(np.full(len(g), i)), at.append(np.arange(len(g)))
        grams, piece, at = np.concatenate(grams), np.concatenate(piece), np.concatenate(at)
        order = np.argsort(grams, kind="stable")
        self.grams, first = np.unique(grams[order], return_index=True)
        self.first = np.append(first, len(order))
        # sorted by gram, then piece
        self.key = np.repeat(np.arange(len(self.grams)), np.diff(self.first)) * len(self.pieces) + piece[order]
        self.at = at[order].astype(np.int32)
        # slot -> gram; grams that meet in a slot go to the next table
        self.longest = max(map(len, self.pieces), default=0)
        self.tables, left = [], np.arange(len(self.grams))
        while len(left) or not self.tables:
            shift = np.uint64(64 - max(16, len(left).bit_length() + 4))
            table = np.full(1 << (64 - int(shift)), -1, dtype=np.int32)
            spot = self.slots(self.grams[left], shift)
            table[spot] = left
            self.tables.append((shift, table))
            left = left[table[spot] != left]

    @staticmethod
    def slots(grams: np.ndarray, shift: np.uint64) -> np.ndarray:
        return ((grams * MIX) >> shift).astype(np.int32)

    def lookup(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, gram numbers) of those of ``grams`` that are in the index, by position."""
        shift, table = self.tables[0]
        at = np.flatnonzero(table[self.slots(grams, shift)] >= 0)
        mine = grams[at]
        found = np.full(len(at), -1, dtype=np.int64)
        for shift, table in self.tables:
            number = table[self.slots(mine, shift)]
            same = (number >= 0) & (self.grams[number] == mine)
            found[same] = number[same]
        real = found >= 0
        return at[real], found[real]

    def places(self, at: np.ndarray, which: np.ndarray, low: int, high: int):
        """The places of grams in the pieces low..high - 1, in slices (text position, piece, place in the piece).

        A slice holds every place of its pieces that any occurrence needs.
        """
        first = np.searchsorted(self.key, which * len(self.pieces) + low)
        times = np.searchsorted(self.key, which * len(self.pieces) + high) - first
        total = int(times.sum())
        if not total:
            return
        if total > SLICE and high - low > 1:
            middle = (low + high) // 2
            yield from self.places(at, which, low, middle)
            yield from self.places(at, which, middle, high)
        elif total > SLICE and at[-1] - at[0] > 8 * self.longest:
            # one piece: halves of the text that share more than any band of an occurrence spans
            middle = (at[0] + at[-1]) // 2
            for part in (at < middle + 2 * self.longest, at >= middle):
                yield from self.places(at[part], which[part], low, high)
        else:
            entry = np.arange(total) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
            yield np.repeat(at, times), self.key[entry] % len(self.pieces), self.at[entry].astype(np.int64)


def windows(form: bytes) -> np.ndarray:
    """Each Q bytes of ``form`` as one number (two overlapping groups of 8 bytes, mixed)."""
    n = len(form) - 7
    if n < Q - 7:
        return np.zeros(0, dtype="<u8")
    eight = np.ndarray((n,), dtype="<u8", buffer=form, strides=(1,))
    return eight[:8 - Q] ^ (eight[Q - 8:] * SPREAD)


def dense(at: np.ndarray, least: int, reach: int) -> np.ndarray:
    """Which of the sorted positions lie among ``least`` within ``reach`` of each other."""
    if len(at) < least:
        return np.zeros(len(at), dtype=bool)
    begins = np.flatnonzero(at[least - 1:] - at[:len(at) - least + 1] <= reach)
    steps = np.zeros(len(at) + 1, dtype=np.int64)
    np.add.at(steps, begins, 1)
    np.add.at(steps, begins + least, -1)
    return np.cumsum(steps[:-1]) > 0


def band_alignment(piece: bytes, form: bytes, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, begin, end) of the best occurrence of ``piece`` in ``form`` on diagonals low..high; None above ``most``.

    Cells are held by diagonal: one row per character of the piece.
    """
    exact = form.find(piece, max(0, low), max(0, high + len(piece) + 1))
    if exact >= 0:
        return 0, exact, exact + len(piece)
    low, high = low - most, high + most
    width, far = high - low + 1, len(piece) + 1
    x = np.frombuffer(form, dtype=np.uint8)
    diagonals = np.arange(low, high + 1)
    cost = np.where((diagonals >= 0) & (diagonals <= len(x)), 0, far)
    begin = diagonals.copy()
    steps = np.arange(width)
    for i, c in enumerate(piece):
        at = diagonals + i  # text position that this row's character would match
        inside = (at >= 0) & (at < len(x))
        same = np.zeros(width, dtype=bool)
        same[inside] = x[at[inside]] == c
        match = np.where(inside, cost + ~same, far)
        drop = np.append(cost[1:], far) + 1  # the piece's character is missing in the text
        take_drop = drop < match
        new = np.where(take_drop, drop, match)
        new_begin = np.where(take_drop, np.append(begin[1:], 0), begin)
        # an extra character of the text: moves one diagonal up at one edit each
        run = np.minimum.accumulate(new - steps)
        origin = np.maximum.accumulate(np.where(new - steps == run, steps, 0))
        cost, begin = run + steps, new_begin[origin]
        if cost.min() > most:
            return None
    best = int(cost.argmin())
    if cost[best] > most:
        return None
    return int(cost[best]), int(begin[best]), int(diagonals[best] + len(piece))


def occurrences(form: bytes, index: PieceIndex) -> list[tuple[int, int, int, int]]:
    """(piece, begin, end, edits) of the verified bands in a normal form; of a piece none after one without edits."""
    found, exact = {}, set()
    longest = index.longest
    for start in range(0, max(1, len(form)), STRETCH):
        part = form[start:start + STRETCH + 2 * longest]
        at, which = index.lookup(windows(part))
        near = dense(at, int(index.bound.min()), index.reach)
        at, which = at[near], which[near]
        n_bands = (len(part) + longest) // int(index.stride.min()) + 2
        for place, piece, place_in_piece in index.places(at, which, 0, len(index.pieces)):
            stride = index.stride[piece]
            low_band = (place - place_in_piece + longest) // stride  # diagonals start at -longest
            lower = piece * n_bands + low_band
            both = np.concatenate([lower, lower - 1])
            order = np.argsort(both, kind="stable")
            keys, first, counts = np.unique(both[order], return_index=True, return_counts=True)
            many = counts >= index.bound[keys // n_bands]
            for key, f, c in zip(keys[many].tolist(), first[many].tolist(), counts[many].tolist()):
                p, band = divmod(key, n_bands)
                if p in exact:
                    continue
                own = order[f:f + c] % len(lower)
                if min(len(np.unique(place_in_piece[own])), len(np.unique(place[own]))) < index.bound[p]:
                    continue
                low, wide = band * int(index.stride[p]) - longest, 2 * int(index.stride[p])
                hit = band_alignment(index.pieces[p], part, low, low + wide - 1, int(index.edits[p]))
                if hit:
                    edits, begin, end = hit
                    spot = (p, start + end)
                    if spot not in found or edits < found[spot][1]:
                        found[spot] = (start + begin, edits)
                    if not edits:
                        exact.add(p)
    return [(p, b, z, e) for (p, z), (b, e) in sorted(found.items())]


def agreeing(x: bytes, y: bytes) -> int:
    """Length of the common beginning."""
    n, size = 0, 32
    while x[n:n + size] == y[n:n + size] and min(len(x), len(y)) > n:
        n, size = min(n + size, len(x), len(y)), 2 * size
    for i, j in zip(x[n:n + size], y[n:n + size]):
        if i != j:
            break
        n += 1
    return n


def grown(form: bytes, item: bytes, a: int, z: int, begin: int, end: int) -> tuple[int, int, int, int]:
    """A piece a..z of an item, found at begin..end, with what agrees on both sides."""
    reach = len(item)
    left = agreeing(item[:a][::-1], form[max(0, begin - reach):max(0, begin)][::-1])
    right = agreeing(item[z:], form[end:end + reach])
    return a - left, z + right, begin - left, end + right


def covering(pieces: list[tuple[int, int, int]]) -> tuple[int, int]:
    """(characters, edits) of pieces (begin, end, edits) of an item: their union, and the edits of the fewest that make it up."""
    covered = edits = upto = 0
    ordered, i = sorted(pieces), 0
    while i < len(ordered):
        if ordered[i][0] > upto:
            upto = ordered[i][0]
        reach, cost = upto, 0
        while i < len(ordered) and ordered[i][0] <= upto:
            if (ordered[i][1], -ordered[i][2]) > (reach, -cost):
                reach, cost = ordered[i][1], ordered[i][2]
            i += 1
        covered, edits, upto = covered + reach - upto, edits + (cost if reach > upto else 0), reach
    return covered, edits


def contaminations(text: str | None, index: PieceIndex) -> list[list[int]]:
    """[item, start, end, edits, covered, item characters] for every item that contaminates the text."""
    if not text or not index.pieces:
        return []
    form = normal_form(text)
    best: dict[int, dict[int, tuple[int, int, int]]] = {}
    for p, b, z, e in occurrences(form, index):
        mine = best.setdefault(index.owner[p], {})
        if p not in mine or e < mine[p][2]:
            mine[p] = (b, z, e)
    out, offsets = [], None
    for n, mine in best.items():
        item, chars = index.item_chars[n]
        parts = [(*grown(form, index.forms[n], index.begin[p], index.begin[p] + len(index.pieces[p]), b, z), e)
                 for p, (b, z, e) in mine.items()]
        covered, edits = covering([(a, z, e) for a, z, _, _, e in parts])
        if covered >= MIN_COVERED * chars:
            offsets = original_offsets(text) if offsets is None else offsets
            start, end = min(x[2] for x in parts), max(x[3] for x in parts)
            start, end = max(0, start), min(len(offsets), end)
            out.append([item, int(offsets[start]), int(offsets[end - 1]) + 1, edits, covered, chars])
    return sorted(out)


def _search_udf(index):
    @F.pandas_udf(ArrayType(ArrayType(LongType())))
    def search(texts: pd.Series) -> pd.Series:
        mine = index.value
        return pd.Series([contaminations(t, mine) for t in texts], dtype=object)
    return search


def _blocks(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text"):
    """(number of blocks, broadcast index) of each block of the benchmark, built one after another."""
    items = benchmark.select(col(item_id).cast("long").alias("item"), col(item_text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).orderBy("item", "text").collect()
        yield blocks, docs.sparkSession.sparkContext.broadcast(PieceIndex([(r.item, r.text) for r in own]))


def _each_block(docs: DataFrame, benchmark: DataFrame, find) -> DataFrame:
    """Rows of ``find(search)`` over all blocks of the benchmark; those of several blocks are stored block by block."""
    path = scratch_dir(docs.sparkSession, "contamination")
    for blocks, index in _blocks(docs, benchmark):
        rows = find(_search_udf(index))
        if blocks == 1:
            return rows
        rows.write.mode("append").parquet(path)
        index.destroy()
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def find_contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per contaminated (document, item): doc_id, item_id, start, end (code points), edits, covered, item_chars."""
    d = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    names = ("item_id", "start", "end", "edits", "covered", "item_chars")
    return _each_block(d, benchmark, lambda search: d.select("doc_id", F.explode(search("text")).alias("hit")).select(
        "doc_id", *[F.col("hit")[i].alias(n) for i, n in enumerate(names)]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no item contaminates, in the columns of ``docs``."""
    d = docs.select(whole_row(docs).alias("row"), col(text).alias("text"))
    blocks, index = next(_blocks(docs, benchmark))
    if blocks == 1:
        return d.where(F.size(_search_udf(index)("text")) == 0).select("row.*")
    index.destroy()
    # contamination is a matter of the text alone
    d = d.withColumn("key", F.sha2("text", 256))
    gone = _each_block(d, benchmark, lambda search: d.where(F.size(search("text")) > 0).select("key"))
    return d.join(gone.distinct(), "key", "left_anti").select("row.*")
