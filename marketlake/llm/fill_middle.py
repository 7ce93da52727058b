"""Fill-in-the-middle: texts cut at code points into prefix, middle and suffix, and rebuilt.

The cuts are found on bytes, eight at a time, for all texts of an Arrow batch at once:

1. The batch's UTF-8 bytes are viewed as little-endian uint64 words.  A byte continues a unit where its
   top bits are 10; shifts and masks mark the others in all eight bytes of a word, and moving these
   marks one byte down marks the bytes that end a unit.
2. ``bitwise_count`` counts the ends of a word, a running sum those before it.
3. The k-th end of a text is the (ends before the text + k)-th of the batch: a search in the
   running sum gives its word, and running sums within the word (one multiplication) its byte.

Texts in psm or spm form hold none of the markers, so that ``restore_text`` finds the parts again.

Defined results: null text = empty text, form plain; a text of one unit has empty parts; null ids take
the cuts of the decimal text ''; repeated rows have equal cuts; an empty table gives no rows; columns of
the input that are named like a result are replaced.  One text must fit in an Arrow batch (2 GB).
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .shared import col

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # percent: h3 at or above it leaves a text plain
SPM_BELOW = 20  # percent: h4 below it puts the suffix first

ONES = np.uint64(0x0101010101010101)
BYTE = np.uint64(8)


def unit_ends(words: np.ndarray) -> np.ndarray:
    """For words of UTF-8 (little-endian), 1 in each byte that ends a unit.

    The byte after the last word counts as the start of a unit.
    """
    continues = (words >> np.uint64(7)) & ~(words >> np.uint64(6)) & ONES
    starts = continues ^ ONES
    after = np.append(starts[1:], ONES)
    return (starts >> BYTE) | (after << np.uint64(56))


def select_in_word(marks: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The byte (0 to 7) of the k-th mark of each word, k from 1."""
    running = marks * ONES  # byte j: marks in bytes 0 to j
    fewer = ((k * ONES | (ONES << np.uint64(7))) - running - ONES) >> np.uint64(7) & ONES  # 1 where running < k
    return np.bitwise_count(fewer).astype(np.int64)


class UnitIndex:
    """Unit ends of many texts that lie one after another in a buffer."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        padded = np.zeros((len(data) + 7) // 8 * 8, np.uint8)
        padded[:len(data)] = data
        self.marks = unit_ends(padded.view("<u8"))
        self.total = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])
        self.starts = starts
        self.before = self.rank(starts)
        self.units = self.rank(ends) - self.before

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Unit ends before a byte."""
        if not len(self.marks):
            return np.zeros(len(at), np.int64)
        word, byte = np.divmod(at, 8)
        below = (np.uint64(1) << (byte.astype(np.uint64) * BYTE)) - np.uint64(1)
        inside = self.marks[np.minimum(word, len(self.marks) - 1)] & below
        return self.total[word] + np.bitwise_count(inside)

    def byte_after(self, units: np.ndarray) -> np.ndarray:
        """For each text, the byte after its first so many units."""
        out = self.starts.copy()
        some = units > 0
        wanted = (self.before + units)[some]
        word = np.searchsorted(self.total, wanted, side="left") - 1
        left = (wanted - self.total[word]).astype(np.uint64)
        out[some] = word * 8 + select_in_word(self.marks[word], left) + 1
        return out


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow array of strings and their borders."""
    flat = texts.cast(pa.large_binary())
    _, offsets, data = flat.buffers()
    borders = np.frombuffer(offsets, np.int64)[flat.offset:flat.offset + len(flat) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[borders[0]:borders[-1]], borders - borders[0]


def cut(texts: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Per text (no nulls): its units, those before the first cut and between the cuts, and its three parts."""
    data, borders = _bytes_of(texts)
    index = UnitIndex(data, borders[:-1], borders[1:])
    n = index.units
    first, second = (np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0) if len(n) else np.zeros((2, 0), np.int64))
    whole = data.tobytes()
    a, b = index.byte_after(first), index.byte_after(second)
    places = zip(*(x.tolist() for x in (borders[:-1], a, b, borders[1:])))
    return n, first, second - first, [(whole[s:x], whole[x:y], whole[y:e]) for s, x, y, e in places]


@F.arrow_udf(StructType([StructField(c, LongType()) for c in ("n", "prefix_chars", "middle_chars")] + [StructField("output", StringType())]))
def _transform(texts: pa.Array, forms: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    n, before, between, parts = cut(texts, h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False))
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    forms = forms.to_pylist()
    made = [b"".join((p, a, s, z, m, b) if form == "psm" else (s, z, p, a, m, b) if form == "spm" else (a, b, z))
            for form, (a, b, z) in zip(forms, parts)]
    plain = np.array([form == "plain" for form in forms], bool)
    return pa.StructArray.from_arrays(
        [pa.array(n), pa.array(before, mask=plain), pa.array(between, mask=plain), pa.array(made, pa.binary()).cast(pa.string())],
        ["n", "prefix_chars", "middle_chars", "output"])


def restore_text(output: Column, form: Column) -> Column:
    """The exact text of an output: its parts between the markers, in their order."""
    after = lambda s, mark: F.substring_index(s, mark, -1)
    before = lambda s, mark: F.substring_index(s, mark, 1)
    middle = after(output, MIDDLE)
    psm = F.concat(after(before(output, SUFFIX), PREFIX), middle, before(after(output, SUFFIX), MIDDLE))
    spm = F.concat(before(after(output, PREFIX), MIDDLE), middle, after(before(output, PREFIX), SUFFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    content = F.coalesce(col(text), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(col(doc_id).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    plain = (content == "") | (h[2] % 100 >= PLAIN_FROM)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | content.contains(mark)
    form = F.when(plain, "plain").when(h[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    made = _transform(content, form, h[0], h[1])
    names = ("n", "prefix_chars", "middle_chars", "output")
    # the results are one struct until the inputs are no longer needed
    out = df.select(F.struct(*[col(c) for c in df.columns]).alias("row"), form.alias("form"), made.alias("made"))
    kept = [F.col("row")[c].alias(c) for c in df.columns if c not in (*names, "form")]
    return out.select(*kept, "form", *[F.col("made")[c].alias(c) for c in names])
