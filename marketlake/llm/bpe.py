"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

A merge list looks only a bounded way ahead.  Compare the merging of a byte string ``w`` with that
of ``w + x``, rule by rule: both agree on all tokens before a border, at first the end of ``w``.
A rule (u, v) moves the border only where u is the last token before it and v the first after it in
one of the two; it then moves left by the length of u, and whatever starts at the new border grows
from u.  So the rules that move it form a chain of rising ranks in which u of one rule begins v of
the next, and the largest sum of ``len(u)`` over such a chain (``sufficient_lookahead``) bounds how
far before the end of ``w`` anything can still change.  Tokens that end before that are stable.

``Encoder`` takes characters in any slices and gives tokens as soon as they are stable.  It holds the
characters of the piece that is open, at most ``LONG`` of them, or ``lookahead + STEP`` bytes of a
longer piece, and memos of at most ``2 * MEMO`` short pieces: constant memory, however long a text or
a piece is.  ``Decoder`` turns tokens into text as they come, with at most three bytes of an open
character; bytes that are no UTF-8 become U+FFFD.

Defined results: null text = empty text, no tokens; a special token's string inside a text is that
token, as the tokenizers library has it; null ids and ids that the vocabulary lacks decode to nothing; null
list of ids = empty text.  Both are columns of a row's own text: repeated rows, ties, empty tables and
clashing names of other columns need no rule.
"""

from __future__ import annotations

import codecs
import heapq
import json
import sys
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import col

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: characters given to an encoder at once
SLICE = 1 << 16
#: a piece with more characters is streamed through the window
LONG = 1024
#: bytes that a window holds beyond the lookahead
STEP = 4096
#: pieces that a task remembers, and the longest of them
MEMO, MEMO_CHARS = 1 << 18, 48

# fixed values: the piece pattern of the byte-level pre-tokenizer and the character classes in it
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CLASSES = (r"\s", r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")

#: rank of neighbours that no rule merges
NO_RULE = 1 << 62


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if printable, else the next free one from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(printable))
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token's end that fix it: the heaviest chain of rules (see the module's docstring)."""
    parts: dict[bytes, list[tuple[bytes, bytes]]] = {}
    for u, v in merges:
        parts.setdefault(u + v, []).append((u, v))

    def beginnings(token: bytes) -> set[bytes]:
        seen, todo = {token}, [token]
        while todo:
            for u, _ in parts.get(todo.pop(), ()):
                if u not in seen:
                    seen.add(u)
                    todo.append(u)
        return seen

    reach: dict[bytes, int] = {}
    most = 0
    for u, v in merges:
        far = len(u) + max(reach.get(t, 0) for t in beginnings(v))
        reach[u] = max(reach.get(u, 0), far)
        most = max(most, far)
    return most


@dataclass(frozen=True)
class BpeModel:
    """``tokens[i]`` are the bytes of id i (None: no such id); merges by rank; special strings and their ids."""

    tokens: list
    merges: list
    specials: dict
    lookahead: int


def load_model(path: str) -> BpeModel:
    """Read a tokenizer file of the tokenizers library (byte-level BPE without normalisation)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    unsupported = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                               "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    if (model.get("type") != "BPE" or unsupported or spec.get("normalizer") or spec.get("post_processor")
            or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or (spec.get("decoder") or {}).get("type") != "ByteLevel"):
        raise ValueError(f"{path}: not a plain byte-level BPE {unsupported}")
    alphabet = byte_alphabet()
    raw = lambda t: bytes(alphabet[c] for c in t)
    specials = {}
    for t in spec.get("added_tokens", []):
        if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized"):
            raise ValueError(f"{path}: added token {t['content']!r} is not a plain one")
        specials[t["content"]] = t["id"]
    tokens: list = [None] * (1 + max([*model["vocab"].values(), *specials.values()]))
    for t, i in model["vocab"].items():
        tokens[i] = raw(t)
    for t, i in specials.items():
        tokens[i] = raw(t) if all(c in alphabet for c in t) else t.encode()
    merges = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    made = {bytes([b]) for b in range(256)}
    for u, v in merges:
        if u not in made or v not in made:
            raise ValueError(f"{path}: a merge uses {u!r} or {v!r} before it is made")
        made.add(u + v)
    return BpeModel(tokens, merges, specials, sufficient_lookahead(merges))


class Merger:
    """Merges of a bounded byte string: always the pair of least rank, the leftmost first."""

    def __init__(self, model: BpeModel):
        self.model = model
        self.longest = max(len(t) for t in model.tokens if t)
        special = set(model.specials.values())
        ids = {t: i for i, t in enumerate(model.tokens) if t is not None and i not in special}
        self.byte_ids = [ids.get(bytes([b])) for b in range(256)]
        self.width = len(model.tokens)
        self.rules = {ids[u] * self.width + ids[v]: rank for rank, (u, v) in enumerate(model.merges)}
        self.made = [ids[u + v] for u, v in model.merges]

    def merge(self, data: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in data]
        return self._few(ids) if len(ids) <= 512 else self._many(ids)

    def _few(self, ids: list[int]) -> list[int]:
        """Ranks of all neighbours in a list; only those beside a merge change."""
        find, width, made = self.rules.get, self.width, self.made
        ranks = [find(a * width + b, NO_RULE) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) != NO_RULE:
            i = ranks.index(least)
            ids[i] = new = made[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find(ids[i - 1] * width + new, NO_RULE)
            if i < len(ranks):
                ranks[i] = find(new * width + ids[i + 1], NO_RULE)
        return ids

    def _many(self, ids: list[int]) -> list[int]:
        """A heap of (rank, place, pair); a merged place keeps its left token, the right one goes."""
        find, width, n = self.rules.get, self.width, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = (a * width + b for a, b in zip(ids, ids[1:]))
        heap = [(rank, i, pair) for i, pair in enumerate(pairs) if (rank := find(pair, NO_RULE)) != NO_RULE]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or ids[i] * width + ids[j] != pair:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((i, k), (before[i], i)):
                if left >= 0 and right < n and (rank := find(pair := ids[left] * width + ids[right], NO_RULE)) != NO_RULE:
                    heapq.heappush(heap, (rank, left, pair))
        return [t for t in ids if t >= 0]


def packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Memo(dict):
    """Tokens of short pieces as packed int32.  When it is full it becomes the elder memo, from which pieces in use come back."""

    def __init__(self, merger: Merger):
        super().__init__()
        self.merger, self.elder = merger, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.elder.get(piece)
        if ids is None:
            ids = packed(self.merger.merge(piece.encode()))
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.elder = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Characters in, stable tokens out: ``feed`` any number of slices, then ``finish``."""

    def __init__(self, model: BpeModel):
        self.merger, self.lookahead, self.specials = Merger(model), model.lookahead, model.specials
        self.step = max(STEP, 2 * self.merger.longest)
        self.memo = Memo(self.merger)
        self.pieces = regex.compile(PIECES)
        self.runs = [regex.compile(f"{c}+") for c in CLASSES]
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.held_back = max(map(len, longest_first), default=1) - 1
        self._restart()

    def _restart(self) -> None:
        self.unread = ""  # may be the beginning of a special token
        self._open_segment()

    def _open_segment(self) -> None:
        self.open = ""  # characters of the last piece, or the last character of a long one
        self.run = None  # the class of an open long piece
        self.window = b""  # its bytes that are not stable

    def feed(self, chars: str) -> array:
        return self._read(self.unread + chars, final=False)

    def finish(self) -> array:
        out = self._read(self.unread, final=True)
        self._restart()
        return out

    def encode(self, text: str) -> array:
        out = array("i")
        for at in range(0, len(text), SLICE):
            out += self.feed(text[at:at + SLICE])
        return out + self.finish()

    def _read(self, chars: str, final: bool) -> array:
        """Cut out special tokens; a place is decided once the longest of them could stand there."""
        out: list[bytes] = []
        decided = len(chars) if final else max(0, len(chars) - self.held_back)
        at = 0
        while self.marks and (m := self.marks.search(chars, at)) and m.start() < decided:
            out += self._split(chars[at:m.start()], final=True)
            out.append(packed([self.specials[m.group()]]))
            at = m.end()
        decided = max(at, decided)
        out += self._split(chars[at:decided], final)
        self.unread = chars[decided:]
        return array("i", b"".join(out))

    def _split(self, chars: str, final: bool) -> list[bytes]:
        """Pieces of one segment; the last one stays open until its end is seen."""
        chars, out = self.open + chars, []
        if self.run is not None:
            end = self.run.match(chars).end() if chars else 0
            if end == len(chars) and not final:
                self.open = chars[-1:]
                return [self._slide(chars[:-1])]
            if end < len(chars) and chars[end - 1].isspace() and self.run is self.runs[0]:
                end -= 1  # the last blank before a word is not of the run
            out += [self._slide(chars[:end]), packed(self.merger.merge(self.window))]
            chars, self.run, self.window = chars[end:], None, b""
        pieces = self.pieces.findall(chars)
        self.open = ""
        if not final and pieces:
            # a piece that touches the end may go on; so may an apostrophe with one letter after it
            if len(pieces) > 1 and pieces[-2] == "'" and len(pieces[-1]) == 1:
                self.open = pieces.pop()
            self.open = pieces.pop() + self.open
        out.append(b"".join(map(self.memo.__getitem__, pieces)))
        if final:
            self._open_segment()
        elif len(self.open) > LONG:
            self.run = next(r for r in self.runs if r.fullmatch(self.open[-1]))
            fed, self.open = self.open[:-1], self.open[-1:]
            out.append(self._slide(fed))
        return out

    def _slide(self, chars: str) -> bytes:
        """Move characters of a long piece through the window; tokens that no further byte changes come out."""
        data, out, at, size = self.window + chars.encode(), [], 0, self.lookahead + self.step
        while len(data) - at >= size:
            end = stable = 0
            for i in self.merger.merge(data[at:at + size]):
                end += len(self.merger.model.tokens[i])
                if end > self.step:
                    break
                out.append(i)
                stable = end
            at += stable
        self.window = data[at:]
        return packed(out)


class Decoder:
    """Tokens in, text out: bytes of an open character are kept until the next tokens."""

    def __init__(self, model: BpeModel):
        known = [t or b"" for t in model.tokens]
        self.lengths = np.array([len(t) for t in known], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(known), np.uint8)
        self.state = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: np.ndarray) -> str:
        """``ids``: integers; those that the vocabulary lacks give nothing."""
        ids = ids[(ids >= 0) & (ids < len(self.lengths))]
        lengths = self.lengths[ids]
        # each output byte's place in the table: its token's start, counted on within the token
        shift = self.starts[ids] - (np.cumsum(lengths) - lengths)
        place = np.repeat(shift, lengths) + np.arange(int(lengths.sum()))
        return self.state.decode(self.bytes[place].tobytes())

    def finish(self) -> str:
        rest = self.state.decode(b"", final=True)
        self.state.reset()
        return rest

    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        out = [self.feed(ids[at:at + SLICE]) for at in range(0, len(ids), SLICE)]
        return "".join([*out, self.finish()])


def encode_column(text: Column, model: BpeModel) -> Column:
    """The token ids of a text, array<int>.

    Declared nondeterministic only to keep Catalyst from encoding anew wherever the ids are used.
    """
    made: list[Encoder] = []

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Encoder(model))
        ids, ends = array("i"), [0]
        for t in texts:
            ids.extend(made[0].encode(t.as_py() or ""))
            ends.append(len(ids))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))

    return encode.asNondeterministic()(text)


def decode_column(ids: Column, model: BpeModel) -> Column:
    """The text of token ids, string."""
    made: list[Decoder] = []

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        if not made:
            made.append(Decoder(model))
        rows = rows.fill_null([]) if rows.null_count else rows
        ends = rows.offsets.to_numpy()
        ids = rows.values.fill_null(-1).to_numpy(zero_copy_only=False)
        return pa.array([made[0].decode(ids[a:z]) for a, z in zip(ends[:-1], ends[1:])], pa.string())

    return decode(ids)


def tokenize(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (the tokens of ``text``) and ``decoded`` (their text); such columns of ``df`` are replaced."""
    model = load_model(path)
    return df.withColumn("ids", encode_column(col(text), model)).withColumn("decoded", decode_column(F.col("ids"), model))
