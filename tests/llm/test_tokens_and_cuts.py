"""Encoding against the tokenizers library; cuts against slices of plain strings; edge cases of both."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from marketlake.llm import bpe, fill_middle, queries

SF = "/root/testdata/sf0.001"
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, `row` int, form int, n string, decoded string"
CHARS = ["'", "s", "re", "ll", " ", "  ", "\n", "a", "b", "1", "2", ".", "é", "日本", "🙂", "<|endoftext|>", "<|endof", "the", " the", "\t", "'d", "'v", "e"]


@pytest.fixture(scope="module")
def model():
    return bpe.load_model(BPE_FILE)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(BPE_FILE)


def in_slices(encoder, text, rng, most):
    out, at = [], 0
    while at < len(text):
        n = rng.randrange(1, most)
        out += encoder.feed(text[at:at + n])
        at += n
    return [*out, *encoder.finish()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_lookahead_is_the_heaviest_chain(model):
    assert bpe.sufficient_lookahead([]) == 0
    assert bpe.sufficient_lookahead([(b"a", b"b")]) == 1
    # (a, b) then (c, ab): a border at "ab" moves by "a", then by "c"
    assert bpe.sufficient_lookahead([(b"a", b"b"), (b"c", b"ab")]) == 2
    assert bpe.sufficient_lookahead([(b"a", b"b"), (b"c", b"d")]) == 1
    assert 0 < model.lookahead < 1000


def test_lookahead_fixes_tokens():
    """Any rules: what ends ``lookahead`` bytes before the end of a text stays when the text goes on."""
    rng = random.Random(7)
    for _ in range(400):
        made, merges = [b"a", b"b", b"c"], []
        for _ in range(rng.randrange(1, 12)):
            u, v = rng.choice(made), rng.choice(made)
            if u + v not in made:
                merges.append((u, v))
                made.append(u + v)
        tokens = [bytes([b]) for b in range(256)] + [u + v for u, v in merges]
        ahead = bpe.sufficient_lookahead(merges)
        merger = bpe.Merger(bpe.BpeModel(tokens, merges, {}, ahead))
        text = bytes(rng.choices(b"abc", k=60))
        whole = merger.merge(text)
        assert merger._many(list(text)) == whole
        for cut in range(1, 60):
            at = 0
            for x, y in zip(merger.merge(text[:cut]), whole):
                at += len(tokens[x])
                if at > cut - ahead:
                    break
                assert x == y


def test_every_code_point(model, library):
    encoder = bpe.Encoder(model)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1000):
        text = "".join(f"a{c}1{c} {c}{c}." for c in points[at:at + 1000])
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_slices_and_specials(model, library):
    rng = random.Random(1)
    encoder, decoder = bpe.Encoder(model), bpe.Decoder(model)
    for _ in range(4000):
        text = "".join(rng.choices(CHARS, k=rng.randrange(0, 60)))
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == want == in_slices(encoder, text, rng, 9)
        assert decoder.decode(want) == text
        ids = [rng.randrange(50_300) for _ in range(30)]  # bytes that are no UTF-8
        assert decoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_pieces_go_through_the_window(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 20)
    monkeypatch.setattr(bpe, "STEP", 64)
    rng = random.Random(2)
    encoder = bpe.Encoder(model)
    words = [t for t in library.get_vocab() if t.isalpha() and t.isascii()]
    kinds = [["a", "b", "th", "in"], [" ", "  ", "\n"], ["1", "2", "٣"], [".", "-", "'"], ["é", "日", "本"], ["a"], words]
    for k in range(700):
        kind = kinds[k % len(kinds)]
        text = "".join(rng.choice(["x", " ", "'", ""]) + "".join(rng.choices(kind, k=rng.randrange(0, 300)))
                       + rng.choice(["", "b", " b", "'s", "  ", "<|endoftext|>"]) for _ in range(3))
        want = library.encode(text, add_special_tokens=False).ids
        assert in_slices(encoder, text, rng, 150) == want
        assert len(encoder.window) == 0


def test_memory_of_the_encoder_is_bounded(model):
    encoder = bpe.Encoder(model)
    for _ in range(20):
        encoder.feed("ab" * 10_000)
        assert len(encoder.open) <= bpe.LONG and len(encoder.window) <= model.lookahead + encoder.step
    assert len(encoder.finish()) > 0


def test_op11_equals_the_library(spark, library):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    want = {}
    for i, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op11(spark, SF).collect()} == want


def test_unsupported_tokenizers_are_refused(tmpdir_path):
    with pytest.raises(ValueError):
        bpe.load_model(public_tokenizers.path("word_bpe_49k.json"))


def edge_rows(spark, empty=False):
    rows = [(1, "a b", "x", 1, 2, "y", "z"), (1, "a b", "x", 1, 2, "y", "z"), (2, None, None, None, None, None, None), (3, "", "x", 1, 2, "y", "z"),
            (None, "no id", "x", 1, 2, "y", "z"), (4, "<P>" * 3, "x", 1, 2, "y", "z"), (5, "日本é🙂" * 50_000, "x", 1, 2, "y", "z"),
            (6, "x" * 200_000 + " " * 200_000, "x", 1, 2, "y", "z"), (7, "🙂", None, 1, 2, "y", "z"), (-8, "less <S than < M>", "x", 1, 2, "y", "z")]
    return spark.createDataFrame([] if empty else rows, SCHEMA)


@pytest.mark.parametrize("empty", [False, True])
def test_edges_of_tokenize(spark, library, empty):
    df = edge_rows(spark, empty)
    got = bpe.tokenize(df, BPE_FILE)
    assert sorted(got.columns) == sorted(df.columns)
    rows = got.collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    model = bpe.load_model(BPE_FILE)
    odd = spark.createDataFrame([(None,), ([],), ([None, 10 ** 9, -5, 64],)], "ids array<int>")
    assert [r[0] for r in odd.select(bpe.decode_column(odd.ids, model)).collect()] == ["", "", library.decode([64])]


def parts_of(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("empty", [False, True])
def test_edges_of_fill_in_middle(spark, empty):
    df = edge_rows(spark, empty)
    got = fill_middle.fill_in_middle(df)
    assert sorted(got.columns) == sorted([*df.columns, "prefix_chars", "middle_chars", "output"])
    rows = got.withColumn("back", fill_middle.restore_text(got.output, got.form)).collect()
    assert len(rows) == df.count()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == parts_of(r.doc_id, r.text)
        assert r.back == (r.text or "")


def test_forms_and_cuts_of_many_texts(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("aé日🙂<>SPM \n", k=rng.randrange(0, 60)))) for i in range(3000)]
    got = fill_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    seen = got.withColumn("back", fill_middle.restore_text(got.output, got.form)).collect()
    assert {r.form for r in seen} == {"plain", "psm", "spm"}
    for r in seen:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == parts_of(r.doc_id, r.text) and r.back == r.text


def test_cuts_of_a_sliced_arrow_array():
    rng = random.Random(3)
    for _ in range(200):
        texts = ["".join(rng.choices("aé日🙂 \n\x00\x7f߿ࠀ￿𐀀", k=rng.randrange(0, 40))) for _ in range(rng.randrange(0, 30))]
        h1, h2 = (np.array([rng.randrange(1 << 32) for _ in texts], np.int64) for _ in "ab")
        n, before, between, parts = fill_middle.cut(pa.array(["é", *texts])[1:], h1, h2)
        assert n.tolist() == [len(t) for t in texts]
        for i, t in enumerate(texts):
            a, b = sorted((int(h1[i]) % (len(t) + 1), int(h2[i]) % (len(t) + 1)))
            assert (before[i], between[i]) == (a, b - a)
            assert tuple(p.decode() for p in parts[i]) == (t[:a], t[a:b], t[b:])
