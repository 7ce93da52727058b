"""Training-data operators against brute force, exact round trips and held-out accuracy; edge cases of every stage."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import (chat, components, decontaminate, mixing, quality_fm, quality_rules, queries, secrets,
                            simhash, suffix_dedup, url_filters, warc)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, `row` string, fp int"
LONG = " ".join(f"wort{i % 977}x{i} und." for i in range(30_000))


def nasty(spark, empty=False):
    """Nulls in any column, empty and long texts, repeated rows and ids, extra columns with clashing names."""
    extra = (5, "x", "y", 9)
    text = "A plain text of more than ten words, that ends well and is kept by every rule here."
    rows = [(1, text, "en", "a", len(text), *extra), (1, text, "en", "a", len(text), *extra), (2, None, None, None, None, None, None, None, None),
            (3, "", "en", "b", 0, *extra), (4, "   \n\t ", "en", "b", 6, *extra), (None, text + " More words follow.", "en", None, 5, *extra),
            (6, LONG, "de", "c", len(LONG), *extra), (7, text.replace("plain", "simple"), "en", "a", None, *extra),
            (8, 'one two three four five six seven eight nine ten. token = "0123456789abcdef0123456789abcdef01234567"', "en", "b", 100, *extra)]
    return spark.createDataFrame([] if empty else rows, SCHEMA)


def rows_of(df, *keys):
    return sorted((tuple(r) for r in df.select(*keys).collect()), key=str)


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(items, near):
    up = list(range(len(items)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(items)):
        for j in range(i):
            if near(items[i], items[j]):
                up[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(500, 560)] + [(9, 9), (None, 3)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    nodes = sorted({x for e in edges if None not in e and e[0] != e[1] for x in e})
    links = {frozenset(e) for e in edges}
    group = brute_groups(nodes, lambda x, y: frozenset((x, y)) in links)
    least = defaultdict(lambda: 10 ** 9)
    for n, g in zip(nodes, group):
        least[g] = min(least[g], n)
    assert got == {n: least[g] for n, g in zip(nodes, group)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_op1_brute_force(spark):
    got = queries.op1(spark, SF).collect()
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{x:016x}" for i, x in prints.items()}
    ids = sorted(prints)
    group = brute_groups(ids, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    least = {}
    for i, g in zip(ids, group):
        least[g] = min(i, least.get(g, i))
    assert {r.doc_id: r.component_id for r in got} == {i: least[g] for i, g in zip(ids, group)}


def test_op1_links_dense_cluster(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(400):
        x = rng.choice(sorted(prints))
        for _ in range(rng.choice([1, 2, 3])):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = dict(components.connected_components(links, "a", "b").collect())
    group = brute_groups(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    sizes = Counter(group)
    assert set(got) == {x for x, g in zip(signed, group) if sizes[g] > 1}
    assert len(set(got.values())) == sum(s > 1 for s in sizes.values())


def test_op1_edges(spark):
    got = rows_of(simhash.simhash_components(nasty(spark)), "doc_id", "fingerprint", "component_id")
    assert len(got) == 9 and [g for g in got if g[0] in (2, 3, 4)] == [(i, "0" * 16, 2) for i in (2, 3, 4)]
    assert simhash.keep_one_per_group(nasty(spark)).where("doc_id = 1").count() == 1


def test_op2_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    got = queries.op2(spark, base).join(spark.read.parquet(f"{base}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    assert got["score"].between(0, 1).all()
    assert queries.op2(spark, base).count() == 1000


def test_op2_identity_and_edges(spark):
    m = quality_fm.FactorisationMachine()
    at, x = np.array([3, 9, 70]), np.array([0.5, 2.0, -1.0])
    pairs = sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(3) for j in range(i))
    assert m.margin(at, x) == pytest.approx(pairs)
    docs, none = nasty(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_fm.score_quality(docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1), (1, 0), (6, None), (None, 1), (7, 0), (3, 0)], "doc_id long, quality int")
    assert quality_fm.score_quality(docs, odd).count() == 9
    assert quality_fm.score_quality(nasty(spark, True), odd).count() == 0


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w, fixed = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {}
    while True:
        rest, share = 1.5 * sum(sizes.values()) - sum(fixed.values()), sum(w[s] for s in names if s not in fixed)
        over = [s for s in names if s not in fixed and rest * w[s] / share > 2 * sizes[s]]
        if not over:
            return {s: fixed.get(s, rest * w[s] / share if share else 0.0) for s in names}
        fixed.update((s, 2.0 * sizes[s]) for s in over)


@pytest.mark.parametrize("table", ["documents", "nasty"])
def test_op3(spark, table):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if table == "documents" else nasty(spark)
    pieces = mixing.mix_pieces(docs)
    got = mixing.mix_summary(pieces).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter(
        (r.doc_id, len(WORD.findall(r.text or ""))) for r in docs.select("doc_id", "text").collect())
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert all(r.source_size == sizes[r.source] for r in got)
    want = brute_targets(dict(sizes))
    assert all(target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix_summary(mixing.mix_pieces(docs.repartition(3))).collect()
    key = lambda rows: sorted(str((r.doc_id, r.size, r.taken, r.pieces)) for r in rows)
    assert key(got) == key(again)


def test_op3_tree_keeps_quotas(spark):
    quotas = {0: 130, 1: 7, 2: 0, 3: 63}
    got = mixing.shard_blocks(spark.createDataFrame(list(quotas.items()), "rank int, blocks long"), shards=8).collect()
    assert Counter(r["rank"] for r in got) == {k: v for k, v in quotas.items() if v}
    assert len({(r["rank"], r["block"]) for r in got}) == 200
    assert set(Counter(r["shard"] for r in got).values()) == {25}


def brute_base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        r'(?ai)(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)', t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def test_op4(spark):
    rng = random.Random(3)
    bits = ["token", "token=", "secret", ": ", "= ", "'", '"', "api_key", "apikey", "API_KEY:", "AKIA", "ABCDEFGH12345678", "é", "𝒳", " ",
            "0123456789abcdef", "deadbeef", "x", "\n", "longvalue_1", "password"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 25))) for _ in range(300)] + ["", None]
    got = secrets.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        base = brute_base(texts[r.doc_id] or "")
        assert [tuple(s) for s in r.base] == base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        assert set(base) <= {tuple(s) for s in r.spans}


def test_op4_random_runs(spark):
    import string
    rng = random.Random(5)
    keys = ["".join(rng.choices(string.ascii_letters + string.digits, k=40)) for _ in range(50)]
    plain = ["Rechtsschutzversicherungsgesellschaften", "a/path/to/some/file/in/a/folder", "a" * 30, "state-of-the-art-machine-learning",
             "12345678901234567890123", "abcdefghijklmnopqrstuvwxyz0123456789", "internationalizationlocalization"] * 5
    df = spark.createDataFrame([(i, f"words {k} here") for i, k in enumerate(keys + plain)], "doc_id long, text string")
    hit = {r.doc_id for r in secrets.scan_secrets(df).collect() if r.spans}
    assert len(hit & set(range(50))) >= 45 and not hit - set(range(50))
    out = secrets.redact_documents(nasty(spark)).collect()
    assert len(out) == 9 and [r.text for r in out if r.doc_id == 8][0].endswith('ten. [SECRET]"')


def test_op5_round_trip(spark):
    big = "x" * 1200
    rows = [(1, "http://a/", big), (9, "http://b/\r\nX: y", big), (5, None, big), (3, "u", "small"), (4, "u", "small"), (6, "u", None),
            (None, "u", big), (7, "u", "é" * 700), (8, "u", "é" * 700), (9, "http://b/", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shard", F.lit("x"))
    got = rows_of(warc.archive_pages(pages, shard_bytes=2000, roll_bytes=300),
                  "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = []
    for page, _, html in rows:
        b = (html or "").encode()
        top = {1200: 9, 1400: 8}.get(len(b))
        revisit = top is not None and page is not None and page < top
        want.append((page, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    assert got == sorted(want, key=str)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_op5_same_files_again(spark, tmpdir_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    a = warc.write_archives(pages, f"file://{tmpdir_path}/a", shard_bytes=60_000, roll_bytes=9_000)
    b = warc.write_archives(pages.repartition(5), f"file://{tmpdir_path}/b", shard_bytes=60_000, roll_bytes=9_000)
    files = rows_of(a, "file", "records", "sha1")
    assert files == rows_of(b, "file", "records", "sha1") and len(files) > 4


def test_op6_edges(spark):
    text = "a b c d e a b c d e a b c d e x"  # windows that repeat and overlap
    rows = [(1, text), (2, None), (3, ""), (4, "same line\nother\nsame line\n \n \nsame line"), (5, "w " * 40_000), (6, "x | y | z | w\nGood words end here. " + " ".join(f"good{i} ones." for i in range(30)))]
    got = {r.doc_id: r for r in quality_rules.judge_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        w = WORD.findall(t or "")
        c = Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4))
        rep = len({p for j in range(len(w) - 4) if c[tuple(w[j:j + 5])] > 1 for p in range(j, j + 5)})
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words, got[i].n_dup_lines) == (
            len(w), sum(map(len, w)), rep, len(lines) - len(set(lines)))
    assert got[6].kept and got[6].clean_text.startswith("Good") and not got[2].kept
    cleaned = quality_rules.clean_documents(nasty(spark))
    assert cleaned.columns == nasty(spark).columns and cleaned.where("doc_id = 1").count() == 2


def test_op7_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [(1, "http://A.example.org/x#f", link.format("https://bad.net/y")), (2, "http://b.org/q", '<META http-equiv=refresh content="0; url=/x2">'),
            (3, "http://b.org/x2", link.format("http://bad.net/z")), (4, "http://c.org/", link.format("http://bad.net/y2")),
            (5, "http://d.org/1", link.format("http://c.org/")), (6, "http://e.org/1", link.format("http://b.org/fr/ok")),
            (7, "http://f.org/1", '<html>' + link.format("http://e.org/1") + '</html>'), (8, None, None), (9, "no scheme", link.format("http://bad.net/")),
            (10, "http://sub.example.net/en/x", None), (11, "http://EXAMPLE.com/de/", ""), (12, "http://net", None), (13, "http://g.org/1", link.format("http://bad.net/fr/")),
            (13, "http://g.org/1", link.format("http://b.org/fr/x"))]
    got = {r.page_id: r for r in url_filters.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow",
                                                      9: "allow", 10: "allow", 11: "block", 12: "allow", 13: "allow"}
    assert got[10].rule == "example.net/en/" and got[12].rule is None and got[8].host == ""


def test_op8(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghiklmnorstuv", k=rng.randrange(2, 9))) for _ in range(4000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [prose(rng.randrange(20, 60)) for _ in range(30)]
    docs, want = [], set()
    for i in range(150):
        body = [prose(rng.randrange(5, 200))]
        if i % 3 == 0:
            k = rng.randrange(30)
            leak = items[k]
            if i % 2:
                leak = leak.upper().replace(" ", " ### ")
            elif i % 4 == 0:
                at = len(leak) // 3
                leak = leak[:at] + "q" + leak[at + 2:]
            body += [leak, prose(30)]
            want.add((i, k))
        docs.append((i, " ".join(body)))
    docs += [(900, None), (901, ""), (902, LONG + " " + items[3]), (903, items[4]), (903, items[4])]
    want |= {(902, 3), (903, 4)}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hits", F.lit(1))
    bench = spark.createDataFrame([*enumerate(items), (50, None), (51, "short"), (None, items[0])], "item_id long, text string")
    got = decontaminate.find_contamination(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    texts = dict(docs)
    assert all(r.edits or decontaminate.normal_form(texts[r.doc_id][r.start:r.end]) == decontaminate.normal_form(items[r.item_id]) for r in got)
    left = {r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}
    assert decontaminate.find_contamination(df, bench.limit(0)).count() == 0


def test_op8_alignment_is_edit_distance():
    rng = random.Random(2)
    for _ in range(200):
        piece = bytes(rng.choices(b"abcd", k=rng.randrange(5, 25)))
        form = bytes(rng.choices(b"abcd", k=rng.randrange(0, 10))) + bytes(c for c in piece if rng.random() > .1) + bytes(rng.choices(b"abcd", k=5))
        row = [0] * (len(form) + 1)
        for i, c in enumerate(piece):
            new = [i + 1]
            for j, d in enumerate(form):
                new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
            row = new
        got = decontaminate.band_alignment(piece, form, -len(piece), len(form), 4)
        assert (got is None) == (min(row) > 4) and (got is None or got[0] == min(row))


def test_op9_suffix_array():
    rng = random.Random(2)
    for _ in range(200):
        x = bytes(rng.choices(rng.choice([b"ab", b"abc", b"a", b"abcdefgh"]), k=rng.randrange(1, 80)))
        assert list(suffix_dedup.suffix_array(np.frombuffer(x, dtype=np.uint8), 96)) == sorted(range(len(x)), key=lambda i: x[i:])


def brute_removed(texts, length=200):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[p:p + length] for b in bodies for p in range(len(b) - length + 1))
    for b in bodies:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        yield len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()


def test_op9_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choices("abcdé ", k=n))
    shared = [prose(rng.randrange(150, 700)) for _ in range(6)]
    texts = [prose(rng.randrange(0, 400)) + rng.choice(shared)[rng.randrange(0, 100):] + prose(rng.randrange(0, 300)) for _ in range(60)]
    texts += ["a" * 199, "a" * 200, "ab" * 400, "xyz" * 67, None, "", texts[0], texts[0], shared[0] * 3]
    df = spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("n_bytes", F.lit("x"))
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = sorted(((i if i % 9 else None, *w) for i, w in enumerate(brute_removed(texts))), key=str)
    assert rows_of(suffix_dedup.remove_repeats(df), *cols) == want
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 300)  # every key takes the way for hot groups
    assert rows_of(suffix_dedup.remove_repeats(df), *cols) == want
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_op10_round_trip(spark):
    rng = random.Random(6)
    bits = ["<|im_end|>", "<|", "|>", "<", "\\", "|", "<\\|", "\n", "x", "é", "<|im_start|>assistant\n", "\\n"]
    say = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(0, 8)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd\nrole", "a\\nb", None]), rng.choice([say(), say(), None])) for c in range(20) for t in range(rng.randrange(1, 9))]
    rows += [(None, 0, "user", "hi"), (30, 1, "user", "tie"), (30, 1, "user", "tie"), (30, 1, "assistant", "tie")] + [(40, t, "assistant", str(t)) for t in range(70)]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    convs = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2] or "", r[3] or "")):
        convs[c].append((r or "", x or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in got} == dict(convs)
    assert {r.conv_id: r.loss_text for r in got} == {c: "".join(x for r, x in t if r == "assistant") for c, t in convs.items()}
    assert all(r.formatted.count("<|im_end|>\n") == len(r.turns) for r in got)


def test_op10_reply_tree(spark):
    nodes = [(1, None, 0.0), (2, 1, 1.0), (3, 1, 5.0), (4, 2, 9.0), (5, 3, 1.0), (6, 5, 1.0), (7, 4, -9.0), (8, 99, 2.0)]
    m = spark.createDataFrame([("t", n, p, s, "user", str(n)) for n, p, s in nodes] + [("u", 1, None, None, None, None)],
                              "tree string, node long, parent long, score double, role string, text string")
    best = chat.reply_paths(m).where("tree = 't'").orderBy("depth").collect()
    assert [r.node for r in best] == [1, 3, 5, 6]
    ranked = chat.reply_paths(m, branches=2).where("tree = 't' and branch = 2").orderBy("depth").collect()
    assert [r.node for r in ranked] == [8]
    assert chat.reply_paths(m.limit(0)).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_on_edge_cases(spark, empty):
    docs = nasty(spark, empty)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        got = out.collect()
        assert not (empty and got)
        if name != "mixing":
            assert out.columns == docs.columns


def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, SF)
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    assert ids and len(ids) == len(set(ids))
    assert got.where("taken <= 0 or taken > 2 * size").count() == 0
