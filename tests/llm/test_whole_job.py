"""Cases in which an operator did less than its whole job."""

import glob
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import decontaminate, mixing, quality_fm, secrets

SF = "/root/testdata/sf0.001"


def prose_of(rng):
    words = ["".join(rng.choices("abcdefghiklmnorstuv", k=rng.randrange(2, 9))) for _ in range(4000)]
    return lambda n: " ".join(rng.choice(words) for _ in range(n))


def test_op8_truncated_and_substituted_passages(spark):
    rng = random.Random(11)
    prose = prose_of(rng)
    items = [prose(rng.randrange(15, 60)) for _ in range(60)]
    cut = lambda a, z: lambda t: t[round(len(t) * a):round(len(t) * z)]
    swap = lambda t: " ".join(prose(1) if rng.random() < .1 else w for w in t.split())
    ways = {"middle": cut(.1, .9), "wide": cut(.05, .95), "first": cut(0, .8), "last": cut(.2, 1), "swapped": swap, "little": cut(.3, .7)}
    docs = [(name, i, f"{prose(30)} {way(t)} {prose(30)}") for name, way in ways.items() for i, t in enumerate(items)]
    df = spark.createDataFrame([(k, d[2]) for k, d in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(docs[r.doc_id][0], docs[r.doc_id][1], r.item_id): r for r in decontaminate.find_contamination(df, bench).collect()}
    assert all(i == item for _, i, item in got)
    found = {name: sum(k[0] == name for k in got) for name in ways}
    assert found.pop("little") == 0 and found.pop("swapped") >= 54 and set(found.values()) == {60}
    for (name, i, _), r in got.items():
        assert r.covered <= r.item_chars == len(items[i])
        if name != "swapped":
            assert r.covered >= len(ways[name](items[i])) - 2  # all of the passage, up to blanks at its ends


def test_op8_union_of_pieces():
    rng = random.Random(12)
    for _ in range(300):
        pieces = [(a, a + rng.randrange(1, 12), rng.randrange(3)) for a in rng.choices(range(60), k=rng.randrange(1, 12))]
        covered, edits = decontaminate.covering(pieces)
        assert covered == len({x for a, z, _ in pieces for x in range(a, z)})
        assert min(e for *_, e in pieces) <= edits <= sum(e for *_, e in pieces)


def test_op4_keys_in_paths_and_urls(spark):
    rng = random.Random(13)
    forms = ("https://host/my-team/{}", "/srv/my_app/{}", "--key/{}", "/srv/app/data/{}", "my-team-key-{}", "https://host/a_b/{}/file-name?x=1", "a {} b")
    keys = [(f, "".join(rng.choices(string.ascii_letters + string.digits, k=40))) for f in forms for _ in range(20)]
    plain = ["https://host/my-team/some-long_article/with-a-title-of_many/words", "/usr/share/my_app/some-directory/and_another/file"] * 10
    texts = [f"see {f.format(k)} end" for f, k in keys] + plain
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == 3] for r in secrets.scan_secrets(df).collect()}
    clean = {r.doc_id: r.text for r in secrets.redact_documents(df).collect()}
    found = 0
    for i, (_, key) in enumerate(keys):
        at = texts[i].index(key)
        hit = any(a <= at and at + 40 <= z for a, z in spans[i])
        assert hit == (key not in clean[i])
        found += hit
        assert not any(a <= b and y <= z and (a, z) != (b, y) for a, z in spans[i] for b, y in spans[i])
    assert found >= len(keys) - 3
    assert all(not spans[i] and clean[i] == texts[i] for i in range(len(keys), len(texts)))


@pytest.mark.parametrize("size_column", [False, True])
def test_op3_texts_of_the_mix(spark, tmpdir_path, size_column):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if size_column:  # repeated rows, odd blanks, a name that the mix uses too
        rows = [(i // 2, f"  a{i} b\n\nc  d " * 40, "xy"[i % 3 == 0]) for i in range(40)] + [(99, None, "x"), (99, "", None)] + [(7, "same text here", "x")] * 2
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumnRenamed("text", "size")
    text = docs.columns[1]
    names = {"text": text}
    out = mixing.write_mix(docs, f"{tmpdir_path}/mix", shards=8, **names)
    pieces = out.collect()
    # the words by source are the targets, the shards are even, the words are those of the pieces
    summary = mixing.mix_summary(mixing.mix_pieces(docs, shards=8, **names)).collect()
    target, taken = {r.source: r.target for r in summary}, Counter()
    for p in pieces:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", p.text))
        assert n == p.word_to - p.word_from
        taken[p.source] += n
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    # pieces of a whole copy, end to end, are a text
    texts, whole, groups = Counter(r[0] for r in docs.select(text).collect()), Counter(), defaultdict(list)
    for r in summary:
        for p in r.pieces:
            groups[r.source, r.row, p.copy].append((p.word_from, p.word_to, p.shard, p.position))
    by_place = {(p.source, p.shard, p.position, p.word_from): p.text for p in pieces}
    size = {(r.source, r.row): r.size for r in summary}
    for (source, row, _), parts in groups.items():
        if sum(z - a for a, z, *_ in parts) == size[source, row]:
            whole["".join(by_place[source, shard, at, a] for a, _, shard, at in sorted(parts))] += 1
    assert whole and set(whole) <= set(texts) and all(n <= 2 * texts[t] for t, n in whole.items())
    # a file per shard, in the order of position
    files = glob.glob(f"{tmpdir_path}/mix/shard=*/*.parquet")
    assert len(files) == len({p.shard for p in pieces})
    for f in files:
        order = [r.position for r in spark.read.parquet(f).coalesce(1).collect()]
        assert order == sorted(order)


def test_op8_blocks_one_at_a_time(spark, monkeypatch):
    rng = random.Random(14)
    prose = prose_of(rng)
    items = [prose(40) for _ in range(40)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [(i, f"{prose(30)} {items[i % 40][:150]} {prose(9)} {items[i % 40][150:] if i % 2 else ''}") for i in range(60)] + [(70, prose(50)), (71, None), (72, prose(9))]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit("x"))
    whole = sorted(decontaminate.find_contamination(df, bench).collect())
    left = sorted(decontaminate.drop_contaminated(df, bench).collect())
    alive, most, make = [0], [0], spark.sparkContext.broadcast

    def counting(value):
        b = make(value)
        alive[0] += 1
        most[0] = max(most[0], alive[0])
        end = b.destroy
        b.destroy = lambda *a: (alive.__setitem__(0, alive[0] - 1), end(*a))
        return b
    monkeypatch.setattr(spark.sparkContext, "broadcast", counting)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1500)
    assert sorted(decontaminate.find_contamination(df, bench).collect()) == whole and len(whole) >= 30
    assert sorted(decontaminate.drop_contaminated(df, bench).collect()) == left and len(left) + len(whole) == len(docs)
    assert most == [1] and alive == [0]


def test_op8_index_memory(monkeypatch):
    rng = random.Random(15)
    prose = prose_of(rng)
    phrase = prose(9)
    items = [(i, f"{prose(12)} {phrase} {prose(12)}") for i in range(400)] + [(900, "a" * 90)]
    index = decontaminate.PieceIndex(items)
    assert sum(t.nbytes for _, t in index.tables) < 1.5 * index.tables[0][1].nbytes or len(index.tables) == 1
    text = f"{prose(20)} {items[7][1]} {phrase} {phrase} " + "a" * 5000 + f" {items[9][1]}"
    want = decontaminate.contaminations(text, index)
    assert {h[0] for h in want} == {7, 9, 900}
    held, plain = [], np.repeat

    def watched(a, times, **kw):
        out = plain(a, times, **kw)
        held.append(len(out))
        return out
    monkeypatch.setattr(decontaminate, "SLICE", 20_000)
    monkeypatch.setattr(np, "repeat", watched)
    assert decontaminate.contaminations(text, index) == want
    assert len(held) > 3 and max(held) <= 80_000  # the rest are places of one piece in one short stretch


def test_op2_repeated_id_is_one_training_row(spark):
    free = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    hot, others = free[0], free[1:41]
    rows = [(hot, f"copy {i % 50} of a hot document", float(i)) for i in range(300)] + [(i, f"text {i}", None) for i in others]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars double")
    labels = spark.createDataFrame([(i, i % 2) for i in [hot, *others]], "doc_id long, quality int")
    got = quality_fm.training_sample(docs, labels, "quality").collect()
    assert Counter(r.doc_id for r in got) == Counter([hot, *others])
    assert sorted(got) == sorted(quality_fm.training_sample(docs.repartition(7), labels, "quality").collect())
    assert (hot, got[[r.doc_id for r in got].index(hot)].text) in {r[:2] for r in rows}
    assert quality_fm.training_sample(docs, labels, "quality", rows=10).count() == 10


def brute_cut(texts, length=200):
    """Bytes covered by a string of ``length`` bytes that starts anywhere else, over all rows."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                hit[i:i + length] = b"\x01" * length
        out.append((len(t), sum(hit), bytes(x for x, h in zip(t, hit) if not h)))
    return out


def test_op9_equal_rows(spark):
    """Hundreds of equal rows beside rows that share parts of them: every byte as by brute force, in time that follows the rows."""
    import hashlib
    import time
    from marketlake.llm import suffix_dedup
    rng = random.Random(21)
    prose = prose_of(rng)
    long_text, shared = prose(160), prose(60)
    rows = [(7, long_text)] * 300 + [(i, f"{prose(40)} {long_text[100 * i:100 * i + 400]} {prose(30)}") for i in range(1, 8)]
    rows += [(20 + i, f"{prose(50)} {shared} {prose(20)}") for i in range(3)] + [(30, shared + prose(5))] * 40 + [(31, prose(90))]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    want = [(i, n, gone, hashlib.sha256(rest).hexdigest()) for (i, _), (n, gone, rest) in
            zip(rows, brute_cut([t.encode() for _, t in rows]))]
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == sorted(want)
    took = {}
    for name, ids in (("distinct", list(range(800))), ("equal", [1] * 800)):
        df = spark.createDataFrame([(i, prose_of(random.Random(1))(1200)) for i in ids], "doc_id long, text string")
        t0 = time.time()
        assert {r.n_removed for r in suffix_dedup.remove_repeats(df).collect()} == {len(df.first().text)}
        took[name] = time.time() - t0
    assert took["equal"] < 3 * took["distinct"] + 5


def test_op5_borders_of_many_ranges(spark):
    from marketlake.llm import warc
    ids = spark.range(60_000).select((F.col("id") * 37).alias("page_id"), F.lit(1200).cast("long").alias("n_bytes"))
    skewed = ids.unionByName(ids.limit(3000).withColumn("page_id", F.col("page_id") % 11 + 10 ** 12))
    borders = warc.shard_borders(skewed.unionByName(spark.createDataFrame([(None, 5)], skewed.schema)), 20_000)
    weights = Counter()
    for r in skewed.collect():
        weights[np.searchsorted(borders, r.page_id, side="right")] += r.n_bytes + warc.RECORD_OVERHEAD
    assert borders == sorted(set(borders)) and len(borders) > 5000
    assert all(w <= 40_000 for k, w in weights.items() if k < len(borders) - 12)  # an id of its own cannot be divided
    assert warc.shard_borders(ids.limit(0)) == []


def test_op2_sample_holds_documents_only(spark):
    docs = spark.createDataFrame([(i, f"text number {i}", 10) for i in range(60)], "doc_id long, text string, n_chars long")
    labels = spark.range(50_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    ids = {r.doc_id for r in quality_fm.training_sample(docs, labels, "quality", rows=100).collect()}
    assert ids == {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1}


@pytest.mark.parametrize("block", [3, 128])
def test_op4_rules_of_spans(spark, monkeypatch, block):
    """Runs beside base spans and within each other, and redaction, against plain loops."""
    monkeypatch.setattr(secrets, "BLOCK", block)
    rng, rows = random.Random(5), []
    for i in range(300):
        base = sorted({(a, rng.randrange(3), a + rng.randrange(1, 9)) for a in rng.choices(range(200), k=rng.randrange(0, 20))})
        runs = list({(a, a + rng.randrange(1, 14)) for a in rng.choices(range(200), k=rng.randrange(0, 30))})
        rows.append((i, base, runs, "".join(rng.choices("abcdé🙂 ", k=230))))
    df = spark.createDataFrame(rows, "i int, base array<struct<start:bigint,kind:int,end:bigint>>, runs array<struct<start:bigint,end:bigint>>, t string")
    got = df.select("i", secrets._let(secrets._apart(F.col("runs"), F.col("base")), secrets._longest).alias("runs"),
                    secrets.redact(F.col("t"), F.col("base")).alias("clean")).collect()
    for r in got:
        _, base, runs, text = rows[r.i]
        free = [x for x in runs if not any(b[0] < x[1] and x[0] < b[2] for b in base)]
        free = [x for x in free if not any(o != x and o[0] <= x[0] and o[1] >= x[1] for o in free)]
        assert sorted(map(tuple, r.runs)) == sorted(free)
        out, at = "", 0
        for a, _, z in base:
            out += text[at:a] + secrets.MARK if a >= at else ""
            at = max(at, z)
        assert r.clean == out + text[at:]


def test_op4_many_keys_in_one_text(spark):
    import time
    rng = random.Random(6)
    texts = {n: " ".join("".join(rng.choices(string.ascii_letters + string.digits, k=40)) for _ in range(n)) for n in (1000, 6000, 24000)}
    took = {}
    for n, text in texts.items():
        t0 = time.time()
        (row,) = secrets.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
        took[n] = time.time() - t0
        starts = [s.start for s in row.spans]
        assert len(starts) > .97 * n and starts == sorted(starts) and all(s % 41 == 0 for s in starts)
    assert took[24000] < 4 * took[6000] + 5
