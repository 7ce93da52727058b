"""The manifest against a plain tree; ranks, ties, nulls, repeated rows, tampering."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from marketlake.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string, idx string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, **changes):
    values = [changes.get(k, v) for k, v in zip(("doc_id", "source", "lang", "n_chars", "text"), row)]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path_of(levels, i):
    steps = []
    for level in levels[:-1]:
        at = i // 3 * 3
        steps.append(("".join(level[at:i]), "".join(level[i + 1:at + 3])))
        i //= 3
    return steps


def brute(rows):
    """doc_id, leaf, subroot, root, proof digest, folded root, verified of each row."""
    nulls_first = lambda v, least: (v is not None, least if v is None else v)
    parts = {}
    for r in sorted(rows, key=lambda r: (nulls_first(r[1] if r[1] is None else r[1].encode(), b""), nulls_first(r[0], 0), leaf_of(r))):
        parts.setdefault(r[1], []).append(r)
    trees = {p: levels_of([leaf_of(r) for r in rs]) for p, rs in parts.items()}
    crown = levels_of([t[-1][0] for t in trees.values()])
    out = []
    for k, (p, rs) in enumerate(parts.items()):
        for i, r in enumerate(rs):
            path = path_of(trees[p], i) + path_of(crown, k)
            node = leaf = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                node = leaf_of(r, text=r[4].replace("\n", ""))
            for left, right in path:
                node = sha(left, node, right)
            root = crown[-1][0]
            out.append((r[0], leaf, trees[p][-1][0], root, sha(*(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in merkle.verify_tampered(df).collect()), key=str)


SIZES = [1, 2, 3, 4, 9, 10, 27, 28, 80, 81, 82, 243, 244, 700]


def test_trees_of_all_sizes(spark):
    rng = random.Random(1)
    rows = [(i * 1000 + j - 5000, f"s{i:02d}é" if i else None, rng.choice(["en", None]), rng.choice([None, j]),
             rng.choice([None, "", "a\nb", "plain", "日本\n"]), 1, "x", "y") for i, n in enumerate(SIZES) for j in range(n)]
    rng.shuffle(rows)
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_a_part_of_three_bands(spark):
    rows = [(j, "big", "en", j, f"text {j % 7}\n", 1, "x", "y") for j in range(6700)] + [(9000, "", "en", 1, "t", 1, "x", "y")]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(7)) == brute(rows)


def test_ties_repeated_rows_and_nulls(spark):
    rows = [(7, "a", "en", 1, "same\n", 1, "x", "y")] * 200 + [(7, "a", "en", 1, f"t{i % 5}", 1, "x", "y") for i in range(40)]
    rows += [(None, None, None, None, None, None, None, None)] * 5 + [(None, "a", "en", 2, "x" * 300_000 + "\n", 1, "x", "y"), (3, "", "", 0, "", 1, "x", "y")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_no_rows_and_one_row(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    row = [(5, None, "en", 1, "alone\n", 1, "x", "y")]
    (one,) = got(spark.createDataFrame(row, SCHEMA))
    assert [one] == brute(row) and one[1] == one[2] == one[3] and one[4] == sha("")


def test_nodes_are_nested_intervals(spark):
    rows = [(j, "ab"[j % 3 == 0], "en", j, "t") for j in range(1000)]
    m = merkle.build_manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"),
                              ["doc_id", "text"], "source", "doc_id")
    nodes = m.nodes.collect()
    leaves = {(r.tree, r.idx): r.digest for r in m.leaves.collect()}
    assert len(leaves) == 1000
    by_level = {}
    for r in nodes:
        by_level.setdefault((r.tree, r.level), []).append((r.lo, r.hi, r.digest))
    for (tree, level), found in by_level.items():
        found.sort()
        n = sum(t == tree for t, _ in leaves)
        assert [f[0] for f in found[1:]] == [f[1] + 1 for f in found[:-1]] and found[0][0] == 0 and found[-1][1] == n - 1
        below = sorted(by_level.get((tree, level - 1), [])) or [(i, i, leaves[tree, i]) for i in range(n)]
        for lo, hi, digest in found:
            assert digest == sha(*(d for a, z, d in below if lo <= a and z <= hi))


@pytest.mark.parametrize("change", ["root", "leaf"])
def test_fold_sees_any_change(spark, change):
    rows = [(j, "s", "en", j, f"t{j}") for j in range(30)]
    m = merkle.build_manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"),
                              ["doc_id", "text"], "source", "doc_id")
    proofs = merkle.prove(m)
    leaf = F.col("leaf") if change == "root" else F.reverse("leaf")
    same = proofs.select((merkle.fold(leaf, F.col("path")) == F.col("root")).alias("same")).distinct().collect()
    assert [r.same for r in same] == [change == "root"]
