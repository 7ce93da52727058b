"""Merkle manifest of a dataset: digests of rows, a tree per part, a tree over the parts, and proofs.

Leaves are ranked within their part; a node is labelled with the interval of leaf ranks that it covers.
Runs of ``ARITY`` consecutive nodes become their hash, level by level, until one remains.

1. Rows get digests and are written once (with a row number that tells equal rows apart), dealt out by
   range and written in order.  Counts per task and part, summed, turn places into ranks: no task holds a part.
2. Levels are built in bands of ``BAND``: a bucket is the ARITY ** BAND (81) neighbours below one band
   top, so a part of any size is many buckets, and each band shrinks the table 81 times.
3. Proofs: the units of a bucket are joined with the bucket's nodes whose interval contains theirs
   (their ancestors).  Of an ancestor's children, those whose interval lies left or right of the
   unit's are the siblings.  A band's part of a path is kept once a bucket and joined to what lies
   below, from the root downwards; the hot key would be the part, but the join is on the bucket.

``prove`` gives each row its path, an array of (left, right): the digests beside its ancestor on each
level, from the bottom to the root.  ``fold`` recomputes a root from a leaf and a path.

Defined results: a null field counts as ``-``; a null part is a part (the first); null order values come
first; rows that tie are ordered by their digests, and equal rows are so many equal leaves; a lone leaf is
its part's subroot, a lone subroot the root, with an empty path; empty table: no rows, root None; columns
that are not named in a call are not read, so names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import col, stored

ARITY = 3
BAND = 4
BUCKET = ARITY ** BAND

PATH = "array<struct<left: string, right: string>>"


def hash_of(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return hash_of(F.concat(*map(field, values)))


def rank_rows(df: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``df`` with ``tree`` (a number of the group, in the groups' order), ``idx`` and ``n`` (rank in it, rows of it).

    ``group`` and ``order`` must tell all rows apart, else a hot group of ties would stay in one task.
    """
    dealt = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(dealt.withColumn("place", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("task", F.shiftright("place", 33))
    counts = placed.groupBy("task", group).agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("task").alias("task_"), F.col(group).alias("group_"), "first", F.min("first").over(whole).alias("tree"),
        F.sum("rows").over(whole).alias("n"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    found = placed.join(counts, (F.col("task") == F.col("task_")) & F.col(group).eqNullSafe(F.col("group_")))
    return (found.withColumn("idx", F.col("place") - F.col("first") + F.col("before"))
            .drop("place", "task", "task_", "group_", "first", "before"))


def _runs(digests: Column) -> Column:
    """Hashes of each ARITY neighbours."""
    starts = F.sequence(F.lit(1), F.size(digests), F.lit(ARITY))
    return F.transform(starts, lambda i: hash_of(F.array_join(F.slice(digests, i, ARITY), "")))


def _nodes_at(level: int, band: int) -> Column:
    """The nodes of one level of a band: interval, digest and children, from the digests of it and of that below."""
    width = BUCKET ** band * ARITY ** (level - 1)  # leaves of a child
    start = F.col("bucket") * BUCKET ** (band + 1)
    last = lambda z: F.least(z, F.col("leaves")) - 1

    def node(digest: Column, i: Column) -> Column:
        lo = start + i * (ARITY * width)
        kids = F.transform(F.slice(F.col(f"at{level - 1}"), i * ARITY + 1, ARITY), lambda d, j: F.struct(
            (lo + j * width).alias("lo"), last(lo + (j + 1) * width).alias("hi"), d.alias("digest")))
        return F.struct(F.lit(band * BAND + level).alias("level"), lo.alias("lo"), last(lo + ARITY * width).alias("hi"),
                        digest.alias("digest"), kids.alias("kids"))

    return F.transform(F.col(f"at{level}"), node)


def _band_nodes(units: DataFrame, band: int) -> DataFrame:
    """Nodes of the band over ``units`` (tree, idx, n, leaves, digest): level, interval, digest, children."""
    out = (units.groupBy("tree", F.expr(f"idx div {BUCKET}").alias("bucket"))
           .agg(F.max("n").alias("n"), F.max("leaves").alias("leaves"),
                F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("units"))
           .withColumn("at0", F.col("units.digest")))
    levels = range(1, BAND + 1)
    for k in levels:  # a part of one bucket ends where one node remains
        below = F.col(f"at{k - 1}")
        out = out.withColumn(f"at{k}", F.when((F.col("n") > BUCKET) | (F.size(below) > 1), _runs(below)))
    nodes = F.flatten(F.array_compact(F.array(*[_nodes_at(k, band) for k in levels])))
    return out.select("tree", "bucket", "n", "leaves", F.explode(nodes).alias("node")).select(
        "tree", "bucket", "n", "leaves", "node.*")


@dataclass
class Tree:
    """Trees over ranked units: a table of units and one of nodes per band, and the top of each tree."""

    units: list
    nodes: list
    tops: DataFrame


def build_trees(leaves: DataFrame, label: str) -> Tree:
    """Trees over ``leaves`` (tree, idx, n, digest)."""
    units = leaves.select("tree", "idx", "n", F.col("n").alias("leaves"), "digest")
    left = leaves.agg(F.max("n")).first()[0] or 1
    tops = units.filter("n = 1").select("tree", "leaves", "digest")
    all_units, all_nodes = [], []
    while True:
        nodes = stored(_band_nodes(units, len(all_nodes)), f"{label}-nodes")
        all_units.append(units)
        all_nodes.append(nodes)
        ended = nodes.filter(F.col("n") <= BUCKET).groupBy("tree").agg(
            F.max("leaves").alias("leaves"), F.max_by("digest", "level").alias("digest"))
        tops = tops.unionByName(ended)
        if left <= BUCKET:
            return Tree(all_units, all_nodes, tops)
        left = -(-left // BUCKET)
        units = nodes.filter((F.col("n") > BUCKET) & (F.col("level") == BAND * len(all_nodes))).select(
            "tree", F.col("bucket").alias("idx"), F.ceil(F.col("n") / BUCKET).alias("n"), "leaves", "digest")


def _band_paths(units: DataFrame, nodes: DataFrame, band: int, payload: list[str]) -> DataFrame:
    """Each unit's (left, right) on the levels of its band, by containment of its interval in those of the nodes."""
    width = BUCKET ** band
    u = units.select("tree", F.expr(f"idx div {BUCKET}").alias("bucket"), "idx", F.struct("n", *payload).alias("unit"),
                     (F.col("idx") * width).alias("u_lo"), (F.least((F.col("idx") + 1) * width, F.col("leaves")) - 1).alias("u_hi"))
    v = nodes.select("tree", "bucket", "level", "lo", "hi", "kids")
    inside = ((u.tree == v.tree) & (u.bucket == v.bucket) & (v.lo <= u.u_lo) & (u.u_hi <= v.hi))
    beside = lambda test: F.array_join(F.transform(F.filter(v.kids, test), lambda k: k["digest"]), "")
    step = F.struct(v.level, beside(lambda k: k["hi"] < u.u_lo).alias("left"), beside(lambda k: k["lo"] > u.u_hi).alias("right"))
    found = u.join(v, inside, "left").select(u.tree, u.bucket, "idx", "unit", F.when(v.level.isNotNull(), step).alias("step"))
    steps = F.sort_array(F.collect_list("step"))
    return found.groupBy("tree", "bucket", "idx").agg(F.any_value("unit").alias("unit"), steps.alias("steps")).select(
        "tree", "bucket", "idx", "unit.*",
        F.transform("steps", lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right"))).alias("path"))


def attach_paths(leaves: DataFrame, trees: Tree, tops: DataFrame, payload: list[str], label: str) -> DataFrame:
    """``payload`` of ``leaves`` with ``path`` and what ``tops`` (tree, leaves, above, ...) holds of its tree.

    ``above`` is the path of a tree's top; every table on the way is joined by bucket, from the top down.
    """
    extra = [c for c in tops.columns if c not in ("tree", "leaves", "above")]
    upper = None
    for band in reversed(range(len(trees.nodes))):
        units, names = (trees.units[band], ["leaves"]) if band else (leaves.withColumn("leaves", F.col("n")), payload)
        own = _band_paths(units, trees.nodes[band], band, names)
        # a tree that ends in this band has one bucket here
        most, least = BUCKET ** (band + 1), BUCKET ** band if band else 0
        ends = tops.filter((F.col("leaves") <= most) & (F.col("leaves") > least)).select(
            "tree", F.lit(0).cast("long").alias("bucket"), "above", *extra)
        upper = ends if upper is None else upper.select(
            "tree", F.col("idx").alias("bucket"), F.col("path").alias("above"), *extra).unionByName(ends)
        joined = own.join(upper, ["tree", "bucket"]).withColumn("path", F.concat("path", "above"))
        upper = joined.select("tree", "idx", "path", *extra, *(payload if not band else []))
        if band:
            upper = stored(upper, f"{label}-paths")
    return upper.drop("idx")


@dataclass
class Manifest:
    """``leaves``: ranked rows; ``nodes``: all nodes of the parts' trees; ``parts``: subroots with their paths; the root."""

    leaves: DataFrame
    trees: Tree
    parts: DataFrame
    root: str | None
    payload: list

    @property
    def nodes(self) -> DataFrame:
        out = self.trees.nodes[0]
        for more in self.trees.nodes[1:]:
            out = out.unionByName(more)
        return out.select("tree", "level", "lo", "hi", "digest")


def build_manifest(df: DataFrame, fields: list[str], part: str, order: str, carry: dict[str, Column] | None = None) -> Manifest:
    """Manifest of ``df``: leaves digest ``fields``, a tree per ``part``, leaves by ``order``; ``carry`` goes with each leaf."""
    carry = carry or {}
    rows = df.select(col(part).alias("part"), col(order).alias("key"), leaf_digest(*map(col, fields)).alias("digest"),
                     F.monotonically_increasing_id().alias("row_no"), F.struct(F.lit(0), *[c.alias(n) for n, c in carry.items()]).alias("carry"))
    leaves = rank_rows(stored(rows, "merkle-rows"), "part", ["key", "digest", "row_no"], "merkle-leaves").drop("row_no")
    trees = build_trees(leaves, "merkle")
    parts = trees.tops.select(F.lit(0).alias("all"), F.col("tree").alias("part_tree"), F.col("leaves").alias("part_leaves"), "digest")
    ranked = rank_rows(parts, "all", ["part_tree"], "merkle-parts")
    over = build_trees(ranked, "merkle-top")
    top = over.tops.withColumn("above", F.array().cast(PATH)).drop("digest")
    proofs = attach_paths(ranked.withColumn("subroot", F.col("digest")), over, top, ["part_tree", "part_leaves", "subroot"], "merkle-top")
    parts = stored(proofs.select(F.col("part_tree").alias("tree"), F.col("part_leaves").alias("leaves"), "subroot", F.col("path").alias("above")), "merkle-subroots")
    found = over.tops.first()
    return Manifest(leaves, trees, parts, found.digest if found else None, list(carry))


def prove(manifest: Manifest) -> DataFrame:
    """Per row: ``part``, ``key``, the carried columns, ``leaf``, ``subroot``, ``root`` and ``path``."""
    leaves = manifest.leaves.withColumnRenamed("digest", "leaf")
    out = attach_paths(leaves, manifest.trees, manifest.parts, ["part", "key", "leaf", "carry"], "merkle")
    return out.select("part", "key", *[F.col("carry")[c].alias(c) for c in manifest.payload], "leaf", "subroot",
                      F.lit(manifest.root).cast("string").alias("root"), "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: hash_of(F.concat(s["left"], node, s["right"])))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return hash_of(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def verify_tampered(df: DataFrame) -> DataFrame:
    """Manifest and proofs of documents, and what they say of copies without line feeds (documents of even crc32)."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    values = {c: col(c) for c in fields}
    cut = leaf_digest(*(values | {"text": F.replace(col("text"), F.lit("\n"), F.lit(""))}).values())
    tampered = F.when((F.crc32(col("doc_id").cast("string")) % 2 == 0) & col("text").contains("\n"), cut)
    proofs = prove(build_manifest(df, fields, "source", "doc_id", {"tampered": tampered}))
    out = proofs.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
