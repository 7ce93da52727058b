"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree (DataFrame functions only).

1. Each source's target is found by water filling: weights share the whole, no
   source above its cap, the excess goes to the others by weight.
2. A source is a tape: its documents in hash order, laid end to end as often as
   the cap allows.  The first ``target`` words of the tape are taken, cut into
   blocks of equal length, so the words taken are exact to one word.
3. The quota vector (blocks per source) is split down a binary tree: a node
   gives half of its blocks to the left by drawing without replacement - block
   by block with probability draws left / blocks left, which is an exact
   multivariate hypergeometric draw - until each leaf is one output shard.
4. Every shard draws as many blocks of a source as its leaf says, from a hashed
   permutation of the source's blocks (disjoint ranges); ``position`` shuffles a
   shard's pieces locally.
5. ``write_mix`` cuts the pieces out of the texts and writes them by shard in
   that order; the pieces of one whole copy, end to end, are the text itself.

Hot sources: word offsets are summed within (source, hash slice), a slice
holding about ROWS_PER_SLICE documents, and only the slices' totals are summed
along a source.  The quota tree has at most ``shards * blocks_per_shard`` blocks
plus one per source, whatever the corpus size.  All draws come from hashes of
ids and the seed: reruns agree.

Defined results: null text: size 0; null source: a source of its own, last in
order; documents of size 0 and sources of size 0 are taken 0 times; repeated rows and ids
are separate documents (equal rows in any order); no words at all: every target
0; empty table: no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BLANK, WORD, col, n_words_of, stored, whole_row

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
SEED = 42
SHARDS = 64
BLOCKS_PER_SHARD = 64
ROWS_PER_SLICE = 4096
MIX_COLUMNS = ("size", "source_size", "target", "taken", "pieces")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def source_targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, max_repeat=MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> adds rank, weight and target; one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("rank") % len(weights) + 1)
    s = (sources.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", w)
         .withColumn("cap", (max_repeat * F.col("source_size")).cast("double")))
    up = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy(F.lit(1))
    # the level that fills the total is the largest that any number of capped sources asks for
    s = (s.withColumn("capped", F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
         .withColumn("open", F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("total", share * F.sum("source_size").over(everything))
         .withColumn("level", F.max((F.col("total") - F.col("capped")) / F.col("open")).over(everything)))
    return s.select("source", "source_size", "rank", "weight",
                    F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _split(quotas: Column, level: int, node: Column, seed: int) -> Column:
    """Blocks per source that go to the left half of a node."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q)

    def one_source(state: Column, item: Column) -> Column:
        blocks = F.when(item["q"] > 0, F.sequence(F.lit(1).cast("long"), F.greatest(item["q"], F.lit(1).cast("long")))) \
            .otherwise(F.array().cast("array<bigint>"))
        draw = F.aggregate(
            blocks, F.struct(state["draws"].alias("draws"), state["left"].alias("left")),
            lambda t, i: F.struct(
                (t["draws"] - F.when(F.pmod(F.xxhash64(F.lit(seed), F.lit(level), node, item["s"], i), t["left"])
                                     < t["draws"], 1).otherwise(0)).alias("draws"),
                (t["left"] - 1).alias("left")))
        return _let(draw, lambda r: F.struct(
            r["draws"].alias("draws"), r["left"].alias("left"),
            F.concat(state["out"], F.array(state["draws"] - r["draws"])).alias("out")))

    items = F.transform(quotas, lambda q, i: F.struct(q.alias("q"), i.alias("s")))
    return _let(total, lambda n: F.aggregate(
        items, F.struct(F.floor(n / 2).cast("long").alias("draws"), n.alias("left"),
                        F.array().cast("array<bigint>").alias("out")),
        one_source, lambda s: s["out"]))


def shard_blocks(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(rank, blocks) per source -> (rank, block, shard): which shard draws which block."""
    if shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    nodes = quotas.agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "blocks"))),
                                   lambda x: x["blocks"]).alias("quotas")).withColumn("node", F.lit(0))
    for level in range(shards.bit_length() - 1):
        left = nodes.select("node", "quotas", _split(F.col("quotas"), level, F.col("node"), seed).alias("left"))
        halves = F.array(
            F.struct((2 * F.col("node")).alias("node"), F.col("left").alias("quotas")),
            F.struct((2 * F.col("node") + 1).alias("node"),
                     F.zip_with("quotas", "left", lambda q, x: q - x).alias("quotas")))
        nodes = left.select(F.explode(halves).alias("h")).select("h.node", "h.quotas")
    leaves = nodes.select(F.col("node").alias("shard"), F.posexplode("quotas").alias("rank", "drawn"))
    along = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    leaves = leaves.withColumn("stop", F.sum("drawn").over(along)).where("drawn > 0")
    drawn = leaves.select("rank", "shard", F.explode(F.expr("sequence(stop - drawn + 1, stop)")).alias("draw"))
    blocks = quotas.where("blocks > 0").select("rank", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
    permuted = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed), "rank", "block"), "block")
    blocks = blocks.withColumn("draw", F.row_number().over(permuted).cast("long"))
    return blocks.join(drawn, ["rank", "draw"]).select("rank", "block", "shard")


def mix_pieces(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
               weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT, shards: int = SHARDS,
               blocks_per_shard: int = BLOCKS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """The mix: one row per piece of a document in a block, or one without a shard for a document not taken.

    Columns: doc_id, text_hash, source, row (number of the document on its
    source's tape), size, source_size, target, copy, word_from, word_to, shard, position.
    """
    rows = stored(docs.select(
        col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), col(source).alias("source"),
        n_words_of(col(text)).alias("size")), "sizes")
    sources = stored(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")),
                                    weights, share, max_repeat), "targets")
    n_docs, wanted = rows.count(), sources.agg(F.sum("target")).first()[0] or 0.0
    length = max(1, -(-round(wanted) // (shards * blocks_per_shard)))
    sources = sources.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long")).withColumn(
        "blocks", F.ceil(F.col("quota") / length).cast("long"))
    owner = shard_blocks(sources.select("rank", "blocks"), shards, seed)

    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_hash")).withColumn(
        "slice", F.pmod("h", F.lit(max(1, -(-n_docs // ROWS_PER_SLICE)))))
    totals = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    totals = totals.select(F.col("source").alias("source_"), F.col("slice").alias("slice_"),
                           (F.sum("words").over(before) - F.col("words")).alias("words_before"),
                           (F.sum("n").over(before) - F.col("n")).alias("rows_before"))
    within = Window.partitionBy("source", "slice").orderBy("h", "doc_id", "text_hash")
    rows = rows.withColumn("row", F.row_number().over(within)).withColumn(
        "start", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    info = sources.select(F.col("source").alias("source_"), "source_size", "target", "rank", "quota")
    tape = (rows.join(totals, rows["source"].eqNullSafe(totals["source_"]) & (rows["slice"] == totals["slice_"]))
            .select("doc_id", "text_hash", "source", "size", (F.col("row") + F.col("rows_before")).alias("row"),
                    (F.col("start") + F.col("words_before")).alias("start")))
    tape = tape.join(info, tape["source"].eqNullSafe(info["source_"])).drop("source_")

    # a document's copies on the tape, cut where a block ends
    copies = F.transform(F.array(*[F.lit(c) for c in range(max_repeat)]), lambda c: F.struct(
        c.alias("copy"), (F.col("start") + c * F.col("source_size")).alias("a"),
        F.least(F.col("start") + c * F.col("source_size") + F.col("size"), F.col("quota")).alias("z")))
    taken = F.filter(copies, lambda c: c["a"] < c["z"])
    pieces = F.flatten(F.transform(taken, lambda c: F.transform(
        F.sequence(F.floor(c["a"] / length), F.floor((c["z"] - 1) / length)),
        lambda b: F.struct(c["copy"].alias("copy"), b.alias("block"),
                           (F.greatest(c["a"], b * length) - c["a"]).alias("word_from"),
                           (F.least(c["z"], (b + 1) * length) - c["a"]).alias("word_to")))))
    pieces = tape.withColumn("p", F.explode_outer(pieces)).select("*", "p.*").drop("p")
    owner = owner.select(F.col("rank").alias("rank_"), F.col("block").alias("block_"), "shard")
    mixed = pieces.join(owner, (pieces["rank"] == owner["rank_"]) & (pieces["block"] == owner["block_"]), "left")
    return mixed.select(
        "doc_id", "text_hash", "source", "row", "size", "source_size", "target", "copy", "word_from", "word_to",
        "shard", F.when(F.col("shard").isNotNull(), F.xxhash64(F.lit(seed), "shard", "source", "row", "copy", "word_from"))
        .alias("position"))


def mix_summary(pieces: DataFrame) -> DataFrame:
    """One row per document of the mix's input: what the mix takes of it, and its pieces."""
    piece = F.when(F.col("shard").isNotNull(), F.struct("copy", "word_from", "word_to", "shard", "position"))
    return pieces.groupBy("source", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.coalesce(F.sum(F.when(F.col("shard").isNotNull(), F.col("word_to") - F.col("word_from"))),
                   F.lit(0).cast("long")).alias("taken"),
        F.sort_array(F.collect_list(piece)).alias("pieces"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                    **params) -> DataFrame:
    """The documents that the mix takes, with ``mix`` (size, source_size, target, taken, pieces) beside their columns."""
    parts = mix_summary(mix_pieces(docs, doc_id, source, text, **params)).where("taken > 0")
    twins = parts.groupBy("doc_id", "text_hash", "source").agg(F.sort_array(F.collect_list(F.struct(
        "row", "size", "source_size", "target", "taken", "pieces"))).alias("mixes"))
    twins = twins.select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_"),
                         F.col("source").alias("source_"), "mixes")
    wide = docs.select(whole_row(docs).alias("doc"), col(doc_id).alias("id"), F.xxhash64(col(text)).alias("hash"),
                       col(source).alias("src"))
    hit = wide.join(twins, wide["id"].eqNullSafe(twins["id_"]) & (wide["hash"] == twins["hash_"])
                    & wide["src"].eqNullSafe(twins["source_"]))
    nth = Window.partitionBy("id", "hash", "src").orderBy("hash")
    hit = hit.withColumn("mix", F.get("mixes", F.row_number().over(nth) - 1)).where("mix is not null")
    return hit.select(*[F.col("doc").getField(c).alias(_kept_name(c)) for c in docs.columns],
                      *[f"mix.{c}" for c in MIX_COLUMNS])


def _kept_name(name: str) -> str:
    """Name of a column of the documents beside those of the mix."""
    return f"{name}_of_document" if name in MIX_COLUMNS else name


def mixed_texts(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                **params) -> DataFrame:
    """The texts of the mix: one row per piece with doc_id, source, copy, word_from, word_to, shard, position, text.

    A word carries the blanks after it, a document's first word also those before it.
    """
    d = mixed_documents(docs, doc_id, source, text, **params)
    words = F.regexp_extract_all(col(_kept_name(text)), F.lit(f"{BLANK}*{WORD}{BLANK}*"), F.lit(0))

    def cut(p: Column) -> Column:
        return F.struct(*[p[c].alias(c) for c in ("copy", "word_from", "word_to", "shard", "position")], F.array_join(F.slice(
            F.col("words"), (p["word_from"] + 1).cast("int"), (p["word_to"] - p["word_from"]).cast("int")), "").alias("text"))
    d = d.select(col(_kept_name(doc_id)).alias("doc_id"), col(_kept_name(source)).alias("source"), "pieces", words.alias("words"))
    return d.select("doc_id", "source", F.explode(F.transform("pieces", cut)).alias("piece")).select("doc_id", "source", "piece.*")


def write_mix(docs: DataFrame, path: str, shards: int = SHARDS, **params) -> DataFrame:
    """Write ``mixed_texts`` as Parquet, one file per shard, ordered by position; returns the written table."""
    texts = mixed_texts(docs, shards=shards, **params).repartition(shards, "shard")
    texts = texts.sortWithinPartitions("shard", "position", "doc_id", "copy", "word_from", "text")
    texts.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(texts.schema).parquet(path)
