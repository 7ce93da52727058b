"""Period-over-period change decomposition: a driver tree.

Definition (the decomposition routine itself is not in the reference; this is
our specification of its call contract): for the rows of a node and every
dimension value, base = sum of target in the base period, comp = the same in
the comparison period, delta = comp - base.  ``best_overall`` splits a node
on the unused dimension holding the single largest |delta| (ties by dimension
name); its children are the top ``top_k`` values by |delta| (ties by value)
whose |delta| >= ``min_node_share`` x |root delta|.  Growth stops at
``max_depth`` or when no child qualifies.

Which dimension splits a node and which values follow depend only on the set of (dimension, value)
pairs on its path, not on their order.  So all candidate nodes are the cells of one lattice: the fact
aggregated once by grouping sets (every set of at most ``max_depth`` dimensions).  Each cell is a pivot
row of the cells that leave out one of its dimensions; cells that change by less than the
share can be no nodes, and only the pivots of the others are ranked.  The tree is then walked by
joins with the few ranked children.  Two jobs prepare it (the lattice, the root's row), a third
evaluates the nodes, whatever the depth.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import scratch_path

ROOT = "root"


@dataclass
class DriverTree:
    nodes: DataFrame
    pivots: DataFrame
    root: dict


def _facts(df: DataFrame, dims: Sequence[str], target_col: str, time_col: str, base_period, comp_period) -> DataFrame:
    """The fact at the grain of the dimensions."""
    t, kind = F.col(time_col), df.schema[target_col].dataType
    exact = isinstance(kind, T.DecimalType)
    amt = F.col(target_col).cast(T.DecimalType(38, kind.scale) if exact else "double")
    zero = F.lit(0).cast(T.DecimalType(38, kind.scale) if exact else "double")
    return (df.where(t.isin(base_period, comp_period))
             .groupBy(*[F.col(d).cast("string").alias(d) for d in dims])
             .agg(F.sum(F.when(t == base_period, amt).otherwise(zero)).alias("_base"),
                  F.sum(F.when(t == comp_period, amt).otherwise(zero)).alias("_comp")))


def _lattice(facts: DataFrame, dims: Sequence[str], max_depth: int) -> DataFrame:
    """One row per set of at most ``max_depth`` dimensions and values of them; ``gid`` has a bit for each dimension left out."""
    sets = [list(c) for k in range(min(max_depth, len(dims)) + 1) for c in itertools.combinations(dims, k)]
    cells = facts.groupingSets(sets, *dims).agg(
        F.grouping_id().cast("int").alias("gid"), F.sum("_base").alias("base"), F.sum("_comp").alias("comp"))
    cells = cells.withColumn("delta", F.col("comp") - F.col("base")).withColumn("abs_delta", F.abs("delta"))
    path = scratch_path(facts.sparkSession, "lattice")
    cells.write.parquet(path)
    return facts.sparkSession.read.schema(cells.schema).parquet(path)


def _pivot_rows(cells: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Every cell below the root as a pivot row of each cell that leaves out one of its dimensions."""
    def key(gid: Column, left_out: str | None = None) -> Column:  # a cell by its set and values
        return F.to_json(F.struct(gid.alias("gid"), *[F.col(d).alias(d) for d in dims if d != left_out]))
    gid = F.col("gid")
    bits = {d: 1 << (len(dims) - 1 - i) for i, d in enumerate(dims)}  # the first dimension is the highest bit
    steps = F.array_compact(F.array(*[
        F.when(gid.bitwiseAND(F.lit(bit)) == 0, F.struct(
            key(gid.bitwiseOR(F.lit(bit)), d).alias("parent"), F.lit(d).alias("dim"), F.col(d).alias("value")))
        for d, bit in bits.items()]))
    return cells.select(F.explode(steps).alias("s"), key(gid).alias("cell"), "base", "comp", "delta", "abs_delta").select(
        "s.*", "cell", "base", "comp", "delta", "abs_delta")


def driver_tree(df: DataFrame, base_period, comp_period, dims: Sequence[str], target_col: str,
                time_col: str, max_depth: int = 3, min_node_share: float = 0.05, top_k: int = 5,
                split_policy: str = "best_overall") -> DriverTree:
    if split_policy != "best_overall":
        raise ValueError("only split_policy='best_overall' is defined")
    spark, dims = df.sparkSession, list(dims)
    cells = _lattice(_facts(df, dims, target_col, time_col, base_period, comp_period), dims, max_depth)
    everything = (1 << len(dims)) - 1
    total = cells.where(F.col("gid") == everything).select("base", "comp").first()
    base0, comp0 = (total["base"] or 0, total["comp"] or 0) if total else (0, 0)
    root_delta = comp0 - base0
    threshold = abs(float(root_delta)) * float(min_node_share)
    # pivots of the root and of the cells that change enough to be nodes
    rows = _pivot_rows(cells, dims)
    able = rows.where(F.col("abs_delta") >= F.lit(threshold)).select(F.col("cell").alias("parent")).distinct()
    top = F.to_json(F.struct(F.lit(everything).alias("gid")))
    pivots = rows.where(F.col("parent") == top).unionByName(rows.where(F.col("parent") != top).join(able, "parent", "left_semi"))
    best = pivots.groupBy("parent").agg(F.min_by("dim", F.struct(-F.col("abs_delta"), "dim")).alias("split_dim"))
    first = Window.partitionBy("parent").orderBy(F.desc("abs_delta"), F.asc_nulls_last("value"))
    children = (pivots.join(best, "parent").where(F.col("dim") == F.col("split_dim")).withColumn("rank", F.row_number().over(first))
                .where((F.col("rank") <= top_k) & (F.col("abs_delta") >= F.lit(threshold)))
                .select(F.col("parent").alias("of"), "split_dim", "value", F.col("cell").alias("child"), *[
                    F.col(c).cast("double").alias(f"c_{c}") for c in ("base", "comp", "delta")]))
    level = spark.range(1).select(
        F.lit(ROOT).alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit(0).alias("depth"), top.alias("cell"),
        *[F.lit(float(x)).alias(c) for c, x in (("base", base0), ("comp", comp0), ("delta", root_delta))])
    nodes = level
    for depth in range(1, max_depth + 1):
        name = F.concat(F.when(F.col("node_id") == ROOT, "").otherwise(F.concat("node_id", F.lit("/"))),
                        "split_dim", F.lit("="), F.coalesce("value", F.lit("None")))
        level = level.join(children, F.col("cell") == F.col("of")).select(
            name.alias("node_id"), F.col("node_id").alias("parent_id"), F.lit(depth).alias("depth"), F.col("child").alias("cell"),
            *[F.col(f"c_{c}").alias(c) for c in ("base", "comp", "delta")])
        nodes = nodes.unionByName(level)
    path = scratch_path(spark, "driver-nodes")
    splits = children.select(F.col("of").alias("cell"), "split_dim").distinct()
    share = F.col("delta") / F.lit(float(root_delta)) if root_delta else F.lit(None).cast("double")
    nodes.join(splits, "cell", "left").select(
        "node_id", "parent_id", "depth", F.when(F.col("depth") < max_depth, F.col("split_dim")).alias("split_dim"),
        F.when(F.col("node_id") == ROOT, "").otherwise(F.col("node_id")).alias("path"), "base", "comp", "delta",
        share.alias("share_of_root"), "cell").write.parquet(path)
    stored = spark.read.parquet(path)
    inner = stored.where(F.col("depth") < max_depth).select("node_id", F.col("cell").alias("parent"))
    out = inner.join(pivots, "parent").select("node_id", "dim", "value", "base", "comp", "delta", "abs_delta")
    split = stored.where(F.col("node_id") == ROOT).first()["split_dim"]
    root = {"node_id": ROOT, "split_dim": split, "base": float(base0), "comp": float(comp0), "delta": float(root_delta),
            "summary": f"change {float(root_delta):,.2f} from {base_period} to {comp_period}"
                       + (f"; largest driver: {split}" if split else "")}
    return DriverTree(stored.drop("cell"), out, root)
