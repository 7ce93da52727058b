"""Connected components over an edge table, with joins and aggregations only.

Alternating large-star / small-star rounds: every round re-hangs each node's
neighbours below the least key it knows, so depth shrinks geometrically.  A
node's minimum is a partial aggregate (map-side combine), so a hub holding a
third of all edges sends one row per task; the join back to the edges is left
to AQE's skew splitting.  Each round ends in a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; component = least node reachable.

    Keys may be of any ordered type.  Edges with a null end and self-loops are
    ignored; repeated and reversed edges count once.  No edges: no rows.
    """
    e = (edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stored(e, "edges")
    now = _state(e)
    while now[0]:
        e = stored(_small_star(_large_star(e)), "edges")
        before, now = now, _state(e)
        if now == before:
            break
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))
