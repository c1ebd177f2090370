"""Connected components with DataFrame operations only (alternating large and small stars).

Every round moves each node's neighbours to the smallest label it sees; the edge table is
written to the shared folder between rounds. A hub with very many edges is only aggregated
(``min``) and joined back (a skewed join that Spark may split), never gathered. Rounds go on
until every node points at its root; their number grows with the logarithm of the longest
chain. Only that test's answer reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import common as C


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(low, both["u"] == low["w"]).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    moved = down.join(low, down["u"] == low["w"])
    return moved.filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("w").alias("a"), F.col("m").alias("b"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Every edge points from a node to the smallest of its component: one edge per first
    end, which is the larger one, and no second end is a first end."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into"), (F.col("a") < F.col("b")).cast("int").alias("up"))
    ends = ends.unionByName(edges.select(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into"), F.lit(0).alias("up")))
    seen = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"), F.max("up").alias("up"))
    return seen.filter("out > 1 OR (out > 0 AND into > 0) OR up > 0").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Null ends, loops and repeated edges are ignored (a node with only a loop is its own root).
    """
    given = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").distinct()
    loops = given.filter("a = b").select(F.col("a").alias("node"))
    now = C.store(given.filter("a != b"), "edges")
    while not _settled(now):
        now = C.store(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("b").alias("node")).distinct()
    named = now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
    return named.unionByName(loops.distinct().join(named.select("node"), "node", "left_anti").select("node", F.col("node").alias("root")))
