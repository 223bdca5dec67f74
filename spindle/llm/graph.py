"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``): one root per component.

    Each round joins every node to its neighbour (or itself) of lowest random
    priority and contracts the graph along these links; priorities are drawn
    anew each round, so the number of rounds grows with the logarithm of the
    longest chain.  Every round is written to the shared folder.  Loops and
    repeated edges do no harm; an edge with a null end is ignored."""
    edges = staged(edges.filter("a is not null and b is not null").select("a", "b"), "edges")
    roots, turn = None, 0
    while True:
        near = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("p"), F.col(c).alias("n"))
        best = staged(near.groupBy("a").agg(F.min(rank("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", rank("a"))["n"].alias("root")), "component-round")
        if roots is None:
            roots = best
        else:
            step = best.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = staged(roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "component-roots")
        left, right = (best.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        edges = staged(edges.join(left, "a").join(right, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return roots
        turn += 1
