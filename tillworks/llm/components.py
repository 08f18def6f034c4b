"""Connected components of a large graph by repeated joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.session import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its component.

    Each round links every node to the smallest node it can see and every neighbour to that one, so
    that paths shrink by half or more. A round's edges are written to the shared folder and its
    predecessor is not read again; only their number reaches the driver. Sums and minima are
    pre-aggregated, so a node with very many neighbours is no single task's work.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        # Larger neighbours of a node go to the smallest node it sees.
        seen = both(edges)
        least = seen.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        up = seen.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = saved(up.filter("a <> b").distinct())
        # A node and its smaller neighbours go to the smallest of these.
        low = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = saved(down.filter("a <> b").distinct())
        # Every node points at a root when no root points anywhere and no node has two.
        state = edges.agg(F.count("*"), F.countDistinct("a"), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0))).first()
        if before == tuple(state):
            break
        before = tuple(state)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
