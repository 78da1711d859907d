"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for each node of edges (a, b): root is the least node of its component.

    Alternates two star operations: every node points its larger neighbours to its least neighbour, then its smaller
    ones. Minima are partial aggregates, so a node of very many edges is no bottleneck; each round is checkpointed and
    only two numbers of it go to the driver. No edges give no rows.
    """
    shared_folder(edges.sparkSession, "components")  # makes sure that checkpoints have a folder
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    state = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("x"), F.col("a").alias("y"), "m")
        edges = small.select(F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("m").alias("b")), F.struct(F.col("y").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
