"""Connected components of a link table by distributed union-find."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.operators.scale import pin

ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that a link names; ``root`` is the smallest node of its component.

    Large-star and small-star rounds: every node hands its neighbours to the
    smallest it knows, until the links are stars. Sums and minima are made before
    the shuffle and the tables are written between rounds, so a lost executor costs
    one task and a hub's links are never gathered in one.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = pin(edges, "links")
    before = None
    for _ in range(ROUNDS):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        edges = pin(_small_star(_large_star(edges)), "links")
    raise RuntimeError(f"links did not settle in {ROUNDS} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).filter("u != v").distinct()
