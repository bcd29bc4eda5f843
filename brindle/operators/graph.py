"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.session import checkpointed


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _contract(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (u, v), u > v."""
    # large star: neighbours larger than u go to the least of u's neighbours and u itself
    both = links.union(links.select("v", "u").toDF("u", "v"))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # small star: u and its smaller neighbours go to the least of them
    small = large.join(_least(large), "u").select(F.col("v").alias("x"), "u", "m")
    return small.filter("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of an undirected graph; component is the smallest node.

    Alternating star contraction: each round links the larger neighbours of a node to its smallest neighbour, then
    a node's smaller neighbours and itself to the smallest. The table shrinks to one star per component in a number
    of rounds logarithmic in the longest path; nothing but a count and a checksum of the links comes to the driver,
    and each round is cut off by a checkpoint. Self-loops, repeated edges and edges with a null end are allowed; nodes
    with self-loops only are components of their own; an empty table gives no rows. Raises if the links still change
    after most_rounds rounds, so a result is always whole.
    """
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()
    nodes = ends.select(F.col("u").alias("node")).union(ends.select("v")).distinct()
    links = checkpointed(ends.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        links = checkpointed(_contract(links))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38, 0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    component = _least(links).select(F.col("u").alias("node"), "m")
    return nodes.join(component, "node", "left").select("node", F.coalesce("m", "node").alias("component"))
