"""Connected components of links that live in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the links, one root for each component; `a` and `b` are longs.

    Each round points every node to its smallest neighbour and replaces the links by those between the nodes pointed
    to, until none is left; the rounds' pointers are then followed. Nodes take part by hash, so that numbering along
    a chain does not slow the rounds down. Every round is stored, hubs are aggregated before they are shuffled, and
    nothing but the question whether links are left reaches the driver. Links of a node with itself are ignored.
    """
    ends = links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter(F.col("x") != F.col("y"))
    # A bijection on longs: no two nodes meet.
    hashed = ends.select(F.xxhash64("x").alias("u"), F.xxhash64("y").alias("v"))
    names = ends.select("x").unionByName(ends.select(F.col("y").alias("x"))).distinct()
    names = names.select(F.col("x").alias("node"), F.xxhash64("x").alias("u"))
    left = materialize(hashed.unionByName(hashed.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    rounds = []
    while not left.isEmpty():
        to = left.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p"))
        to = materialize(to)
        rounds.append(to)
        other = to.select(F.col("u").alias("v"), F.col("p").alias("q"))
        moved = left.join(to, "u").join(other, "v").filter(F.col("p") != F.col("q"))
        left = materialize(moved.select(F.col("p").alias("u"), F.col("q").alias("v")).distinct())
    if not rounds:
        return names.select("node", F.col("u").alias("root"))
    roots = rounds.pop()
    while rounds:
        further = roots.select(F.col("u").alias("p"), F.col("p").alias("r"))
        roots = materialize(rounds.pop().join(further, "p", "left").select("u", F.coalesce("r", "p").alias("p")))
    return names.join(roots, "u").select("node", F.col("p").alias("root"))
