"""Connected components of an edge table by alternating star contraction (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linecross.staging import discard, stage_observed

MAX_ROUNDS = 60


def _turned(edges: DataFrame, keys: list[str]) -> DataFrame:
    return edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v"))


def _to_smallest(neighbours: DataFrame, keys: list[str]) -> DataFrame:
    """Each (u, v) with ``low``, the smallest of u and its neighbours.

    The minimum is combined on the map side and joined back, so a hub's edges never meet in one task:
    the join has one row per hub on the other side, which lets adaptive execution split the hub's partition.
    """
    low = neighbours.groupBy(*keys, "u").agg(F.min("v").alias("low"))
    low = low.withColumn("low", F.least("u", "low"))
    return neighbours.join(low, [*keys, "u"])


def _large_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    both = edges.unionByName(_turned(edges, keys))
    return _to_smallest(both, keys).where(F.col("v") > F.col("u")).select(
        *keys, F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame, keys: list[str]) -> DataFrame:
    low = _to_smallest(edges, keys)
    return low.where(F.col("v") != F.col("low")).select(*keys, F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
        low.select(*keys, "u", F.col("low").alias("v"))).distinct()


def connected_components(edges: DataFrame, keys: list[str] = (), a: str = "a", b: str = "b") -> DataFrame:
    """``keys, node, root``: every node that is not its component's smallest, with that smallest node.

    Nodes are comparable values, distinct within ``keys``; edges never connect different keys. A node without a
    row is a root itself. Each round is written once and read back; the driver only sees the number of edges and a sum of their hashes,
    which the same write observes: a round that changes neither has found the stars.
    """
    keys = list(keys)
    oriented = edges.where(F.col(a) != F.col(b)).select(
        *keys, F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    marks = {"n": "count(*)", "mark": f"sum(CAST(xxhash64({', '.join([*keys, 'u', 'v'])}) AS DECIMAL(20, 0)))"}
    stars, seen = stage_observed(oriented, "edges", **marks)
    for _ in range(MAX_ROUNDS):
        before = seen
        if seen["n"]:
            done = stars
            stars, seen = stage_observed(_small_star(_large_star(stars, keys), keys), "stars", **marks)
            discard(done)
        if seen == before:
            return stars.select(*keys, F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("connected components did not settle")
