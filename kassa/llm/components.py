"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import drop_kept, keep


def _stars(edges: DataFrame) -> DataFrame:
    """Each node ``u`` with the least node of its neighbourhood and itself.
    Combined before the shuffle: a hub costs one row per task. Written as a
    table, so that the join with it reads both sides from a shuffle (or one
    from a broadcast, where the table is small) and a hub's rows can be split."""
    return keep(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")


def large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node it sees."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    stars = _stars(both)
    found = keep(both.join(stars, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct(), "links")
    drop_kept(stars)
    return found


def small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = _stars(down)
    found = keep(down.join(stars, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(stars.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
    drop_kept(stars)
    return found


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (u, v).

    Rounds repeat until nothing changes, about the logarithm of the longest
    path. Each round is written to the shared folder, so a lost executor costs
    one round's part at most, and the round before is deleted. What changed is
    seen from a row count and a sum of hashes, not from the links."""
    now = keep(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(now)
    while state[0]:
        large = large_star(now)
        after = small_star(large)
        drop_kept(now)
        drop_kept(large)
        now, (before, state) = after, (state, _state(after))
        if before == state:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
