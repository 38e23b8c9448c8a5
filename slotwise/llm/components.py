"""Connected components of links by alternating stars: all neighbours are hung on the smallest one
until nothing moves. Each step is a minimum per vertex, taken before the shuffle too, and a join; no
vertex's neighbours are gathered, and the number of steps grows with the logarithm of the longest path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u")
    return hung.select(F.col("m").alias("a"), F.col("v").alias("b")).union(least.select("m", "u"))


def components(edges: DataFrame, most_steps: int = 60) -> DataFrame:
    """(id, component) of every vertex of the links (a, b); component is the smallest id reachable."""
    now = stage(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most_steps):
        now = stage(_small_star(stage(_large_star(now).where("a != b").distinct())).where("a != b").distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError("the stars did not settle")
    # Settled: every vertex hangs on the smallest of its component.
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).union(now.select("a", "a").distinct())


def grouped(keyed: DataFrame) -> DataFrame:
    """Rows (key, id, ...) of keys with two ids and more, with size and least_id. Sizes are summed up
    before the shuffle; rows of a large key are split at run time by the join."""
    several = keyed.groupBy("key").agg(
        F.min("id").alias("least_id"), F.max("id").alias("most_id"), F.count(F.lit(1)).alias("size")
    ).where("least_id < most_id").drop("most_id")
    return keyed.join(several, "key")


def central_pairs(members: DataFrame) -> DataFrame:
    """(a, b) of each member with the most central one of its key: the one whose keys have the most
    members. In a family of edited copies that is the text they were made from, if it is there."""
    weight = members.groupBy("id").agg(F.sum("size").alias("weight"))
    head = members.select("key", "id").join(weight, "id").groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("head")
    ).select("key", (-F.col("head.minus")).alias("head"))
    return members.join(head, "key").where("id != head").select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()


def unresolved(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members, with their component c, of keys that have two components and more."""
    labelled = members.where("size > 2").join(found, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
    several = labelled.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("key")
    return labelled.join(several, "key")


def link_within(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], rest: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """Components of vertices that share a key, and links that make them, without all pairs of a key: pairs that others
    connect already stay untested. Who needs every link tests all pairs, as ``passages`` does.

    ``members`` is what ``grouped`` returns; ``verify`` takes pairs (a, b), a < b, and returns the rows of
    those that link. First each member is tested against the most central one of its key. A key whose
    members are in one component then is done. ``rest`` gets the members of the others, with their
    component c, and returns all pairs of them that may still link and are in different components."""
    links = stage(verify(stage(central_pairs(members))))
    found = stage(components(links))
    open_ones = stage(unresolved(members, found))
    if open_ones.isEmpty():
        return links, found
    links = stage(links.unionByName(verify(stage(rest(open_ones)))))
    return links, stage(components(links))
