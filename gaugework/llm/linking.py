"""Groups of similar items from shared buckets: star pairs first, then only pairs between different groups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gaugework.llm.common import settle


def _settled(stars: DataFrame) -> tuple[DataFrame, tuple]:
    """``stars`` written out, with its number of rows and the sum of their hashes, which are observed while it is written."""
    seen = Observation()
    written = settle(stars.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
    return written, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame) -> DataFrame:
    """(item, root) for every item of ``edges`` (a, b); root is the smallest item reachable.

    Alternating large and small stars until the edge set no longer changes, a logarithmic number of
    rounds. Minima are combined before the shuffle and read back by joins that Spark can split, so a hub
    with any number of neighbours is no hot task. Each round is checkpointed.
    """
    stars, mark = _settled(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    last = None
    while mark != last and mark[0]:
        last = mark
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Dealt once by u for the minima and the join; the last step of a round takes repeats out.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").repartition("u")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        stars, mark = _settled(small.where("u <> v").distinct())
    roots = stars.select(F.col("v").alias("item"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("item"), F.col("v").alias("root")).union(roots)


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (item, root), joined further by ``links`` (a, b) of any items: only the linked groups are walked again."""
    ends = links
    for c in ("a", "b"):
        ends = ends.join(groups.select(F.col("item").alias(c), F.col("root").alias(f"_{c}")), c, "left").withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
    above = settle(components(ends))
    known = groups.join(above.select(F.col("item").alias("root"), F.col("root").alias("top")), "root", "left").select("item", F.coalesce("top", "root").alias("root"))
    return known.union(above.join(groups, "item", "left_anti").select("item", "root"))


def link(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    marks: DataFrame | None = None,
    near: Callable[[Column, Column], Column] | None = None,
    between: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(item, root) of the groups of items joined by verified pairs; items without a verified pair are left out.

    ``buckets`` (bucket, item) proposes pairs: any two items that share a bucket and, given ``marks`` (item, mark),
    whose marks are ``near``. ``verify`` takes distinct pairs (a, b) and returns those that are similar. Two passes
    give the groups of *all* proposed pairs without writing out the pairs of a large group: (1) every member
    against the smallest item of each of its buckets; (2) in buckets whose members still lie in different
    groups, every pair of members of different groups. Pairs inside one group cannot change it and are never
    formed. Pass 2 forms near pairs inside a join and verifies them, or leaves all to ``between``, which takes the members
    (bucket, item, root) and returns links (a, b) between groups.
    """
    hubs = buckets.groupBy("bucket").agg(F.min("item").alias("hub"), F.max("item").alias("top")).where("hub <> top").drop("top")
    # Few buckets are shared, so they are hashed and the many members need no sort.
    members = buckets.join(hubs.hint("shuffle_hash"), "bucket")
    # Given marks, ``buckets`` may hold a row more than once.
    members = settle(members if marks is None else members.distinct())
    star = members.where("item <> hub").select(F.col("hub").alias("a"), F.col("item").alias("b")).distinct()
    if marks is not None:
        star = star.join(marks.toDF("a", "ma"), "a").join(marks.toDF("b", "mb"), "b").where(near(F.col("ma"), F.col("mb")))
    first = settle(verify(star.select("a", "b")).select("a", "b"))
    groups = components(first)
    rooted = members.join(groups, "item", "left").select("bucket", "item", "hub", F.coalesce("root", "item").alias("root"))
    if between is not None:
        second = settle(between(settle(rooted.select("bucket", "item", "root"))))
        return groups if second.isEmpty() else merged(groups, second.select("a", "b"))
    known = settle(rooted.join(marks, "item") if marks is not None else rooted.withColumn("mark", F.lit(0)))
    lead = known.where("item = hub").select("bucket", F.col("root").alias("lead"))
    apart = known.join(lead, "bucket").where("root <> lead").select("bucket", F.col("item").alias("a"), F.col("mark").alias("ma"), F.col("root").alias("ra"), "lead")
    others = known.where("item <> hub").select("bucket", F.col("item").alias("b"), F.col("mark").alias("mb"), F.col("root").alias("rb"))
    # The hub has met everyone. Two strangers to its group meet once (a < b); a stranger meets each member of that group.
    meet = (F.col("ra") != F.col("rb")) & ((F.col("rb") == F.col("lead")) | (F.col("a") < F.col("b")))
    if near is not None:
        meet &= near(F.col("ma"), F.col("mb"))
    rest = settle(apart.join(others, (apart["bucket"] == others["bucket"]) & meet).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if rest.isEmpty():
        return groups
    return merged(groups, verify(rest).select("a", "b"))


def spanning(a: Sequence[int], b: Sequence[int]) -> list[bool]:
    """Which of the pairs form a spanning forest, so a task passes on at most one link per item, not all of a group."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    keep = []
    for x, y in zip(a, b, strict=True):
        x, y = root(x), root(y)
        keep.append(x != y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return keep
