"""Choices that depend on earlier choices, settled by rounds over sparse links instead of one pass over a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.plans.settle import settle


def first_independent(nodes: DataFrame, links: DataFrame, node: str) -> DataFrame:
    """The nodes kept when they are visited in order and one goes if a kept one links to it.

    ``nodes``: column ``node``; ``links``: (earlier, later) pairs of node values. Every round keeps all nodes without an
    undecided earlier neighbour and drops their later neighbours, so rounds follow the longest chain of links, not the
    number of nodes; no list of kept nodes exists. Each round is checkpointed.
    """
    open_ = settle(links.select("earlier", "later").where("earlier <> later").distinct())
    linked = open_.select(F.col("earlier").alias(node)).union(open_.select(F.col("later").alias(node))).distinct()
    kept = settle(nodes.select(node).distinct().join(linked, node, "left_anti"))
    waiting = settle(linked)
    parts = [kept]
    while True:
        held_back = open_.select(F.col("later").alias(node)).distinct()
        roots = settle(waiting.join(held_back, node, "left_anti"))
        if roots.isEmpty():
            break
        parts.append(roots)
        dropped = settle(open_.join(roots.select(F.col(node).alias("earlier")), "earlier", "left_semi").select(F.col("later").alias(node)).distinct())
        gone = settle(roots.union(dropped))
        waiting = settle(waiting.join(gone, node, "left_anti"))
        left = open_.join(gone.select(F.col(node).alias("earlier")), "earlier", "left_anti")
        open_ = settle(left.join(gone.select(F.col(node).alias("later")), "later", "left_anti").select("earlier", "later"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def one_to_one(links: DataFrame, left: str, right: str, best: Sequence[Column], order: Column | None = None) -> DataFrame:
    """The matches of visiting ``left`` values in order, each taking its best ``right`` value that is still free.

    ``links``: one row per admissible pair. ``best`` ranks the partners of a left value (ascending, ties by ``right``);
    ``order`` ranks left values (``left`` itself by default). A pair is final when the right value is the left's best free
    partner and no earlier left value still waits for that right value: then no later choice can disturb it. All such
    pairs of a round are settled at once and their rows leave the table. The first waiting left value is always final, so every round progresses.
    """
    turn = F.col(left) if order is None else order
    open_ = settle(links.withColumn("_turn", F.struct(turn.alias("t"), F.col(left).alias("l"))).withColumn("_rank", F.struct(*[b.alias(f"r{i}") for i, b in enumerate(best)], F.col(right).alias("id"))))
    parts = None
    while not open_.isEmpty():
        choice = open_.groupBy(left).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in open_.columns]), "_rank").alias("_m")).select("_m.*")
        first = open_.groupBy(right).agg(F.min("_turn").alias("_first"))
        fixed = settle(choice.join(first, right).where(F.col("_turn") == F.col("_first")).select(*open_.columns))
        parts = fixed if parts is None else parts.unionByName(fixed)
        rest = open_.join(fixed.select(left), left, "left_anti").join(fixed.select(right), right, "left_anti")
        open_ = settle(rest.select(*open_.columns))
    out = open_ if parts is None else parts
    return out.drop("_turn", "_rank")


def similar_sets(rows: DataFrame, group: Sequence[str], item: str, tokens: str, share: float) -> DataFrame:
    """(a, b) item pairs of one group whose token sets share at least ``share`` of the smaller set.

    Prefix filter: a set with n tokens that shares m = ceil(share * n) of them with a set of at least its size must share one of its
    n - m + 1 rarest. Only those tokens of the smaller set look for partners, among all tokens of the other, so frequent tokens make no candidates.
    """
    sized = rows.select(*group, F.col(item).alias("_i"), F.array_distinct(tokens).alias("_t")).where(F.size("_t") > 0).withColumn("_n", F.size("_t"))
    held = settle(sized.select(*group, "_i", "_n", F.explode("_t").alias("_w")))
    seen = held.groupBy("_w").agg(F.count("*").alias("_df"))
    ranked = held.join(seen, "_w").groupBy(*group, "_i", "_n").agg(F.array_sort(F.collect_list(F.struct("_df", "_w"))).alias("_o"))  # the tokens of one set
    rare = F.transform(F.slice("_o", F.lit(1), F.col("_n") - F.ceil(F.col("_n") * share - 1e-9).cast("int") + 1), lambda x: x["_w"])
    small = ranked.select(*group, F.col("_i").alias("_s"), F.col("_n").alias("_sn"), F.explode(rare).alias("_w"))
    pairs = small.join(held.select(*group, F.col("_i").alias("_l"), F.col("_n").alias("_ln"), "_w"), [*group, "_w"])
    smaller_first = (F.col("_sn") < F.col("_ln")) | ((F.col("_sn") == F.col("_ln")) & (F.col("_s") != F.col("_l")))
    near = settle(pairs.where(smaller_first).select(F.least("_s", "_l").alias("a"), F.greatest("_s", "_l").alias("b")).distinct())
    sets = sized.select(F.col("_i"), F.col("_t"))
    both = near.join(sets.toDF("a", "ta"), "a").join(sets.toDF("b", "tb"), "b")
    enough = F.size(F.array_intersect("ta", "tb")) >= F.least(F.size("ta"), F.size("tb")) * share - 1e-9
    return both.where(enough).select("a", "b")
