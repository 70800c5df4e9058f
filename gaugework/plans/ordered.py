"""Ordered computations inside groups of any size.

A plain window puts a whole group into one task. Here rows are range-partitioned on
(group, order), numbered inside each range, and shifted by the totals of the earlier ranges of
the same group, so a group that holds a third of the table is spread over a third of the tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.plans.joins import look_up
from gaugework.plans.settle import settle


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    amounts: Mapping[str, Column],
) -> DataFrame:
    """Add, per amount, ``<name>`` (inclusive running total) and ``<name>_all`` (group total).

    ``order`` must be unique inside a group; ties would have no defined running total.
    """
    key_cols = [F.col(k) for k in keys]
    amount_cols = df.select("*", *[c.alias(f"_amt_{n}") for n, c in amounts.items()])
    placed = settle(
        amount_cols.repartitionByRange(*key_cols, *order).withColumn("_slab", F.spark_partition_id())
    )
    sums = placed.groupBy(*keys, "_slab").agg(*[F.sum(f"_amt_{n}").alias(f"_slab_{n}") for n in amounts])
    earlier = Window.partitionBy(*keys).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = sums.select(
        *keys,
        "_slab",
        *[F.coalesce(F.sum(f"_slab_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in amounts],
        *[F.sum(f"_slab_{n}").over(whole).alias(f"{n}_all") for n in amounts],
    )
    inside = Window.partitionBy(*keys, "_slab").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(f"_amt_{n}").over(inside).alias(f"_in_{n}") for n in amounts])
    joined = local.join(offsets, [*keys, "_slab"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(n) for n in amounts],
        *[f"{n}_all" for n in amounts],
    )


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """``row_number`` over a group of any size; also adds the group's row count as ``<name>_all``."""
    return running_totals(df, keys, order, {name: F.lit(1).cast("long")})


def value_positions(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (group, distinct value): ``ties``, ``upto`` (rows <= value) and ``upto_all`` (group size)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("ties"))
    return running_totals(counts, keys, [F.col(value)], {"upto": F.col("ties")})


def medians(positions: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact group medians read off ``value_positions``."""
    low = F.floor((F.col("upto_all") + 1) / 2)
    high = F.floor((F.col("upto_all") + 2) / 2)
    start = F.col("upto") - F.col("ties")
    return positions.groupBy(*keys).agg(
        (
            (
                F.max(F.when((start < low) & (F.col("upto") >= low), F.col(value)))
                + F.max(F.when((start < high) & (F.col("upto") >= high), F.col(value)))
            )
            / 2
        ).alias(name)
    )


def with_average_rank(df: DataFrame, keys: Sequence[str], value: str, rank: str = "avg_rank", size: str = "n") -> DataFrame:
    """Add tie-averaged rank and group size to every row (NULL values get NULL rank)."""
    ranks = value_positions(df, keys, value).select(
        *keys,
        value,
        (F.col("upto") - (F.col("ties") - 1) / 2).alias(rank),
        F.col("upto_all").alias(size),
    )
    return look_up(df, ranks, [*keys, value])


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """``lag`` for groups of any size: number the rows, then join each to its predecessor."""
    placed = numbered(df, keys, order, "_pos").drop("_pos_all")
    before = placed.select(*keys, (F.col("_pos") + 1).alias("_pos"), *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    return placed.join(before, [*keys, "_pos"], "left").drop("_pos")


def following(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], column: str, count: int, name: str = "ahead", block: int = 100_000) -> DataFrame:
    """Add the next ``count`` values of ``column`` as an array, for groups of any size.

    Rows are numbered, cut into blocks of fixed length, and the first ``count`` rows of each block are
    lent to the previous one, so every window partition holds at most ``block + count`` rows.
    """
    placed = numbered(df, keys, order, "_pos").drop("_pos_all")
    home = F.floor((F.col("_pos") - 1) / block)
    lent = ((F.col("_pos") - 1) % block < count) & (F.col("_pos") > block)
    spread = placed.withColumn("_b", F.explode(F.when(lent, F.array(home, home - 1)).otherwise(F.array(home))))
    w = Window.partitionBy(*keys, "_b").orderBy("_pos").rowsBetween(1, count)
    looked = spread.withColumn(name, F.collect_list(column).over(w)).where(F.col("_b") == home)
    return looked.drop("_pos", "_b")


def running_maxima(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], values: Mapping[str, Column]) -> DataFrame:
    """Add, per value, the maximum over all earlier rows of the group (``<name>``; NULL for the first), for groups of any size.

    An associative scan: each range of (keys, order) takes the running maximum inside itself, and the maxima of the
    group's earlier ranges, one row per group and range, are carried in. Rows of equal order count as earlier in any order.
    """
    placed = settle(
        df.select("*", *[c.alias(f"_amt_{n}") for n, c in values.items()])
        .repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_slab", F.spark_partition_id())
    )
    tops = placed.groupBy(*keys, "_slab").agg(*[F.max(f"_amt_{n}").alias(f"_top_{n}") for n in values])
    earlier = Window.partitionBy(*keys).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(*keys, "_slab", *[F.max(f"_top_{n}").over(earlier).alias(f"_carry_{n}") for n in values])
    inside = Window.partitionBy(*keys, "_slab").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select("*", *[F.max(f"_amt_{n}").over(inside).alias(f"_in_{n}") for n in values])
    return local.join(carried, [*keys, "_slab"]).select(*df.columns, *[F.greatest(f"_in_{n}", f"_carry_{n}").alias(n) for n in values])
