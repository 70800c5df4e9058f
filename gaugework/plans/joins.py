"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 16


def row_salt(df: DataFrame, salts: int = SALTS) -> Column:
    """Salt that depends only on row content, so a recomputed task places rows identically."""
    usable = [f.name for f in df.schema.fields if not _holds_map(f.dataType)]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in usable]), F.lit(salts)).cast("int")


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.VariantType)


def attach(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join a small ``lookup`` (few keys, a few rows each) to ``df``, spreading each key over ``salts`` tasks.

    Spark still replaces this by a broadcast when it measures ``lookup`` below the session's
    broadcast threshold; beyond that the salt bounds the share of a hot key in any one task.
    The copies come from a cross join, because Spark's size estimate counts those; it does not count the rows that
    ``explode`` adds, so a small compressed file was taken for a small lookup and collected to the driver ``salts`` times.
    """
    left = df.withColumn("_salt", row_salt(df, salts))
    copies = lookup.sparkSession.range(salts).select(F.col("id").cast("int").alias("_salt"))
    right = lookup.crossJoin(F.broadcast(copies))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def look_up(df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a lookup that may be as large as the data (one row per key): nothing is copied.

    Both sides are shuffled once on the whole key, such as (group, value), which no longer holds a group
    together; if one key is still hot, the adaptive skew join splits its rows and reads the one lookup row for each part.
    """
    return df.join(lookup, list(keys), how)


def asof_day(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_day: str,
    right_day: str,
    payload: Sequence[str],
    tolerance_days: int | None = None,
    prefer: Sequence[str] = (),
) -> DataFrame:
    """Latest ``right`` row on or before each left day.

    Both sides are first reduced to one row per key and day, so a window partition never exceeds
    the number of calendar days in the data whatever the row count of the key.
    """
    days = left.where(F.col(left_day).isNotNull()).select(*keys, F.col(left_day).alias("_day")).distinct()
    best = F.max_by(F.struct(*payload), F.struct(*(prefer or payload))) if len(payload) else F.lit(None)
    quotes = (
        right.where(F.col(right_day).isNotNull())
        .groupBy(*keys, F.col(right_day).alias("_day"))
        .agg(best.alias("_payload"))
    )
    line = (
        days.withColumn("_want", F.lit(True))
        .join(quotes, [*keys, "_day"], "full")
        .withColumn("_quote", F.when(F.col("_payload").isNotNull(), F.struct(F.col("_day").alias("day"), "_payload")))
    )
    back = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_hit", F.last("_quote", ignorenulls=True).over(back)).where("_want")
    if tolerance_days is not None:
        fresh = F.datediff("_day", F.col("_hit.day")) <= tolerance_days
        found = found.withColumn("_hit", F.when(fresh, F.col("_hit")))
    found = found.select(
        *keys,
        F.col("_day").alias(left_day),
        F.col("_hit.day").alias("matched_day"),
        *[F.col(f"_hit._payload.{p}").alias(p) for p in payload],
    )
    return look_up(left, found, [*keys, left_day])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the last row per key in ``order``; combined before the shuffle, so hot keys stay cheap."""
    rank = F.struct(*[o.alias(f"o{i}") if isinstance(o, Column) else F.col(o).alias(f"o{i}") for i, o in enumerate(order)])
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in keys]), rank).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)
