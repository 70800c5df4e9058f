"""Small helpers shared by the pipeline operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugework.plans.settle import scratch_folder, settle  # noqa: F401

#: ASCII white space; a word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the fixed-size membership bitmap: 256 rows of 4 KB, 1 MB whatever the number of ids.
BITMAP_BITS = 1 << 23


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` and one struct ``_rest`` of all others, so that no name of the caller can clash inside an operator."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*[F.col(f"`{c}`") for c in columns], (F.struct(*others) if others else F.lit(None).cast("int")).alias("_rest"))


def unpacked(columns: Sequence[str], kept: Sequence[str]) -> list[Column]:
    """The ``columns`` of the packed frame's origin, in order; ``kept`` stand outside the struct."""
    return [F.col(c) if c in kept else F.col("_rest").getField(c).alias(c) for c in columns]


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """Global row number from 0 in ``order``; native, no task sees more than one range.

    Rows are range-partitioned and sorted; ``monotonically_increasing_id`` gives range and place, and the
    places are shifted by the row counts of the earlier ranges (one row per range, so broadcast is bounded
    by the number of partitions). Rows equal in every ordering column get consecutive numbers in any order.
    """
    placed = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_slab", F.shiftright("_at", 33))
    sizes = placed.groupBy("_slab").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slab", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(offsets), "_slab")
    return joined.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_slab", "_before")


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], amount: str, name: str) -> DataFrame:
    """Inclusive running total of ``amount`` inside each group, for groups of any size; group columns must not be NULL.

    Rows are range-partitioned on (group, order), so a group with a third of the rows spans a third of the
    ranges; totals of a group's earlier ranges (one row per group and range) are added. The placed rows are
    checkpointed, so both branches see one placement. Ties get consecutive totals in any order.
    """
    placed = settle(df.repartitionByRange(*group, *order).withColumn("_slab", F.spark_partition_id()))
    sums = placed.groupBy(*group, "_slab").agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_slab", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_slab").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("_in", F.sum(amount).over(inside))
    return local.join(offsets, [*group, "_slab"]).withColumn(name, F.col("_in") + F.col("_before")).drop("_in", "_before", "_slab")


def id_bitmap(ids: DataFrame, column: str) -> bytes:
    """Bitmap of hashed 64-bit ids, always 1 MB: no false negatives, and past some million ids it only filters less."""
    place = F.pmod(F.col(column), F.lit(BITMAP_BITS)) + 1  # Spark's bitmap functions number bits from 1
    parts = ids.where(F.col(column).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = bytearray(BITMAP_BITS // 8)
    for row in parts.collect():  # at most BITMAP_BITS / 32768 rows of 4 KB
        start = (row["b"] - 1) * 4096
        out[start : start + 4096] = row["bits"]
    return bytes(out)


def in_bitmap(bits, ids):
    """Which of the int64 ``ids`` may be in the bitmap (numpy)."""
    import numpy as np

    place = np.mod(ids, BITMAP_BITS)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
