"""Shards along a Hilbert curve over document metadata; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.common import numbered, settle

BITS = 5
DIMENSIONS = ("source", "lang", "n_chars")


def cell_bounds(docs: DataFrame, column: str, bits: int) -> list:
    """Smallest value of each used cell when the rows, ordered by ``column``, are quantised into 2^bits cells of equal depth.

    A value lies in the cell of the first row that has it, so a value that holds a third of all rows fills one
    cell. The distinct values are counted in parallel and numbered by range; only the at most 2^bits bounds
    reach the driver.
    """
    counts = docs.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    placed = settle(counts.repartitionByRange("value").sortWithinPartitions("value").withColumn("slab", F.spark_partition_id()))
    total = placed.agg(F.sum("n")).first()[0]
    if not total:
        return []
    slabs = placed.groupBy("slab").agg(F.sum("n").alias("m"))
    base = slabs.select("slab", F.coalesce(F.sum("m").over(Window.orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("slab").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(base), "slab")
    cell = F.floor((F.col("base") + F.col("before")) * F.lit(1 << bits) / F.lit(total))
    rows = ranked.groupBy(cell.alias("cell")).agg(F.min("value").alias("bound")).orderBy("cell").collect()
    return [(r["cell"], r["bound"]) for r in rows]


def cell_of(column: Column, bounds: Sequence[tuple[int, object]]) -> Column:
    """Cell number of a value under ``cell_bounds``; NULL, and a table without values, lie in cell 0."""
    out = F.lit(0)
    for cell, bound in bounds:
        out = F.when(column >= F.lit(bound), F.lit(cell)).otherwise(out) if bound is not None else out
    return F.when(column.isNull(), F.lit(0)).otherwise(out).cast("long")


def hilbert_index(cells: Sequence[Column], bits: int) -> Column:
    """Index on the Hilbert curve through a grid of ``len(cells)`` axes with ``bits`` bits each.

    Skilling's public transform: undo excess work from the highest bit down, Gray-encode, interleave. Every
    step is a column expression; steps are stored as struct fields, so the expression stays small.
    """
    n = len(cells)
    x = F.array(*[c.cast("long") for c in cells])

    def put(a: Column, values: dict[int, Column]) -> Column:
        return F.array(*[values.get(i, a[i]) for i in range(n)])

    for level in range(bits - 1, 0, -1):
        q, p = 1 << level, (1 << level) - 1
        for i in range(n):
            def step(a: Column) -> Column:
                high = a[i].bitwiseAND(F.lit(q)) != 0
                swap = a[0].bitwiseXOR(a[i]).bitwiseAND(F.lit(p))
                flipped = put(a, {0: a[0].bitwiseXOR(F.lit(p))})
                swapped = put(a, {0: a[0].bitwiseXOR(swap), i: a[i].bitwiseXOR(swap)}) if i else a
                return F.when(high, flipped).otherwise(swapped)

            # transform over a one-element array binds the previous step to a variable.
            x = F.transform(F.array(x), step)[0]

    def gray(a: Column) -> Column:
        out = [a[0]]
        for i in range(1, n):
            out.append(a[i].bitwiseXOR(out[-1]))
        return F.array(*out)

    x = F.transform(F.array(x), gray)[0]

    def finish(a: Column) -> Column:
        t = F.lit(0).cast("long")
        for level in range(bits - 1, 0, -1):
            t = F.when(a[n - 1].bitwiseAND(F.lit(1 << level)) != 0, t.bitwiseXOR(F.lit((1 << level) - 1))).otherwise(t)
        index = F.lit(0).cast("long")
        for level in range(bits - 1, -1, -1):
            for i in range(n):
                bit = F.shiftright(a[i].bitwiseXOR(t), level).bitwiseAND(F.lit(1))
                index = F.shiftleft(index, 1).bitwiseOR(bit)
        return index

    return F.transform(F.array(x), finish)[0]


def hilbert_shards(docs: DataFrame, shards: int = 40, dimensions: Sequence[str] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """Shard and slot of every row of ``docs``: rows in Hilbert order over ``dimensions``, cut into runs of equal row counts.

    Each dimension is quantised by depth into 2^bits cells; neighbours on the curve are close in every
    dimension, so a shard covers a small box and the minima and maxima of ``shard_bounds`` prune on any of
    them. The law is ``rows``: the row with global place r of n lies in shard floor(r * shards / n), so counts
    differ by one at most, and a source with a third of all rows simply spans a third of the shards.
    Ties on the curve are broken by the dimensions, doc_id and text checksum; rows equal in all of
    these may take each other's slot.

    Returns doc_id, size (UTF-8 bytes plus 16), text_crc32 (0 for a NULL text), law, shard, slot (from 0 in each
    shard), grown_shard (always NULL here), curve, and the dimensions. NULL dimensions lie in cell 0. Fewer rows
    than shards leave shards empty; an empty table gives no row. Further columns of ``docs`` are ignored.
    """
    bounds = {d: cell_bounds(docs, d, bits) for d in dimensions}
    curve = hilbert_index([cell_of(F.col(f"`{d}`"), bounds[d]) for d in dimensions], bits)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        curve.alias("curve"),
        *[F.col(f"`{d}`").alias(d) for d in dimensions],
    )
    placed = numbered(settle(rows), ["curve", *dimensions, "doc_id", "text_crc32", "size"], "place")
    total = (placed.agg(F.max("place")).first()[0] or 0) + 1
    exact = F.expr(f"cast(place * {int(shards)} div {total} as int)")
    start = F.expr(f"(shard * cast({total} as bigint) + {int(shards) - 1}) div {int(shards)}")
    return (
        placed.withColumn("shard", exact)
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("place") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve", *dimensions)
    )


def shard_bounds(sharded: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One row per shard: rows, bytes, and the minimum and maximum of each dimension, for file pruning."""
    return sharded.groupBy("shard").agg(
        F.count("*").alias("rows"),
        F.sum("size").alias("bytes"),
        *[f(d).alias(f"{d}_{n}") for d in dimensions for f, n in ((F.min, "min"), (F.max, "max"))],
    )
