"""Systematic sampling of documents towards target words per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.common import WORD, numbered, packed, running_sum, settle, unpacked

#: Expected copies are whole multiples of 2^-24: sums stay exact in 64 bits up to 2^38 documents a source.
UNIT = 1 << 24
WEIGHTS = (5, 2, 1)
VOLUME = 1.5
CAP = 2


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, volume: float = VOLUME, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources by code point, NULL last, weigh ``weights`` in turn and share ``volume`` times all words; a target
    stops at ``cap`` times its source's words, and the excess is shared again by weight among the others until
    none is above. One combined row per source; each round of sharing reads two sums.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(per.withColumn("absent", F.col("source").isNull()), ["absent", "source"], "rank")
    which = F.pmod(F.col("rank"), F.lit(len(weights)))
    weight = F.lit(weights[-1])
    for i, w in enumerate(weights[:-1]):
        weight = F.when(which == i, F.lit(w)).otherwise(weight)
    table = settle(ranked.select("source", "source_size", weight.cast("long").alias("weight")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        capped = F.lit(level) * F.col("weight") >= F.col("source_size") * cap
        taken, free, count = table.agg(
            F.sum(F.when(capped, F.col("source_size") * cap).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight"))), F.sum(F.when(capped, 1).otherwise(0))
        ).first()
        if not free or count == full:
            break
        full, level = count, (volume * total - taken) / free
    target = F.when(capped, (F.col("source_size") * cap).cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return settle(table.select("source", "source_size", target.cast("double").alias("target")))


def systematic_copies(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = WEIGHTS, volume: float = VOLUME, cap: int = CAP, keep: Sequence[str] = ()) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken, one row per row of ``docs``.

    Expected copies of a document are its source's target over its source's words. Inside a source the documents
    stand in order of size (then of a seeded hash), their expected copies are summed up, one random offset is
    added, and a document is emitted once for every whole number its interval crosses. Neighbours have nearly
    equal sizes, so the words taken differ from the target by about one longest document at most; copies are the
    expected number rounded down or up, so never above ``cap``. All sums are whole numbers, so reruns agree.

    A source with a third of all rows is summed over a third of the tasks. NULL texts and texts without a word
    have size 0. A NULL source is a source of its own. Repeated rows are sampled one by one. An empty table
    gives no row. Columns of ``docs`` are doc_id, text and source, and those named in ``keep``; others are left out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *keep)
    rows = settle(rows)
    targets = source_targets(rows, weights, volume, cap)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT + 0.5)).otherwise(F.lit(0)).cast("long")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))), 1, 6), 16, 10).cast("long")
    rated = rows.join(targets.withColumnRenamed("source", "origin"), F.col("source").eqNullSafe(F.col("origin"))).withColumn("rate", rate).withColumn("offset", offset)
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = rated.withColumn("mark", mark).withColumn("absent", F.col("source").isNull()).withColumn("origin", F.coalesce("source", F.lit("")))
    summed = running_sum(keyed, ["absent", "origin"], ["size", "mark"], "rate", "upto")
    copies = F.shiftright(F.col("upto") + F.col("offset"), 24) - F.shiftright(F.col("upto") - F.col("rate") + F.col("offset"), 24)
    return summed.select(*keep, "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the systematic sample takes it; columns as they are.

    The sample runs over narrow rows and its counts come back by doc_id and checksum. Rows equal in both share their
    copies as evenly as whole numbers allow.
    """
    key = ["_id", "_sum"]
    own = ["doc_id", "text", "source"]
    marked = packed(docs, own).withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))).withColumn("_sum", F.xxhash64("doc_id", "text"))
    taken = systematic_copies(marked, keep=key, **options).groupBy(*key).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).where("_copies > 0")
    # Both the join and the window use the key's partitioning, so texts are shuffled once.
    placed = marked.join(taken, key).withColumn("_turn", F.row_number().over(Window.partitionBy(*key).orderBy("source")))
    times = F.floor(F.col("_copies") / F.col("_rows")) + F.when(F.col("_turn") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    return placed.withColumn("_time", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*unpacked(docs.columns, own))
