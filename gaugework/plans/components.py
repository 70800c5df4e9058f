"""Connected groups of rows that share keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.plans.joins import look_up
from gaugework.plans.settle import settle


def connected(links: DataFrame, row: str, key: str) -> DataFrame:
    """Smallest row id of each row's connected group; ``links`` holds one (row, key) per shared key.

    Labels travel row -> key -> row by two partial aggregations per round, so a key shared by a third of
    all rows costs one combined minimum, never its pairs. Each round is checkpointed; the loop ends when
    no label changed; chains halve, so rounds are logarithmic.
    """
    edges = settle(links.select(row, key).where(F.col(key).isNotNull()).distinct())
    labels = edges.select(row).distinct().withColumn("root", F.col(row))
    while True:
        by_key = look_up(edges, labels, [row]).groupBy(key).agg(F.min("root").alias("root"))
        better = look_up(edges, by_key, [key]).groupBy(row).agg(F.min("root").alias("better"))
        seen = settle(labels.join(better, row))
        # The old root learns what its members saw, then every row jumps to its root's root: long chains halve per round.
        hooked = seen.groupBy("root").agg(F.min("better").alias("hook")).withColumnRenamed("root", row)
        stepped = seen.join(hooked, row, "left").select(row, F.col("root").alias("old"), F.least("root", "better", "hook").alias("root"))
        parents = stepped.select(F.col(row).alias("root"), F.col("root").alias("parent"))
        moved = settle(look_up(stepped, parents, ["root"]).select(row, F.least("root", "parent").alias("root"), (F.least("root", "parent") < F.col("old")).alias("_moved")))
        labels = moved.drop("_moved")
        if moved.where("_moved").limit(1).count() == 0:
            return labels
