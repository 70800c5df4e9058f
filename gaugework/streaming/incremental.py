"""Incremental loads: fill-and-append, history protection, journals, and their streaming forms."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugework.functions.numbers import equal_within
from gaugework.operators.quality import change_counts, compare_cells
from gaugework.plans.settle import settle


def plan_merge(stored: DataFrame, incoming: DataFrame, skip_late: bool = False) -> DataFrame:
    """Decide every cell of (dataset, series, obs_date): kept, filled, appended, or late.

    Populated cells never change, blank ones fill, only dates newer than the newest stored date of
    the dataset append; an unseen older date is ``late`` (an error row, or skipped on request).
    """
    keys = ["dataset", "series", "obs_date"]
    newest = stored.groupBy("dataset").agg(F.max("obs_date").alias("_newest"))
    known = stored.select("dataset", "obs_date").distinct().withColumn("_known", F.lit(True))
    old = stored.select(*keys, F.col("value").alias("_old"), F.lit(True).alias("_cell"))
    new = incoming.select(*keys, F.col("value").alias("_new"))
    both = old.join(new, keys, "full").join(known, ["dataset", "obs_date"], "left").join(newest, "dataset", "left")
    fills = F.col("_old").isNull() & F.col("_new").isNotNull()
    action = (
        F.when(F.col("_known") & ~fills, "kept")
        .when(F.col("_known"), "filled")
        .when(F.col("_newest").isNull() | (F.col("obs_date") > F.col("_newest")), "appended")
        .otherwise("late")
    )
    planned = both.select(*keys, F.coalesce("_old", "_new").alias("value"), action.alias("action"))
    return planned.where(F.col("action") != "late") if skip_late else planned


def merged_table(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("action") != "late").drop("action")


def late_dates(plan: DataFrame) -> DataFrame:
    """Missing historical dates: must be empty before a merge is published."""
    return plan.where(F.col("action") == "late").select("dataset", "obs_date").distinct()


def history_violations(
    stored: DataFrame,
    incoming: DataFrame,
    allow_absent: bool = False,
    allow_blank: bool = False,
    allow_revision: bool = False,
    mutable_months: DataFrame | None = None,
) -> DataFrame:
    """Populated stored cells the replacement would change without permission."""
    keys = ["dataset", "series", "obs_date"]
    dates = incoming.select("dataset", "obs_date").distinct().withColumn("_there", F.lit(True))
    cells = stored.where(F.col("value").isNotNull()).select(*keys, F.col("value").alias("existing"))
    if mutable_months is not None:
        cells = cells.withColumn("month", F.trunc("obs_date", "MM")).join(mutable_months.select("month").distinct(), "month", "left_anti").drop("month")
    both = cells.join(incoming.select(*keys, F.col("value").alias("replacement")), keys, "left").join(dates, ["dataset", "obs_date"], "left")
    new = F.col("replacement")
    allowed = (
        (F.lit(allow_absent) & F.col("_there").isNull())
        | (F.lit(allow_blank) & new.isNull())
        | (F.lit(allow_revision) & new.isNotNull())
        | (new.isNotNull() & equal_within(F.col("existing"), new))
    )
    return both.where(~F.coalesce(allowed, F.lit(False))).select(*keys, "existing", "replacement")


def merge_components(stored: DataFrame, components: Sequence[DataFrame]) -> DataFrame:
    """Shared append-only table fed by several components (each: dataset, series, obs_date, value); late months skipped."""
    incoming = components[0]
    for part in components[1:]:
        incoming = incoming.unionByName(part)
    return plan_merge(stored, incoming, skip_late=True)


def journal(output: str, old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Change counts of one output table."""
    changes = compare_cells(old, new, keys, columns).withColumn("output", F.lit(output))
    return change_counts(changes, ["output"])


class DeltaStore:
    """Cells (dataset, series, obs_date, value) kept as one folder of changed cells per version, with full copies now and then.

    A replayed batch rewrites its own version only. A cell's value is that of its newest version.
    """

    KEYS = ("dataset", "series", "obs_date")

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder, schema

    def _load(self, kind: str, before: int | None) -> DataFrame:
        try:
            rows = self.spark.read.parquet(f"{self.folder}/{kind}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # an unreadable store must not look new
                raise
            rows = self.spark.createDataFrame([], f"{self.schema}, version int")
        return rows if before is None else rows.where(F.col("version") < before)

    def read(self, before: int | None = None) -> DataFrame:
        """All cells, or those of the versions strictly below ``before``: the newest full copy and the later changes."""
        full = self._load("full", before)
        newest = full.agg(F.max("version")).first()[0]
        rows = self._load("changes", before)
        if newest is not None:
            rows = rows.where(F.col("version") > newest).unionByName(full.where(F.col("version") == newest))
        return rows.groupBy(*self.KEYS).agg(F.max_by("value", "version").alias("value"))

    def write(self, changes: DataFrame, version: int) -> None:
        changes.select(*self.KEYS, "value").write.mode("overwrite").parquet(f"{self.folder}/changes/version={version}")

    def compact(self, version: int) -> None:
        """Write all cells up to ``version`` as a full copy; older folders are then no longer read."""
        self.read(version + 1).write.mode("overwrite").parquet(f"{self.folder}/full/version={version}")


def stream_merge(stream: DataFrame, store: DeltaStore, checkpoint: str, late_folder: str, compact_every: int = 20) -> StreamingQuery:
    """Run :func:`plan_merge` per micro-batch; filled and appended cells go to the store, late dates to an error table.

    ``late_folder`` receives every cell of a missing historical date (dataset, series, obs_date, value), one
    folder per batch, so no row of any batch vanishes whatever the order of arrival.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        per_cell = batch.groupBy("dataset", "series", "obs_date").agg(F.max("value").alias("value"))
        plan = settle(plan_merge(store.read(before=batch_id + 1), per_cell))
        plan.where(F.col("action") == "late").drop("action").write.mode("overwrite").parquet(f"{late_folder}/batch={batch_id}")
        store.write(plan.where(F.col("action").isin("filled", "appended")), batch_id + 1)
        if (batch_id + 1) % compact_every == 0:
            store.compact(batch_id + 1)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest_per_day(rows: DataFrame) -> DataFrame:
    """Newest vintage per (series, day) of ``rows`` (series, ts, value, vintage)."""
    newest = F.struct("ts", "vintage")
    return rows.groupBy("series", F.to_date("ts").alias("obs_date")).agg(F.max_by("value", newest).alias("value"), F.max(newest).alias("seen"))


def stream_daily(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's newest vintage per (series, day) to its own folder (rewritten on replay).

    Nothing is kept in stream state: vintages carry their own order, so one that arrives any number of days late still
    wins or loses against the stored ones when the days are read.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        newest_per_day(batch).write.mode("overwrite").parquet(f"{folder}/part={batch_id}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def monthly_from_daily(spark: SparkSession, folder: str, method: Column | None = None) -> DataFrame:
    """Monthly latest (or mean where ``method`` says so) from the streamed days."""
    days = spark.read.parquet(folder).groupBy("series", "obs_date").agg(F.max_by("value", "seen").alias("value"))
    how = method if method is not None else F.lit("latest")
    return days.withColumn("_m", how).groupBy("series", F.trunc("obs_date", "MM").alias("month")).agg(
        F.when(F.max("_m") == "mean", F.avg("value")).otherwise(F.max_by("value", "obs_date")).alias("value")
    )
