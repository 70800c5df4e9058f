"""Streams over several micro-batches give what one batch gives; nothing that arrives late is lost."""

import datetime as dt

from pyspark.sql import functions as F

from gaugework.plans.settle import scratch_folder
from gaugework.streaming import incremental as inc

CELLS = "dataset string, series string, obs_date date, value double"


def stream_of(spark, folder, schema, batches):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_merge_over_batches(spark):
    home = scratch_folder(spark, "merge-test")
    batches = [[("d", "a", day(n), float(n)) for n in range(k, k + 3)] for k in (0, 3, 6, 9)] + [[("d", "b", day(4), 1.0), ("d", "a", day(5), 99.0), ("d", "a", day(-7), 5.0), ("e", "a", day(-7), 6.0)]]
    store = inc.DeltaStore(spark, f"{home}/table", CELLS)
    inc.stream_merge(stream_of(spark, f"{home}/in", CELLS, batches), store, f"{home}/state", f"{home}/late", compact_every=2).awaitTermination()
    got = {(r.dataset, r.series, r.obs_date): r.value for r in store.read().collect()}
    want = {("d", "a", day(n)): float(n) for n in range(12)} | {("d", "b", day(4)): 1.0, ("e", "a", day(-7)): 6.0}
    assert got == want
    late = spark.read.parquet(f"{home}/late").select("dataset", "series", "obs_date", "value").collect()
    assert [tuple(r) for r in late] == [("d", "a", day(-7), 5.0)]
    assert {(r.series, r.obs_date) for r in store.read(before=3).collect()} == {("a", day(n)) for n in range(6)}


def test_late_vintages_win(spark):
    home = scratch_folder(spark, "daily-test")
    schema = "series string, ts timestamp, value double, vintage int"
    at = lambda n, hour: dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=n)
    batches = [[("s", at(0, 9), 1.0, 1)], [("s", at(200, 9), 2.0, 2)], [("s", at(0, 10), 3.0, 3), ("s", at(200, 8), 4.0, 4)], [("s", at(1, 9), 5.0, 5)]]
    rows = stream_of(spark, f"{home}/in", schema, batches)
    inc.stream_daily(rows, f"{home}/days", f"{home}/state").awaitTermination()
    got = {(r.series, r.month): r.value for r in inc.monthly_from_daily(spark, f"{home}/days", F.lit("mean")).collect()}
    assert got == {("s", dt.date(2024, 1, 1)): 4.0, ("s", dt.date(2024, 7, 1)): 2.0}
