"""Skew-safe building blocks against brute force, with one key holding most of the rows."""

import random
import statistics

from pyspark.sql import functions as F

from gaugework.operators.crosssection import group_statistics, standard_scores
from gaugework.plans.components import connected
from gaugework.plans.joins import attach, asof_day, latest_per_key
from gaugework.plans.ordered import following, medians, numbered, value_positions, with_previous


def hot_rows(n=3000):
    rnd = random.Random(7)
    return [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(20)}", i, float(rnd.randrange(50)) if rnd.random() < 0.3 else rnd.random() * 50) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, id long, v double").repartition(8)


def test_numbered_matches_sort(spark):
    rows = hot_rows()
    got = {r["id"]: r["n"] for r in numbered(frame(spark, rows), ["k"], [F.desc("v"), F.col("id")], "n").collect()}
    for key in {r[0] for r in rows}:
        for place, row in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (-r[2], r[1])), 1):
            assert got[row[1]] == place


def test_numbered_without_keys(spark):
    got = sorted(r["n"] for r in numbered(frame(spark, hot_rows(500)), [], ["v", "id"], "n").collect())
    assert got == list(range(1, 501))


def test_medians_and_statistics(spark):
    rows = hot_rows()
    df = frame(spark, rows)
    got = {r["k"]: r["median"] for r in medians(value_positions(df, ["k"], "v"), ["k"], "v").collect()}
    stats = {r["k"]: r for r in group_statistics(df, ["k"], "v").select("k", "n", "median", "mad", "variance").distinct().collect()}
    for key in got:
        values = [r[2] for r in rows if r[0] == key]
        med = statistics.median(values)
        assert abs(got[key] - med) < 1e-12
        assert abs(stats[key]["mad"] - statistics.median(abs(v - med) for v in values)) < 1e-9
        assert abs(stats[key]["variance"] - statistics.pvariance(values)) < 1e-9


def test_percentiles(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])] + [("c", 10 + i, 0.0) for i in range(4)] + [("s", 20, 5.0)], "k string, id long, v double")
    got = {r["id"]: r["percentile"] for r in standard_scores(df, ["k"], "v").collect()}
    assert [got[i] for i in range(5)] == [0, 25, 50, 75, 100]
    assert {got[10 + i] for i in range(4)} == {50.0} and got[20] == 50.0


def test_previous_and_following(spark):
    rows = hot_rows(800)
    df = frame(spark, rows)
    prev = {r["id"]: r["prev_v"] for r in with_previous(df, ["k"], ["id"], ["v"]).collect()}
    ahead = {r["id"]: list(r["ahead"]) for r in following(df, ["k"], ["id"], "v", 3, block=50).collect()}
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        for i, row in enumerate(group):
            assert prev[row[1]] == (group[i - 1][2] if i else None)
            assert ahead[row[1]] == [g[2] for g in group[i + 1:i + 4]]


def test_salted_join_and_latest(spark):
    rows = hot_rows(1000)
    df = frame(spark, rows)
    sizes = df.groupBy("k").agg(F.count("*").alias("n"))
    joined = attach(df, sizes, ["k"])
    assert joined.count() == 1000 and joined.where("n IS NULL").count() == 0
    last = {r["k"]: r["id"] for r in latest_per_key(df, ["k"], ["id"]).collect()}
    assert all(last[k] == max(r[1] for r in rows if r[0] == k) for k in last)


def test_connected_groups(spark):
    rnd = random.Random(3)
    edges = [(i, f"k{rnd.randrange(150)}") for i in range(200)] + [(i, f"c{i // 2}") for i in range(200, 260)] + [(i, f"d{(i + 1) // 2}") for i in range(200, 260)] + [(i, "hot") for i in range(300, 400)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    first = {}
    for row, key in edges:
        a, b = find(row), find(first.setdefault(key, row))
        parent[max(a, b)] = min(a, b)
    got = {r["id"]: r["root"] for r in connected(spark.createDataFrame(edges, "id long, key string"), "id", "key").collect()}
    assert got == {row: find(row) for row, _ in edges}


def test_asof(spark):
    left = spark.createDataFrame([("a", "2024-01-10"), ("a", "2024-03-01"), ("b", "2024-01-10")], "k string, d string").select("k", F.to_date("d").alias("d"))
    right = spark.createDataFrame([("a", "2024-01-05", 1.0), ("a", "2024-01-10", 2.0), ("b", "2024-01-11", 3.0)], "k string, q string, p double").select("k", F.to_date("q").alias("q"), "p")
    got = {(r["k"], str(r["d"])): r["p"] for r in asof_day(left, right, ["k"], "d", "q", ["p"], 21).collect()}
    assert got == {("a", "2024-01-10"): 2.0, ("a", "2024-03-01"): None, ("b", "2024-01-10"): None}


def test_attach_does_not_broadcast_a_compressed_lookup_in_copies(spark, tmp_path, capsys):
    # A file far below the broadcast threshold whose 16 copies of 900,000 rows would have gone to the driver.
    folder = f"{tmp_path}/lookup"
    spark.range(900_000).select(F.col("id").alias("k"), F.lit("T").alias("t")).coalesce(1).write.parquet(folder)
    lookup, df = spark.read.parquet(folder), spark.range(3_000_000).select(F.col("id").alias("k"), F.lit(1).alias("one"))
    joined = attach(df, lookup, ["k"], how="inner")
    joined.explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out
    assert joined.count() == 900_000 and joined.columns == ["k", "one", "t"]
