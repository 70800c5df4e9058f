"""Hand-computed scores, gaps, no look-ahead, and invariance under repartitioning."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gaugework.operators import timeseries as ts

START = dt.date(2024, 1, 1)


def pairs(spark, x, y):
    rows = [("a~b", START + dt.timedelta(days=i), None if u is None else float(u), None if v is None else float(v)) for i, (u, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "pair_id string, obs_date date, xv double, yv double")


def column(df, name):
    return [r[name] for r in df.orderBy("obs_date").collect()]


def test_correlation_of_prior_values(spark):
    got = column(ts.pair_correlation(pairs(spark, [1, 2, 3, 100], [1, 3, 2, -100]), 3), "fisher")
    assert got[:3] == [None] * 3 and got[3] == pytest.approx(0.5 * math.log(3))


@pytest.mark.parametrize("x,y", [([1, 2, 3, 4], [2, 4, 6, 8]), ([1, 1, 1, 1], [1, 2, 3, 4])])
def test_perfect_or_constant_pairs_have_no_score(spark, x, y):
    assert column(ts.pair_correlation(pairs(spark, x, y), 3), "fisher") == [None] * 4


def test_spread_z(spark):
    assert column(ts.pair_spread(pairs(spark, [1, 2, 3, 5], [0, 0, 0, 0]), 3), "spread_z")[-1] == pytest.approx(3)


def test_gap_uses_last_valid_values(spark):
    got = column(ts.pair_spread(pairs(spark, [1, 2, None, 4, 5, 6, 7], [0] * 7), 3), "spread_z")
    assert got[:4] == [None] * 4
    assert got[4] == pytest.approx((5 - 7 / 3) / math.sqrt(7 / 3)) and got[-1] == pytest.approx(2)


def test_momentum(spark):
    p = pairs(spark, [i * i for i in range(7)], [0] * 7).withColumn("v", F.col("xv"))
    out = ts.momentum(p, ["pair_id"], "v", 3, 3)
    assert column(out, "change") == [None] * 3 + [9, 15, 21, 27]
    assert column(out, "momentum_z")[-1] == pytest.approx(2)


def test_future_never_changes_the_past(spark):
    base = [float(i * i) for i in range(12)]
    bent = base[:6] + [base[6] + 60] + [999.0] * 5
    run = lambda v: column(ts.momentum(pairs(spark, v, [0] * 12).withColumn("v", F.col("xv")), ["pair_id"], "v", 3, 3), "momentum_z")
    one, two = run(base), run(bent)
    assert one[:6] == two[:6] and two[6] == pytest.approx(12)


def test_second_opinion_and_lineage_agree(spark):
    p = pairs(spark, [math.sin(i * 1.7) + i % 3 for i in range(40)], [math.cos(i * 0.9) for i in range(40)])
    assert ts.second_opinion(p, 5).count() == 0
    assert ts.stale_lineage(ts.pair_correlation(p, 5), p, 5).count() == 0


def test_repartitioning_changes_nothing(spark):
    p = pairs(spark, [math.sin(i * 1.7) for i in range(40)], [math.cos(i * 0.9) for i in range(40)])
    a = column(ts.pair_spread(p, 6), "spread_z")
    assert a == column(ts.pair_spread(p.orderBy(F.rand(3)).repartition(7), 6), "spread_z")


def test_forward_outcome(spark):
    days = [START + dt.timedelta(days=i) for i in range(400)]
    prices = spark.createDataFrame([("A", d, 100.0 + i) for i, d in enumerate(days)], "ticker string, session_date date, close double")
    bench = spark.createDataFrame([(d, 100 + i / 2) for i, d in enumerate(days)], "session_date date, close double")
    cut = spark.createDataFrame([("o", "A", START), ("n", "Z", START)], "observation_id string, ticker string, cutoff date")
    got = {r["observation_id"]: r for r in ts.forward_outcome(cut, prices, bench, 21).collect()}
    assert got["o"]["execution_date"] == dt.date(2024, 1, 2) and got["o"]["forward_return"] == pytest.approx(121 / 101 - 1)
    assert got["n"]["status"] in (None, "UNAVAILABLE")
