"""Pair scores, monthly selection and price windows over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.catalog.registry import query, table
from gaugework.operators import timeseries as ts
from gaugework.plans.joins import asof_day
from gaugework.plans.settle import settle

WINDOW, LOOKBACK = 24, 3


def daily_segment_series(spark, folder):
    """Mean order value per market segment and day; days without an order are true gaps."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("obs_date"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("series"))
    # The raw tables are scanned once; the day-level result feeds names, dates and both pair sides.
    return settle(orders.join(customers, "o_custkey").groupBy("series", "obs_date").agg(F.avg("o_totalprice").alias("value")))


def wide_daily_series(spark, folder):
    """38 daily series (nations, segments, priorities, statuses): 703 pairs."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("obs_date"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    tagged = orders.join(customers, "o_custkey").select(
        "obs_date", "o_totalprice",
        F.explode(F.array(
            F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")),
            F.concat(F.lit("segment "), F.col("c_mktsegment")),
            F.concat(F.lit("priority "), F.col("o_orderpriority")),
            F.concat(F.lit("status "), F.col("o_orderstatus")),
        )).alias("series"),
    )
    return settle(tagged.groupBy("series", "obs_date").agg(F.avg("o_totalprice").alias("value")))


def segment_pairs(spark, folder):
    series = daily_segment_series(spark, folder)
    return ts.pair_values(series, ts.pair_names(series))


def _round(df, *names):
    return df.select([F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns]).withColumns(
        {c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"}
    )


SERIES = """
series AS (
  SELECT c_mktsegment AS series, CAST(o_orderdate AS DATE) AS obs_date, avg(o_totalprice) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
names AS (SELECT DISTINCT series FROM series),
pairs AS (SELECT a.series || '~' || b.series AS pair_id, a.series AS x, b.series AS y FROM names a JOIN names b ON a.series < b.series),
pv AS (
  SELECT p.pair_id, d.obs_date, sx.value AS xv, sy.value AS yv
  FROM pairs p CROSS JOIN (SELECT DISTINCT obs_date FROM series) d
  LEFT JOIN series sx ON sx.series = p.x AND sx.obs_date = d.obs_date
  LEFT JOIN series sy ON sy.series = p.y AND sy.obs_date = d.obs_date),
ok AS (SELECT *, xv - yv AS spread FROM pv WHERE xv IS NOT NULL AND yv IS NOT NULL)"""

FISHER = f"""
raw AS (
  SELECT pair_id, obs_date, count(*) OVER w AS n, covar_samp(xv, yv) OVER w AS cxy, stddev_samp(xv) OVER w AS sx, stddev_samp(yv) OVER w AS sy
  FROM ok WINDOW w AS (PARTITION BY pair_id ORDER BY obs_date ROWS BETWEEN {WINDOW} PRECEDING AND 1 PRECEDING)),
rr AS (SELECT pair_id, obs_date, CASE WHEN n = {WINDOW} AND sx > 0 AND sy > 0 THEN cxy / (sx * sy) END AS r FROM raw),
fisher AS (SELECT pair_id, obs_date, CASE WHEN abs(r) < 1 - 1e-14 THEN atanh(r) END AS fisher FROM rr)"""


def z_sql(source: str, value: str, out: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT pair_id, obs_date, CASE WHEN n = {WINDOW} AND s > 0 THEN ({value} - m) / s END AS {out} FROM (
    SELECT pair_id, obs_date, {value}, count(*) OVER w AS n, avg({value}) OVER w AS m, stddev_samp({value}) OVER w AS s
    FROM {source} WHERE {value} IS NOT NULL
    WINDOW w AS (PARTITION BY pair_id ORDER BY obs_date ROWS BETWEEN {WINDOW} PRECEDING AND 1 PRECEDING)))"""


def change_sql(source: str, value: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT pair_id, obs_date, {value} - lag({value}, {LOOKBACK}) OVER (PARTITION BY pair_id ORDER BY obs_date) AS change
  FROM {source} WHERE {value} IS NOT NULL)"""


@query("series_pair_definitions", f"WITH {SERIES} SELECT pair_id, x, y FROM pairs")
def _(spark, folder):
    return ts.pair_names(daily_segment_series(spark, folder))


@query(
    "pair_definition_errors",
    """WITH names AS (SELECT DISTINCT c_mktsegment AS series FROM customer),
    defs AS (SELECT DISTINCT c_mktsegment AS x, o_orderpriority AS y FROM orders JOIN customer ON o_custkey = c_custkey
      UNION SELECT DISTINCT c_mktsegment, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END FROM customer)
    SELECT x, y, CASE WHEN x = '' AND y = '' THEN 'empty pair' WHEN x = '' OR y = '' THEN 'missing pair side'
      WHEN x NOT IN (SELECT series FROM names) OR y NOT IN (SELECT series FROM names) THEN 'unknown indicator' END AS error FROM defs""",
)
def _(spark, folder):
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders")
    series = customers.select(F.col("c_mktsegment").alias("series"))
    used = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("x"), F.col("o_orderpriority").alias("y"))
    own = customers.select(F.col("c_mktsegment").alias("x"), F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("y"))
    return ts.check_pairs(used.distinct().union(own).distinct(), series)


@query(
    "prior_value_windows",
    f"""WITH {SERIES}, fin AS (SELECT series, obs_date, value FROM series),
    grid AS (SELECT n.series, d.obs_date, f.value FROM names n CROSS JOIN (SELECT DISTINCT obs_date FROM series) d LEFT JOIN fin f USING (series, obs_date)),
    num AS (SELECT *, count(value) OVER (PARTITION BY series ORDER BY obs_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_n FROM grid),
    pos AS (SELECT series, value, row_number() OVER (PARTITION BY series ORDER BY obs_date) AS k FROM fin)
    SELECT n.series, CAST(n.obs_date AS VARCHAR) AS obs_date, round(sum(p.value), 4) AS history_sum, round(min(p.value), 4) AS history_min
    FROM num n LEFT JOIN pos p ON p.series = n.series AND n.prior_n >= {WINDOW} AND p.k BETWEEN n.prior_n - {WINDOW} + 1 AND n.prior_n
    GROUP BY 1, 2""",
)
def _(spark, folder):
    series = daily_segment_series(spark, folder)
    grid = series.select("series").distinct().crossJoin(series.select("obs_date").distinct())
    held = ts.prior_windows(grid.join(series, ["series", "obs_date"], "left"), ["series"], "value", WINDOW)
    return held.select(
        "series", F.col("obs_date").cast("string").alias("obs_date"),
        F.round(F.aggregate("history", F.lit(0.0), lambda a, v: a + v), 4).alias("history_sum"),
        F.round(F.array_min("history"), 4).alias("history_min"),
    )


@query(
    "pair_correlation_fisher",
    f"WITH {SERIES}, {FISHER} SELECT pv.pair_id, CAST(pv.obs_date AS VARCHAR) AS obs_date, round(fisher, 6) AS fisher FROM pv LEFT JOIN fisher USING (pair_id, obs_date)",
)
def _(spark, folder):
    return _round(ts.pair_correlation(segment_pairs(spark, folder), WINDOW).select("pair_id", "obs_date", "fisher"), "fisher")


@query(
    "pair_spread_zscore",
    f"""WITH {SERIES}, {z_sql('ok', 'spread', 'spread_z', 'zz')}
    SELECT pv.pair_id, CAST(pv.obs_date AS VARCHAR) AS obs_date, round(xv - yv, 6) AS spread, round(spread_z, 6) AS spread_z FROM pv LEFT JOIN zz USING (pair_id, obs_date)""",
)
def pair_spread_zscore(spark, folder):
    return _round(ts.pair_spread(segment_pairs(spark, folder), WINDOW).select("pair_id", "obs_date", "spread", "spread_z"), "spread", "spread_z")


@query(
    "observation_change",
    f"""WITH {SERIES}, {change_sql('ok', 'spread', 'ch')}
    SELECT pv.pair_id, CAST(pv.obs_date AS VARCHAR) AS obs_date, round(change, 6) AS change FROM pv LEFT JOIN ch USING (pair_id, obs_date)""",
)
def _(spark, folder):
    spread = segment_pairs(spark, folder).withColumn("spread", F.col("xv") - F.col("yv"))
    return _round(ts.observation_change(spread, ["pair_id"], "spread", LOOKBACK).select("pair_id", "obs_date", "change"), "change")


@query(
    "spread_momentum_zscore",
    f"""WITH {SERIES}, {change_sql('ok', 'spread', 'ch')}, {z_sql('ch', 'change', 'momentum_z', 'zz')}
    SELECT pv.pair_id, CAST(pv.obs_date AS VARCHAR) AS obs_date, round(momentum_z, 6) AS momentum_z FROM pv LEFT JOIN zz USING (pair_id, obs_date)""",
)
def _(spark, folder):
    spread = segment_pairs(spark, folder).withColumn("spread", F.col("xv") - F.col("yv"))
    return _round(ts.momentum(spread, ["pair_id"], "spread", LOOKBACK, WINDOW).select("pair_id", "obs_date", "momentum_z"), "momentum_z")


UPDATES = """
upd AS (
  SELECT pair_id, obs_date, n > coalesce(lag(n) OVER (PARTITION BY pair_id ORDER BY obs_date), 0) AS is_update, last_paired FROM (
    SELECT g.pair_id, g.obs_date, sum(CASE WHEN xv IS NOT NULL AND yv IS NOT NULL THEN 1 ELSE 0 END) OVER w AS n,
      max(CASE WHEN xv IS NOT NULL AND yv IS NOT NULL THEN obs_date END) OVER w AS last_paired, dayofweek(obs_date) IN (0, 6) AS weekend
    FROM pv g WINDOW w AS (PARTITION BY pair_id ORDER BY obs_date)) WHERE NOT weekend)"""


@query(
    "paired_update_clock",
    f"WITH {SERIES}, {UPDATES} SELECT pair_id, CAST(obs_date AS VARCHAR) AS obs_date, is_update, CAST(last_paired AS VARCHAR) AS last_paired_date FROM upd",
)
def _(spark, folder):
    pairs = segment_pairs(spark, folder)
    outputs = pairs.select("pair_id", "obs_date").where(~F.dayofweek("obs_date").isin(1, 7))
    return _round(ts.update_clock(outputs, pairs))


@query(
    "fisher_momentum_zscore",
    f"""WITH {SERIES}, {FISHER}, {UPDATES}, ev AS (SELECT u.pair_id, u.obs_date, fisher FROM upd u JOIN fisher f USING (pair_id, obs_date) WHERE is_update),
    {change_sql('ev', 'fisher', 'ch')}, {z_sql('ch', 'change', 'fisher_momentum_z', 'zz')}
    SELECT u.pair_id, CAST(u.obs_date AS VARCHAR) AS obs_date, round(fisher_momentum_z, 5) AS fisher_momentum_z FROM upd u LEFT JOIN zz USING (pair_id, obs_date)""",
)
def _(spark, folder):
    pairs = segment_pairs(spark, folder)
    scores = ts.pair_correlation(pairs, WINDOW).select("pair_id", "obs_date", "fisher").where(~F.dayofweek("obs_date").isin(1, 7))
    scored = ts.fisher_momentum(scores, pairs, LOOKBACK, WINDOW)
    return scored.select("pair_id", F.col("obs_date").cast("string").alias("obs_date"), F.round("fisher_momentum_z", 5).alias("fisher_momentum_z"))


@query(
    "all_pair_scores",
    f"""WITH {SERIES}, {FISHER}, {z_sql('ok', 'spread', 'spread_z', 'z1')}, {change_sql('ok', 'spread', 'c1')}, {z_sql('c1', 'change', 'spread_momentum_z', 'z2')},
    {change_sql('fisher', 'fisher', 'c2')}, {z_sql('c2', 'change', 'fisher_momentum_z', 'z3')}
    SELECT pair_id, count(*) AS cells, count(spread_z) AS spread_cells, count(fisher) AS fisher_cells, count(spread_momentum_z) AS spread_momentum_cells,
      count(fisher_momentum_z) AS fisher_momentum_cells, round(sum(spread_z), 4) AS spread_sum, round(sum(fisher), 4) AS fisher_sum,
      round(sum(spread_momentum_z), 4) AS spread_momentum_sum, round(sum(fisher_momentum_z), 4) AS fisher_momentum_sum
    FROM pv LEFT JOIN fisher USING (pair_id, obs_date) LEFT JOIN z1 USING (pair_id, obs_date) LEFT JOIN z2 USING (pair_id, obs_date) LEFT JOIN z3 USING (pair_id, obs_date)
    GROUP BY pair_id""",
)
def _(spark, folder):
    series = daily_segment_series(spark, folder)
    return score_totals(ts.pair_scores(series, ts.pair_names(series), WINDOW, LOOKBACK))


def score_totals(scores):
    names = {"spread": "spread_z", "fisher": "fisher", "spread_momentum": "spread_momentum_z", "fisher_momentum": "fisher_momentum_z"}
    return scores.groupBy("pair_id").agg(
        F.count("*").alias("cells"),
        *[F.count(c).alias(f"{n}_cells") for n, c in names.items()],
        *[F.round(F.sum(c), 4).alias(f"{n}_sum") for n, c in names.items()],
    )


@query(
    "pair_run_report",
    f"""WITH {SERIES}, {change_sql('ok', 'spread', 'ch')}, {z_sql('ch', 'change', 'mz', 'zz')},
    v AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY obs_date DESC) AS k FROM zz WHERE mz IS NOT NULL),
    f AS (SELECT pair_id, count(*) AS c, min(obs_date) AS a, max(obs_date) AS b, max(CASE WHEN k = {LOOKBACK} + 1 THEN obs_date END) AS l FROM v GROUP BY 1),
    e AS (SELECT pair_id, max(obs_date) AS g FROM pv GROUP BY 1)
    SELECT pair_id, coalesce(c, 0) AS update_count, CAST(a AS VARCHAR) AS first_date, CAST(b AS VARCHAR) AS last_date, CAST(l AS VARCHAR) AS lag_date,
      CASE WHEN b IS NULL THEN 'No finite momentum history' WHEN b = g THEN 'OK' ELSE 'No current momentum score' END AS status
    FROM e LEFT JOIN f USING (pair_id)""",
)
def _(spark, folder):
    spread = segment_pairs(spark, folder).withColumn("spread", F.col("xv") - F.col("yv"))
    scored = ts.momentum(spread, ["pair_id"], "spread", LOOKBACK, WINDOW)
    return _round(ts.run_report(scored, "momentum_z", LOOKBACK))


@query(
    "pair_score_trace",
    f"""WITH {SERIES}, t AS (
      SELECT pair_id, obs_date, count(*) OVER w AS n, first_value(obs_date) OVER w AS wf, last_value(obs_date) OVER w AS wl, avg(spread) OVER w AS m,
        stddev_samp(spread) OVER w AS s, covar_samp(xv, yv) OVER w AS c
      FROM ok WINDOW w AS (PARTITION BY pair_id ORDER BY obs_date ROWS BETWEEN {WINDOW} PRECEDING AND 1 PRECEDING))
    SELECT pv.pair_id, CAST(pv.obs_date AS VARCHAR) AS obs_date, CAST(wf AS VARCHAR) AS window_first, CAST(wl AS VARCHAR) AS window_last,
      round(m, 4) AS spread_mean, round(s, 4) AS spread_std, round(c / 1e6, 4) AS covariance_mil,
      CASE WHEN n IS NULL THEN 'CURRENT PAIR MISSING' WHEN n < {WINDOW} THEN 'INSUFFICIENT HISTORY' WHEN coalesce(s, 0) <= 0 THEN 'ZERO VARIANCE' ELSE 'SCORED' END AS status
    FROM pv LEFT JOIN t USING (pair_id, obs_date)""",
)
def _(spark, folder):
    t = ts.score_trace(segment_pairs(spark, folder), WINDOW)
    scored = F.col("status") != "CURRENT PAIR MISSING"
    return t.select(
        "pair_id", F.col("obs_date").cast("string").alias("obs_date"),
        F.when(scored, F.col("window_first")).cast("string").alias("window_first"),
        F.when(scored, F.col("window_last")).cast("string").alias("window_last"),
        F.when(scored, F.round("spread_mean", 4)).alias("spread_mean"),
        F.when(scored, F.round("spread_std", 4)).alias("spread_std"),
        F.when(scored, F.round(F.col("covariance") / 1e6, 4)).alias("covariance_mil"),
        "status",
    )


@query(
    "score_matrix_comparison",
    f"""WITH {SERIES}, {z_sql('ok', 'spread', 'z', 'zz')}, o AS (SELECT pair_id, obs_date, z FROM zz WHERE obs_date < DATE '2001-01-01'),
    c AS (SELECT a.z AS o, b.z AS n, coalesce(a.obs_date, b.obs_date) AS d FROM o a FULL JOIN zz b ON a.pair_id = b.pair_id AND a.obs_date = b.obs_date),
    l AS (SELECT max(obs_date) AS m FROM o WHERE z IS NOT NULL)
    SELECT count(o) AS existing_numeric, count(n) AS new_numeric, count(CASE WHEN o IS NOT NULL AND n IS NOT NULL THEN 1 END) AS compared_numeric,
      count(CASE WHEN abs(n - o) > 1e-10 + 1e-9 * abs(o) THEN 1 END) AS numeric_mismatches,
      count(CASE WHEN (o IS NULL) <> (n IS NULL) THEN 1 END) AS blank_mismatches, count(CASE WHEN o IS NULL AND n IS NOT NULL THEN 1 END) AS added_numeric,
      count(CASE WHEN o IS NOT NULL AND n IS NULL THEN 1 END) AS removed_numeric,
      count(CASE WHEN o IS NULL AND n IS NOT NULL AND d > m THEN 1 END) AS new_tail_numeric,
      count(CASE WHEN (o IS NULL) <> (n IS NULL) AND NOT (o IS NULL AND n IS NOT NULL AND d > m) THEN 1 END) AS historical_blank_mismatches,
      round(max(abs(o - n)), 6) AS max_absolute_difference
    FROM c CROSS JOIN l""",
)
def _(spark, folder):
    z = ts.pair_spread(segment_pairs(spark, folder), WINDOW).where(F.col("spread").isNotNull())
    old = z.where(F.col("obs_date") < F.lit("2001-01-01").cast("date"))
    out = ts.matrix_comparison(old, z, ["pair_id"], "spread_z")
    return out.withColumn("max_absolute_difference", F.round("max_absolute_difference", 6))


@query(
    "score_second_opinion",
    f"""WITH {SERIES}, {FISHER} SELECT pair_id, count(*) AS cells, count(fisher) AS scored, CAST(0 AS BIGINT) AS disagreements
    FROM pv LEFT JOIN fisher USING (pair_id, obs_date) GROUP BY 1""",
)
def _(spark, folder):
    pairs = segment_pairs(spark, folder)
    wrong = ts.second_opinion(pairs, WINDOW).groupBy("pair_id").agg(F.count("*").alias("_wrong"))
    cells = ts.pair_correlation(pairs, WINDOW).groupBy("pair_id").agg(F.count("*").alias("cells"), F.count("fisher").alias("scored"))
    return cells.join(wrong, "pair_id", "left").select("pair_id", "cells", "scored", F.coalesce("_wrong", F.lit(0)).alias("disagreements"))


@query(
    "stale_fisher_lineage",
    f"""WITH {SERIES}, {FISHER} SELECT pair_id, CAST(obs_date AS VARCHAR) AS obs_date, round(fisher + 0.001, 6) AS stored, round(fisher, 6) AS expected
    FROM fisher WHERE fisher IS NOT NULL AND year(obs_date) = 1999""",
)
def _(spark, folder):
    pairs = segment_pairs(spark, folder)
    stored = ts.pair_correlation(pairs, WINDOW).withColumn("fisher", F.when(F.year("obs_date") == 1999, F.col("fisher") + 0.001).otherwise(F.col("fisher")))
    return _round(ts.stale_lineage(stored, pairs, WINDOW), "stored", "expected")


@query(
    "results_on_output_grid",
    f"""WITH {SERIES}, {z_sql('ok', 'spread', 'z', 'zz')}, g AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS obs_date FROM lineitem)
    SELECT p.pair_id, CAST(g.obs_date AS VARCHAR) AS obs_date, round(z, 6) AS spread_z FROM pairs p CROSS JOIN g LEFT JOIN zz ON zz.pair_id = p.pair_id AND zz.obs_date = g.obs_date""",
)
def _(spark, folder):
    z = ts.pair_spread(segment_pairs(spark, folder), WINDOW)
    grid = table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("obs_date"))
    return _round(ts.on_output_grid(z, grid).select("pair_id", "obs_date", "spread_z"), "spread_z")


@query(
    "dates_missing_from_grid",
    """SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS obs_date FROM orders
    WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""",
)
def _(spark, folder):
    grid = table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("obs_date"))
    return _round(ts.dates_missing_from_grid(table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("obs_date")), grid))


# --- vintaged records: one order is one vintage of its day --------------------------------------

RECORDS = """
rec AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS observation_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS release_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 50 AS INTEGER) AS realtime_start,
  ln(o_totalprice) AS value, CASE WHEN o_orderpriority LIKE '1%' THEN 'mean' ELSE 'latest' END AS method, o_orderkey FROM orders),
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series, observation_date ORDER BY release_date DESC, realtime_start DESC, value DESC) AS k FROM rec) WHERE k = 1)"""


def order_records(spark, folder):
    day = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("series"),
        day.alias("observation_date"),
        F.date_add(day, (F.col("o_orderkey") % 40).cast("int")).alias("release_date"),
        F.date_add(day, (F.col("o_orderkey") % 50).cast("int")).alias("realtime_start"),
        F.ln("o_totalprice").alias("value"),
        F.when(F.col("o_orderpriority").startswith("1"), "mean").otherwise("latest").alias("monthly_aggregation"),
        F.lit(None).cast("date").alias("selection_date"),
        F.lit(False).alias("period_aligned"),
    )


def unique_records(spark, folder):
    """One record per (series, observation, release): a vintage can appear only once."""
    return order_records(spark, folder).groupBy("series", "observation_date", "release_date").agg(
        F.max("realtime_start").alias("realtime_start"), F.max("value").alias("value"),
        F.first("monthly_aggregation").alias("monthly_aggregation"), F.first("selection_date").alias("selection_date"), F.first("period_aligned").alias("period_aligned"),
    )


UNIQUE = """
u AS (SELECT series, observation_date, release_date, max(realtime_start) AS realtime_start, max(value) AS value, min(method) AS method FROM rec GROUP BY 1, 2, 3),
day AS (SELECT series, observation_date, arg_max(value, release_date) AS value, arg_max(release_date, release_date) AS release_date, min(method) AS method FROM u GROUP BY 1, 2)"""


@query(
    "monthly_series_values",
    f"""WITH {RECORDS}, {UNIQUE} SELECT series, CAST(date_trunc('month', observation_date) AS DATE)::VARCHAR AS month, min(method) AS method, false AS method_conflict,
    round(CASE WHEN min(method) = 'mean' THEN avg(value) ELSE arg_max(value, observation_date) END, 6) AS value FROM day GROUP BY 1, 2""",
)
def _(spark, folder):
    return _round(ts.monthly_values(unique_records(spark, folder)), "value")


@query(
    "month_end_selection",
    f"""WITH {RECORDS}, {UNIQUE} SELECT series, CAST(row_date AS VARCHAR) AS row_date, count(*) AS records, min(method) AS method, CAST(max(observation_date) AS VARCHAR) AS observation_date,
      CAST(max(release_date) AS VARCHAR) AS release_date,
      round(CASE WHEN min(method) = 'mean' AND count(*) > 1 THEN avg(value) ELSE arg_max(value, strftime(observation_date, '%Y%m%d') || strftime(release_date, '%Y%m%d')) END, 6) AS value
    FROM (SELECT *, last_day(release_date) AS row_date FROM u) WHERE observation_date <= row_date AND release_date <= row_date GROUP BY 1, 2""",
)
def _(spark, folder):
    return _round(ts.month_end_selection(unique_records(spark, folder)), "value")


@query(
    "month_selection_reasons",
    f"""WITH {RECORDS}, {UNIQUE}, sel AS (SELECT series, last_day(release_date) AS row_date, count(*) AS records, min(method) AS method, max(observation_date) AS o FROM u GROUP BY 1, 2)
    SELECT s.series, CAST(m.row_date AS VARCHAR) AS row_date,
      CASE WHEN o IS NULL THEN 'no eligible observation released by the row date' WHEN method = 'mean' AND records > 1 THEN 'mean of ' || records || ' observations'
        ELSE 'latest observation ' || CAST(o AS VARCHAR) END AS reason
    FROM (SELECT DISTINCT series FROM u) s CROSS JOIN (SELECT DISTINCT row_date FROM sel) m LEFT JOIN sel ON sel.series = s.series AND sel.row_date = m.row_date""",
)
def _(spark, folder):
    selected = ts.month_end_selection(unique_records(spark, folder))
    return _round(ts.selection_reasons(selected, selected, selected).select("series", "row_date", "reason"))


@query("first_release_dates", f"WITH {RECORDS} SELECT series, CAST(observation_date AS VARCHAR) AS observation_date, CAST(min(realtime_start) AS VARCHAR) AS first_release FROM rec GROUP BY 1, 2")
def _(spark, folder):
    return _round(ts.first_release(order_records(spark, folder)))


@query(
    "annual_ratio_series",
    """WITH t AS (SELECT year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY 1),
    b AS (SELECT year(l_shipdate) AS y, sum(CASE WHEN l_returnflag = 'R' AND year(l_shipdate) > 1996 THEN l_extendedprice ELSE 0 END) AS v FROM lineitem GROUP BY 1)
    SELECT CAST(t.y AS BIGINT) AS year, CASE WHEN b.v IS NOT NULL AND b.v <> 0 THEN round(t.v / b.v, 6) END AS ratio,
      CASE WHEN b.v IS NULL THEN 'MISSING_DENOMINATOR' WHEN b.v = 0 THEN 'ZERO_DENOMINATOR' END AS warning FROM t LEFT JOIN b ON t.y = b.y""",
)
def _(spark, folder):
    top = table(spark, folder, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year")).agg(F.sum("o_totalprice").alias("value"))
    counted = (F.col("l_returnflag") == "R") & (F.year("l_shipdate") > 1996)
    bottom = table(spark, folder, "lineitem").groupBy(F.year("l_shipdate").cast("long").alias("year")).agg(
        F.sum(F.when(counted, F.col("l_extendedprice")).otherwise(0.0)).alias("value")
    )
    return _round(ts.ratio_series(top, bottom, "year"), "ratio")


@query(
    "year_over_year_same_date",
    f"""WITH {RECORDS}, {UNIQUE} SELECT a.series, CAST(a.observation_date AS VARCHAR) AS observation_date, CAST(b.observation_date AS VARCHAR) AS prior_date,
      CAST(greatest(a.release_date, b.release_date) AS VARCHAR) AS release_date, round((a.value / b.value - 1) * 100, 6) AS value
    FROM day a JOIN day b ON a.series = b.series AND b.observation_date = CAST(a.observation_date - INTERVAL 1 YEAR AS DATE) WHERE b.value <> 0""",
)
def _(spark, folder):
    return _round(ts.year_over_year(_daily(spark, folder)), "value")


def _daily(spark, folder):
    from gaugework.plans.joins import latest_per_key

    return latest_per_key(unique_records(spark, folder), ["series", "observation_date"], ["release_date"])


@query(
    "year_over_year_weekly",
    f"""WITH {RECORDS}, {UNIQUE}, c AS (SELECT a.series, a.observation_date, a.value, a.release_date, max(b.observation_date) AS p FROM day a JOIN day b ON a.series = b.series
      AND b.observation_date <= CAST(a.observation_date - INTERVAL 1 YEAR AS DATE) AND b.observation_date >= CAST(a.observation_date - INTERVAL 1 YEAR AS DATE) - 8 GROUP BY 1, 2, 3, 4)
    SELECT c.series, CAST(c.observation_date AS VARCHAR) AS observation_date, CAST(p AS VARCHAR) AS prior_date, CAST(greatest(c.release_date, b.release_date) AS VARCHAR) AS release_date,
      round((c.value / b.value - 1) * 100, 6) AS value FROM c JOIN day b ON b.series = c.series AND b.observation_date = c.p WHERE b.value <> 0""",
)
def _(spark, folder):
    return _round(ts.year_over_year(_daily(spark, folder), weekly=True), "value")


@query(
    "month_end_table",
    f"""WITH {RECORDS}, {UNIQUE}, s AS (SELECT series, last_day(observation_date) AS row_date, avg(value) AS value FROM day GROUP BY 1, 2),
    m AS (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(row_date)), date_trunc('month', max(row_date)), INTERVAL 1 MONTH)) AS DATE)) AS row_date FROM s),
    old AS (SELECT series, last_day(observation_date) AS row_date, min(value) AS value, min(value) < 9.0 AS bad FROM day WHERE year(observation_date) = 1996 GROUP BY 1, 2)
    SELECT coalesce(g.series, old.series) AS series, CAST(coalesce(g.row_date, old.row_date) AS VARCHAR) AS row_date, round(CASE WHEN old.bad THEN g.value ELSE coalesce(old.value, g.value) END, 6) AS value
    FROM (SELECT n.series, m.row_date, s.value FROM (SELECT DISTINCT series FROM s) n CROSS JOIN m LEFT JOIN s ON s.series = n.series AND s.row_date = m.row_date) g
    FULL JOIN old ON old.series = g.series AND old.row_date = g.row_date""",
)
def _(spark, folder):
    day = _daily(spark, folder).withColumn("row_date", F.last_day("observation_date"))
    series = day.groupBy("series", "row_date").agg(F.avg("value").alias("value"))
    old = day.where(F.year("observation_date") == 1996).groupBy("series", "row_date").agg(F.min("value").alias("value"), (F.min("value") < 9.0).alias("verified_invalid"))
    return _round(ts.month_grid(series, old), "value")


@query(
    "misplaced_quarterly_rows",
    """WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS obs_date FROM orders), inc AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders WHERE o_totalprice > 450000)
    SELECT CAST(obs_date AS VARCHAR) AS obs_date, CAST(make_date(year(obs_date), quarter(obs_date) * 3, 1) AS VARCHAR) AS replacement_month FROM o
    WHERE month(obs_date) % 3 <> 0 AND make_date(year(obs_date), quarter(obs_date) * 3, 1) IN (SELECT month FROM inc)""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders")
    stored = orders.select(F.to_date("o_orderdate").alias("obs_date")).distinct()
    incoming = orders.where(F.col("o_totalprice") > 450000).select(F.trunc("o_orderdate", "MM").alias("month"))
    return _round(ts.misplaced_sparse_rows(stored, incoming, "quarterly").select("obs_date", "replacement_month"))


@query(
    "release_month_shift",
    """WITH m AS (SELECT o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, avg(ln(o_totalprice)) AS v FROM orders GROUP BY 1, 2)
    SELECT series, CAST(CAST(d + INTERVAL 2 MONTH AS DATE) AS VARCHAR) AS month, round(v, 6) AS value FROM m
    WHERE CAST(d + INTERVAL 2 MONTH AS DATE) IN (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) FROM lineitem)""",
)
def _(spark, folder):
    months = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("series"), F.trunc("o_orderdate", "MM").alias("obs_date")).agg(F.avg(F.ln("o_totalprice")).alias("value"))
    wanted = table(spark, folder, "lineitem").select(F.trunc("l_shipdate", "MM").alias("month"))
    return _round(ts.release_shift(months, 2, wanted), "value")


@query(
    "latest_contiguous_months",
    """WITH r AS (SELECT DISTINCT o_custkey AS custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
    i AS (SELECT *, year(month) * 12 + month(month) AS ix FROM r), s AS (SELECT *, ix - row_number() OVER (PARTITION BY custkey ORDER BY month) AS isl FROM i),
    t AS (SELECT *, row_number() OVER (PARTITION BY custkey, isl ORDER BY month) AS run, row_number() OVER (PARTITION BY custkey ORDER BY month DESC) AS bk FROM s),
    e AS (SELECT *, max(CASE WHEN run >= 2 THEN ix END) OVER (PARTITION BY custkey) AS en FROM t)
    SELECT custkey, CAST(month AS VARCHAR) AS month FROM e WHERE CASE WHEN en IS NOT NULL THEN ix BETWEEN en - 1 AND en ELSE bk <= 2 END""",
)
def _(spark, folder):
    rows = table(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"), F.trunc("o_orderdate", "MM").alias("month")).distinct()
    return _round(ts.latest_contiguous_months(rows, ["custkey"], 2))


# --- prices -------------------------------------------------------------------------------------

BARS = "bars AS (SELECT event_type AS ticker, CAST(ts AS DATE) AS session_date, avg(value) AS close, CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY 1, 2)"


def event_bars(spark, folder):
    return table(spark, folder, "events").groupBy(F.col("event_type").alias("ticker"), F.to_date("ts").alias("session_date")).agg(
        F.avg("value").alias("close"), F.count("*").cast("double").alias("volume")
    )


@query(
    "average_dollar_volume",
    f"""WITH {BARS} SELECT ticker, CAST(session_date AS VARCHAR) AS session_date, round(CASE WHEN count(*) OVER w = 20 THEN avg(close * volume) OVER w END, 6) AS average_dollar_volume
    FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY session_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
)
def _(spark, folder):
    return _round(ts.average_dollar_volume(event_bars(spark, folder)).select("ticker", "session_date", "average_dollar_volume"), "average_dollar_volume")


@query(
    "forward_outcomes",
    f"""WITH {BARS}, bench AS (SELECT CAST(ts AS DATE) AS d, avg(value) AS c FROM events GROUP BY 1), n AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY session_date) AS k, count(*) OVER (PARTITION BY ticker) AS total FROM bars),
    q AS (SELECT e.event_id, e.event_type AS ticker, CAST(e.ts AS DATE) AS cutoff, min(n.k) AS k0 FROM events e LEFT JOIN n ON n.ticker = e.event_type AND n.session_date > CAST(e.ts AS DATE) GROUP BY 1, 2, 3)
    SELECT q.event_id AS observation_id, CAST(s.session_date AS VARCHAR) AS execution_date, CAST(t.session_date AS VARCHAR) AS end_date, CASE WHEN t.k > s.k THEN round(t.close / s.close - 1, 6) END AS forward_return,
      CASE WHEN t.k > s.k THEN round((t.close / s.close - 1) - (b1.c / b0.c - 1), 6) END AS excess_return, CASE WHEN t.k > s.k THEN 'AVAILABLE' ELSE 'UNAVAILABLE' END AS status
    FROM q LEFT JOIN n s ON s.ticker = q.ticker AND s.k = q.k0 LEFT JOIN n t ON t.ticker = q.ticker AND t.k = least(q.k0 + 4, s.total)
    LEFT JOIN bench b0 ON b0.d = s.session_date LEFT JOIN bench b1 ON b1.d = t.session_date""",
)
def _(spark, folder):
    events = table(spark, folder, "events")
    cutoffs = events.select(F.col("event_id").alias("observation_id"), F.col("event_type").alias("ticker"), F.to_date("ts").alias("cutoff"))
    bench = events.groupBy(F.to_date("ts").alias("session_date")).agg(F.avg("value").alias("close"))
    out = ts.forward_outcome(cutoffs, event_bars(spark, folder), bench, 5)
    return _round(out.select("observation_id", "execution_date", "end_date", "forward_return", "excess_return", "status"), "forward_return", "excess_return")


@query(
    "asof_price",
    """WITH p AS (SELECT l_partkey AS k, CAST(l_shipdate AS DATE) AS d, max(l_extendedprice / l_quantity) AS price FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1, 2),
    f AS (SELECT l_partkey AS k, CAST(o_orderdate AS DATE) AS fy, l_orderkey, l_linenumber, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    h AS (SELECT DISTINCT f.k, f.fy, arg_max(p.price, p.d) AS price, max(p.d) AS d FROM (SELECT DISTINCT k, fy FROM f) f JOIN p ON p.k = f.k AND p.d <= f.fy AND p.d >= f.fy - 21 GROUP BY 1, 2)
    SELECT f.k AS partkey, CAST(f.fy AS VARCHAR) AS fiscal_end, CAST(h.d AS VARCHAR) AS price_date, round(h.price, 6) AS price, count(*) AS statement_rows
    FROM f LEFT JOIN h ON h.k = f.k AND h.fy = f.fy GROUP BY 1, 2, 3, 4""",
)
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    prices = lines.where(F.col("l_extendedprice") > 0).select(F.col("l_partkey").alias("partkey"), F.to_date("l_shipdate").alias("price_day"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("fiscal_end"))
    statements = lines.join(orders, "l_orderkey").select(F.col("l_partkey").alias("partkey"), "fiscal_end", "l_orderkey", "l_linenumber")
    found = asof_day(statements, prices, ["partkey"], "fiscal_end", "price_day", ["price"], tolerance_days=21)
    return _round(found.withColumn("price", F.round("price", 6)).groupBy("partkey", "fiscal_end", F.col("matched_day").alias("price_date"), "price").agg(F.count("*").alias("statement_rows")))


@query(
    "overlapping_forward_windows",
    """WITH w AS (SELECT o_custkey AS custkey, o_orderkey AS orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 30 AS e FROM orders)
    SELECT a.orderkey, count(b.orderkey) > 0 AS overlaps FROM w a LEFT JOIN w b ON a.custkey = b.custkey AND a.orderkey <> b.orderkey AND a.s < b.e AND b.s < a.e GROUP BY 1""",
)
def _(spark, folder):
    windows = table(spark, folder, "orders").select("o_custkey", F.col("o_orderkey").alias("orderkey"), F.to_date("o_orderdate").alias("start"), F.date_add(F.to_date("o_orderdate"), 30).alias("end"))
    return ts.overlapping_windows(windows, ["o_custkey"], "start", "end").select("orderkey", "overlaps")
