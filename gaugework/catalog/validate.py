"""Validation statistics over documents, labels, embeddings and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.catalog.registry import query, table
from gaugework.operators import validate as va
from gaugework.plans.settle import settle

R = lambda *names: [F.round(n, 6).alias(n) for n in names]


@query(
    "point_in_time_availability",
    """WITH d AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority LIKE '1%' THEN NULL WHEN o_orderpriority LIKE '2%' THEN CAST(o_orderdate AS DATE) + 30 ELSE CAST(o_orderdate AS DATE) END AS a FROM orders)
    SELECT k AS orderkey, CASE WHEN a IS NULL THEN 'UNKNOWN' WHEN a <= DATE '1999-06-30' THEN 'PASS' ELSE 'FAIL' END AS availability FROM d""",
)
def _(spark, folder):
    p, d = F.col("o_orderpriority"), F.to_date("o_orderdate")
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"), F.when(p.startswith("2"), F.date_add(d, 30)).alias("filing_date"), F.when(~p.startswith("1"), d).alias("publication_date"))
    return va.availability(o, F.lit("1999-06-30").cast("date")).select("orderkey", "availability")


@query("as_of_filter", "SELECT o_orderkey AS orderkey FROM orders WHERE o_orderpriority LIKE '1%' OR CAST(o_orderdate AS DATE) <= DATE '1998-03-31'")
def _(spark, folder):
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"), F.when(~F.col("o_orderpriority").startswith("1"), F.to_date("o_orderdate")).alias("d"))
    return va.as_of(o, "d", F.lit("1998-03-31").cast("date")).select("orderkey")


def panel(spark, folder):
    """Part-level panel: factor = order line value, outcome = quantity, grouped by brand."""
    l = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.avg("l_discount").alias("x"), F.avg("l_extendedprice").alias("v"), F.avg("l_quantity").alias("y"))
    return table(spark, folder, "part").join(l, "p_partkey", "left").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.round("x", 3).alias("x"), F.round("y", 1).alias("y"), "v")


PANEL = "pn AS (SELECT p_partkey, p_brand AS brand, p_type AS kind, round(x, 3) AS x, round(y, 1) AS y, v FROM part LEFT JOIN (SELECT l_partkey, avg(l_discount) AS x, avg(l_extendedprice) AS v, avg(l_quantity) AS y FROM lineitem GROUP BY 1) ON l_partkey = p_partkey)"


@query("pearson_information_coefficient", f"WITH {PANEL} SELECT brand, count(*) AS sample_count, round(covar_samp(v, y) / (stddev_samp(v) * stddev_samp(y)), 6) AS ic FROM pn WHERE v IS NOT NULL GROUP BY 1")
def _(spark, folder):
    return va.pearson(panel(spark, folder), ["brand"], "v", "y").select("brand", "sample_count", *R("ic"))


@query(
    "rank_information_coefficient",
    f"""WITH {PANEL}, r AS (SELECT brand, rank() OVER (PARTITION BY brand ORDER BY x) + (count(*) OVER (PARTITION BY brand, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY brand ORDER BY y) + (count(*) OVER (PARTITION BY brand, y) - 1) / 2.0 AS ry FROM pn WHERE x IS NOT NULL)
    SELECT brand, count(*) AS sample_count, round(covar_samp(rx, ry) / (stddev_samp(rx) * stddev_samp(ry)), 6) AS rank_ic FROM r GROUP BY 1""",
)
def _(spark, folder):
    return va.spearman(settle(panel(spark, folder)), ["brand"], "x", "y").select("brand", "sample_count", *R("rank_ic"))


@query(
    "factor_correlation_matrix",
    """WITH e AS (SELECT vec_id, 'd' || i AS f, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, (SELECT unnest(range(64)) AS i))
    SELECT a.f AS factor_a, b.f AS factor_b, count(*) AS sample_count, round(covar_samp(a.v, b.v) / (stddev_samp(a.v) * stddev_samp(b.v)), 6) AS correlation FROM e a JOIN e b USING (vec_id) GROUP BY 1, 2""",
)
def _(spark, folder):
    e = table(spark, folder, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v")).select("vec_id", F.concat(F.lit("d"), F.col("i").cast("string")).alias("f"), F.col("v").cast("double").alias("v"))
    return va.factor_correlations(e, "vec_id", "f", "v").select("factor_a", "factor_b", "sample_count", *R("correlation"))


@query(
    "distribution_description",
    """SELECT lang, count(*) AS count, round(avg(n_chars), 5) AS mean, CAST(median(n_chars) AS DOUBLE) AS median, round(coalesce(stddev_samp(n_chars), 0), 5) AS std, CAST(min(n_chars) AS DOUBLE) AS min, CAST(max(n_chars) AS DOUBLE) AS max FROM documents GROUP BY 1""",
)
def _(spark, folder):
    d = va.describe(table(spark, folder, "documents").select("lang", F.col("n_chars").cast("double").alias("n_chars")), ["lang"], "n_chars")
    return d.select("lang", "count", F.round("mean", 5).alias("mean"), "median", F.round("std", 5).alias("std"), "min", "max")


@query("factor_missingness", "SELECT source, count(*) AS rows, count(quality) AS present, round(count(quality) / CAST(count(*) AS DOUBLE), 6) AS availability FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def _(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "source").join(table(spark, folder, "labels"), "doc_id", "left")
    return va.missingness(d, ["source"], "quality").select("source", "rows", "present", *R("availability"))


@query("coverage_sensitivity", """SELECT CASE WHEN c IS NULL THEN 'MISSING' WHEN c < 0.4 THEN '<0.4' WHEN c < 0.5 THEN '<0.5' WHEN c < 0.6 THEN '<0.6' WHEN c < 0.7 THEN '<0.7' WHEN c < 0.8 THEN '<0.8' ELSE '>=0.8' END AS band, count(*) AS observations
    FROM (SELECT CASE WHEN c_acctbal >= 0 THEN c_acctbal / 10000 END AS c FROM customer) GROUP BY 1""")
def _(spark, folder):
    return va.coverage_bands(table(spark, folder, "customer").select(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 10000).alias("c")), "c")


@query("factor_matrix", "SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS as_of, max(CASE WHEN event_type = 'click' THEN value END) AS click, max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase FROM events GROUP BY 1, 2")
def _(spark, folder):
    e = table(spark, folder, "events").withColumn("as_of", F.to_date("ts").cast("string"))
    return va.factor_matrix(e, ["user_id", "as_of"], "event_type", "value", ["click", "purchase"])


@query(
    "quantile_outcomes",
    f"""WITH {PANEL}, q AS (SELECT kind, x, y, p_partkey, row_number() OVER (PARTITION BY kind ORDER BY x, p_partkey) - 1 AS r, count(*) OVER (PARTITION BY kind) AS n FROM pn WHERE x IS NOT NULL AND y IS NOT NULL),
    g AS (SELECT *, 1 + CASE WHEN r >= n // 4 THEN 1 ELSE 0 END + CASE WHEN r >= 2 * n // 4 THEN 1 ELSE 0 END + CASE WHEN r >= 3 * n // 4 THEN 1 ELSE 0 END AS quantile FROM q),
    h AS (SELECT *, row_number() OVER (PARTITION BY kind, quantile ORDER BY y) AS k, count(*) OVER (PARTITION BY kind, quantile) AS c FROM g WHERE n >= 40),
    s AS (SELECT kind, quantile, count(*) AS count, avg(y) AS m, max(CASE WHEN k = c // 2 + 1 THEN y END) AS median FROM h GROUP BY 1, 2)
    SELECT kind, CAST(quantile AS BIGINT) AS quantile, count, round(m, 6) AS mean, median, round(max(CASE WHEN quantile = 4 THEN m END) OVER (PARTITION BY kind) - max(CASE WHEN quantile = 1 THEN m END) OVER (PARTITION BY kind), 6) AS spread_top_minus_bottom FROM s""",
)
def _(spark, folder):
    q = va.quantile_outcomes(settle(panel(spark, folder)), ["kind"], "x", "y", ["p_partkey"], 4, 10)
    return q.select("kind", F.col("quantile").cast("long").alias("quantile"), "count", F.round("mean", 6).alias("mean"), "median", *R("spread_top_minus_bottom"))


@query("quantile_adequacy", f"WITH {PANEL} SELECT brand, count(x) AS sample_count, CASE WHEN count(x) < 80 THEN 'INSUFFICIENT_SAMPLE' ELSE 'AVAILABLE' END AS status FROM pn GROUP BY 1")
def _(spark, folder):
    return va.sample_adequacy(panel(spark, folder), ["brand"], "x", "y", 4, 20)


@query("simple_regression", f"WITH {PANEL} SELECT brand, count(*) AS sample_count, round(regr_slope(v, y), 4) AS slope, round(regr_intercept(v, y), 3) AS intercept, round(covar_samp(v, y) / (stddev_samp(v) * stddev_samp(y)), 6) AS correlation, 'EXPLORATORY' AS status FROM pn WHERE v IS NOT NULL GROUP BY 1")
def _(spark, folder):
    r = va.regression(panel(spark, folder), ["brand"], "y", "v")
    return r.select("brand", "sample_count", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), *R("correlation"), "status")


@query(
    "bootstrap_interval",
    """WITH it AS (SELECT unnest(range(200)) AS it), h AS (SELECT p_type AS kind, it, p_retailprice AS v, (('0x' || substr(md5('20260924:' || p_partkey), 1, 8))::UBIGINT + it::UBIGINT * 2654435769) % 4294967296 AS x FROM part CROSS JOIN it),
    h2 AS (SELECT kind, it, v, xor(x, x >> 16) * 2146121005 % 4294967296 AS x FROM h), h3 AS (SELECT kind, it, v, xor(x, x >> 15) * 2221713035 % 4294967296 AS x FROM h2), d AS (SELECT kind, it, v, xor(x, x >> 16) / 4294967296.0 AS u FROM h3),
    w AS (SELECT kind, it, v, (u >= 0.36787944117144233)::INT + (u >= 0.7357588823428847)::INT + (u >= 0.9196986029286058)::INT + (u >= 0.9810118431238462)::INT + (u >= 0.9963401531726563)::INT + (u >= 0.9994058151824183)::INT + (u >= 0.9999167588507119)::INT AS w FROM d),
    m AS (SELECT kind, it, sum(w * v) / sum(w) AS m FROM w GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY m, it) - 1 AS k FROM m)
    SELECT kind, count(*) AS iterations, round(avg(m), 5) AS mean, round(max(CASE WHEN k = 4 THEN m END), 5) AS lower, round(max(CASE WHEN k = 195 THEN m END), 5) AS upper FROM k GROUP BY 1""",
)
def _(spark, folder):
    b = va.bootstrap_mean(table(spark, folder, "part").select(F.col("p_type").alias("kind"), "p_partkey", F.col("p_retailprice").alias("v")), ["kind"], "p_partkey", "v", 200)
    return b.select("kind", "iterations", *[F.round(c, 5).alias(c) for c in ("mean", "lower", "upper")])


@query("score_stability", """WITH d AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) SELECT count(p) AS count, round(avg(abs(value - p)), 6) AS mean_absolute_change, round(max(abs(value - p)), 6) AS largest_change, 'AVAILABLE' AS status FROM d""")
def _(spark, folder):
    s = va.score_stability(table(spark, folder, "events"), "user_id", "event_id", "value")
    return s.select("count", *R("mean_absolute_change", "largest_change"), "status")


OBS = """ob AS (SELECT event_id AS observation_id, user_id AS ticker, CAST(ts AS DATE) AS a, CASE WHEN event_type = 'view' THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS c, event_type <> 'error' AS ok, CASE WHEN value > 3 THEN value END AS s, CASE WHEN event_type = 'error' AND value > 10 THEN 'LEAKAGE_DETECTED' END AS why, event_type = 'click' AS unk FROM events)"""


def observation_panel(spark, folder):
    t, d = F.col("event_type"), F.to_date("ts")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("observation_id"), F.col("user_id").alias("ticker"), d.alias("as_of_date"), F.when(t == "view", F.date_add(d, 1)).otherwise(d).alias("information_cutoff"), (t != "error").alias("point_in_time_valid"),
        F.when(F.col("value") > 3, F.col("value")).alias("overall_score"), F.when((t == "error") & (F.col("value") > 10), "LEAKAGE_DETECTED").alias("exclusion_reason"), (t == "click").alias("source_availability_unknown"), "ts",
    )


@query("observation_audit", f"""WITH {OBS} SELECT count(*) AS observations, count(CASE WHEN ok THEN 1 END) AS valid, count(CASE WHEN NOT ok THEN 1 END) AS excluded, count(DISTINCT CASE WHEN ok THEN ticker END) AS companies, count(DISTINCT CASE WHEN ok THEN a END) AS dates,
    CAST(min(CASE WHEN ok THEN a END) AS VARCHAR) AS first_date, CAST(max(CASE WHEN ok THEN a END) AS VARCHAR) AS last_date, round(count(CASE WHEN ok AND s IS NOT NULL THEN 1 END) / CAST(count(CASE WHEN ok THEN 1 END) AS DOUBLE), 6) AS score_availability, true AS adequate_exploratory FROM ob""")
def _(spark, folder):
    a = va.observation_audit(observation_panel(spark, folder))
    return a.select("observations", "valid", "excluded", "companies", "dates", F.col("first_date").cast("string").alias("first_date"), F.col("last_date").cast("string").alias("last_date"), *R("score_availability"), "adequate_exploratory")


@query("exclusion_reasons", f"WITH {OBS} SELECT coalesce(why, 'UNKNOWN') AS reason, count(*) AS observations FROM ob WHERE NOT ok GROUP BY 1")
def _(spark, folder):
    return va.exclusion_reasons(observation_panel(spark, folder))


@query("leakage_findings", f"""WITH {OBS} SELECT observation_id, 'FAIL' AS status, 'observation_valid' AS "check" FROM ob WHERE NOT ok UNION ALL SELECT observation_id, 'FAIL', 'cutoff_alignment' FROM ob WHERE a <> c UNION ALL SELECT observation_id, 'UNKNOWN', 'source_timestamp' FROM ob WHERE unk
    UNION ALL SELECT observation_id, 'FAIL', 'outcome_after_cutoff' FROM ob WHERE c = a + 1""")
def _(spark, folder):
    o = observation_panel(spark, folder)
    outcomes = o.select("observation_id", F.date_add("as_of_date", 1).alias("execution_date"))
    return va.leakage_findings(o, outcomes)


@query("leakage_status", f"WITH {OBS} SELECT count(CASE WHEN NOT ok THEN 1 END) + 2 * count(CASE WHEN a <> c THEN 1 END) AS failed, count(CASE WHEN unk THEN 1 END) AS unknown, 'FAIL' AS status FROM ob")
def _(spark, folder):
    o = observation_panel(spark, folder)
    return va.leakage_status(va.leakage_findings(o, o.select("observation_id", F.date_add("as_of_date", 1).alias("execution_date"))))


@query(
    "built_observations",
    """WITH s AS (SELECT user_id AS ticker, max(CAST(ts AS DATE)) AS a FROM events GROUP BY 1), f AS (SELECT s.ticker, s.a, event_type, max(value) AS v FROM s JOIN events e ON e.user_id = s.ticker AND CAST(e.ts AS DATE) = s.a GROUP BY 1, 2, 3)
    SELECT s.ticker, CAST(s.a AS VARCHAR) AS as_of_date, string_agg(event_type || '=' || v, ',' ORDER BY event_type) AS factors, NOT bool_or(event_type = 'signup') AS point_in_time_valid FROM s JOIN f USING (ticker) GROUP BY 1, 2""",
)
def _(spark, folder):
    e = table(spark, folder, "events").select(F.col("user_id").alias("ticker"), F.to_date("ts").alias("as_of_date"), "event_type", "value")
    scores = e.groupBy("ticker", "as_of_date").agg(F.avg("value").alias("overall_score")).withColumn("available_on", F.col("as_of_date"))
    factors = e.groupBy("ticker", "as_of_date", F.col("event_type").alias("factor")).agg(F.max("value").alias("score")).withColumn("available_on", F.when(F.col("factor") == "signup", F.date_add("as_of_date", 2)).otherwise(F.col("as_of_date")))
    o = va.build_observations(scores, factors, factors.withColumnRenamed("factor", "pillar"))
    text = F.array_join(F.transform(F.map_entries("factor_values"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",")
    return o.select("ticker", F.col("as_of_date").cast("string").alias("as_of_date"), text.alias("factors"), "point_in_time_valid")


@query("observation_duplicates", "SELECT count(*) - count(DISTINCT o_custkey) AS duplicates FROM orders")
def _(spark, folder):
    return va.deduplicate(table(spark, folder, "orders").withColumnRenamed("o_custkey", "observation_id"))[1]


@query("deduplicated_observations", "SELECT DISTINCT o_custkey AS observation_id FROM orders")
def _(spark, folder):
    return va.deduplicate(table(spark, folder, "orders").select(F.col("o_custkey").alias("observation_id")))[0]


@query("chronological_split", """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), n AS (SELECT d, row_number() OVER (ORDER BY d) AS k, count(*) OVER () AS n FROM d), c AS (SELECT max(CASE WHEN k = n // 2 THEN d END) AS t, max(CASE WHEN k = n - 1 THEN d END) AS v FROM n)
    SELECT event_id, CASE WHEN CAST(ts AS DATE) <= t THEN 'train' WHEN CAST(ts AS DATE) <= v THEN 'validation' ELSE 'holdout' END AS split FROM events CROSS JOIN c""")
def _(spark, folder):
    return va.chronological_split(table(spark, folder, "events").select("event_id", F.to_date("ts").alias("d")), "d").select("event_id", "split")


@query("walk_forward_folds", """WITH c AS (SELECT CAST(ts AS DATE) AS d, count(*) AS c FROM events GROUP BY 1), n AS (SELECT d, c, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n, lag(d) OVER (ORDER BY d) AS te, sum(c) OVER (ORDER BY d) - c AS tr FROM c)
    SELECT i - 2 AS fold, CAST(te AS VARCHAR) AS train_end, CAST(d AS VARCHAR) AS validation_date, CAST(tr AS BIGINT) AS train_rows, c AS validation_rows FROM n WHERE i >= 2 AND i < n - 1""")
def _(spark, folder):
    o = table(spark, folder, "events").select(F.to_date("ts").alias("d"))
    f = va.fold_sizes(o, va.walk_forward_folds(o, "d"), "d")
    return f.withColumns({"train_end": F.col("train_end").cast("string"), "validation_date": F.col("validation_date").cast("string")})


@query("constrained_weights", """WITH w AS (SELECT c_custkey, c_mktsegment, greatest(0.0, least(0.3, c_acctbal / 10000)) AS w FROM customer), t AS (SELECT c_mktsegment, sum(w) AS t FROM w GROUP BY 1) SELECT c_custkey AS custkey, round(w / t * 1000, 6) AS constrained FROM w JOIN t USING (c_mktsegment)""")
def _(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment", (F.col("c_acctbal") / 10000).alias("w"))
    return va.constrained_weights(c, ["c_mktsegment"], "w", 0.3).select("custkey", F.round(F.col("constrained") * 1000, 6).alias("constrained"))


@query("calibration_adequacy", f"WITH {OBS} SELECT 'INSUFFICIENT_HISTORICAL_DATA' AS status, 'MINIMUM_UNIQUE_DATES_NOT_MET' AS reasons FROM ob HAVING count(*) >= 30")
def _(spark, folder):
    return va.calibration_refusal(observation_panel(spark, folder), min_dates=1000)


@query("candidate_profile_id", """WITH w AS (SELECT c_mktsegment AS f, round(avg(c_acctbal), 2) AS w FROM customer GROUP BY 1) SELECT count(*) AS factors, round(sum(w), 2) AS total FROM w""")
def _(spark, folder):
    w = table(spark, folder, "customer").groupBy(F.col("c_mktsegment").alias("factor")).agg(F.round(F.avg("c_acctbal"), 2).alias("weight"))
    c = va.candidate_profile(w, {"parent": F.lit("core"), "horizon": F.lit(21)})
    return c.select(F.size("weights").cast("long").alias("factors"), F.round(F.aggregate(F.map_values("weights"), F.lit(0.0), lambda a, v: a + v), 2).alias("total"))


@query("random_baseline", "SELECT event_id, round(('0x' || substr(md5('20260924:' || event_id), 1, 8))::BIGINT / 4294967296.0, 9) AS random_signal FROM events")
def _(spark, folder):
    return va.random_baseline(table(spark, folder, "events").select("event_id"), "event_id").select("event_id", F.round("random_signal", 9).alias("random_signal"))


@query(
    "factor_diagnostics",
    f"""WITH {PANEL}, r AS (SELECT kind, v, y, rank() OVER (PARTITION BY kind ORDER BY v) + (count(*) OVER (PARTITION BY kind, v) - 1) / 2.0 AS rv, rank() OVER (PARTITION BY kind ORDER BY y) + (count(*) OVER (PARTITION BY kind, y) - 1) / 2.0 AS ry FROM pn WHERE v IS NOT NULL)
    SELECT kind, count(*) AS count, round(avg(v), 4) AS mean, round(median(v), 4) AS median, round(covar_samp(v, y) / (stddev_samp(v) * stddev_samp(y)), 6) AS pearson_ic, round(covar_samp(rv, ry) / (stddev_samp(rv) * stddev_samp(ry)), 6) AS spearman_ic FROM r GROUP BY 1""",
)
def _(spark, folder):
    d = va.factor_diagnostics(settle(panel(spark, folder)), "kind", "v", "y", "p_partkey")
    return d.select("kind", "count", F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"), *R("pearson_ic", "spearman_ic"))
