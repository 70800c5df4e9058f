"""Annual histories: suppliers as companies, ship years as fiscal years."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.catalog.registry import query, table
from gaugework.functions.numbers import steady_sum
from gaugework.operators import history as hs
from gaugework.operators.crosssection import melt
from gaugework.params import HistoryParams
from gaugework.plans.settle import settle

AS_OF = "2001-10-01"


def annual_rows(spark, folder):
    """Two rows per supplier and year (one per line status): the later period wins."""
    l = table(spark, folder, "lineitem")
    value, q = F.col("l_extendedprice"), F.col("l_quantity")
    return l.groupBy(F.concat(F.lit(" s"), F.col("l_suppkey").cast("string")).alias("ticker"), F.year("l_shipdate").alias("fiscal_year"), "l_linestatus").agg(
        F.min(F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("source_row"), F.to_date(F.max("l_shipdate")).alias("fiscal_period_end"),
        steady_sum(value).alias("revenue"), steady_sum(value * (F.col("l_discount") - 0.045)).alias("net_income"), steady_sum(value * (F.col("l_tax") - 0.038)).alias("free_cash_flow"),
        (steady_sum(value * F.col("l_discount")) / steady_sum(value)).alias("gross_margin"), (steady_sum(F.col("l_discount") * q) / F.count(F.col("l_discount") * q)).alias("roa"), (steady_sum(F.col("l_tax") * q) / F.count(F.col("l_tax") * q) - 0.9).alias("debt_to_equity"),
        (steady_sum(value * (F.col("l_discount") - 0.045)) / steady_sum(value)).alias("net_margin"), F.count("*").alias("lines"),
    )


ANNUAL = """
an AS (SELECT 'S' || l_suppkey AS ticker, CAST(year(l_shipdate) AS INTEGER) AS y, min(l_orderkey * 1000000 + l_partkey * 10 + l_linenumber) AS rn, CAST(max(l_shipdate) AS DATE) AS pe, sum(l_extendedprice) AS rev,
  sum(l_extendedprice * (l_discount - 0.045)) AS ni, sum(l_extendedprice * (l_tax - 0.038)) AS fcf, sum(l_extendedprice * l_discount) / sum(l_extendedprice) AS gm, avg(l_discount * l_quantity) AS roa,
  avg(l_tax * l_quantity) - 0.9 AS de, sum(l_extendedprice * (l_discount - 0.045)) / sum(l_extendedprice) AS nm, l_linestatus FROM lineitem GROUP BY l_suppkey, year(l_shipdate), l_linestatus),
dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, y ORDER BY pe DESC, rn DESC) AS k FROM an) WHERE k = 1),
r4 AS (SELECT *, fcf / rev AS fm, CASE WHEN de >= 0 THEN de END AS dev, row_number() OVER (PARTITION BY ticker ORDER BY y) AS i, count(*) OVER (PARTITION BY ticker) AS n,
  lag(y) OVER w AS py, lag(rev) OVER w AS prev, lag(nm) OVER w AS pnm, lag(roa) OVER w AS proa FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY y DESC) AS back FROM dd) WHERE back <= 4 WINDOW w AS (PARTITION BY ticker ORDER BY y)),
gr AS (SELECT *, CASE WHEN i > 1 AND y - py = 1 AND rev > 0 AND prev > 0 THEN rev / prev - 1 END AS g FROM r4)"""


def features(spark, folder):
    return hs.history_features(annual_rows(spark, folder))


@query(
    "history_features",
    f"""WITH {ANNUAL}, c AS (SELECT ticker, count(*) AS rows, count(DISTINCT y) AS ys FROM an GROUP BY 1)
    SELECT gr.ticker, CAST(max(n) AS BIGINT) AS history_years, max(c.ys) AS available_history_years, max(c.rows - c.ys) AS duplicate_fiscal_rows_dropped, string_agg(CAST(y AS VARCHAR), ' | ' ORDER BY y) AS fiscal_years,
      CAST(max(y) AS BIGINT) AS latest_fiscal_year, round(pow(arg_max(rev, y) / arg_min(rev, y), 1.0 / (max(y) - min(y))) - 1, 6) AS revenue_cagr, round(max(CASE WHEN i = n THEN g END), 6) AS latest_revenue_growth,
      round(max(CASE WHEN i = n THEN g END) - max(CASE WHEN i = n - 1 THEN g END), 6) AS revenue_growth_acceleration, round(stddev_pop(g), 6) AS revenue_growth_stability, round(CAST(count(CASE WHEN g > 0 THEN 1 END) AS DOUBLE) / (max(n) - 1), 6) AS positive_revenue_growth_share,
      round(CAST(count(CASE WHEN ni > 0 THEN 1 END) AS DOUBLE) / count(*), 6) AS positive_net_income_share, round(max(CASE WHEN i = n AND y - py = 1 THEN nm - pnm END), 6) AS net_margin_change, round(max(CASE WHEN i = n AND y - py = 1 THEN roa - proa END), 6) AS roa_change,
      round(max(CASE WHEN i = n THEN fm END), 6) AS latest_fcf_margin, round(max(CASE WHEN i = n THEN dev END), 6) AS latest_debt_to_equity
    FROM gr JOIN c ON c.ticker = gr.ticker GROUP BY 1""",
)
def _(spark, folder):
    f = features(spark, folder)
    six = ["revenue_cagr", "latest_revenue_growth", "revenue_growth_acceleration", "revenue_growth_stability", "positive_revenue_growth_share", "positive_net_income_share", "net_margin_change", "roa_change", "latest_fcf_margin", "latest_debt_to_equity"]
    return f.select("ticker", F.col("history_years").cast("long").alias("history_years"), "available_history_years", "duplicate_fiscal_rows_dropped", "fiscal_years", F.col("latest_fiscal_year").cast("long").alias("latest_fiscal_year"), *[F.round(c, 6).alias(c) for c in six])


def trend_sql(name: str, value: str, log: bool = False) -> str:
    v = f"CASE WHEN {value} > 0 THEN ln({value}) END" if log else value
    return f"""
{name}p AS (SELECT ticker, CAST(y AS DOUBLE) AS x, {v} AS v, i = n AS last FROM r4 WHERE {v} IS NOT NULL),
{name}w AS (SELECT *, pow(0.7, max(x) OVER (PARTITION BY ticker) - x) AS w, count(*) OVER (PARTITION BY ticker) AS c, bool_or(last) OVER (PARTITION BY ticker) AS lv FROM {name}p),
{name}sl AS (SELECT a.ticker, (b.v - a.v) / (b.x - a.x) AS s, a.w * b.w AS w FROM {name}w a JOIN {name}w b ON a.ticker = b.ticker AND a.x < b.x WHERE a.c >= 4 AND a.lv),
{name}m AS (SELECT ticker, min(s) AS slope FROM (SELECT *, sum(w) OVER (PARTITION BY ticker ORDER BY s, w ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY ticker) AS tot FROM {name}sl) WHERE run >= tot / 2 - 1e-15 GROUP BY 1),
{name}i AS (SELECT ticker, min(o) AS icpt FROM (SELECT *, sum(w) OVER (PARTITION BY ticker ORDER BY o, w ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY ticker) AS tot FROM (SELECT p.ticker, p.v - m.slope * p.x AS o, p.w FROM {name}w p JOIN {name}m m ON m.ticker = p.ticker)) WHERE run >= tot / 2 GROUP BY 1),
{name}f AS (SELECT p.ticker, m.slope, greatest(0.0, least(1.0, 1 - sum(w * (v - icpt - slope * x) ** 2) / sum(w * (v - mu) ** 2))) AS r2 FROM (SELECT *, sum(w * v) OVER (PARTITION BY ticker) / sum(w) OVER (PARTITION BY ticker) AS mu FROM {name}w) p
  JOIN {name}m m ON m.ticker = p.ticker JOIN {name}i i ON i.ticker = p.ticker GROUP BY 1, 2)"""


@query(
    "robust_trends",
    f"""WITH {ANNUAL}, {trend_sql('a', 'rev', True)}, {trend_sql('b', 'nm')}, {trend_sql('c', 'dev')}
    SELECT t.ticker, round(exp(a.slope) - 1, 6) AS revenue_four_year_trend, round(a.r2, 5) AS revenue_four_year_trend_r2, round(b.slope, 6) AS net_margin_four_year_trend, round(b.r2, 5) AS net_margin_four_year_trend_r2, round(c.slope, 6) AS debt_to_equity_four_year_trend, round(c.r2, 5) AS debt_to_equity_four_year_trend_r2
    FROM (SELECT DISTINCT ticker FROM r4) t LEFT JOIN af a ON a.ticker = t.ticker LEFT JOIN bf b ON b.ticker = t.ticker LEFT JOIN cf c ON c.ticker = t.ticker""",
)
def _(spark, folder):
    f = features(spark, folder)
    return f.select("ticker", *[F.round(f"{n}_four_year_trend", 6).alias(f"{n}_four_year_trend") for n in ("revenue", "net_margin", "debt_to_equity")], *[F.round(f"{n}_four_year_trend_r2", 5).alias(f"{n}_four_year_trend_r2") for n in ("revenue", "net_margin", "debt_to_equity")])


METRIC_LIST = ["latest_roa", "latest_net_margin", "latest_gross_margin", "latest_fcf_margin", "positive_net_income_share", "revenue_cagr", "latest_debt_to_equity"]
PARAMS = HistoryParams(min_peers=5)
WEIGHTS = {"PROFITABILITY": 35.0, "CASH_FLOW": 25.0, "BALANCE_SHEET": 20.0, "STABILITY": 10.0, "GROWTH": 10.0}

SHORTLIST = f"""{ANNUAL},
ft AS (SELECT ticker, max(CASE WHEN i = n THEN roa END) AS latest_roa, max(CASE WHEN i = n THEN nm END) AS latest_net_margin, max(CASE WHEN i = n THEN gm END) AS latest_gross_margin, max(CASE WHEN i = n THEN fm END) AS latest_fcf_margin,
  CAST(count(CASE WHEN ni > 0 THEN 1 END) AS DOUBLE) / count(*) AS positive_net_income_share, pow(arg_max(rev, y) / arg_min(rev, y), 1.0 / (max(y) - min(y))) - 1 AS revenue_cagr, max(CASE WHEN i = n THEN dev END) AS latest_debt_to_equity FROM gr GROUP BY 1),
lg AS (UNPIVOT ft ON latest_roa, latest_net_margin, latest_gross_margin, latest_fcf_margin, positive_net_income_share, revenue_cagr, latest_debt_to_equity INTO NAME metric VALUE value),
rg(metric, family, dir, grp, mw) AS (VALUES {", ".join(f"('{m}', '{hs.HISTORY_METRICS[m][0]}', '{hs.HISTORY_METRICS[m][1]}', '{hs.HISTORY_METRICS[m][2]}', 1.0)" for m in METRIC_LIST)}),
st AS (SELECT metric, count(*) AS n, median(value) AS med, stddev_pop(value) AS sd FROM lg GROUP BY 1), md AS (SELECT metric, median(abs(value - med)) AS mad FROM lg JOIN st USING (metric) GROUP BY 1),
rk AS (SELECT lg.*, rank() OVER (PARTITION BY metric ORDER BY value) + (count(*) OVER (PARTITION BY metric, value) - 1) / 2.0 AS r FROM lg),
s0 AS (SELECT ticker, rk.metric, family, grp, mw, dir, n, (CASE WHEN dir = 'lower' THEN n + 1 - r ELSE r END - 0.5) / n * 100 AS pct, CASE WHEN 1.4826 * mad > 0 THEN 1.4826 * mad WHEN sd > 0 THEN sd END AS sc, value, med FROM rk JOIN st USING (metric) JOIN md USING (metric) JOIN rg USING (metric)),
s1 AS (SELECT *, CASE WHEN sc IS NULL THEN 50.0 ELSE 50 + 50 * CASE WHEN dir = 'lower' THEN -1 ELSE 1 END * greatest(-2.5, least(2.5, (value - med) / sc)) / 2.5 END AS rb FROM s0),
ms AS (SELECT *, CASE WHEN n >= 5 THEN 50 + (0.7 * pct + 0.3 * rb - 50) * n / (n + 10.0) END AS score FROM s1)"""


def shortlist(spark, folder):
    f = features(spark, folder)
    long = melt(f, ["ticker"], METRIC_LIST)
    lower = [m for m in METRIC_LIST if hs.HISTORY_METRICS[m][1] == "lower"]
    directed = long.withColumn("direction", F.when(F.col("metric").isin(lower), "lower").otherwise("higher"))
    return hs.shortlist_scores(directed, [], PARAMS)


@query("shortlist_metric_scores", f"WITH {SHORTLIST} SELECT ft.ticker, rg.metric, round(score, 6) AS score FROM ft CROSS JOIN rg LEFT JOIN ms ON ms.ticker = ft.ticker AND ms.metric = rg.metric")
def _(spark, folder):
    return shortlist(spark, folder).select("ticker", "metric", F.round("score", 6).alias("score"))


def category_scores(spark, folder):
    registry = spark.createDataFrame([(m, hs.HISTORY_METRICS[m][0], hs.HISTORY_METRICS[m][2], 1.0) for m in METRIC_LIST], "metric string, family string, duplicate_group string, metric_weight double")
    weights = spark.createDataFrame(list(WEIGHTS.items()), "family string, family_weight double")
    return hs.weighted_families(settle(shortlist(spark, folder)).select("ticker", "metric", "score"), registry, weights)


CATEGORY = f"""{SHORTLIST}, fw(family, fw) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in WEIGHTS.items())}), al AS (SELECT t.ticker, rg.*, ms.score FROM (SELECT ticker FROM ft) t CROSS JOIN rg LEFT JOIN ms ON ms.ticker = t.ticker AND ms.metric = rg.metric),
g1 AS (SELECT ticker, family, grp, sum(mw) AS cf, sum(CASE WHEN score IS NOT NULL THEN mw ELSE 0 END) AS pr, sum(score * mw) / nullif(sum(CASE WHEN score IS NOT NULL THEN mw ELSE 0 END), 0) AS gs FROM al GROUP BY 1, 2, 3),
f1 AS (SELECT ticker, family, count(*) AS gc, count(CASE WHEN gs IS NOT NULL AND pr / cf >= 0.5 THEN 1 END) AS ug, sum(CASE WHEN gs IS NOT NULL AND pr / cf >= 0.5 THEN gs END) AS sm FROM g1 GROUP BY 1, 2),
f2 AS (SELECT f1.*, fw, CASE WHEN CAST(ug AS DOUBLE) / gc >= 0.5 THEN sm / nullif(ug, 0) END AS fs FROM f1 JOIN fw USING (family)),
t1 AS (SELECT ticker, sum(CASE WHEN fs IS NOT NULL THEN fw ELSE 0 END) AS ap, sum(fw) AS cw, sum(fs * fw) AS nu FROM f2 GROUP BY 1),
lo AS (SELECT f2.ticker, min((nu - coalesce(fs * fw, 0)) / nullif(ap - CASE WHEN fs IS NOT NULL THEN fw ELSE 0 END, 0)) AS lm FROM f2 JOIN t1 USING (ticker) GROUP BY 1)"""


@query("category_scores", f"WITH {CATEGORY} SELECT ticker, round(nu / nullif(ap, 0), 6) AS final_score, round(ap / cw, 6) AS weight_coverage, round(lm, 6) AS leave_one_out_min FROM t1 JOIN lo USING (ticker)")
def _(spark, folder):
    final, _, _ = category_scores(spark, folder)
    return final.select("ticker", *[F.round(c, 6).alias(c) for c in ("final_score", "weight_coverage", "leave_one_out_min")])


@query("category_contributions", f"""WITH {CATEGORY} SELECT al.ticker, al.metric, round(CASE WHEN gs IS NOT NULL AND pr / cf >= 0.5 AND fs IS NOT NULL THEN gs * al.mw / cf / ug END, 6) AS family_contribution,
    round(CASE WHEN gs IS NOT NULL AND pr / cf >= 0.5 AND fs IS NOT NULL THEN gs * al.mw / cf / ug * fw / ap END, 5) AS final_contribution FROM al JOIN g1 USING (ticker, family, grp) JOIN f2 USING (ticker, family) JOIN t1 USING (ticker)""")
def _(spark, folder):
    _, _, metrics = category_scores(spark, folder)
    return metrics.select("ticker", "metric", F.round("family_contribution", 6).alias("family_contribution"), F.round("final_contribution", 5).alias("final_contribution"))


GATED = f"""{CATEGORY}, {trend_sql('a', 'rev', True)}, {trend_sql('b', 'nm')},
gt AS (SELECT t1.ticker, round(nu / nullif(ap, 0), 9) AS final_score, round(ap / cw, 9) AS cov, ft.*, (CASE WHEN a.slope IS NOT NULL THEN 1.0 ELSE 0 END * 2 + CASE WHEN b.slope IS NOT NULL THEN 1.0 ELSE 0 END) / 3 AS hr, ((0.5 + 0.5 * coalesce(a.r2, 0)) * 2 + (0.5 + 0.5 * coalesce(b.r2, 0))) / 3 AS fr
  FROM t1 JOIN ft ON ft.ticker = t1.ticker LEFT JOIN af a ON a.ticker = t1.ticker LEFT JOIN bf b ON b.ticker = t1.ticker),
gg AS (SELECT *, round(cov * hr * fr, 9) AS rel, final_score >= 50 AS g1x, positive_net_income_share >= 0.5 AS g2x FROM gt)"""


def gated_table(spark, folder):
    final, families, _ = category_scores(spark, folder)
    joined = settle(final.join(features(spark, folder), "ticker").withColumns({"final_score": F.round("final_score", 9), "weight_coverage": F.round("weight_coverage", 9)}))
    rel = hs.trend_reliability(joined, {"revenue": 2.0, "net_margin": 1.0}, "weight_coverage").withColumn("effective_trend_reliability", F.round("effective_trend_reliability", 9))
    gates = {"score_gate": F.col("final_score") >= 50, "strategy_gate": F.col("positive_net_income_share") >= 0.5}
    checks = {"history_gate": F.col("history_years") >= 4, "coverage_gate": F.col("weight_coverage") >= 0.9, "trend_reliability_gate": F.col("effective_trend_reliability") >= 0.6}
    return hs.ranked_by(hs.gated(rel, gates, checks), [], "final_score", "effective_trend_reliability", F.col("source_error_count") == 0)


@query(
    "category_gates_and_rank",
    f"""WITH {GATED} SELECT ticker, round(rel, 6) AS effective_trend_reliability, g1x AND g2x AS eligible, array_to_string(list_filter([CASE WHEN NOT g1x THEN 'score_gate' END, CASE WHEN NOT g2x THEN 'strategy_gate' END], lambda x: x IS NOT NULL), '; ') AS gate_fail_reasons,
    CASE WHEN cov >= 0.9 AND rel >= 0.6 THEN 'STANDARD_DATA' ELSE 'LIMITED_DATA' END AS data_regime, row_number() OVER (ORDER BY final_score DESC, rel DESC, ticker) AS rank FROM gg""",
)
def _(spark, folder):
    return gated_table(spark, folder).select("ticker", F.round("effective_trend_reliability", 6).alias("effective_trend_reliability"), "eligible", "gate_fail_reasons", "data_regime", "rank")


@query("category_top_names", f"WITH {GATED} SELECT * FROM (SELECT row_number() OVER (ORDER BY final_score DESC, rel DESC, ticker) AS position, ticker, round(final_score, 6) AS final_score FROM gg) WHERE position <= 15")
def _(spark, folder):
    return hs.top_summary(gated_table(spark, folder), 15, [F.round("final_score", 6).alias("final_score")])


@query("category_run_counts", f"WITH {GATED} SELECT 'Safe' AS category, count(*) AS rows, count(final_score) AS scored, count(CASE WHEN g1x AND g2x THEN 1 END) AS eligible, count(*) AS ranked, count(CASE WHEN cov >= 0.9 AND rel >= 0.6 THEN 1 END) AS standard_data, count(CASE WHEN NOT (cov >= 0.9 AND rel >= 0.6) THEN 1 END) AS limited_data FROM gg")
def _(spark, folder):
    return hs.run_counts(gated_table(spark, folder), "Safe")


@query("category_reconciliation", f"WITH {CATEGORY} SELECT ticker, round(nu / ap + 1, 6) AS final_score, round(nu / ap, 6) AS rebuilt FROM t1 WHERE ticker LIKE '%7'")
def _(spark, folder):
    # Scores of tickers ending in 7 are overstated by one point; exactly those must be reported.
    final, families, _ = category_scores(spark, folder)
    bent = final.withColumn("final_score", F.col("final_score") + F.when(F.col("ticker").endswith("7"), 1.0).otherwise(0.0))
    return hs.score_reconciliation(bent, families).select("ticker", F.round("final_score", 6).alias("final_score"), F.round("rebuilt", 6).alias("rebuilt"))


@query("category_rank_order", f"WITH {GATED}, r AS (SELECT ticker, row_number() OVER (ORDER BY final_score DESC, rel DESC, ticker) AS k FROM gg), m AS (SELECT max(k) AS n FROM r) SELECT n - a.k + 1 AS rank, a.ticker, b.ticker AS next_ticker FROM r a JOIN r b ON b.k = a.k - 1 CROSS JOIN m")
def _(spark, folder):
    # Ranks are reversed, so every neighbouring pair is out of order.
    t = gated_table(spark, folder)
    n = t.agg(F.max("rank").alias("_n"))
    return hs.order_violations(t.crossJoin(F.broadcast(n)).withColumn("rank", F.col("_n") - F.col("rank") + 1))


@query(
    "evidence_domain_counts",
    f"""WITH {CATEGORY}, dm(family, domain) AS (VALUES ('PROFITABILITY', 'QUALITY'), ('CASH_FLOW', 'QUALITY'), ('BALANCE_SHEET', 'RESILIENCE'), ('STABILITY', 'RESILIENCE'), ('GROWTH', 'GROWTH_TREND')),
    d AS (SELECT ticker, domain, sum(fs * fw) / nullif(sum(CASE WHEN fs IS NOT NULL THEN fw ELSE 0 END), 0) AS ds FROM f2 JOIN dm USING (family) GROUP BY 1, 2)
    SELECT f.ticker, sf AS strong_families, sd AS strong_domains FROM (SELECT ticker, count(CASE WHEN fs >= 55 THEN 1 END) AS sf FROM f2 GROUP BY 1) f JOIN (SELECT ticker, count(CASE WHEN ds >= 55 THEN 1 END) AS sd FROM d GROUP BY 1) d USING (ticker)""",
)
def _(spark, folder):
    _, families, _ = category_scores(spark, folder)
    domains = spark.createDataFrame([("PROFITABILITY", "QUALITY"), ("CASH_FLOW", "QUALITY"), ("BALANCE_SHEET", "RESILIENCE"), ("STABILITY", "RESILIENCE"), ("GROWTH", "GROWTH_TREND")], "family string, domain string")
    return hs.evidence_domains(families, domains, 55.0)


@query(
    "adverse_history_breadth",
    f"""WITH {ANNUAL}, {trend_sql('a', 'rev', True)}, {trend_sql('b', 'nm')}, {trend_sql('c', 'fm')}, {trend_sql('d', 'roa')}, {trend_sql('e', 'gm')}, {trend_sql('f', 'dev')},
    x AS (SELECT gr.ticker, count(CASE WHEN g > 0 THEN 1 END) / CAST(max(n) - 1 AS DOUBLE) AS ps, max(CASE WHEN i = n THEN ni END) AS ni, max(CASE WHEN i = n THEN nm END) AS nm, max(CASE WHEN i = n THEN fcf END) AS fcf FROM gr GROUP BY 1),
    v AS (SELECT x.*, [CASE WHEN a.slope IS NOT NULL THEN (a.slope < 0)::INT END, CASE WHEN b.slope IS NOT NULL THEN (b.slope < 0)::INT END, CASE WHEN c.slope IS NOT NULL THEN (c.slope < 0)::INT END, CASE WHEN d.slope IS NOT NULL THEN (d.slope < 0)::INT END,
      CASE WHEN e.slope IS NOT NULL THEN (e.slope < 0)::INT END, CASE WHEN f.slope IS NOT NULL THEN (f.slope > 0)::INT END, (ps < 0.5)::INT] AS t FROM x LEFT JOIN af a USING (ticker) LEFT JOIN bf b USING (ticker) LEFT JOIN cf c USING (ticker) LEFT JOIN df d USING (ticker) LEFT JOIN ef e USING (ticker) LEFT JOIN ff f USING (ticker))
    SELECT ticker, list_count(t) AS adverse_trend_observations, round(list_avg(t), 6) AS adverse_trend_breadth, CAST((ni < 0 OR nm < 0)::INT + (fcf < 0)::INT AS BIGINT) AS weak_domains FROM v""",
)
def _(spark, folder):
    a = hs.adverse_breadth(features(spark, folder))
    return a.select("ticker", F.col("adverse_trend_observations").cast("long").alias("adverse_trend_observations"), F.round("adverse_trend_breadth", 6).alias("adverse_trend_breadth"), F.col("weak_domains").cast("long").alias("weak_domains"))


@query(
    "short_history_scores",
    f"""WITH {SHORTLIST.replace(", 'higher', '", ", 'lower', '").replace("'latest_debt_to_equity', 'BALANCE_SHEET', 'lower'", "'latest_debt_to_equity', 'BALANCE_SHEET', 'higher'")} SELECT ticker, round(avg(score), 6) AS mean_short_score, count(score) AS scored FROM ms GROUP BY 1""",
)
def _(spark, folder):
    f = features(spark, folder)
    adverse = {m: d for fam in hs.SHORT_METRICS.values() for m, d in fam.items()}
    higher = [m for m in METRIC_LIST if adverse.get(m, "lower") == "higher"]
    long = melt(f, ["ticker"], METRIC_LIST).withColumn("direction", F.when(F.col("metric").isin(higher), "higher").otherwise("lower"))
    return hs.shortlist_scores(long, [], PARAMS).groupBy("ticker").agg(F.round(F.avg("score"), 6).alias("mean_short_score"), F.count("score").alias("scored"))


# --- joins ------------------------------------------------------------------------------------------


@query("one_to_one_join", "SELECT c_custkey AS k, c_mktsegment AS segment, n.o AS orders FROM customer JOIN (SELECT o_custkey, count(*) AS o FROM orders GROUP BY 1) n ON o_custkey = c_custkey")
def _(spark, folder):
    left = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    right = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    return hs.one_to_one(left, right, "k")[0]


@query("one_to_one_key_check", "SELECT o_custkey AS k, 'right' AS side, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def _(spark, folder):
    left = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"))
    return hs.one_to_one(left, table(spark, folder, "orders").select(F.col("o_custkey").alias("k")), "k")[1]


@query("lineage_join", "SELECT o_orderkey AS orderkey, c_mktsegment AS segment, c_name AS name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, folder):
    history = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("orderkey"), F.lit("old").alias("segment"), F.lit("x").alias("name_x"))
    lineage = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    return hs.with_lineage(history, lineage, "k").select("orderkey", "segment", "name")


@query("shortlist_restriction", "SELECT o_orderkey AS orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0)")
def _(spark, folder):
    short = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING' AND c_acctbal > 0").select(F.col("c_custkey").alias("ticker"))
    return hs.restrict_to_shortlist(table(spark, folder, "orders").withColumnRenamed("o_custkey", "ticker"), short).select(F.col("o_orderkey").alias("orderkey"))


@query("missing_names_appended", "SELECT c_custkey AS ticker, coalesce(n, 0) AS history_years, coalesce(n > 5, false) AS eligible, CASE WHEN n IS NULL THEN 'missing_source_history' WHEN n > 5 THEN '' ELSE 'history' END AS gate_fail_reasons FROM customer LEFT JOIN (SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def _(spark, folder):
    n = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("ticker")).agg(F.countDistinct(F.year("o_orderdate")).alias("history_years"))
    scored = n.select("ticker", "history_years", (F.col("history_years") > 5).alias("eligible"), F.when(F.col("history_years") > 5, "").otherwise("history").alias("gate_fail_reasons"))
    return hs.append_missing(scored, table(spark, folder, "customer").select(F.col("c_custkey").alias("ticker")))


@query(
    "most_complete_history",
    f"""WITH {ANNUAL}, u AS (SELECT ticker, y, pe, rn, CASE WHEN l_linestatus = 'O' THEN rev END AS rev, ni, 0 AS s FROM an UNION ALL SELECT ticker, y, pe, rn + 500, rev, CASE WHEN ni > 0 THEN ni END, 1 FROM an)
    SELECT ticker, y AS fiscal_year, round(rev, 4) AS revenue, round(ni / 7, 4) AS net_income FROM (SELECT *, row_number() OVER (PARTITION BY ticker, y ORDER BY pe DESC, (rev IS NOT NULL)::INT + (ni IS NOT NULL)::INT DESC, s DESC, rn DESC) AS k FROM u) WHERE k = 1""",
)
def _(spark, folder):
    a = annual_rows(spark, folder).withColumn("ticker", F.upper(F.trim("ticker")))
    one = a.select("ticker", "fiscal_year", "fiscal_period_end", "source_row", F.when(F.col("l_linestatus") == "O", F.col("revenue")).alias("revenue"), "net_income")
    two = a.select("ticker", "fiscal_year", "fiscal_period_end", (F.col("source_row") + 500).alias("source_row"), "revenue", F.when(F.col("net_income") > 0, F.col("net_income")).alias("net_income"))
    m = hs.merge_histories([one, two], ["revenue", "net_income"])
    return m.select("ticker", "fiscal_year", F.round("revenue", 4).alias("revenue"), F.round(F.col("net_income") / 7, 4).alias("net_income"))


@query("shortlist_difference", "SELECT c_mktsegment AS category, c_custkey AS ticker, CASE WHEN c_acctbal > 8000 THEN 'added' ELSE 'removed' END AS change FROM customer WHERE c_acctbal > 8000 OR c_acctbal < 1000")
def _(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("category"), F.col("c_custkey").alias("ticker"), "c_acctbal")
    return hs.shortlist_difference(c.where("c_acctbal <= 8000"), c.where("c_acctbal >= 1000"))


# --- integrity --------------------------------------------------------------------------------------

AUDIT = f"""{ANNUAL},
ar AS (SELECT ticker, CASE WHEN l_linestatus = 'F' AND y % 2 = 0 THEN y + 1 ELSE y END AS y, rn, CASE WHEN roa > 1.26 THEN make_date(y, 12, 31) ELSE pe END AS pe, rev * CASE WHEN de > 0.13 THEN 400 ELSE 1 END AS cap, rev / 100 AS sh, CASE WHEN nm > 0.007 THEN 110.0 ELSE 100.0 END AS px,
  CASE WHEN fcf > 0 THEN pe + 30 ELSE pe - 1 END AS filed, ni FROM an),
ru AS (SELECT ticker, pe, y, min(rn) AS lo, max(rn) AS hi FROM ar GROUP BY 1, 2, 3), rv AS (SELECT *, lag(y) OVER w AS p, lead(y) OVER w AS nx FROM ru WINDOW w AS (PARTITION BY ticker, pe ORDER BY y)),
rd AS (SELECT lo AS rn FROM rv WHERE p IS NOT NULL UNION SELECT hi FROM rv WHERE nx IS NOT NULL),
fy AS (SELECT ticker, y, arg_min(cap, rn) AS cap, min(rn) AS rn FROM ar GROUP BY 1, 2), fj AS (SELECT *, lag(cap) OVER w AS pc, lead(cap) OVER w AS nc FROM fy WINDOW w AS (PARTITION BY ticker ORDER BY y)),
cj AS (SELECT rn FROM fj WHERE greatest(cap, pc) >= 20 * least(cap, pc) AND pc IS NOT NULL OR greatest(cap, nc) >= 20 * least(cap, nc) AND nc IS NOT NULL),
fl AS (SELECT ar.*, array_to_string(list_filter([CASE WHEN rn IN (SELECT rn FROM rd) THEN 'DUPLICATE_PERIOD_END_ACROSS_FISCAL_YEARS' END, CASE WHEN abs(cap / (sh * px) - 1) > 0.05 THEN 'MARKET_CAP_PRICE_SHARES_MISMATCH' END, CASE WHEN filed < pe THEN 'FILING_BEFORE_PERIOD_END' END,
  CASE WHEN filed > DATE '2001-10-01' THEN 'FILING_AFTER_ANALYSIS_DATE' END, CASE WHEN rn IN (SELECT rn FROM cj) THEN 'MARKET_CAP_JUMP_20X' END], lambda x: x IS NOT NULL), '; ') AS flags FROM ar)"""


def audit(spark, folder):
    a = annual_rows(spark, folder)
    pe = F.when(F.col("roa") > 1.26, F.make_date(F.col("fiscal_year"), F.lit(12), F.lit(31))).otherwise(F.col("fiscal_period_end"))
    rows = a.select(
        "ticker", "source_row", F.when((F.col("l_linestatus") == "F") & (F.col("fiscal_year") % 2 == 0), F.col("fiscal_year") + 1).otherwise(F.col("fiscal_year")).alias("fiscal_year"), pe.alias("fiscal_period_end"),
        (F.col("revenue") * F.when(F.col("debt_to_equity") > 0.13, 400).otherwise(1)).alias("market_cap"), F.lit(None).cast("double").alias("shares_jump"), (F.col("revenue") / 100).alias("shares"), F.when(F.col("net_margin") > 0.007, 110.0).otherwise(100.0).alias("price"),
        F.when(F.col("free_cash_flow") > 0, F.date_add("fiscal_period_end", 30)).otherwise(F.date_add("fiscal_period_end", -1)).alias("filed"), F.when(F.col("net_income") > 0, F.col("net_income")).alias("net_income"), "revenue",
    )
    return hs.audit_rows(rows, None, F.lit(AS_OF).cast("date"), essential=["revenue", "net_income"], provenance=["filed", "accession"], statement=["revenue", "net_income", "total_assets"])


@query("source_row_audit", f"""WITH {AUDIT} SELECT rn AS source_row, flags AS integrity_flags, CASE WHEN ni > 0 THEN '' ELSE 'net_income' END AS missing_essential, 'accession' AS missing_provenance, round(CASE WHEN ni > 0 THEN 2 ELSE 1 END / 3.0, 6) AS statement_coverage, 'LIMITED_DATA' AS data_regime FROM fl""")
def _(spark, folder):
    return audit(spark, folder).select("source_row", "integrity_flags", "missing_essential", "missing_provenance", F.round("statement_coverage", 6).alias("statement_coverage"), "data_regime")


@query("source_integrity_gate", f"""WITH {AUDIT}, g AS (SELECT ticker, bool_and(flags = '') AS clean, arg_max(CASE WHEN ni > 0 THEN '' ELSE 'net_income' END, strftime(pe, '%Y%m%d') || lpad(CAST(rn AS VARCHAR), 20, '0')) AS me FROM fl GROUP BY 1)
    SELECT ticker, clean AS source_integrity_pass, me = '' AS source_essential_pass, clean AS eligible, CASE WHEN clean THEN 'score_gate' ELSE 'score_gate; source_integrity' END AS gate_fail_reasons, CASE WHEN clean THEN 'LIMITED_DATA' ELSE 'DATA_FAILURE' END AS data_regime FROM g""")
def _(spark, folder):
    audited = audit(spark, folder).withColumn("ticker", F.upper(F.trim("ticker")))
    names = audited.select("ticker").distinct().select("ticker", F.lit(True).alias("eligible"), F.lit("score_gate").alias("gate_fail_reasons"), F.lit("STANDARD_DATA").alias("data_regime"), F.lit("").alias("data_regime_reasons"))
    return hs.integrity_gate(names, audited).select("ticker", "source_integrity_pass", "source_essential_pass", "eligible", "gate_fail_reasons", "data_regime")


@query("research_handoff", f"""WITH {AUDIT}, q AS (SELECT 'S' || s_suppkey AS ticker, s_acctbal AS b FROM supplier), rr AS (SELECT ticker, string_agg(DISTINCT f, '; ' ORDER BY f) AS fs FROM (SELECT ticker, unnest(string_split(flags, '; ')) AS f FROM fl) WHERE f <> '' GROUP BY 1)
    SELECT q.ticker, array_to_string(list_filter([CASE WHEN b <= 1000 THEN 'NO_RANKABLE_FOUR_YEAR_SCORE' END, CASE WHEN b <= 500 THEN 'MISSING_OR_INCOMPLETE_SOURCE_HISTORY' END, CASE WHEN q.ticker NOT IN (SELECT ticker FROM fl) THEN 'NO_SOURCE_AUDIT' ELSE fs END, 'FIELD_PROVENANCE_INCOMPLETE',
      CASE WHEN b <= 5000 THEN 'PRIMARY_POINT_IN_TIME_UNVERIFIED' END], lambda x: x IS NOT NULL), '; ') AS blockers, 'DATA REVIEW' AS disposition FROM q LEFT JOIN rr ON rr.ticker = q.ticker""")
def _(spark, folder):
    s = table(spark, folder, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"), F.lit("Safe").alias("category"), F.col("s_acctbal").alias("b"))
    candidates = s.select("category", "ticker", F.when(F.col("b") > 5000, "VERIFIED_POINT_IN_TIME").alias("pit_status"))
    scored = s.select("category", "ticker", F.col("b").alias("score"), F.when(F.col("b") > 1000, 1).alias("rank"), F.when(F.col("b") > 500, 4).alias("history_years"), F.lit(True).alias("ttm_verified"))
    audited = audit(spark, folder).withColumn("ticker", F.upper(F.trim("ticker"))).withColumn("category", F.lit("Safe"))
    return hs.handoff(candidates, scored, audited).select("ticker", "blockers", "disposition")


@query("research_status", f"""WITH {AUDIT}, q AS (SELECT 'S' || s_suppkey AS ticker, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank FROM supplier), g AS (SELECT ticker, bool_and(flags = '') AS clean, arg_max(CASE WHEN ni > 0 THEN '' ELSE 'x' END, strftime(pe, '%Y%m%d') || lpad(CAST(rn AS VARCHAR), 20, '0')) AS me FROM fl GROUP BY 1)
    SELECT q.ticker, rank, array_to_string(list_filter([CASE WHEN NOT coalesce(clean, false) THEN 'SOURCE_INTEGRITY_REVIEW' END, 'FIELD_LINEAGE_INCOMPLETE', CASE WHEN coalesce(me, '') <> '' THEN 'LATEST_ESSENTIAL_FIELDS_MISSING' END], lambda x: x IS NOT NULL), '; ') AS research_blockers FROM q LEFT JOIN g ON g.ticker = q.ticker WHERE rank <= 60""")
def _(spark, folder):
    from gaugework.plans.ordered import numbered

    s = table(spark, folder, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"), F.lit("Safe").alias("category"), "s_acctbal", "s_suppkey")
    ranked = numbered(s, [], [F.desc("s_acctbal"), F.col("s_suppkey")], "rank")
    audited = audit(spark, folder).withColumn("ticker", F.upper(F.trim("ticker"))).withColumn("category", F.lit("Safe"))
    return hs.research_status(ranked, audited, 60).select("ticker", "rank", "research_blockers")
