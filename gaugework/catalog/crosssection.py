"""Cross-section scoring: customers as names, nations as industries, regions as sectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.catalog.registry import query, table
from gaugework.functions.numbers import steady_sum
from gaugework.operators import crosssection as cs
from gaugework.operators import features as ft
from gaugework.params import SnapshotParams, checked_weights
from gaugework.plans.settle import settle

METRICS = ["balance", "order_count", "order_value", "average_order"]
PARAMS = SnapshotParams(max_longs=40, max_shorts=30, min_long_score=55.0, min_short_score=55.0)


def customer_snapshot(spark, folder):
    size = F.ln("o_totalprice")
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").cast("double").alias("order_count"), steady_sum(F.col("o_totalprice")).alias("order_value"), (steady_sum(size, 15) / F.count(size)).alias("average_order")
    )
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("industry"), F.col("r_name").alias("sector"))
    return table(spark, folder, "customer").join(places, "c_nationkey").join(orders, "c_custkey", "left").select(
        F.col("c_name").alias("ticker"), F.col("c_custkey").alias("source_row"), "industry", "sector", F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"), "order_count", "order_value", "average_order",
    )


def customer_long(spark, folder):
    return cs.melt(customer_snapshot(spark, folder), ["ticker", "source_row", "industry", "sector"], METRICS)


SNAP = """
snap AS (
  SELECT c_name AS ticker, c_custkey AS source_row, n_name AS industry, r_name AS sector, c_mktsegment AS segment, c_acctbal AS balance, order_count, order_value, average_order
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS order_count, sum(o_totalprice) AS order_value, avg(ln(o_totalprice)) AS average_order FROM orders GROUP BY 1) ON o_custkey = c_custkey),
lng AS (
  SELECT ticker, source_row, industry, sector, 'balance' AS metric, balance AS value FROM snap UNION ALL SELECT ticker, source_row, industry, sector, 'order_count', order_count FROM snap
  UNION ALL SELECT ticker, source_row, industry, sector, 'order_value', order_value FROM snap UNION ALL SELECT ticker, source_row, industry, sector, 'average_order', average_order FROM snap)"""


def _level(key: str, p: str) -> str:
    return f"""
{p}m AS (SELECT {key}, metric, count(*) AS n, avg(value) AS mean, var_pop(value) AS var, median(value) AS med FROM lng WHERE value IS NOT NULL GROUP BY 1, 2),
{p}d AS (SELECT {key}, metric, median(abs(value - med)) AS mad FROM lng JOIN {p}m USING ({key}, metric) WHERE value IS NOT NULL GROUP BY 1, 2),
{p}r AS (SELECT source_row, metric, rank() OVER (PARTITION BY {key}, metric ORDER BY value) + (count(*) OVER (PARTITION BY {key}, metric, value) - 1) / 2.0 AS rk FROM lng WHERE value IS NOT NULL),
{p}p AS (SELECT l.source_row, l.metric, m.n, m.mean, m.var, m.med, d.mad, CASE WHEN m.n = 1 THEN 50.0 ELSE (r.rk - 1) / (m.n - 1) * 100 END AS pct
  FROM lng l JOIN {p}m m USING ({key}, metric) JOIN {p}d d USING ({key}, metric) JOIN {p}r r ON r.source_row = l.source_row AND r.metric = l.metric)"""


PEER = f"""{SNAP}, {_level('industry', 'i')}, {_level('sector', 's')},
b0 AS (SELECT l.*, i.n AS i_n, s.n AS s_n, CASE WHEN s.n >= 5 THEN CAST(i.n AS DOUBLE) / (i.n + 8.0) END AS w, i.mean AS im, s.mean AS sm, i.var AS iv, s.var AS sv,
  i.med AS imed, s.med AS smed, i.mad AS imad, s.mad AS smad, i.pct AS ip, s.pct AS sp
  FROM lng l LEFT JOIN ip i ON i.source_row = l.source_row AND i.metric = l.metric LEFT JOIN sp s ON s.source_row = l.source_row AND s.metric = l.metric),
b1 AS (SELECT *, w * im + (1 - w) * sm AS m, w * imed + (1 - w) * smed AS med, w * imad + (1 - w) * smad AS mad, w * ip + (1 - w) * sp AS pct FROM b0),
b2 AS (SELECT *, sqrt(w * (iv + (im - m) ** 2) + (1 - w) * (sv + (sm - m) ** 2)) AS sd0 FROM b1),
b3 AS (SELECT *, CASE WHEN sd0 <= 1e-12 * greatest(1.0, abs(m)) THEN 0.0 ELSE sd0 END AS sd FROM b2),
b4 AS (SELECT *, CASE WHEN sd = 0 THEN 0.0 WHEN sd > 0 THEN (value - m) / sd END AS z, CASE WHEN sd <> 0 AND mad > 0 THEN 0.6745 * (value - med) / mad END AS rz FROM b3),
peer AS (SELECT *, CASE WHEN sd = 0 THEN 50.0 ELSE 50 + 50 * greatest(-3.0, least(3.0, coalesce(rz, z))) / 3 END AS rs FROM b4),
ps AS (SELECT *, CASE WHEN w IS NOT NULL AND value IS NOT NULL THEN 0.5 * pct + 0.5 * rs END AS score FROM peer)"""


def peer_scores(spark, folder):
    return cs.peer_statistics(customer_long(spark, folder), PARAMS)


@query(
    "peer_statistics",
    f"""WITH {PEER} SELECT source_row, metric, CASE WHEN w IS NOT NULL THEN 'Industry/sector shrinkage' ELSE 'INSUFFICIENT SECTOR PEERS' END AS comparison,
    CAST(i_n AS DOUBLE) AS industry_n, CAST(s_n AS DOUBLE) AS sector_n, round(w, 6) AS industry_weight, round(m, 5) AS peer_mean, round(med, 5) AS peer_median, round(sd, 5) AS peer_std, round(mad, 5) AS peer_mad,
    round(pct, 6) AS percentile, round(z, 6) AS z, round(rz, 6) AS robust_z, round(score, 6) AS peer_score FROM ps""",
)
def _(spark, folder):
    p = peer_scores(spark, folder)
    return p.select(
        "source_row", "metric", "comparison", F.col("industry_n").cast("double").alias("industry_n"), F.col("sector_n").cast("double").alias("sector_n"), F.round("industry_weight", 6).alias("industry_weight"),
        *[F.round(c, 5).alias(c) for c in ("peer_mean", "peer_median", "peer_std", "peer_mad")],
        *[F.round(c, 6).alias(c) for c in ("percentile", "z", "robust_z", "peer_score")],
    )


@query(
    "group_percentile_and_z",
    f"""WITH {SNAP}, sl AS (SELECT source_row, segment, order_count AS value FROM snap),
    m AS (SELECT segment, count(value) AS n, avg(value) AS mean, var_pop(value) AS var, median(value) AS med FROM sl GROUP BY 1),
    d AS (SELECT segment, median(abs(value - med)) AS mad FROM sl JOIN m USING (segment) GROUP BY 1),
    r AS (SELECT source_row, rank() OVER (PARTITION BY segment ORDER BY value) + (count(*) OVER (PARTITION BY segment, value) - 1) / 2.0 AS rk FROM sl WHERE value IS NOT NULL)
    SELECT sl.source_row, round((rk - 1) / (n - 1) * 100, 6) AS percentile, round((value - mean) / sqrt(var), 6) AS z, round(0.6745 * (value - med) / mad, 6) AS robust_z
    FROM sl JOIN m USING (segment) JOIN d USING (segment) LEFT JOIN r USING (source_row)""",
)
def _(spark, folder):
    rows = customer_snapshot(spark, folder).select("source_row", "segment", F.col("order_count").alias("value"))
    s = cs.standard_scores(rows, ["segment"])
    return s.select("source_row", *[F.round(c, 6).alias(c) for c in ("percentile", "z", "robust_z")])


# --- composite ------------------------------------------------------------------------------------

REGISTRY = [
    ("balance", "VALUATION", "higher_better", "cash", 1.0, 1.0),
    ("order_count", "PROFITABILITY_AND_RETURNS", "higher_better", "activity", 1.0, 1.0),
    ("order_value", "PROFITABILITY_AND_RETURNS", "higher_better", "activity", 2.0, 1.0),
    ("average_order", "BALANCE_SHEET_AND_LEVERAGE", "lower_better", "ticket", 1.0, 1.0),
]
LW = {"VALUATION": 20.0, "PROFITABILITY_AND_RETURNS": 25.0, "BALANCE_SHEET_AND_LEVERAGE": 25.0}
SW = {"VALUATION": 25.0, "PROFITABILITY_AND_RETURNS": 25.0, "BALANCE_SHEET_AND_LEVERAGE": 30.0}

REG_SQL = "reg(metric, family, direction, grp, sw, gw) AS (VALUES " + ", ".join(f"('{m}', '{f}', '{d}', '{g}', {s}, {w})" for m, f, d, g, s, w in REGISTRY) + ")"
FAM_SQL = "fam(family, lw, shw) AS (VALUES " + ", ".join(f"('{f}', {LW[f]}, {SW[f]})" for f in LW) + ")"

# Furniture customers carry no applicable leverage signal, as a financial company would not.
COMPOSITE = f"""{PEER}, {REG_SQL}, {FAM_SQL},
c0 AS (SELECT p.source_row, p.ticker, p.industry, p.sector, r.*, f.lw, f.shw, NOT (r.family = 'BALANCE_SHEET_AND_LEVERAGE' AND s.segment = 'FURNITURE') AS app, p.score
  FROM ps p JOIN reg r USING (metric) JOIN fam f USING (family) JOIN snap s ON s.source_row = p.source_row),
c1 AS (SELECT *, CASE WHEN app THEN CASE WHEN direction = 'higher_better' THEN score ELSE 100 - score END END AS ls, CASE WHEN app THEN CASE WHEN direction = 'higher_better' THEN 100 - score ELSE score END END AS ss FROM c0),
g1 AS (SELECT source_row, family, grp, max(gw) AS gw, max(lw) AS lw, max(shw) AS shw, sum(ls * sw) / nullif(sum(CASE WHEN ls IS NOT NULL THEN sw END), 0) AS gl,
  sum(ss * sw) / nullif(sum(CASE WHEN ls IS NOT NULL THEN sw END), 0) AS gs, bool_or(app) AS ga, count(ls) AS have, count(CASE WHEN app THEN 1 END) AS want,
  count(CASE WHEN ls > 50 THEN 1 END) AS pos, count(CASE WHEN ls < 50 THEN 1 END) AS neg FROM c1 GROUP BY 1, 2, 3),
f1 AS (SELECT source_row, family, max(lw) AS lw, max(shw) AS shw, sum(CASE WHEN gl IS NOT NULL THEN gw ELSE 0 END) AS avail, sum(CASE WHEN ga THEN gw ELSE 0 END) AS tot, sum(gl * gw) AS ln, sum(gs * gw) AS sn,
  sum(CASE WHEN gl IS NOT NULL AND ga THEN gw ELSE 0 END) AS gh, sum(CASE WHEN ga THEN gw ELSE 0 END) AS gt, sum(have) AS have, sum(want) AS want, sum(pos) AS pos, sum(neg) AS neg FROM g1 GROUP BY 1, 2),
f2 AS (SELECT *, avail / nullif(tot, 0) AS cov, CASE WHEN avail > 0 AND avail / nullif(tot, 0) >= 0.5 THEN ln / avail END AS fl, CASE WHEN avail > 0 AND avail / nullif(tot, 0) >= 0.5 THEN sn / avail END AS fs FROM f1),
t1 AS (SELECT source_row, sum(CASE WHEN fl IS NOT NULL THEN lw ELSE 0 END) AS ld, sum(CASE WHEN fl IS NOT NULL THEN shw ELSE 0 END) AS sd, sum(fl * lw) AS ln, sum(fs * shw) AS sn,
  CAST(sum(have) AS DOUBLE) / nullif(sum(want), 0) AS rawcov, sum(gh) / nullif(sum(gt), 0) AS gcov, sum(CASE WHEN fl IS NOT NULL THEN lw ELSE 0 END) / nullif(sum(CASE WHEN tot > 0 THEN lw ELSE 0 END), 0) AS fcov,
  sum(CASE WHEN fl IS NOT NULL THEN shw ELSE 0 END) / nullif(sum(CASE WHEN tot > 0 THEN shw ELSE 0 END), 0) AS sfcov, sum(pos) AS pos, sum(neg) AS neg FROM f2 GROUP BY 1),
sc AS (SELECT t1.*, greatest(0.0, least(100.0, ln / nullif(ld, 0))) AS l, greatest(0.0, least(100.0, sn / nullif(sd, 0))) AS s, 100 * (0.6 * gcov + 0.4 * fcov) AS conf, 100 * (0.6 * gcov + 0.4 * sfcov) AS sconf,
  CASE WHEN gcov >= 0.7 AND fcov >= 0.7 AND ld > 0 THEN 'SUFFICIENT' ELSE 'LIMITED DATA' END AS status FROM t1)"""


def composite_scores(spark, folder):
    """(scores, family parts), joined back to identities; the peer scores are materialised once."""
    snapshot = customer_snapshot(spark, folder)
    segments = snapshot.select("ticker", "segment")
    registry = spark.createDataFrame(REGISTRY, "metric string, family string, direction string, duplicate_group string, signal_weight double, group_weight double")
    families = cs.weight_table(spark, LW, "family", "long_weight").join(cs.weight_table(spark, SW, "family", "short_weight"), "family")
    leverage = [m for m, f, *_ in REGISTRY if f == "BALANCE_SHEET_AND_LEVERAGE"]
    signals = peer_scores(spark, folder).join(segments, "ticker").select(
        "ticker", "metric", F.col("peer_score").alias("score"), (~(F.col("metric").isin(leverage) & (F.col("segment") == "FURNITURE"))).alias("applicable")
    )
    return cs.composite(settle(signals), registry, families, PARAMS)


@query(
    "composite_scores",
    f"""WITH {COMPOSITE} SELECT snap.ticker, round(l, 6) AS long_score, round(s, 6) AS short_score, round(rawcov, 6) AS raw_signal_coverage, round(gcov, 6) AS group_coverage, round(fcov, 6) AS family_coverage,
    round(conf, 6) AS confidence, round(sconf, 6) AS short_confidence, status AS data_status, CAST(pos AS BIGINT) AS positive_evidence, CAST(neg AS BIGINT) AS negative_evidence FROM sc JOIN snap USING (source_row)""",
)
def _(spark, folder):
    scores, _ = composite_scores(spark, folder)
    rounded = ["long_score", "short_score", "raw_signal_coverage", "group_coverage", "family_coverage", "confidence", "short_confidence"]
    return scores.select("ticker", *[F.round(c, 6).alias(c) for c in rounded], "data_status", "positive_evidence", "negative_evidence")


@query(
    "composite_contributions",
    f"""WITH {COMPOSITE} SELECT snap.ticker, f2.family, tot > 0 AS applicable, round(cov, 6) AS coverage, round(fl, 6) AS long_score, round(fs, 6) AS short_score,
    round(fl * f2.lw / nullif(sc.ld, 0), 6) AS long_contribution, round(fs * f2.shw / nullif(sc.sd, 0), 6) AS short_contribution FROM f2 JOIN sc USING (source_row) JOIN snap USING (source_row)""",
)
def _(spark, folder):
    _, parts = composite_scores(spark, folder)
    return parts.select("ticker", "family", "applicable", *[F.round(c, 6).alias(c) for c in ("coverage", "long_score", "short_score", "long_contribution", "short_contribution")])


STRATEGIES = {"Safe": {"VALUATION": 10.0, "PROFITABILITY_AND_RETURNS": 25.0, "BALANCE_SHEET_AND_LEVERAGE": 35.0}, "Turnaround Story": {"VALUATION": 30.0, "PROFITABILITY_AND_RETURNS": 15.0, "BALANCE_SHEET_AND_LEVERAGE": 30.0}}
STRAT_SQL = "wt(strategy, family, w) AS (VALUES " + ", ".join(f"('{s}', '{f}', {w})" for s, ws in STRATEGIES.items() for f, w in ws.items()) + ")"


@query(
    "strategy_scores",
    f"""WITH {COMPOSITE}, {STRAT_SQL},
    st AS (SELECT source_row, strategy, sum(CASE WHEN fl IS NOT NULL AND tot > 0 THEN w ELSE 0 END) AS ap, sum(CASE WHEN tot > 0 THEN w ELSE 0 END) AS cf, sum(CASE WHEN tot > 0 THEN fl * w END) AS nu,
      count(CASE WHEN fl IS NOT NULL AND tot > 0 THEN 1 END) AS comp, count(CASE WHEN tot > 0 THEN 1 END) AS structural FROM f2 JOIN wt USING (family) GROUP BY 1, 2),
    tv AS (SELECT source_row, max(CASE WHEN family = 'VALUATION' THEN fl END) AS v, max(CASE WHEN family = 'PROFITABILITY_AND_RETURNS' THEN fl END) AS p FROM f2 GROUP BY 1),
    x AS (SELECT st.*, snap.ticker, snap.industry, greatest(0.0, least(100.0, nu / nullif(ap, 0))) AS raw, CASE WHEN strategy = 'Safe' THEN balance > 0 ELSE coalesce(v >= 55 AND p <= 50, false) END AS gate FROM st JOIN snap USING (source_row) JOIN tv USING (source_row)),
    y AS (SELECT *, coalesce(gate, false) AND raw IS NOT NULL AS elig FROM x)
    SELECT ticker, strategy, round(ap / nullif(cf, 0), 6) AS weight_coverage, comp AS components, structural - comp AS components_missing, round(raw, 6) AS raw_score, elig AS eligible,
      round(CASE WHEN elig THEN raw END, 6) AS score, CAST(CASE WHEN elig THEN row_number() OVER (PARTITION BY strategy, elig ORDER BY round(raw, 9) DESC, lower(ticker)) END AS DOUBLE) AS universe_rank FROM y""",
)
def _(spark, folder):
    _, parts = composite_scores(spark, folder)
    parts = settle(parts)
    snapshot = customer_snapshot(spark, folder).select("ticker", "source_row", "industry", "balance")
    weights = spark.createDataFrame([(s, f, w) for s, ws in STRATEGIES.items() for f, w in ws.items()], "strategy string, family string, weight double")
    safe = snapshot.select("ticker", F.lit("Safe").alias("strategy"), (F.col("balance") > 0).alias("gate_pass"))
    turn = cs.turnaround_setup(parts, PARAMS).select("ticker", F.lit("Turnaround Story").alias("strategy"), F.col("setup_pass").alias("gate_pass"))
    scored = cs.strategy_scores(parts, weights, safe.unionByName(turn), PARAMS).join(snapshot.drop("balance"), "ticker")
    placed = cs.ranked(scored.withColumn("score", F.round("score", 9)), ["strategy"], "score", "universe_rank")
    return placed.select(
        "ticker", "strategy", F.round("weight_coverage", 6).alias("weight_coverage"), "components", "components_missing", F.round("raw_score", 6).alias("raw_score"), "eligible",
        F.when(F.col("eligible"), F.round("raw_score", 6)).alias("score"), F.col("universe_rank").cast("double").alias("universe_rank"),
    )


@query(
    "short_thesis_gate",
    f"""WITH {COMPOSITE} SELECT ticker, count(CASE WHEN fs >= 60 THEN 1 END) AS weak_families, count(CASE WHEN fs >= 60 AND family <> 'VALUATION' THEN 1 END) AS weak_beyond_value,
    count(CASE WHEN fs >= 60 THEN 1 END) >= 2 AND count(CASE WHEN fs >= 60 AND family <> 'VALUATION' THEN 1 END) > 0 AS thesis_pass FROM f2 JOIN snap USING (source_row) GROUP BY 1""",
)
def _(spark, folder):
    _, parts = composite_scores(spark, folder)
    return cs.short_thesis(parts, SnapshotParams(short_min_weak_families=2, short_weak_score=60.0))


SELECTION = f"""{COMPOSITE},
th AS (SELECT source_row, count(CASE WHEN fs >= 60 THEN 1 END) >= 2 AND count(CASE WHEN fs >= 60 AND family <> 'VALUATION' THEN 1 END) > 0 AS thesis FROM f2 GROUP BY 1),
q0 AS (SELECT snap.*, round(l, 9) AS long_score, round(s, 9) AS short_score, round(conf, 9) AS confidence, round(sconf, 9) AS short_confidence, status, balance > 0 AS lg, thesis AS sg FROM sc JOIN snap USING (source_row) JOIN th USING (source_row)),
q1 AS (SELECT *, coalesce(lg AND long_score >= 55, false) AS lp, coalesce(sg AND short_score >= 55, false) AS sp0 FROM q0),
q2 AS (SELECT *, lp AND sp0 AS conflict, lp AND (NOT (lp AND sp0) OR long_score >= short_score) AS lpool, sp0 AND (NOT (lp AND sp0) OR long_score < short_score) AS spool FROM q1),
q3 AS (SELECT *, CASE WHEN lpool THEN row_number() OVER (PARTITION BY industry, lpool ORDER BY long_score DESC, lower(ticker)) END AS lr, CASE WHEN spool THEN row_number() OVER (PARTITION BY industry, spool ORDER BY short_score DESC, lower(ticker)) END AS sr FROM q2),
q4 AS (SELECT *, coalesce(lr <= 3, false) AS le, coalesce(sr <= 3, false) AS se FROM q3),
q5 AS (SELECT *, CASE WHEN le THEN row_number() OVER (PARTITION BY le ORDER BY long_score DESC, confidence DESC, lower(ticker)) END AS lu, CASE WHEN se THEN row_number() OVER (PARTITION BY se ORDER BY short_score DESC, short_confidence DESC, lower(ticker)) END AS su FROM q4),
sel AS (SELECT *, CASE WHEN lu <= 40 THEN 'QUANT LONG' WHEN su <= 30 THEN 'QUANT SHORT' ELSE '' END AS candidate FROM q5)"""


def selected_candidates(spark, folder):
    scores, parts = composite_scores(spark, folder)
    scores, parts = settle(scores), settle(parts)
    snapshot = customer_snapshot(spark, folder).select("ticker", "source_row", "industry", "sector", "balance")
    thesis = cs.short_thesis(parts, SnapshotParams(short_min_weak_families=2, short_weak_score=60.0))
    rounded = scores.withColumns({c: F.round(c, 9) for c in ("long_score", "short_score", "confidence", "short_confidence")})
    ready = rounded.join(snapshot, "ticker").join(thesis, "ticker").withColumn("long_gate", F.col("balance") > 0).withColumnRenamed("thesis_pass", "short_gate")
    return cs.select_candidates(ready, PARAMS)


@query(
    "candidate_selection",
    f"WITH {SELECTION} SELECT ticker, round(long_score, 6) AS long_score, round(short_score, 6) AS short_score, conflict, CAST(lr AS DOUBLE) AS long_rank, CAST(sr AS DOUBLE) AS short_rank, le AS long_eligible, se AS short_eligible, candidate FROM sel",
)
def _(spark, folder):
    s = selected_candidates(spark, folder)
    return s.select("ticker", F.round("long_score", 6).alias("long_score"), F.round("short_score", 6).alias("short_score"), "conflict", F.col("long_rank").cast("double").alias("long_rank"), F.col("short_rank").cast("double").alias("short_rank"), "long_eligible", "short_eligible", "candidate")


@query(
    "short_candidate_view",
    f"""WITH {SELECTION} SELECT ticker, array_to_string(list_filter([CASE WHEN short_score IS NULL THEN 'Scored' END, CASE WHEN NOT coalesce(short_score >= 55, false) THEN 'Score' END,
      CASE WHEN NOT coalesce(sg, false) THEN 'Thesis' END, CASE WHEN NOT coalesce(sr <= 3, false) THEN 'Industry rank' END], lambda x: x IS NOT NULL), ' | ') AS rejection_reasons,
    CAST(su AS DOUBLE) AS universe_rank, CAST(CASE WHEN su <= 30 THEN su END AS DOUBLE) AS short_display_rank FROM sel""",
)
def _(spark, folder):
    v = cs.short_view(selected_candidates(spark, folder), {"Thesis": "short_gate"}, PARAMS)
    return v.select("ticker", "rejection_reasons", F.col("universe_rank").cast("double").alias("universe_rank"), F.col("short_display_rank").cast("double").alias("short_display_rank"))


@query(
    "industry_summary",
    f"""WITH {SELECTION} SELECT industry, min(sector) AS sector, count(*) AS stocks, count(CASE WHEN status = 'SUFFICIENT' THEN 1 END) AS sufficient_stocks, count(CASE WHEN candidate = 'QUANT LONG' THEN 1 END) AS quant_longs,
    count(CASE WHEN candidate = 'QUANT SHORT' THEN 1 END) AS quant_shorts, round(stddev_pop(long_score - short_score), 5) AS net_score_std, round(avg(confidence), 6) AS average_confidence,
    arg_max(ticker, long_score) AS top_long, round(max(long_score), 6) AS top_long_score, round(median(long_score), 6) AS median_long_score, round(median(short_score), 6) AS median_short_score,
    round(median(long_score - short_score), 6) AS median_net_score FROM sel GROUP BY 1""",
)
def _(spark, folder):
    s = selected_candidates(spark, folder).withColumn("net_score", F.col("long_score") - F.col("short_score"))
    out = cs.industry_summary(settle(s))
    return out.select("industry", "sector", "stocks", "sufficient_stocks", "quant_longs", "quant_shorts", F.round("net_score_std", 5).alias("net_score_std"), "top_long", *[F.round(c, 6).alias(c) for c in ("average_confidence", "top_long_score", "median_long_score", "median_short_score", "median_net_score")])


@query(
    "universe_and_industry_rank",
    f"""WITH {SNAP} SELECT ticker, CAST(CASE WHEN order_value IS NOT NULL THEN row_number() OVER (PARTITION BY industry, order_value IS NULL ORDER BY order_value DESC, lower(ticker), source_row) END AS DOUBLE) AS industry_rank,
    CAST(CASE WHEN order_count IS NOT NULL THEN row_number() OVER (PARTITION BY order_count IS NULL ORDER BY order_count DESC, lower(ticker), source_row) END AS DOUBLE) AS universe_rank FROM snap""",
)
def _(spark, folder):
    s = customer_snapshot(spark, folder)
    both = cs.ranked(cs.ranked(s, ["industry"], "order_value", "industry_rank"), [], "order_count", "universe_rank")
    return both.select("ticker", F.col("industry_rank").cast("double").alias("industry_rank"), F.col("universe_rank").cast("double").alias("universe_rank"))


@query(
    "selection_assertions",
    f"""WITH {SELECTION} SELECT rule, count(*) AS violations FROM (
      SELECT 'industry limit' AS rule FROM sel WHERE candidate <> '' GROUP BY industry, candidate HAVING count(*) > 1
      UNION ALL SELECT 'global limit' FROM sel WHERE candidate <> '' GROUP BY candidate HAVING count(*) > 20
      UNION ALL SELECT 'gate or threshold' FROM sel WHERE (candidate = 'QUANT LONG' AND long_score < 60) OR (candidate = 'QUANT SHORT' AND short_score < 60)) GROUP BY 1""",
)
def _(spark, folder):
    strict = SnapshotParams(top_per_industry=1, max_longs=20, max_shorts=20, min_long_score=60.0, min_short_score=60.0)
    return cs.selection_violations(settle(selected_candidates(spark, folder)), strict).groupBy("rule").agg(F.count("*").alias("violations"))


@query(
    "contribution_reconciliation",
    f"""WITH {COMPOSITE} SELECT ticker, round(l, 6) AS long_score, round(l + 0.5, 6) AS rebuilt_long FROM sc JOIN snap USING (source_row) WHERE segment = 'MACHINERY' AND l IS NOT NULL""",
)
def _(spark, folder):
    # One family of every machinery customer is overstated by half a point; exactly those must be reported.
    scores, parts = composite_scores(spark, folder)
    scores, parts = settle(scores), settle(parts)
    machinery = customer_snapshot(spark, folder).where("segment = 'MACHINERY'").select("ticker", F.lit(0.5).alias("_extra"))
    first = parts.where(F.col("long_contribution").isNotNull()).groupBy("ticker").agg(F.min("family").alias("family")).join(machinery, "ticker")
    bent = parts.join(first, ["ticker", "family"], "left").withColumn("long_contribution", F.col("long_contribution") + F.coalesce("_extra", F.lit(0.0)))
    return cs.contribution_violations(scores, bent).select("ticker", F.round("long_score", 6).alias("long_score"), F.round("rebuilt_long", 6).alias("rebuilt_long"))


@query(
    "rank_gap_assertion",
    f"""WITH {SNAP}, r AS (SELECT industry, source_row, row_number() OVER (PARTITION BY industry ORDER BY balance DESC, lower(ticker)) AS k, balance FROM snap), x AS (SELECT * FROM r WHERE balance <= 5000)
    SELECT industry, count(*) AS n, count(DISTINCT k) AS "distinct", min(k) AS low, max(k) AS high FROM x GROUP BY 1 HAVING min(k) <> 1 OR max(k) <> count(*)""",
)
def _(spark, folder):
    s = cs.ranked(customer_snapshot(spark, folder), ["industry"], "balance", "rank")
    flawed = s.withColumn("rank", F.when(F.col("balance") <= 5000, F.col("rank")))
    return cs.rank_gaps(flawed, ["industry"], "rank")


# --- row rules --------------------------------------------------------------------------------------


def fundamentals(spark, folder):
    """Parts as companies: fields derived from price, size and their order lines; zeros and gaps are real."""
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum("l_extendedprice").alias("sales"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("cogs"), F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice"))).alias("ebitda"),
        F.sum("l_quantity").alias("average_volume"), F.sqrt(F.avg("l_discount")).alias("beta"), F.max("l_extendedprice").alias("high_52w"), F.min("l_extendedprice").alias("low_52w"),
    )
    p = table(spark, folder, "part").join(lines, "p_partkey", "left")
    size = F.col("p_size").cast("double")
    return p.select(
        F.col("p_partkey").alias("source_row"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker"), F.col("p_type").alias("industry"), F.col("p_brand").alias("sector"),
        "sales", "cogs", "ebitda", "average_volume", "beta", "high_52w", "low_52w", F.col("p_retailprice").alias("last_close"), (size - 5).alias("pe_f1"), (size - 10).alias("pe_f2"), (25 - size).alias("trailing_pe"),
        (size - 3).alias("eps_f1"), F.when(size != 20, size - 7).alias("eps_f2"), (size - 15).alias("trailing_eps"), (size * 100 - 500).alias("common_equity"), F.when(size != 30, size * 90).alias("long_term_debt"),
        (size * 4).alias("debt_total_capital_pct"), (size / 10 - 1).alias("debt_equity"), (size * 150).alias("market_cap"), F.when(size != 12, size / 10).alias("dividend"), (size / 20).alias("current_ratio"),
        F.col("p_name").alias("security_type"), F.when(size > 40, "OTC").otherwise("NYSE").alias("exchange"),
    )


FUND = """
fu AS (SELECT p_partkey AS source_row, 'P' || p_partkey AS ticker, p_type AS industry, p_brand AS sector, l.*, p_retailprice AS last_close, CAST(p_size AS DOUBLE) AS z FROM part LEFT JOIN
  (SELECT l_partkey, sum(l_extendedprice) AS sales, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS cogs, sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END) AS ebitda, sum(l_quantity) AS average_volume,
    sqrt(avg(l_discount)) AS beta, max(l_extendedprice) AS high_52w, min(l_extendedprice) AS low_52w FROM lineitem GROUP BY 1) l ON l_partkey = p_partkey)"""


@query(
    "derived_features",
    f"""WITH {FUND} SELECT ticker, round(CASE WHEN z - 5 > 0 THEN 1 / (z - 5) END, 6) AS earnings_yield_f1,
    round(CASE WHEN (z > 5)::INT + (z > 10)::INT + (z < 25)::INT > 0 THEN (coalesce(CASE WHEN z > 5 THEN 1 / (z - 5) END, 0) + coalesce(CASE WHEN z > 10 THEN 1 / (z - 10) END, 0) + coalesce(CASE WHEN z < 25 THEN 1 / (25 - z) END, 0)) / ((z > 5)::INT + (z > 10)::INT + (z < 25)::INT) END, 6) AS earnings_yield_pe_valid,
    round((z - 15) / last_close, 8) AS signed_trailing_eps_yield, round((sales - cogs) / sales, 6) AS gross_margin, round(ebitda / sales, 6) AS ebitda_margin,
    round(CASE WHEN z * 100 - 500 > 0 AND z <> 30 THEN z * 90 / (z * 100 - 500) END, 6) AS long_term_debt_equity, round(average_volume * last_close, 2) AS average_daily_dollar_volume,
    round(CASE WHEN z > 15 AND z <> 12 THEN z / 10 / (z - 15) END, 6) AS dividend_payout_ratio, round(abs(beta - 1), 6) AS beta_distance_one,
    round(CASE WHEN high_52w > low_52w THEN (last_close - low_52w) / (high_52w - low_52w) END, 6) AS range_position_reconstructed,
    CASE WHEN sales IS NULL OR cogs IS NULL THEN 'NO DATA/NOT MEANINGFUL: sales > 0' ELSE '' END AS gross_margin__reason FROM fu""",
)
def _(spark, folder):
    out = ft.default_features().apply(fundamentals(spark, folder))
    six = ["earnings_yield_f1", "earnings_yield_pe_valid", "gross_margin", "ebitda_margin", "long_term_debt_equity", "dividend_payout_ratio", "beta_distance_one", "range_position_reconstructed"]
    return out.select("ticker", *[F.round(c, 6).alias(c) for c in six], F.round("signed_trailing_eps_yield", 8).alias("signed_trailing_eps_yield"), F.round("average_daily_dollar_volume", 2).alias("average_daily_dollar_volume"), "gross_margin__reason")


@query(
    "safe_scalar_rules",
    f"""WITH {FUND} SELECT ticker, round(sales / nullif(z - 10, 0), 6) AS signed_ratio, round(CASE WHEN z - 10 > 0 THEN sales / (z - 10) END, 6) AS positive_ratio, round(CASE WHEN z > 5 THEN 1 / (z - 5) END, 6) AS inverse,
    round(CASE WHEN z > 5 THEN ln(z - 5) END, 6) AS log_value, round(sign(z - 25) * ln(1 + abs(z - 25)), 6) AS signed_log, round(z / 100, 6) AS from_percent,
    round(CASE WHEN z - 3 > 0 AND z <> 20 THEN ((z - 7) / (z - 3) - 1) * 100 END, 6) AS growth, CASE WHEN z = 20 THEN 'MISSING_INPUT' WHEN z = 3 THEN 'ZERO_BASE' WHEN z < 3 THEN 'NONPOSITIVE_BASE' END AS growth_reason FROM fu""",
)
def _(spark, folder):
    from gaugework.functions import numbers as nb

    f = fundamentals(spark, folder)
    value, reason = nb.growth_with_reason(F.col("eps_f1"), F.col("eps_f2"))
    z = F.col("pe_f1") + 5
    return f.select(
        "ticker", F.round(nb.safe_div(F.col("sales"), F.col("pe_f2")), 6).alias("signed_ratio"), F.round(nb.safe_div(F.col("sales"), F.col("pe_f2"), True), 6).alias("positive_ratio"),
        F.round(nb.inverse_positive(F.col("pe_f1")), 6).alias("inverse"), F.round(nb.natural_log(F.col("pe_f1")), 6).alias("log_value"), F.round(nb.signed_log(z - 25), 6).alias("signed_log"),
        F.round(nb.percent_to_decimal(z), 6).alias("from_percent"), F.round(value, 6).alias("growth"), reason.alias("growth_reason"),
    )


@query(
    "unit_normalisation",
    f"""WITH {FUND} SELECT ticker, round(z * 4 / 100, 6) AS debt_total_capital_ratio__normalized, 'DIVIDE_BY_100' AS debt_total_capital_ratio__rule, z * 4 / 100 > 1.5 AS debt_total_capital_ratio__scaling_warning,
    round(z / 10 - 1, 6) AS debt_equity_ratio__normalized, (z / 10 - 1 < 0 OR z / 10 - 1 > 10) AS debt_equity_ratio__scaling_warning,
    CASE WHEN z * 4 / 100 > 1.5 OR z / 10 - 1 < 0 THEN 'SCALING_WARNING' ELSE 'CONFIGURED_UNITS_APPLIED' END AS unit_scaling_status FROM fu""",
)
def _(spark, folder):
    out = ft.normalise_units(fundamentals(spark, folder))
    return out.select("ticker", F.round("debt_total_capital_ratio__normalized", 6).alias("debt_total_capital_ratio__normalized"), "debt_total_capital_ratio__rule", "debt_total_capital_ratio__scaling_warning", F.round("debt_equity_ratio__normalized", 6).alias("debt_equity_ratio__normalized"), "debt_equity_ratio__scaling_warning", "unit_scaling_status")


@query(
    "identity_cleaning",
    "SELECT trim(c_name) AS ticker, trim(c_mktsegment) AS industry, try_cast(replace(c_name, 'Customer#', '') AS DOUBLE) AS code, c_acctbal AS balance FROM customer",
)
def _(spark, folder):
    raw = table(spark, folder, "customer").select(F.concat(F.lit("  "), "c_name").alias("ticker"), F.concat("c_mktsegment", F.lit(" ")).alias("industry"), F.regexp_replace("c_name", "Customer#", "").alias("code"), F.col("c_acctbal").cast("string").alias("balance"))
    return ft.clean_identities(raw, ["ticker", "industry"])


@query(
    "universe_exclusions",
    """SELECT p_partkey AS source_row, CASE WHEN p_name LIKE 'small%' THEN 'blank ticker' WHEN p_type = 'PROMO' THEN 'blank sector' WHEN p_type = 'LARGE' THEN 'blank industry'
    WHEN split_part(p_name, ' ', 2) NOT IN ('ring', 'bolt') THEN 'security type excluded: ' || split_part(p_name, ' ', 2) END AS exclusion_reason FROM part""",
)
def _(spark, folder):
    p = table(spark, folder, "part").select(
        F.col("p_partkey").alias("source_row"), F.when(F.col("p_name").startswith("small"), " ").otherwise(F.col("p_name")).alias("ticker"), F.when(F.col("p_type") == "PROMO", None).otherwise("x").alias("sector"),
        F.when(F.col("p_type") == "LARGE", "").otherwise("x").alias("industry"), F.split("p_name", " ")[1].alias("security_type"),
    )
    return ft.universe(p, ["RING", "bolt"]).select("source_row", "exclusion_reason")


@query("duplicate_tickers", "SELECT lower(trim(p_name)) AS ticker, count(*) AS rows FROM part GROUP BY 1 HAVING count(*) > 1")
def _(spark, folder):
    return ft.duplicate_tickers(table(spark, folder, "part").select(F.col("p_name").alias("ticker")))


TYPES = """
bt AS (SELECT c_name AS ticker, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Mortgage REIT' WHEN 'FURNITURE' THEN 'Equity REIT' WHEN 'HOUSEHOLD' THEN 'Regional Banks' WHEN 'BUILDING' THEN 'Tools' ELSE 'Credit' END AS industry,
  CASE WHEN c_acctbal > 5000 THEN 'Finance' ELSE 'Industrial' END AS sector, c_acctbal AS bal FROM customer),
bk AS (SELECT *, CASE WHEN bal > 9500 THEN 'REAL_ESTATE' WHEN industry = 'Mortgage REIT' THEN 'MORTGAGE_FINANCE' WHEN industry = 'Equity REIT' THEN 'EQUITY_REIT' WHEN industry = 'Regional Banks' THEN 'SPECIALIST_FINANCIAL'
  WHEN sector = 'Finance' THEN 'UNCLASSIFIED_FINANCIAL' ELSE 'STANDARD_OPERATING_COMPANY' END AS kind FROM bt)"""


def typed_customers(spark, folder):
    seg = F.col("c_mktsegment")
    base = table(spark, folder, "customer").select(
        F.col("c_name").alias("ticker"), F.when(seg == "MACHINERY", "Mortgage REIT").when(seg == "FURNITURE", "Equity REIT").when(seg == "HOUSEHOLD", "Regional Banks").when(seg == "BUILDING", "Tools").otherwise("Credit").alias("industry"),
        F.when(F.col("c_acctbal") > 5000, "Finance").otherwise("Industrial").alias("sector"), F.col("c_acctbal").alias("bal"),
    )
    overrides = base.where(F.col("bal") > 9500).select("ticker", F.lit("real_estate").alias("business_type"))
    return ft.business_type(base, PARAMS, overrides)


@query(
    "business_types",
    f"""WITH {TYPES} SELECT ticker, kind AS business_type, kind NOT LIKE 'UNCLASSIFIED%' AS classification_verified, CASE WHEN bal > 9500 THEN 'CONTROL_OVERRIDE' WHEN kind LIKE 'UNCLASSIFIED%' THEN 'REVIEW_REQUIRED' ELSE 'INDUSTRY_RULE' END AS classification_note,
    kind = 'STANDARD_OPERATING_COMPANY' AS liquidity_applicable, kind IN ('STANDARD_OPERATING_COMPANY', 'EQUITY_REIT', 'REAL_ESTATE') AS leverage_applicable FROM bk""",
)
def _(spark, folder):
    return typed_customers(spark, folder).select("ticker", "business_type", "classification_verified", "classification_note", "liquidity_applicable", "leverage_applicable")


@query(
    "signal_applicability",
    f"""WITH {TYPES}, m(metric, family) AS (VALUES ('current_ratio', 'LIQUIDITY_AND_EFFICIENCY'), ('debt_equity_ratio', 'BALANCE_SHEET_AND_LEVERAGE'), ('payout_sustainability', 'SHAREHOLDER_AND_YIELD'), ('book_yield', 'VALUATION'))
    SELECT ticker, metric, NOT (family = 'LIQUIDITY_AND_EFFICIENCY' AND kind <> 'STANDARD_OPERATING_COMPANY') AND NOT (family = 'BALANCE_SHEET_AND_LEVERAGE' AND kind NOT IN ('STANDARD_OPERATING_COMPANY', 'EQUITY_REIT', 'REAL_ESTATE'))
      AND NOT (metric = 'payout_sustainability' AND kind IN ('EQUITY_REIT', 'MORTGAGE_FINANCE')) AS applicable FROM bk CROSS JOIN m""",
)
def _(spark, folder):
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(f).alias("family")) for m, f in (("current_ratio", ft.LIQ), ("debt_equity_ratio", ft.LEV), ("payout_sustainability", ft.YLD), ("book_yield", ft.VAL))])
    rows = typed_customers(spark, folder).withColumn("m", F.explode(pairs))
    return rows.select("ticker", "m.metric", ft.applicability(F.col("m.metric"), F.col("m.family")).alias("applicable"))


@query(
    "diagnostic_only_filter",
    f"""WITH {SNAP} SELECT metric, count(*) AS rows, metric IN ('average_order') AS diagnostic FROM (SELECT CASE WHEN metric = 'average_order' THEN 'gross_margin' ELSE metric END AS m2, metric FROM lng) WHERE m2 <> 'gross_margin' GROUP BY 1""",
)
def _(spark, folder):
    named = customer_long(spark, folder).withColumn("signal", F.when(F.col("metric") == "average_order", "gross_margin").otherwise(F.col("metric")))
    kept = named.where(~F.col("signal").isin(*ft.DIAGNOSTIC_ONLY))
    return kept.groupBy("metric").agg(F.count("*").alias("rows"), F.max(F.col("signal").isin(*ft.DIAGNOSTIC_ONLY)).alias("diagnostic"))


@query(
    "eps_growth_audit",
    f"""WITH {FUND} SELECT ticker, CASE WHEN z = 20 THEN 'MISSING_FORWARD_EPS' WHEN z = 3 THEN 'ZERO_BASE_NOT_MEANINGFUL' WHEN z <= 3 OR z <= 7 THEN 'NEGATIVE_BASE_CONVENTIONAL_GROWTH_INVALID' ELSE 'CONVENTIONAL_GROWTH_VALID' END AS eps_growth_reading,
    z <= 3 AS eps_base_negative, z > 7 AND z <> 20 AS eps_valid_safe, z <> 20 AS eps_valid_high_growth, z <= 7 AS eps_exemption FROM fu""",
)
def _(spark, folder):
    return ft.eps_growth(fundamentals(spark, folder)).select("ticker", "eps_growth_reading", "eps_base_negative", "eps_valid_safe", "eps_valid_high_growth", "eps_exemption")


@query(
    "margin_reconciliation",
    f"""WITH {FUND}, m AS (SELECT ticker, CASE WHEN z <> 9 THEN z / 100 END AS vendor, ebitda / sales AS derived FROM fu)
    SELECT ticker, round(abs(vendor - derived), 6) AS ebitda_margin_absolute_difference, round(abs(vendor - derived) / nullif(abs(derived), 0), 6) AS ebitda_margin_relative_difference,
      CASE WHEN vendor IS NULL THEN 'VENDOR_MARGIN_UNAVAILABLE' WHEN derived IS NULL THEN 'NUMERATOR_OR_SALES_UNAVAILABLE' WHEN abs(vendor - derived) <= 0.05 THEN 'WITHIN_TOLERANCE' ELSE 'OUTSIDE_TOLERANCE' END AS ebitda_margin_status,
      CASE WHEN abs(vendor - derived) > 0.05 THEN 'REVIEW_REQUIRED' WHEN abs(vendor - derived) <= 0.05 THEN 'TESTED' ELSE 'NOT_TESTABLE' END AS margin_status FROM m""",
)
def _(spark, folder):
    f = ft.default_features().apply(fundamentals(spark, folder), reasons=False)
    z = F.col("pe_f1") + 5
    ready = f.withColumn("vendor_margin", F.when(z != 9, z / 100))
    out = ft.margin_reconciliation(ready, {"ebitda_margin": ("vendor_margin", "ebitda_margin"), "gross_margin": (None, "gross_margin")}, 0.05)
    return out.select("ticker", F.round("ebitda_margin_absolute_difference", 6).alias("ebitda_margin_absolute_difference"), F.round("ebitda_margin_relative_difference", 6).alias("ebitda_margin_relative_difference"), "ebitda_margin_status", "margin_status")


@query(
    "reconciliation_flags",
    f"""WITH {FUND} SELECT ticker, CASE WHEN z > 9 THEN abs(last_close / (z * 20) / (z - 9) - 1) > 0.15 END AS price_book_flag, CASE WHEN z > 4 THEN abs(z * 150 / (z - 4) / last_close - 1) > 0.2 END AS cap_per_share_flag,
    CASE WHEN z <> 33 THEN abs(z + 2 * z + 10 - 100) > 2 END AS rating_percent_flag FROM fu""",
)
def _(spark, folder):
    z = F.col("pe_f1") + 5
    f = fundamentals(spark, folder).withColumns({"book_value": z * 20, "price_book": z - 9, "shares": z - 4, "bullish_pct": F.when(z != 33, z), "hold_pct": 2 * z, "bearish_pct": F.lit(10.0)})
    return ft.reconciliation_flags(f, PARAMS).select("ticker", "price_book_flag", "cap_per_share_flag", "rating_percent_flag")


@query(
    "solvency_gate",
    f"""WITH {FUND}, k AS (SELECT *, CASE industry WHEN 'PROMO' THEN 'MORTGAGE_FINANCE' WHEN 'LARGE' THEN 'EQUITY_REIT' WHEN 'SMALL' THEN 'SPECIALIST_FINANCIAL' WHEN 'ECONOMY' THEN 'UNCLASSIFIED_REIT' ELSE 'STANDARD_OPERATING_COMPANY' END AS kind,
      CASE WHEN ebitda > 0 AND z <> 30 THEN z * 90 * 2000 / ebitda END AS de2, CASE WHEN z / 10 - 1 >= 0 THEN z / 10 - 1 END AS de, z * 4 / 100 AS dc FROM fu),
    r AS (SELECT ticker, CASE kind WHEN 'UNCLASSIFIED_REIT' THEN 'BUSINESS_CLASSIFICATION_REQUIRES_REVIEW' WHEN 'MORTGAGE_FINANCE' THEN 'MORTGAGE_FINANCE_SPECIALIST_CAPITAL_DATA_UNAVAILABLE' WHEN 'SPECIALIST_FINANCIAL' THEN ''
      WHEN 'EQUITY_REIT' THEN CASE WHEN de2 > 10 THEN 'DEBT_EBITDA_ABOVE_LIMIT' WHEN de2 IS NULL THEN 'REIT_LEVERAGE_NOT_TESTABLE' ELSE '' END
      ELSE array_to_string(list_filter([CASE WHEN z * 100 - 500 <= 0 THEN 'NONPOSITIVE_EQUITY_REQUIRES_REVIEW' END, CASE WHEN de >= 2 THEN 'DEBT_EQUITY_OUTSIDE_LIMIT' END, CASE WHEN dc >= 0.75 THEN 'DEBT_TOTAL_CAPITAL_OUTSIDE_LIMIT' END,
        CASE WHEN z / 20 < 0.75 THEN 'CURRENT_RATIO_BELOW_SURVIVABILITY_FLOOR' END], lambda x: x IS NOT NULL), ' | ') END AS solvency_reasons FROM k)
    SELECT *, solvency_reasons = '' AS solvency_pass FROM r""",
)
def _(spark, folder):
    f = fundamentals(spark, folder).withColumn("ebitda", F.col("ebitda") / 2000).withColumn("ebit", F.lit(None).cast("double"))
    kind = F.col("industry")
    typed = ft.default_features().apply(f, reasons=False).withColumn(
        "business_type", F.when(kind == "PROMO", "MORTGAGE_FINANCE").when(kind == "LARGE", "EQUITY_REIT").when(kind == "SMALL", "SPECIALIST_FINANCIAL").when(kind == "ECONOMY", "UNCLASSIFIED_REIT").otherwise("STANDARD_OPERATING_COMPANY")
    ).withColumn("classification_verified", ~F.col("business_type").startswith("UNCLASSIFIED"))
    return ft.solvency_gate(typed, PARAMS).select("ticker", "solvency_reasons", "solvency_pass")


@query(
    "tradability_gates",
    f"""WITH {FUND}, x AS (SELECT ticker, z * 150 < 3000 AS small, z > 40 AS otc, average_volume * last_close * 40 AS v FROM fu)
    SELECT ticker, array_to_string(list_filter([CASE WHEN small THEN 'MARKET_CAP_BELOW_MINIMUM_OR_MISSING' END, CASE WHEN otc THEN 'OTC_NOT_ALLOWED' END, CASE WHEN v IS NULL OR v < 25000000 THEN 'DOLLAR_VOLUME_BELOW_MINIMUM_OR_MISSING' END], lambda x: x IS NOT NULL), ' | ') AS tradability_reasons,
    NOT small AND NOT otc AND coalesce(v >= 50000000, false) AS short_tradability_pass FROM x""",
)
def _(spark, folder):
    f = ft.default_features().apply(fundamentals(spark, folder), reasons=False).withColumn("average_daily_dollar_volume", F.col("average_daily_dollar_volume") * 40)
    return ft.tradability_gate(f, PARAMS).select("ticker", "tradability_reasons", "short_tradability_pass")


@query(
    "liquidity_and_payout_policy",
    f"""WITH {FUND}, q AS (SELECT ticker, (z - 25) / 8 AS cz, CASE WHEN z <> 18 THEN (z - 25) / 7 END AS wz, industry <> 'PROMO' AS app, CASE WHEN z > 15 THEN CASE WHEN z <> 12 THEN z / 10 / (z - 15) END END AS po, CASE WHEN z <> 12 THEN z / 10 END AS dv, z - 15 AS eps FROM fu)
    SELECT ticker, round(CASE WHEN app THEN CASE WHEN cz < -1 THEN 50 * (greatest(cz, -3.0) + 3) / 2 ELSE 50 END END, 6) AS liquidity_current_ratio_score, CASE WHEN app THEN cz < -1 END AS liquidity_current_ratio_distress,
    round(CASE WHEN app AND wz IS NOT NULL THEN CASE WHEN wz > 2 THEN 50 * (1 - (least(wz, 3.0) - 2)) ELSE 50 END END, 6) AS working_capital_score, CASE WHEN app AND wz IS NOT NULL THEN wz > 2 END AS excess_working_capital,
    round(CASE WHEN coalesce(dv, 0) > 0 AND eps <= 0 THEN 0 WHEN po > 0.8 THEN 50 * (1 - (least(po, 1.5) - 0.8) / 0.7) WHEN dv = 0 OR po >= 0 THEN 50 END, 6) AS payout_score,
    CASE WHEN dv IS NOT NULL OR po IS NOT NULL THEN (coalesce(dv, 0) > 0 AND eps <= 0) OR coalesce(po > 0.8, false) END AS unsustainable_payout FROM q""",
)
def _(spark, folder):
    z = F.col("pe_f1") + 5
    f = ft.default_features().apply(fundamentals(spark, folder), reasons=False)
    ready = f.withColumns({"current_ratio_z": (z - 25) / 8, "quick_ratio_z": F.lit(None).cast("double"), "cash_ratio_z": F.lit(None).cast("double"), "working_capital_z": F.when(z != 18, (z - 25) / 7), "liquidity_applicable": F.col("industry") != "PROMO"})
    out = ft.liquidity_policy(ready, PARAMS)
    return out.select("ticker", F.round("liquidity_current_ratio_score", 6).alias("liquidity_current_ratio_score"), "liquidity_current_ratio_distress", F.round("working_capital_score", 6).alias("working_capital_score"), "excess_working_capital", F.round("payout_score", 6).alias("payout_score"), "unsustainable_payout")


@query(
    "optionability_flag",
    "SELECT o_orderkey AS orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN false WHEN '3-MEDIUM' THEN NULL WHEN '5-LOW' THEN true ELSE false END AS optionable FROM orders",
)
def _(spark, folder):
    p = F.col("o_orderpriority")
    text = F.when(p == "1-URGENT", " Yes").when(p == "2-HIGH", "N").when(p == "3-MEDIUM", "No Data").when(p == "5-LOW", "OPTIONABLE").otherwise("never")
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"), ft.optionability(text).alias("optionable"))


@query(
    "coverage_audit",
    f"""WITH {SNAP}, c AS (SELECT ticker, (CASE WHEN balance > 0 THEN 1 ELSE 0 END + CASE WHEN order_count IS NOT NULL THEN 1 ELSE 0 END) / 2.0 * 100 AS g1, CASE WHEN order_value IS NOT NULL THEN 100.0 ELSE 0.0 END AS g2, 0.0 AS g3, order_count / 12.0 AS rc FROM snap),
    d AS (SELECT *, (g1 + g2 + g3) / 3 AS u, greatest(0.0, least(100.0, rc * 100)) AS q FROM c)
    SELECT ticker, round(g1, 6) AS base_coverage, round(u, 6) AS underwriting_coverage, round(CASE WHEN rc IS NOT NULL THEN greatest(0.0, least(100.0, 0.6 * q + 0.4 * u)) END, 6) AS data_quality,
    CASE WHEN rc IS NOT NULL AND q >= 70 THEN 'STANDARD_DATA' ELSE 'LIMITED_DATA' END AS data_regime, CASE WHEN u < 60 THEN 'SCREENING_QUALITY_ONLY' WHEN u < 75 THEN 'MATERIALLY_INCOMPLETE' WHEN u < 90 THEN 'ANALYST_REVIEW_REQUIRED' ELSE 'CLOSE_TO_MEMO_READINESS' END AS readiness FROM d""",
)
def _(spark, folder):
    s = customer_snapshot(spark, folder).withColumn("balance", F.when(F.col("balance") > 0, F.col("balance"))).withColumn("rc", F.col("order_count") / 12)
    out = ft.coverage_audit(s, {"base": ["balance", "order_count"], "orders": ["order_value"], "prices": ["historical_prices"]}, "rc")
    return out.select("ticker", *[F.round(c, 6).alias(c) for c in ("base_coverage", "underwriting_coverage", "data_quality")], "data_regime", "readiness")


@query(
    "metric_availability",
    f"""WITH {SNAP}, t AS (SELECT avg(CASE WHEN order_value IS NOT NULL AND balance IS NOT NULL THEN 1.0 ELSE 0.0 END) AS s FROM snap)
    SELECT 'wallet' AS metric, 'order_value | balance' AS required_fields, 'order_value | balance' AS present_fields, '' AS missing_fields, true AS active, round(s, 6) AS populated_share FROM t
    UNION ALL SELECT 'net_debt', 'balance | cash', 'balance', 'cash', false, NULL""",
)
def _(spark, folder):
    out = ft.metric_availability(customer_snapshot(spark, folder), {"wallet": ["order_value", "balance"], "net_debt": ["balance", "cash"]})
    return out.withColumn("populated_share", F.round("populated_share", 6))


@query(
    "parameterised_weights",
    f"""WITH {SNAP} SELECT ticker, round((0.25 * balance + 0.75 * order_value) / 1.0, 4) AS weighted FROM snap""",
)
def _(spark, folder):
    from gaugework.params import HistoryParams, with_overrides

    controls = spark.createDataFrame([("decay", "0.25")], "name string, value string")
    params = with_overrides(HistoryParams(), controls, {"decay": (0.0, 1.0)})
    w = checked_weights({"balance": params.decay, "order_value": 1 - params.decay}, 1.0)
    return customer_snapshot(spark, folder).select("ticker", F.round(w["balance"] * F.col("balance") + w["order_value"] * F.col("order_value"), 4).alias("weighted"))
