"""Claim comparison, states, factors and summaries: customers as companies, orders as dated statements and outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.catalog.crosssection import SELECTION, SNAP, composite_scores, customer_snapshot, selected_candidates
from gaugework.catalog.registry import query, table
from gaugework.functions import text as tx
from gaugework.operators import factors as fa
from gaugework.operators import quality as ql
from gaugework.operators import state as sa
from gaugework.operators import summary as su
from gaugework.plans.settle import settle

C = F.col


def statement_claims(spark, folder, plain: bool = False):
    """Orders as claims of their fiscal years; with ``plain`` no claim states a direction and all share their wording."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("y"), "o_orderdate")
    million = F.round(C("o_totalprice") / 1000).cast("int").cast("string")
    move = F.when(C("o_orderstatus") == "F", "grew").when(C("o_orderstatus") == "O", "declined").otherwise("was stable")
    text = F.concat(F.lit("Revenue "), move, F.lit(" to $"), million, F.lit(" million in order "), C("o_orderkey").cast("string")) if not plain else F.concat(F.lit("Revenue was $"), million, F.lit(" million in the period"))
    return o.select(
        C("o_orderkey").cast("string").alias("claim_id"), C("o_custkey").cast("string").alias("ticker"), C("o_orderkey").cast("string").alias("document_id"), C("y").alias("fiscal_year"), F.lit(None).cast("int").alias("fiscal_quarter"),
        F.concat(F.lit("FY "), C("y").cast("string")).alias("period_label"), F.lit("ANNUAL_ACTUAL").alias("period_type"), F.lit("revenue").alias("dimension"), F.lit("revenue").alias("topic"),
        F.lit("unknown").alias("direction") if plain else F.when(C("o_orderstatus") == "F", "increasing").when(C("o_orderstatus") == "O", "decreasing").otherwise("stable").alias("direction"),
        F.lit("actual").alias("certainty"), tx.magnitudes(text).alias("magnitude"), text.alias("evidence_text"), F.to_date("o_orderdate").alias("available_date"),
    )


# Claims of one wording are all equally alike, so the current claims take the previous ones in id order.
PAIRED = """
fy AS (SELECT o_custkey AS ticker, year(o_orderdate) AS y, CAST(o_orderkey AS VARCHAR) AS id, CAST(round(o_totalprice / 1000) AS INTEGER) AS m FROM orders),
fc AS (SELECT *, dense_rank() OVER (PARTITION BY ticker ORDER BY y DESC) AS back, row_number() OVER (PARTITION BY ticker, y ORDER BY id) AS k FROM fy),
pc AS (SELECT b.ticker, b.id, a.id AS old, a.m AS before, b.m AS after FROM (SELECT * FROM fc WHERE back = 1) b LEFT JOIN (SELECT * FROM fc WHERE back = 2) a ON a.ticker = b.ticker AND a.k = b.k)"""


@query("period_changes", f"WITH {PAIRED} SELECT CAST(ticker AS VARCHAR) AS ticker, old AS from_claim, id AS to_claim, CASE WHEN after = before THEN 'reiterated' WHEN after > before THEN 'increasing' ELSE 'decreasing' END AS change_type, 'numeric_metric_comparison' AS method, 0.92 AS confidence FROM pc WHERE old IS NOT NULL UNION ALL SELECT CAST(ticker AS VARCHAR), NULL, min(id), 'newly_mentioned', 'current_period_only', 0.64 FROM pc WHERE old IS NULL GROUP BY ticker")
def _(spark, folder):
    changes, _ = sa.compare_periods(settle(statement_claims(spark, folder, True)))
    return changes.select("ticker", "from_claim", "to_claim", "change_type", "method", "confidence")


@query("period_changes_of_all_statements")
def _(spark, folder):
    changes, _ = sa.compare_periods(settle(statement_claims(spark, folder)))
    return changes.select("change_id", "ticker", "subject", "change_type", "direction", "confidence", "method")


@query("change_members", f"WITH {PAIRED} SELECT CAST(ticker AS VARCHAR) AS ticker, side, count(*) AS claims FROM (SELECT ticker, 'previous' AS side FROM pc WHERE old IS NOT NULL UNION ALL SELECT ticker, 'current' FROM pc) GROUP BY 1, 2")
def _(spark, folder):
    changes, members = sa.compare_periods(settle(statement_claims(spark, folder, True)))
    return members.join(changes.select("change_id", "ticker"), "change_id").groupBy("ticker", "side").agg(F.count("*").alias("claims"))


@query("missing_change_evidence", f"WITH {PAIRED} SELECT id AS claim_id FROM pc")
def _(spark, folder):
    # Every claim of each ticker's current period is withheld, so each current membership must be reported.
    claims = settle(statement_claims(spark, folder, True))
    _, members = sa.compare_periods(claims)
    known = sa.period_pair(claims).where("side = 'previous'")
    return ql.missing_references(members.select("change_id", F.array("claim_id").alias("ids")), "ids", known, "claim_id", "change_id").select(C("missing_id").alias("claim_id"))


STATES = """
sc AS (SELECT o_custkey AS ticker, o_orderkey AS k, o_orderstatus AS s, max(year(o_orderdate)) OVER (PARTITION BY o_custkey) AS my, year(o_orderdate) AS y FROM orders),
ss AS (SELECT ticker, count(*) AS g, count(CASE WHEN s = 'F' THEN 1 END) AS p, count(CASE WHEN s = 'O' THEN 1 END) AS n, count(CASE WHEN s NOT IN ('F', 'O') THEN 1 END) AS u FROM sc WHERE y = my GROUP BY 1),
s2 AS (SELECT *, CASE WHEN p + n > 0 THEN (p - n) / CAST(p + n AS DOUBLE) END AS w, CASE WHEN p > 0 AND n > 0 THEN least(p, n) ELSE 0 END AS ct FROM ss),
s3 AS (SELECT *, CASE WHEN p > 0 AND n > 0 AND abs(w) < 0.45 THEN 'mixed' WHEN w >= 0.65 THEN CASE WHEN p >= 3 THEN 'strong' ELSE 'healthy' END WHEN w > 0 THEN 'healthy' WHEN w <= -0.65 THEN CASE WHEN n > 0 THEN 'stressed' ELSE 'weak' END WHEN w < 0 THEN 'weak' ELSE 'neutral' END AS st,
  CASE WHEN p > 0 THEN 'improving' ELSE 'unknown' END AS tr FROM s2)"""


@query("current_states", f"WITH {STATES} SELECT CAST(ticker AS VARCHAR) AS ticker, g AS evidence_groups, p AS positive, n AS negative, st AS current_state, tr AS trend, CAST(ct AS BIGINT) AS contradictions FROM s3")
def _(spark, folder):
    return states(spark, folder).select("ticker", "evidence_groups", "positive", "negative", "current_state", "trend", C("contradictions").cast("long").alias("contradictions"))


def states(spark, folder):
    claims = settle(statement_claims(spark, folder))
    current = sa.period_pair(claims).where("side = 'current'")
    none = spark.createDataFrame([], "ticker string, dimension string, subject string, change_type string, direction string")
    return settle(sa.synthesize_states(current, none)).where("topic IS NULL")


@query("state_confidence", f"""WITH {STATES} SELECT CAST(ticker AS VARCHAR) AS ticker, round_even(least(CASE WHEN st = 'unknown' THEN 0.58 ELSE 1 END, 0.15 + 0.20 * least(1, g / 3.0) + 0.22 + 0.20 * greatest(0.25, 1 - 0.65 * ct) + 0.10 * CASE WHEN tr <> 'unknown' THEN 0.72 ELSE 0.45 END + 0.08 * 0.86 + 0.05), 4) AS confidence FROM s3""")
def _(spark, folder):
    return states(spark, folder).select("ticker", F.round("confidence", 4).alias("confidence"))


@query("claim_polarity", """SELECT o_orderkey AS orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END AS polarity, CASE o_orderstatus WHEN 'O' THEN -1 ELSE 0 END AS absolute, o_orderstatus IN ('F') AS comparative FROM orders""")
def _(spark, folder):
    c, s = statement_claims(spark, folder), C("evidence_text")
    return c.select(C("claim_id").cast("long").alias("orderkey"), tx.claim_polarity(s, C("direction"), C("dimension")).alias("polarity"), tx.absolute_signal(s, C("dimension")).alias("absolute"), tx.is_comparative(s).alias("comparative"))


@query("comparable_periods", "WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY y DESC) AS k FROM y) SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(y AS BIGINT) AS fiscal_year, CASE k WHEN 1 THEN 'current' ELSE 'previous' END AS side FROM r WHERE k <= 2")
def _(spark, folder):
    o = table(spark, folder, "orders").select(C("o_custkey").cast("string").alias("ticker"), F.year("o_orderdate").alias("fiscal_year"), F.lit(None).cast("int").alias("fiscal_quarter"), F.lit("ANNUAL_ACTUAL").alias("period_type"))
    return sa.period_pair(o).select("ticker", C("fiscal_year").cast("long").alias("fiscal_year"), "side").distinct()


# --- factors ------------------------------------------------------------------------------------------------


@query("ordinal_and_band_maps", "SELECT o_orderkey AS orderkey, CASE o_orderstatus WHEN 'F' THEN 100.0 WHEN 'O' THEN 25.0 END AS mapped, CASE WHEN o_totalprice / 40000 < 1 THEN 25.0 WHEN o_totalprice / 40000 < 5 THEN 50.0 WHEN o_totalprice / 40000 < 10 THEN 75.0 ELSE 100.0 END AS band FROM orders")
def _(spark, folder):
    label = F.when(C("o_orderstatus") == "F", "BEAT").when(C("o_orderstatus") == "O", "miss").otherwise("other")
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), fa.ordinal(label, fa.GUIDANCE_MAP).alias("mapped"), fa.banded(C("o_totalprice") / 40000, fa.OWNERSHIP_BANDS).alias("band"))


def factor_rows(spark, folder):
    o = table(spark, folder, "orders").select(C("o_custkey").cast("string").alias("ticker"), "o_orderstatus", "o_orderpriority", "o_totalprice", F.lit("DIRECT").alias("attribution"), (C("o_totalprice") - 200000).alias("percent_change"))
    guidance = fa.outcome_factor(o.withColumn("outcome", F.when(C("o_orderstatus") == "F", "BEAT").when(C("o_orderstatus") == "O", "MISS").otherwise("UNRESOLVED")), "management_guidance_reliability", "outcome", fa.GUIDANCE_MAP, 3)
    operating = fa.operating_factor(o)
    owned = fa.ownership_factor(table(spark, folder, "customer").select(C("c_custkey").cast("string").alias("ticker"), F.when(C("c_acctbal") >= 0, C("c_acctbal") / 1000).alias("known_insider_percent")))
    deals = fa.trade_factor(o.select("ticker", F.lit(True).alias("is_open_market"), F.when(C("o_orderpriority") < "3", "open_market_purchase").when(C("o_orderpriority") < "5", "open_market_sale").otherwise("gift").alias("transaction_type")))
    return guidance.unionByName(operating).unionByName(owned).unionByName(deals)


FACT = """
og AS (SELECT o_custkey AS ticker, count(CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 END) AS gn, avg(CASE o_orderstatus WHEN 'F' THEN 100.0 WHEN 'O' THEN 25.0 END) AS gs, count(*) AS onn, count(CASE WHEN o_totalprice > 200000 THEN 1 END) AS ou,
  count(CASE WHEN o_orderpriority < '5' THEN 1 END) AS tn, count(CASE WHEN o_orderpriority < '3' THEN 1 END) AS tb FROM orders GROUP BY 1),
fs AS (SELECT ticker, 'management_guidance_reliability' AS factor, CASE WHEN gn >= 3 THEN gs END AS score, CASE WHEN gn >= 3 THEN 'SCORED' ELSE 'INSUFFICIENT_SAMPLE' END AS status, least(1.0, gn / 3.0) AS cov, CASE WHEN gn >= 3 THEN round_even((1 + least(1.0, 0.5 + 0.15 * least(gn, 4)) + least(1.0, 0.5 + 0.1 * least(gn, 5))) / 3, 4) WHEN gn > 0 THEN round_even(least(1.0, 0.5 + 0.1 * least(gn, 5)), 4) ELSE 0.0 END AS conf FROM og
  UNION ALL SELECT ticker, 'management_operating_execution', CASE WHEN onn >= 3 THEN 50 + 50 * (ou / CAST(onn AS DOUBLE) * 2 - 1) END, CASE WHEN onn >= 3 THEN 'SCORED' ELSE 'INSUFFICIENT_SAMPLE' END, least(1.0, onn / 3.0), CASE WHEN onn >= 3 THEN round_even((1 + least(1.0, 0.5 + 0.15 * least(onn, 4)) + least(1.0, 0.5 + 0.1 * least(onn, 5))) / 3, 4) WHEN onn > 0 THEN round_even(least(1.0, 0.5 + 0.1 * least(onn, 5)), 4) ELSE 0.0 END FROM og
  UNION ALL SELECT c_custkey, 'insider_ownership_alignment', CASE WHEN c_acctbal >= 0 THEN CASE WHEN c_acctbal / 1000 < 1 THEN 25.0 WHEN c_acctbal / 1000 < 5 THEN 50.0 WHEN c_acctbal / 1000 < 10 THEN 75.0 ELSE 100.0 END END, CASE WHEN c_acctbal >= 0 THEN 'SCORED' ELSE 'UNSCORED' END, CASE WHEN c_acctbal >= 0 THEN 1.0 ELSE 0.0 END, CASE WHEN c_acctbal >= 0 THEN 0.825 ELSE 0.0 END FROM customer
  UNION ALL SELECT ticker, 'insider_transaction_activity', CASE WHEN tn > 0 THEN 50 + 50 * (2 * tb - tn) / CAST(tn AS DOUBLE) END, CASE WHEN tn > 0 THEN 'SCORED' ELSE 'UNSCORED' END, CASE WHEN tn > 0 THEN 1.0 ELSE 0.0 END, CASE WHEN tn > 0 THEN round_even((1 + least(1.0, 0.5 + 0.15 * least(tn, 4)) + least(1.0, 0.5 + 0.1 * least(tn, 5))) / 3, 4) ELSE 0.0 END FROM og)"""


@query("factor_scores", f"WITH {FACT} SELECT CAST(ticker AS VARCHAR) AS ticker, factor, round(score, 6) AS score, status, round(cov, 6) AS coverage FROM fs")
def _(spark, folder):
    return factor_rows(spark, folder).select("ticker", "factor", F.round("score", 6).alias("score"), "status", F.round("coverage", 6).alias("coverage"))


@query(
    "factor_confidence",
    f"""WITH {FACT}, n AS (SELECT ticker, 'management_guidance_reliability' AS factor, gn AS n FROM og UNION ALL SELECT ticker, 'management_operating_execution', onn FROM og)
    SELECT CAST(ticker AS VARCHAR) AS ticker, factor, CASE WHEN n >= 3 THEN round_even((1 + least(1.0, 0.5 + 0.15 * least(n, 4)) + least(1.0, 0.5 + 0.1 * least(n, 5))) / 3, 4) WHEN n > 0 THEN least(1.0, 0.5 + 0.1 * least(n, 5)) ELSE 0.0 END AS confidence FROM n""",
)
def _(spark, folder):
    return factor_rows(spark, folder).where(C("factor").startswith("management_")).select("ticker", "factor", "confidence")


PILLARS = """
rg(factor, pillar, w, mc) AS (VALUES """ + ", ".join(f"('{f}', '{p}', {w}, {m})" for f, p, w, m in fa.FACTORS) + """),
gd AS (SELECT c.c_custkey AS ticker, rg.*, fs.score, coalesce(fs.status, 'UNSCORED') AS status, coalesce(fs.cov, 0) AS cov, coalesce(fs.conf, 0) AS conf FROM customer c CROSS JOIN rg LEFT JOIN fs ON fs.ticker = c.c_custkey AND fs.factor = rg.factor),
el AS (SELECT *, status = 'SCORED' AND score IS NOT NULL AND cov >= mc AS ok FROM gd),
pl AS (SELECT ticker, pillar, sum(w) AS cw, sum(CASE WHEN ok THEN w ELSE 0 END) AS ew, sum(CASE WHEN ok THEN w * score END) / nullif(sum(CASE WHEN ok THEN w ELSE 0 END), 0) AS calc, sum(w * cov) / sum(w) AS ev, sum(CASE WHEN ok THEN w * cov ELSE 0 END) / sum(w) AS sc, count(CASE WHEN ok THEN 1 END) AS n, sum(CASE WHEN ok THEN w * conf ELSE 0 END) AS cf FROM el GROUP BY 1, 2)"""


def pillar_tables(spark, folder):
    tickers = table(spark, folder, "customer").select(C("c_custkey").cast("string").alias("ticker"))
    return fa.aggregate_pillars(settle(fa.complete_factors(spark, factor_rows(spark, folder), tickers)))


@query("pillar_scores", f"WITH {FACT}, {PILLARS} SELECT CAST(ticker AS VARCHAR) AS ticker, pillar, round(CASE WHEN n > 0 AND sc >= 0.7 THEN calc END, 6) AS score, round(calc, 6) AS calculated_score, round(ev, 6) AS evidence_coverage, round(sc, 6) AS scoring_coverage, CASE WHEN n = 0 THEN 'UNSCORED' WHEN sc < 0.7 THEN 'INSUFFICIENT_SCORING_COVERAGE' ELSE 'SCORED' END AS status, round_even(coalesce(cf / nullif(ew, 0), 0), 4) AS confidence FROM pl")
def _(spark, folder):
    p, _ = pillar_tables(spark, folder)
    return p.select("ticker", "pillar", *[F.round(c, 6).alias(c) for c in ("score", "calculated_score", "evidence_coverage", "scoring_coverage")], "status", F.round("confidence", 4).alias("confidence"))


@query("company_scores", f"WITH {FACT}, {PILLARS}, w(pillar, pw) AS (VALUES ('MANAGEMENT_EXECUTION', 0.6), ('INSIDER_ALIGNMENT', 0.4)), t AS (SELECT ticker, sum(pw * ev) AS ev, sum(pw * sc) AS sc FROM pl JOIN w USING (pillar) GROUP BY 1), cc AS (SELECT ticker, round_even(coalesce(sum(CASE WHEN status = 'SCORED' AND score IS NOT NULL THEN w * conf END) / sum(CASE WHEN status = 'SCORED' AND score IS NOT NULL THEN w END), 0), 4) AS confidence FROM gd GROUP BY 1) SELECT CAST(t.ticker AS VARCHAR) AS ticker, confidence, round(ev, 6) AS evidence_coverage, round(sc, 6) AS scoring_coverage, 'INSUFFICIENT_SCORING_COVERAGE' AS score_status, 'business_quality_revenue_state; business_quality_demand_state' AS critical_missing FROM t JOIN cc USING (ticker)")
def _(spark, folder):
    p, f = pillar_tables(spark, folder)
    s = fa.company_scores(p, f, spark, {"MANAGEMENT_EXECUTION": 0.6, "INSIDER_ALIGNMENT": 0.4})
    return s.select("ticker", F.round("evidence_coverage", 6).alias("evidence_coverage"), F.round("scoring_coverage", 6).alias("scoring_coverage"), "score_status", "critical_missing", F.round("confidence", 4).alias("confidence"))


@query("factor_explanations", f"WITH {FACT}, {PILLARS} SELECT CAST(ticker AS VARCHAR) AS ticker, factor, round(CASE WHEN ok THEN el.w / ew END, 6) AS effective_weight, round(CASE WHEN ok THEN el.w / ew * score END, 6) AS contribution, CASE WHEN status = 'SCORED' THEN 'VALID' ELSE 'INSUFFICIENT_EVIDENCE' END AS audit_class FROM el JOIN pl USING (ticker, pillar)")
def _(spark, folder):
    _, f = pillar_tables(spark, folder)
    return fa.factor_audit(f).select("ticker", "factor", F.round("effective_weight", 6).alias("effective_weight"), F.round("contribution", 6).alias("contribution"), "audit_class")


@query("shared_factor_evidence", "SELECT CAST(o_custkey AS VARCHAR) AS ticker, o_orderstatus AS record_id, count(DISTINCT o_orderpriority) AS factors FROM orders GROUP BY 1, 2 HAVING count(DISTINCT o_orderpriority) > 1")
def _(spark, folder):
    support = table(spark, folder, "orders").select(C("o_custkey").cast("string").alias("ticker"), C("o_orderpriority").alias("factor"), C("o_orderstatus").alias("record_id"))
    groups = support.select("factor").distinct().withColumn("dependency_group", F.lit("g"))
    return fa.shared_evidence(support, groups).select("ticker", "record_id", "factors")


@query("state_factors", f"WITH {STATES} SELECT CAST(ticker AS VARCHAR) AS ticker, CAST(CASE tr WHEN 'improving' THEN 75 END AS DOUBLE) AS score, CASE WHEN tr IN ('improving') THEN 'SCORED' ELSE 'UNKNOWN' END AS status FROM s3")
def _(spark, folder):
    return fa.state_factors(states(spark, folder)).where("factor = 'trajectory_revenue_trend'").select("ticker", "score", "status")


@query("cluster_factor", "WITH s AS (SELECT o_custkey, bool_or(o_orderpriority < '2') AS b, bool_or(o_orderpriority >= '2' AND o_orderpriority < '3') AS x FROM orders GROUP BY 1) SELECT CAST(c_custkey AS VARCHAR) AS ticker, CASE WHEN b THEN 100.0 WHEN x THEN 0.0 END AS score FROM customer LEFT JOIN s ON o_custkey = c_custkey")
def _(spark, folder):
    tickers = table(spark, folder, "customer").select(C("c_custkey").cast("string").alias("ticker"))
    clusters = table(spark, folder, "orders").where("o_orderpriority < '3'").select(C("o_custkey").cast("string").alias("ticker"), F.when(C("o_orderpriority") < "2", "purchase").otherwise("sale").alias("side"))
    return fa.cluster_factor(tickers, clusters).select("ticker", "score")


@query("board_factors", "SELECT CAST(c_custkey AS VARCHAR) AS ticker, CASE WHEN c_acctbal > 0 THEN 60.0 END AS independence, CASE c_mktsegment WHEN 'BUILDING' THEN 100.0 WHEN 'FURNITURE' THEN 35.0 END AS leadership FROM customer")
def _(spark, folder):
    n = F.lit(None).cast("double")
    b = table(spark, folder, "customer").select(
        C("c_custkey").cast("string").alias("ticker"), F.lit(6).alias("independent"), F.when(C("c_acctbal") > 0, 9).otherwise(3).alias("known_independence"), F.lit(10).alias("board_size"),
        F.when(C("c_mktsegment") == "BUILDING", "SEPARATE_INDEPENDENT_CHAIR").when(C("c_mktsegment") == "FURNITURE", "CEO_CHAIR_WITHOUT_LEAD_INDEPENDENT_DIRECTOR").otherwise("UNKNOWN").alias("leadership"),
        F.lit(3).alias("required_committees"), F.lit(2).alias("independent_committees"), F.lit(1).alias("audit_committees"), F.lit(1).alias("financial_experts"), n.alias("average_outside_boards"), F.lit(3).alias("rights_known"), F.lit(2).alias("rights_positive"), F.lit(5).alias("rights_total"),
    )
    f = fa.board_factors(b)
    return f.groupBy("ticker").agg(F.max(F.when(C("factor") == "governance_board_independence", C("score"))).alias("independence"), F.max(F.when(C("factor") == "governance_leadership_structure", C("score"))).alias("leadership"))


# --- summaries -------------------------------------------------------------------------------------------------


@query("candidate_summary", f"WITH {SELECTION} SELECT ticker, candidate, round(CASE WHEN candidate = 'QUANT LONG' THEN long_score ELSE short_score END, 6) AS score, CAST(CASE WHEN candidate = 'QUANT LONG' THEN lr ELSE sr END AS DOUBLE) AS industry_rank, CASE WHEN status = 'SUFFICIENT' THEN 'NONE' ELSE 'LIMITED DATA' END AS risk_flags FROM sel WHERE candidate <> ''")
def _(spark, folder):
    selected = settle(selected_candidates(spark, folder))
    _, parts = composite_scores(spark, folder)
    s = su.candidate_summary(selected, parts)
    return s.select("ticker", "candidate", F.round("score", 6).alias("score"), C("industry_rank").cast("double").alias("industry_rank"), "risk_flags")


@query("strategy_summary", f"WITH {SNAP}, r AS (SELECT segment AS strategy, ticker, order_value, row_number() OVER (PARTITION BY segment ORDER BY order_value DESC, lower(ticker)) AS position FROM snap WHERE order_value >= 1000000) SELECT strategy, position, ticker, round(order_value, 2) AS score FROM r WHERE position <= 7")
def _(spark, folder):
    s = customer_snapshot(spark, folder).select(C("segment").alias("strategy"), "ticker", C("order_value").alias("score"), F.lit(True).alias("eligible"), F.lit(3).alias("components"), F.lit(1.0).alias("weight_coverage"))
    return su.strategy_summary(s, 7, 1000000.0).select("strategy", C("position").cast("long").alias("position"), "ticker", F.round("score", 2).alias("score"))


@query("contribution_concentration", """WITH p AS (SELECT l_suppkey AS k, l_returnflag || l_linestatus || l_linenumber AS part, sum(l_extendedprice * (l_discount - 0.02)) AS v FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v DESC, part) AS i FROM p)
    SELECT k AS suppkey, count(CASE WHEN v > 0 THEN 1 END) AS positive_count, round(sum(CASE WHEN i <= 3 AND v > 0 THEN v END) / sum(CASE WHEN v > 0 THEN v END), 6) AS top_3_share, round(max(abs(v)) / sum(abs(v)), 6) AS top_1_absolute_share, arg_max(part, v) AS strongest, arg_min(part, v) AS weakest FROM r GROUP BY 1""")
def _(spark, folder):
    p = table(spark, folder, "lineitem").groupBy(C("l_suppkey").alias("suppkey"), F.concat("l_returnflag", "l_linestatus", C("l_linenumber").cast("string")).alias("part")).agg(F.sum(C("l_extendedprice") * (C("l_discount") - 0.02)).alias("v"))
    c = su.contribution_concentration(p, ["suppkey"], "part", "v")
    return c.select("suppkey", "positive_count", F.round("top_3_share", 6).alias("top_3_share"), F.round("top_1_absolute_share", 6).alias("top_1_absolute_share"), "strongest", "weakest")


LOOK = """
pr AS (SELECT c_mktsegment AS category, c_nationkey AS ticker, count(*) AS n, min(c_custkey) AS k FROM customer GROUP BY 1, 2), sd AS (SELECT c_mktsegment AS category, c_nationkey AS ticker, arg_min(c_acctbal, c_custkey) AS b, count(*) AS n FROM customer WHERE c_acctbal > 3000 AND c_nationkey < 20 GROUP BY 1, 2), ds AS (SELECT s_nationkey AS ticker, count(*) AS n FROM supplier GROUP BY 1),
jn AS (SELECT pr.category, pr.ticker, sd.b, array_to_string(list_filter([CASE WHEN pr.n > 1 THEN 'primary_duplicate' END, CASE WHEN sd.n > 1 THEN 'secondary_duplicate' END, CASE WHEN ds.n > 1 THEN 'dataset_duplicate' END, CASE WHEN sd.n IS NULL THEN 'secondary_analysis_match_missing' END, CASE WHEN ds.n IS NULL THEN 'primary_dataset_match_missing' END], lambda x: x IS NOT NULL), '; ') AS warnings,
  sd.n IS NULL AS ns, ds.n IS NULL AS nd FROM pr LEFT JOIN sd USING (category, ticker) LEFT JOIN ds ON ds.ticker = pr.ticker)"""


def lookup(spark, folder):
    c = table(spark, folder, "customer").select(C("c_mktsegment").alias("category"), C("c_nationkey").alias("ticker"), C("c_custkey").alias("source_row"), C("c_acctbal").alias("score"), F.lit(1).alias("rank"), (C("c_acctbal") / 10000).alias("breadth"))
    d = table(spark, folder, "supplier").select(C("s_nationkey").alias("ticker"), C("s_suppkey").alias("source_row"), F.lit("i").alias("industry"))
    return su.model_lookup(c, c.where("score > 3000 AND ticker < 20"), d)


@query("model_lookup", f"WITH {LOOK} SELECT category, CAST(ticker AS BIGINT) AS ticker, warnings, CASE WHEN b IS NULL THEN 'insufficient evidence' WHEN b / 10000 >= 0.75 THEN 'strong confirmation' WHEN b / 10000 >= 0.5 THEN 'partial confirmation' ELSE 'contradiction' END AS alignment FROM jn")
def _(spark, folder):
    return lookup(spark, folder).select("category", C("ticker").cast("long").alias("ticker"), "warnings", "alignment")


@query("match_failures", f"WITH {LOOK} SELECT category, count(*) AS names, count(CASE WHEN ns THEN 1 END) AS without_secondary, count(CASE WHEN nd THEN 1 END) AS without_dataset, count(CASE WHEN contains(warnings, 'duplicate') THEN 1 END) AS with_duplicates FROM jn GROUP BY 1")
def _(spark, folder):
    return su.match_failures(lookup(spark, folder))


@query("threshold_distances", f"WITH {SNAP} SELECT ticker, round(balance - 5000, 4) AS score_distance FROM snap")
def _(spark, folder):
    s = customer_snapshot(spark, folder).select("ticker", C("balance").alias("score"), F.lit(1).alias("rank"))
    return su.threshold_distance(s, 10, 5000.0).select("ticker", F.round("score_distance", 4).alias("score_distance"))


@query("missing_field_lists", f"WITH {SNAP} SELECT ticker, CASE WHEN order_value IS NULL THEN 'order_count,order_value' ELSE '' END AS missing FROM snap")
def _(spark, folder):
    m = su.missing_fields(customer_snapshot(spark, folder), ["ticker"], ["balance", "order_count", "order_value"])
    return m.select("ticker", F.array_join("missing", ",").alias("missing"))


@query("consolidated_history", "SELECT l_suppkey AS ticker, CAST(year(l_shipdate) AS BIGINT) AS fiscal_year, count(*) AS copies, count(DISTINCT l_orderkey) AS locations, string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS categories FROM lineitem GROUP BY 1, 2")
def _(spark, folder):
    r = table(spark, folder, "lineitem").select(C("l_suppkey").alias("ticker"), F.year("l_shipdate").cast("long").alias("fiscal_year"), C("l_returnflag").alias("category"), C("l_orderkey").alias("location"))
    return su.consolidated_history(r, ["ticker", "fiscal_year"]).select("ticker", "fiscal_year", "copies", "locations", "categories")


@query("statement_packages", f"WITH {SNAP} SELECT ticker, 1 + 2 * (order_value IS NOT NULL)::INT AS available, CASE WHEN order_value IS NULL THEN 'order_count,order_value' ELSE '' END AS unavailable FROM snap")
def _(spark, folder):
    p = su.statement_package(customer_snapshot(spark, folder), ["ticker"], ["balance", "order_count", "order_value"])
    return p.select("ticker", F.size("items").alias("available"), F.array_join("unavailable", ",").alias("unavailable"))


def dossier_facts(spark, folder):
    o = table(spark, folder, "orders")
    return o.select(
        C("o_custkey").alias("ticker"), C("o_orderpriority").alias("section"), F.lpad(C("o_orderkey").cast("string"), 12, "0").alias("record_id"), F.lit("t").alias("text"), (C("o_totalprice") / 1e6).alias("confidence"), F.when(C("o_orderstatus") == "F", "improving").otherwise("deteriorating").alias("direction"),
        F.when(C("o_orderstatus") == "P", "unknown").otherwise("strong").alias("state"), F.concat(F.lit("http://s/"), (C("o_orderkey") % 7).cast("string")).alias("source_url"), C("o_orderkey").alias("position"),
    )


@query("dossier_facts", """WITH f AS (SELECT o_custkey AS ticker, o_orderpriority AS section, o_orderkey AS k, CASE o_orderstatus WHEN 'P' THEN 'gap' WHEN 'F' THEN 'positive' ELSE 'negative' END AS stance, o_totalprice AS c FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY ticker, section, stance ORDER BY c DESC, k) AS position FROM f) SELECT ticker, section, stance, k AS orderkey, position FROM r WHERE position <= 2""")
def _(spark, folder):
    d = su.dossier(dossier_facts(spark, folder).drop("position"), 2)
    return d.select("ticker", "section", "stance", C("record_id").cast("long").alias("orderkey"), C("position").cast("long").alias("position"))


@query("numbered_sources", """WITH u AS (SELECT o_custkey AS ticker, 'http://s/' || (o_orderkey % 7) AS url, min(o_orderpriority || lpad(CAST(o_orderkey AS VARCHAR), 14, '0')) AS f, count(*) AS uses FROM orders GROUP BY 1, 2) SELECT ticker, url AS source_url, uses, row_number() OVER (PARTITION BY ticker ORDER BY f, url) AS source_number FROM u""")
def _(spark, folder):
    return su.numbered_sources(dossier_facts(spark, folder))[1].select("ticker", "source_url", "uses", "source_number")


RECORDS = """
rc AS (SELECT o_custkey AS ticker, o_orderstatus AS category, CASE WHEN o_orderpriority < '3' THEN 'DOWNLOADED' WHEN o_orderpriority < '4' THEN 'BLOCKED' ELSE 'FAILED' END AS status, o_orderpriority LIKE '2%' AND o_totalprice > 250000 AS hit, o_totalprice < 30000 AS dup FROM orders),
mm AS (SELECT ticker, category, count(*) AS discovered, count(CASE WHEN status = 'DOWNLOADED' AND NOT hit AND NOT dup THEN 1 END) AS newly_saved, count(CASE WHEN hit OR (status = 'DOWNLOADED' AND dup) THEN 1 END) AS cached, count(CASE WHEN status = 'BLOCKED' THEN 1 END) AS blocked, count(CASE WHEN status = 'FAILED' THEN 1 END) AS failed FROM rc GROUP BY 1, 2),
ms AS (SELECT *, CASE WHEN blocked > 0 AND newly_saved + cached = 0 THEN 'ACCESS_BLOCKED' WHEN newly_saved + cached = 0 AND failed + blocked >= discovered THEN 'DISCOVERY_FAILED' ELSE 'SUCCESS' END AS category_status FROM mm)"""


def collection(spark, folder):
    o = table(spark, folder, "orders")
    r = o.select(C("o_custkey").alias("ticker"), C("o_orderstatus").alias("category"), F.when(C("o_orderpriority") < "3", "DOWNLOADED").when(C("o_orderpriority") < "4", "BLOCKED").otherwise("FAILED").alias("status"), (C("o_orderpriority").startswith("2") & (C("o_totalprice") > 250000)).alias("cache_hit"), F.when(C("o_totalprice") < 30000, "x").alias("duplicate_of"))
    return su.collection_metrics(r, ["ticker", "category"])


@query("collection_metrics", f"WITH {RECORDS} SELECT ticker, category, discovered, newly_saved, cached, blocked, failed, category_status FROM ms")
def _(spark, folder):
    return collection(spark, folder).select("ticker", "category", "discovered", "newly_saved", "cached", "blocked", "failed", "category_status")


@query("company_collection_status", f"WITH {RECORDS} SELECT ticker, count(*) AS categories, CASE WHEN bool_or(category_status = 'SUCCESS') AND bool_or(category_status <> 'SUCCESS') THEN 'PARTIAL' WHEN bool_or(category_status = 'SUCCESS') THEN 'SUCCESS' WHEN bool_or(category_status = 'DISCOVERY_FAILED') THEN 'DISCOVERY_FAILED' ELSE 'ACCESS_BLOCKED' END AS company_status FROM ms GROUP BY 1")
def _(spark, folder):
    return su.company_status(collection(spark, folder))


@query("acquisition_failures", "SELECT o_orderkey AS orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'TRANSIENT_HTTP_ERROR' WHEN '2' THEN 'ACCESS_BLOCKED' WHEN '3' THEN 'INVALID_DOCUMENT' WHEN '4' THEN 'STALE_URL' ELSE 'HTML_PAGE_NOT_REPORT' END AS class, CASE substr(o_orderpriority, 1, 1) WHEN '2' THEN 'access_check' WHEN '3' THEN 'content_validation' WHEN '5' THEN 'candidate_validation' ELSE 'pdf_fetch' END AS stage, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'annual_report' WHEN '2' THEN 'quarterly_report' ELSE 'report_document' END AS type FROM orders")
def _(spark, folder):
    p = F.substring("o_orderpriority", 1, 1)
    n = F.lit(None).cast("string")
    url = F.when(p == "5", "https://x.com/news").otherwise("https://x.com/a.pdf")
    code = F.when(p == "1", "TIMEOUT").when(p == "2", "SITE_BLOCKED").when(p == "3", "BAD").when(p == "4", "NOT_FOUND").otherwise("BAD")
    message = F.when(p == "3", "missing PDF signature").when(p == "5", "landing page").otherwise("")
    title = F.when(p == "1", "Annual letter").when(p == "2", "Q3 figures").otherwise("Other")
    ok = su.is_report_candidate(url, n, F.lit("reports"), n)
    return table(spark, folder, "orders").select(
        C("o_orderkey").alias("orderkey"), su.failure_class(code, message, F.lit(None).cast("int"), n, n, F.lit(False), ok).alias("class"), su.failure_stage(code, message, ok).alias("stage"), su.report_type(title, F.lit("https://x.com/doc")).alias("type"),
    )


@query("feature_registry_table", "SELECT 'scored' AS kind, CAST(0 AS BIGINT) AS rows FROM region WHERE r_regionkey < 0 UNION ALL SELECT metric, count(*) FROM (SELECT 'balance' AS metric FROM customer UNION ALL SELECT 'order_count' FROM customer) GROUP BY 1")
def _(spark, folder):
    from gaugework.operators import features as ft

    registry = ft.FeatureRegistry([ft.Feature("balance", ("balance",), "finite", ft.VAL, ft.UP, "cash", lambda x: x), ft.Feature("order_count", ("order_count",), "finite", ft.PROF, ft.UP, "activity", lambda x: x)])
    names = ft.registry_frame(spark, registry).select(C("feature").alias("kind"))
    long = customer_snapshot(spark, folder).unpivot(["ticker"], [F.col("balance").cast("double").alias("balance"), "order_count"], "kind", "value")
    return long.join(F.broadcast(names), "kind").groupBy("kind").agg(F.count("*").alias("rows"))


REPORTS = """
rr AS (SELECT o_custkey AS ticker, CASE WHEN o_orderpriority < '3' THEN 'DOWNLOADED' WHEN o_orderpriority < '4' THEN 'BLOCKED' WHEN o_orderpriority < '5' THEN 'FAILED' ELSE 'REUSED' END AS status, o_orderpriority LIKE '2%' AND o_totalprice > 250000 AS hit, o_totalprice < 30000 AS dup FROM orders),
rm AS (SELECT ticker, count(*) AS n, count(CASE WHEN status = 'DOWNLOADED' AND NOT hit AND NOT dup THEN 1 END) AS saved, count(CASE WHEN hit OR status = 'REUSED' OR (status = 'DOWNLOADED' AND dup) THEN 1 END) AS reused, count(CASE WHEN status = 'FAILED' THEN 1 END) AS failed, count(CASE WHEN status = 'BLOCKED' THEN 1 END) AS blocked FROM rr GROUP BY 1)"""


@query("report_metrics", f"WITH {REPORTS} SELECT ticker, CASE WHEN ticker % 2 = 0 THEN n + 7 ELSE n END AS raw_report_candidates, CASE WHEN ticker % 2 = 0 THEN n + 2 ELSE n END AS reports_discovered, saved + reused + failed AS reports_validated, saved AS reports_saved, reused AS reports_reused, failed AS reports_failed, blocked AS reports_blocked, saved + reused + failed + blocked = n AS reconciled FROM rm")
def _(spark, folder):
    o, p = table(spark, folder, "orders"), C("o_orderpriority")
    r = o.select(C("o_custkey").alias("ticker"), F.when(p < "3", "DOWNLOADED").when(p < "4", "BLOCKED").when(p < "5", "FAILED").otherwise("REUSED").alias("status"), (p.startswith("2") & (C("o_totalprice") > 250000)).alias("cache_hit"), F.when(C("o_totalprice") < 30000, "x").alias("duplicate_of"))
    # Every second company's scan found more than it recorded.
    scanned = r.where("ticker % 2 = 0").groupBy("ticker").agg((F.count("*") + 2).alias("discovered"), (F.count("*") + 7).alias("raw_candidates"))
    return su.report_metrics(r, ["ticker"], scanned)


EVENT_ROWS = """
ee AS (SELECT o_custkey AS ticker, o_orderkey AS k, substr(o_orderpriority, 1, 1) AS p, o_orderkey % 3 = 0 AS resumed, o_totalprice > 400000 AS warn, o_orderstatus = 'P' AS protected, o_totalprice > 50000 AS selected FROM orders),
eo AS (SELECT *, CASE p WHEN '1' THEN 'generated_transcript' WHEN '2' THEN 'official_transcript' WHEN '3' THEN 'official_captions' END AS method, CASE WHEN p < '4' THEN 'TRANSCRIBED' WHEN p = '4' THEN CASE WHEN k % 2 = 0 THEN 'MEDIA_NOT_FOUND' ELSE 'CAPTCHA_REQUIRED' END ELSE 'NO_WEBCAST' END AS status FROM ee),
ev AS (SELECT *, CASE WHEN resumed AND p = '1' THEN 'GENERATED_TRANSCRIPT_ALREADY_AVAILABLE' WHEN status = 'TRANSCRIBED' THEN CASE WHEN warn THEN 'TRANSCRIPT_QA_WARNING' WHEN resumed THEN 'EVENT_ALREADY_COMPLETE' WHEN p = '1' THEN 'GENERATED_TRANSCRIPT_SUCCESS' WHEN p = '2' THEN 'OFFICIAL_TRANSCRIPT_USED' ELSE 'OFFICIAL_CAPTIONS_USED' END
  WHEN protected THEN 'EVENT_MEDIA_PROTECTED' ELSE status END AS o FROM eo),
pr(o, n) AS (VALUES """ + ", ".join(f"('{o}', {i})" for i, o in enumerate(su.OUTCOME_PRECEDENCE)) + """)"""


def event_rows(spark, folder):
    p, k = F.substring("o_orderpriority", 1, 1), C("o_orderkey")
    return table(spark, folder, "orders").select(
        C("o_custkey").alias("ticker"), F.when(p < "4", "TRANSCRIBED").when(p == "4", F.when(k % 2 == 0, "MEDIA_NOT_FOUND").otherwise("CAPTCHA_REQUIRED")).otherwise("NO_WEBCAST").alias("status"), F.when(p == "1", "generated_transcript").when(p == "2", "official_transcript").when(p == "3", "official_captions").alias("method"),
        (k % 3 == 0).alias("resumed"), F.when(C("o_totalprice") > 400000, "TRANSCRIPT_QA_WARNING").alias("qa_status"), F.when(C("o_orderstatus") == "P", "encrypted HLS").alias("protected_media_type"), (C("o_totalprice") > 50000).alias("selected"), F.when(p < "5", "https://cast.x.com").alias("webcast_url"),
        (p == "2").alias("transcript_found"), F.lit(False).alias("captions_found"), F.lit(False).alias("transcript_saved"), (p == "3").alias("captions_saved"), (p == "1").alias("generated_created"), (k % 5 == 0).alias("media_attempted"),
    )


@query("event_metrics", f"""WITH {EVENT_ROWS}, m AS (SELECT ticker, count(*) AS events_discovered, count(CASE WHEN p < '5' THEN 1 END) AS events_with_webcasts, count(CASE WHEN selected THEN 1 END) AS events_processed, count(CASE WHEN selected AND resumed THEN 1 END) AS events_resumed,
    count(CASE WHEN selected AND p = '2' THEN 1 END) AS official_transcript_discovered, count(CASE WHEN selected AND p = '3' THEN 1 END) AS official_captions_discovered, count(CASE WHEN selected AND o = 'OFFICIAL_TRANSCRIPT_USED' THEN 1 END) AS official_transcript_saved, count(CASE WHEN selected AND p = '3' THEN 1 END) AS official_captions_saved,
    count(CASE WHEN selected AND resumed AND p = '2' THEN 1 END) AS official_transcript_reused, count(CASE WHEN selected AND resumed AND p = '3' THEN 1 END) AS official_captions_reused, count(CASE WHEN selected AND p = '1' AND NOT resumed THEN 1 END) AS generated_transcript_created,
    count(CASE WHEN selected AND p = '1' AND resumed THEN 1 END) AS generated_transcript_reused, count(CASE WHEN selected AND p = '1' THEN 1 END) AS generated_transcript_available, count(CASE WHEN selected AND k % 5 = 0 THEN 1 END) AS media_attempts_used, count(CASE WHEN p = '5' THEN 1 END) AS events_no_replay,
    count(CASE WHEN selected AND o = 'CAPTCHA_REQUIRED' THEN 1 END) AS registration_blocked, count(CASE WHEN selected AND o = 'EVENT_MEDIA_PROTECTED' THEN 1 END) AS media_blocked, count(CASE WHEN selected AND o = 'MEDIA_NOT_FOUND' THEN 1 END) AS media_not_found, count(CASE WHEN selected AND o = 'MEDIA_NOT_FOUND' THEN 1 END) AS media_failures,
    CAST(0 AS BIGINT) AS transcription_failures, count(CASE WHEN selected AND o = 'MEDIA_NOT_FOUND' THEN 1 END) AS event_failures, arg_min(CASE WHEN selected THEN o END, CASE WHEN selected THEN n END) AS best, min(CASE WHEN selected THEN o END) AS other FROM ev LEFT JOIN pr USING (o) GROUP BY 1)
    SELECT * EXCLUDE (best, other), greatest(0, official_transcript_saved - official_transcript_reused) AS official_transcript_saved_new, greatest(0, official_captions_saved - official_captions_reused) AS official_captions_saved_new, coalesce(best, other, 'EVENTS_FOUND') AS event_outcome FROM m""")
def _(spark, folder):
    return su.event_metrics(event_rows(spark, folder), ["ticker"])
