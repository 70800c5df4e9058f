"""Factor scores from states, outcomes, ownership and boards; pillar and company scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.numbers import clamp
from gaugework.plans.joins import attach

# --- fixed values: label maps, bands, pillars and factors of the published profile -----------------------------
STATE_MAP = {
    "revenue": {"strong": 100, "healthy": 75, "neutral": 50, "weak": 25, "stressed": 0}, "demand": {"strong": 100, "healthy": 75, "neutral": 50, "weak": 25, "stressed": 0},
    "margins": {"expanding": 100, "stable": 50, "compressing": 0, "strong": 75, "healthy": 75, "weak": 25, "stressed": 0}, "guidance": {"raised": 100, "maintained": 50, "lowered": 25, "withdrawn": 0, "neutral": 50},
}
_TREND = {"accelerating": 100, "improving": 75, "stable": 50, "deteriorating": 25, "decelerating": 0}
TREND_MAP = {"revenue": _TREND, "demand": _TREND, "margins": _TREND, "risks": {"improving": 100, "stable": 50, "deteriorating": 25, "decelerating": 0}}
GUIDANCE_MAP = {"BEAT": 100, "MET": 75, "MISS": 25, "WITHDRAWN": 0}
COMMITMENT_MAP = {"ACHIEVED": 100, "PARTIALLY_ACHIEVED": 65, "REVISED": 50, "DELAYED": 25, "MISSED": 0, "ABANDONED": 0}
CAPITAL_MAP = {"positive": 100, "successful": 100, "achieved": 100, "negative": 0, "missed": 0}
LEADERSHIP_MAP = {"SEPARATE_INDEPENDENT_CHAIR": 100, "SEPARATE_NONINDEPENDENT_CHAIR": 65, "CEO_CHAIR_WITH_LEAD_INDEPENDENT_DIRECTOR": 70, "CEO_CHAIR_WITHOUT_LEAD_INDEPENDENT_DIRECTOR": 35}
OWNERSHIP_BANDS = [(0, 1, 25), (1, 5, 50), (5, 10, 75), (10, 101, 100)]
PILLAR_WEIGHTS = {"BUSINESS_QUALITY": 0.30, "BUSINESS_TRAJECTORY": 0.20, "MANAGEMENT_EXECUTION": 0.20, "INSIDER_ALIGNMENT": 0.15, "GOVERNANCE": 0.15}
CRITICAL_FACTORS = ["business_quality_revenue_state", "business_quality_demand_state"]
FACTORS = [  # factor, pillar, weight, minimum coverage
    ("business_quality_revenue_state", "BUSINESS_QUALITY", 1.0, 0.5), ("business_quality_demand_state", "BUSINESS_QUALITY", 1.0, 0.5), ("business_quality_margins_state", "BUSINESS_QUALITY", 1.0, 0.5), ("business_quality_guidance_state", "BUSINESS_QUALITY", 0.75, 0.5),
    ("trajectory_revenue_trend", "BUSINESS_TRAJECTORY", 1.0, 0.5), ("trajectory_demand_trend", "BUSINESS_TRAJECTORY", 1.0, 0.5), ("trajectory_margins_trend", "BUSINESS_TRAJECTORY", 1.0, 0.5), ("trajectory_risk_trend", "BUSINESS_TRAJECTORY", 0.75, 0.5),
    ("management_guidance_reliability", "MANAGEMENT_EXECUTION", 1.0, 0.5), ("management_commitment_delivery", "MANAGEMENT_EXECUTION", 0.75, 0.5), ("management_operating_execution", "MANAGEMENT_EXECUTION", 0.75, 0.5), ("management_capital_allocation", "MANAGEMENT_EXECUTION", 0.5, 0.5),
    ("insider_ownership_alignment", "INSIDER_ALIGNMENT", 1.0, 0.5), ("insider_transaction_activity", "INSIDER_ALIGNMENT", 1.0, 0.5), ("insider_cluster_activity", "INSIDER_ALIGNMENT", 0.5, 0.5),
    ("governance_board_independence", "GOVERNANCE", 1.0, 0.5), ("governance_leadership_structure", "GOVERNANCE", 0.75, 1.0), ("governance_committee_independence", "GOVERNANCE", 0.75, 0.75), ("governance_audit_expertise", "GOVERNANCE", 0.5, 1.0),
    ("governance_refreshment", "GOVERNANCE", 0.5, 1.0), ("governance_outside_board_burden", "GOVERNANCE", 0.5, 1.0), ("governance_related_party", "GOVERNANCE", 0.5, 1.0), ("governance_voting_control", "GOVERNANCE", 0.75, 1.0),
    ("governance_shareholder_rights", "GOVERNANCE", 0.75, 1.0), ("governance_class_structure", "GOVERNANCE", 0.25, 1.0),
]
ATTRIBUTION_PART = {"DIRECT": 1.0, "ROLE_BASED": 0.9, "TEAM": 0.75, "TENURE_OVERLAP": 0.2}


def ordinal(label: Column, mapping: Mapping[str, float]) -> Column:
    """Mapped score of a label, NULL when the label is not configured."""
    return F.coalesce(*[F.when(F.lower(label) == k.lower(), F.lit(float(v))) for k, v in mapping.items()], F.lit(None).cast("double"))


def banded(value: Column, bands: Sequence[tuple[float, float, float]]) -> Column:
    """Score of the band [low, high) holding the value."""
    return F.coalesce(*[F.when((value >= a) & (value < b), F.lit(float(s))) for a, b, s in bands], F.lit(None).cast("double"))


def evidence_confidence(*, state: Column | None = None, completeness: Column | None = None, groups: Column | None = None, sample: Column | None = None, level: Column | None = None) -> Column:
    """Mean of the available reliability parts, rounded half-even to four places; 0 when nothing is known."""
    unit = lambda c: clamp(c.cast("double"), 0.0, 1.0)
    parts = []
    if state is not None:
        parts.append(unit(state))
    if completeness is not None:
        parts.append(F.when(completeness > 0, unit(completeness)))
    if groups is not None:
        parts.append(F.when(groups > 0, F.least(F.lit(1.0), 0.5 + 0.15 * F.least(groups, F.lit(4)))))
    if sample is not None:
        parts.append(F.when(sample > 0, F.least(F.lit(1.0), 0.5 + 0.1 * F.least(sample, F.lit(5)))))
    if level is not None:
        parts.append(F.when(level.isNotNull(), F.coalesce(*[F.when(level == k, F.lit(v)) for k, v in ATTRIBUTION_PART.items()], F.lit(0.45))))
    if not parts:
        return F.lit(0.0)
    known = F.array_compact(F.array(*parts))
    return F.when(F.size(known) > 0, F.bround(F.aggregate(known, F.lit(0.0), lambda a, v: a + v) / F.size(known), 4)).otherwise(0.0)


_COLUMNS = ["ticker", "factor", "score", "status", "coverage", "confidence", "reason", "source_group", "sample"]


def _factor(df: DataFrame, name: str, score: Column, status: Column, coverage: Column, confidence: Column, reason: Column, sample: Column, source: Column | None = None) -> DataFrame:
    return df.select(
        "ticker", F.lit(name).alias("factor"), F.when(status == "SCORED", score.cast("double")).alias("score"), status.alias("status"), coverage.cast("double").alias("coverage"), confidence.cast("double").alias("confidence"),
        reason.alias("reason"), (source if source is not None else F.lit(name)).alias("source_group"), sample.cast("long").alias("sample"),
    )


def state_factors(states: DataFrame, proven_absolute: Sequence[str] = ()) -> DataFrame:
    """Level and trend factors of each dimension's whole-dimension state.

    A level is only scored for dimensions listed in ``proven_absolute``; directions are always safe to score.
    """
    whole = states.where(F.col("topic").isNull())
    groups, coverage = F.col("evidence_groups"), F.when(F.col("evidence_groups") > 0, 1.0).otherwise(0.0)
    confidence = evidence_confidence(state=F.col("confidence"), completeness=F.lit(1.0), groups=groups)
    names = {"risks": "risk"}
    parts = []
    for field, prefix, suffix, maps in (("current_state", "business_quality", "state", STATE_MAP), ("trend", "trajectory", "trend", TREND_MAP)):
        for dim, mapping in maps.items():
            rows = whole.where(F.col("dimension") == dim)
            score = ordinal(F.col(field), mapping)
            unsafe = field == "current_state" and dim not in proven_absolute
            status = F.lit("UNSCORED") if unsafe else F.when(score.isNotNull() & (coverage >= 0.5), "SCORED").when(score.isNull(), "UNKNOWN").otherwise("INSUFFICIENT_COVERAGE")
            reason = F.lit("UPSTREAM_STATE_NOT_PROVEN_ABSOLUTE_QUALITY") if unsafe else F.when(status == "SCORED", "AUDITED_STATE_MAPPED").when(score.isNull(), "STATE_LABEL_NOT_CONFIGURED").otherwise("STATE_COVERAGE_BELOW_MINIMUM")
            parts.append(_factor(rows, f"{prefix}_{names.get(dim, dim)}_{suffix}", score, status, coverage, confidence, reason, groups, F.concat(F.lit("state:"), "ticker", F.lit(":"), "dimension")))
    return _all(parts)


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def outcome_factor(rows: DataFrame, name: str, label: str, mapping: Mapping[str, float], minimum: int) -> DataFrame:
    """Mean mapped outcome per ticker once enough outcomes are resolved."""
    score = ordinal(F.col(label), mapping)
    g = rows.groupBy("ticker").agg(F.count(score).alias("n"), F.avg(score).alias("s"))
    enough = F.col("n") >= minimum
    status = F.when(enough, "SCORED").otherwise("INSUFFICIENT_SAMPLE")
    confidence = F.when(enough, evidence_confidence(completeness=F.lit(1.0), groups=F.col("n"), sample=F.col("n"))).otherwise(evidence_confidence(sample=F.col("n")))
    return _factor(g, name, F.col("s"), status, F.least(F.lit(1.0), F.col("n") / minimum), confidence, F.when(enough, "RESOLVED_COMPARABLE_OUTCOMES").otherwise("INSUFFICIENT_RESOLVED_SAMPLE"), F.col("n"))


def operating_factor(outcomes: DataFrame, minimum: int = 3) -> DataFrame:
    """Share of improving outcomes that are attributed to a person, role or team (mere tenure overlap does not count)."""
    own = F.col("attribution").isin("DIRECT", "ROLE_BASED", "TEAM") & F.col("percent_change").isNotNull()
    g = outcomes.groupBy("ticker").agg(F.count_if(own).alias("n"), F.count_if(own & (F.col("percent_change") > 0)).alias("up"))
    enough = F.col("n") >= minimum
    score = clamp(50.0 + 50.0 * (F.try_divide(F.col("up"), F.col("n")) * 2 - 1), 0.0, 100.0)
    confidence = F.when(enough, evidence_confidence(completeness=F.lit(1.0), groups=F.col("n"), sample=F.col("n"))).otherwise(evidence_confidence(sample=F.col("n")))
    reason = F.when(enough, "EXPLICIT_ATTRIBUTED_OPERATING_OUTCOMES").when(F.col("n") == 0, "TENURE_OVERLAP_NOT_MANAGEMENT_ATTRIBUTION").otherwise("INSUFFICIENT_ATTRIBUTED_SAMPLE")
    return _factor(g, "management_operating_execution", score, F.when(enough, "SCORED").otherwise("INSUFFICIENT_SAMPLE"), F.least(F.lit(1.0), F.col("n") / minimum), confidence, reason, F.col("n"))


def ownership_factor(alignment: DataFrame) -> DataFrame:
    """Known insider percent by band (``ticker``, ``known_insider_percent``)."""
    v = F.col("known_insider_percent")
    score = banded(v, OWNERSHIP_BANDS)
    status = F.when(v.isNull(), "UNSCORED").when(score.isNull(), "UNKNOWN").otherwise("SCORED")
    reason = F.when(v.isNull(), "ECONOMIC_BENEFICIAL_PERCENT_NOT_DISCLOSED").when(score.isNull(), "OWNERSHIP_PERCENT_OUTSIDE_CONFIGURED_BANDS").otherwise("KNOWN_BENEFICIAL_OWNERSHIP_PERCENT_CONFIGURED_BAND")
    known = v.isNotNull().cast("int")
    return _factor(alignment, "insider_ownership_alignment", score, status, known, F.when(v.isNotNull(), evidence_confidence(completeness=F.lit(1.0), groups=F.lit(1))).otherwise(0.0), reason, known)


def trade_factor(trades: DataFrame) -> DataFrame:
    """Balance of discretionary open-market purchases and sales."""
    own = F.coalesce("is_open_market", F.lit(False)) & F.col("transaction_type").isin("open_market_purchase", "open_market_sale")
    g = trades.groupBy("ticker").agg(F.count_if(own).alias("n"), F.count_if(own & (F.col("transaction_type") == "open_market_purchase")).alias("b"))
    any_ = F.col("n") > 0
    score = 50.0 + 50.0 * F.try_divide(2 * F.col("b") - F.col("n"), F.col("n"))
    return _factor(g, "insider_transaction_activity", score, F.when(any_, "SCORED").otherwise("UNSCORED"), any_.cast("int"), F.when(any_, evidence_confidence(completeness=F.lit(1.0), groups=F.col("n"), sample=F.col("n"))).otherwise(0.0),
                   F.when(any_, "DISCRETIONARY_OPEN_MARKET_TRANSACTIONS").otherwise("NO_SIGNAL_NO_DISCRETIONARY_OPEN_MARKET_ACTIVITY"), F.col("n"))


def cluster_factor(tickers: DataFrame, clusters: DataFrame) -> DataFrame:
    """100 with a purchase cluster, 0 with only sale clusters (``side`` is purchase or sale)."""
    c = clusters.groupBy("ticker").agg(F.count("*").alias("n"), F.count_if(F.col("side") == "purchase").alias("b"))
    g = tickers.select("ticker").distinct().join(c, "ticker", "left").fillna(0)
    any_ = F.col("n") > 0
    return _factor(g, "insider_cluster_activity", F.when(F.col("b") > 0, 100.0).otherwise(0.0), F.when(any_, "SCORED").otherwise("UNSCORED"), any_.cast("int"), F.when(any_, evidence_confidence(completeness=F.lit(1.0), groups=F.col("n"))).otherwise(0.0),
                   F.when(any_, "ELIGIBLE_DISCRETIONARY_CLUSTER").otherwise("NO_ELIGIBLE_DISCRETIONARY_CLUSTER"), F.col("n"))


def board_factors(boards: DataFrame) -> DataFrame:
    """Governance factors from one board snapshot row per ticker.

    ``boards``: ticker, independent, known_independence, board_size, leadership, required_committees, independent_committees,
    audit_committees, financial_experts, average_outside_boards, rights_known, rights_positive, rights_total.
    """
    c = F.col
    steady = evidence_confidence(completeness=F.lit(1.0), groups=F.lit(1))

    def make(name: str, score: Column, known: Column, coverage: Column, missing: str, found: str) -> DataFrame:
        ok = F.coalesce(known & score.isNotNull(), F.lit(False))
        return _factor(boards, name, score, F.when(ok, "SCORED").otherwise(missing), coverage, F.when(ok, steady).otherwise(0.0), F.when(ok, found).otherwise(f"{name.upper()}_NOT_ESTABLISHED"), ok.cast("int"))

    share = F.coalesce(F.try_divide(c("known_independence"), c("board_size")), F.lit(0.0))
    rights = F.coalesce(F.try_divide(c("rights_known"), c("rights_total")), F.lit(0.0))
    lead = ordinal(c("leadership"), LEADERSHIP_MAP)
    return _all([
        make("governance_board_independence", F.try_divide(100.0 * c("independent"), c("board_size")), share >= 0.5, share, "INSUFFICIENT_COVERAGE", "EXPLICIT_INDEPENDENCE"),
        make("governance_leadership_structure", lead, lead.isNotNull(), lead.isNotNull().cast("int"), "UNKNOWN", "EXPLICIT_CONFIGURED_LEADERSHIP_MAPPING"),
        make("governance_committee_independence", F.try_divide(100.0 * c("independent_committees"), c("required_committees")), c("required_committees") > 0, (c("required_committees") > 0).cast("int"), "INSUFFICIENT_COVERAGE", "EXPLICIT_COMMITTEE_INDEPENDENCE"),
        make("governance_audit_expertise", F.lit(100.0), (c("audit_committees") > 0) & (c("financial_experts") > 0), (c("audit_committees") > 0).cast("int"), "UNKNOWN", "EXPLICIT_AUDIT_FINANCIAL_EXPERTS"),
        make("governance_outside_board_burden", F.greatest(F.lit(0.0), 100.0 - c("average_outside_boards") * 25.0), c("average_outside_boards").isNotNull(), c("average_outside_boards").isNotNull().cast("int"), "UNSCORED", "EXPLICIT_OUTSIDE_BOARDS"),
        make("governance_shareholder_rights", F.try_divide(100.0 * c("rights_positive"), c("rights_total")), rights >= 1.0, rights, "INSUFFICIENT_COVERAGE", "EXPLICIT_RIGHTS"),
    ])


def complete_factors(spark, scored: DataFrame, tickers: DataFrame, factors: Sequence[tuple[str, str, float, float]] = FACTORS) -> DataFrame:
    """Every registered factor of every ticker with pillar, weight and minimum coverage; absent ones are UNSCORED."""
    registry = spark.createDataFrame(list(factors), "factor string, pillar string, weight double, min_coverage double")
    # The registry is a fixed short list, so this grid is a constant number of rows per ticker.
    grid = tickers.select("ticker").distinct().crossJoin(F.broadcast(registry))
    j = grid.join(scored.select(*_COLUMNS), ["ticker", "factor"], "left")
    return j.withColumns({"status": F.coalesce("status", F.lit("UNSCORED")), "coverage": F.coalesce("coverage", F.lit(0.0)), "confidence": F.coalesce("confidence", F.lit(0.0)), "reason": F.coalesce("reason", F.lit("NO_INPUT")), "source_group": F.coalesce("source_group", "factor")})


def aggregate_pillars(factors: DataFrame, threshold: float = 0.70) -> tuple[DataFrame, DataFrame]:
    """Pillar scores, and factors with effective weight and contribution.

    Evidence coverage weighs each factor's coverage; scoring coverage only counts factors that are scored.
    """
    w = F.col("weight")
    ok = (F.col("status") == "SCORED") & F.col("score").isNotNull() & (F.col("coverage") >= F.col("min_coverage"))
    f = factors.withColumn("eligible", F.coalesce(ok, F.lit(False)))
    e = F.col("eligible")
    p = f.groupBy("ticker", "pillar").agg(
        F.sum(w).alias("configured_weight"), F.sum(F.when(e, w).otherwise(0.0)).alias("eligible_weight"), F.sum(F.when(e, w * F.col("score"))).alias("_n"), F.sum(w * F.col("coverage")).alias("_ev"), F.sum(F.when(e, w * F.col("coverage")).otherwise(0.0)).alias("_sc"),
        F.sum(F.when(e, w * F.col("confidence"))).alias("_cf"), F.count_if(e).alias("scored_factors"), F.countDistinct(F.when(e, F.col("source_group"))).alias("_src"),
    )
    calculated = F.try_divide("_n", F.nullif("eligible_weight", F.lit(0.0)))
    scoring = F.col("_sc") / F.col("configured_weight")
    status = F.when(F.col("scored_factors") == 0, "UNSCORED").when(scoring < threshold, "INSUFFICIENT_SCORING_COVERAGE").otherwise("SCORED")
    pillars = p.select(
        "ticker", "pillar", F.when(status == "SCORED", calculated).alias("score"), calculated.alias("calculated_score"), (F.col("_ev") / F.col("configured_weight")).alias("evidence_coverage"), scoring.alias("scoring_coverage"), status.alias("status"),
        "configured_weight", "eligible_weight", "scored_factors", F.coalesce(correlated_confidence(F.col("_cf"), F.col("eligible_weight"), F.col("_src"), F.col("scored_factors")), F.lit(0.0)).alias("confidence"),
    )
    parts = attach(f, pillars.select("ticker", "pillar", F.col("eligible_weight").alias("_w")), ["ticker", "pillar"])
    effective = F.when(e, w / F.col("_w"))
    return pillars, parts.withColumns({"effective_weight": effective, "contribution": effective * F.col("score")}).drop("_w")


def correlated_confidence(weighted: Column, weight: Column, sources: Column, n: Column) -> Column:
    """Weighted mean confidence, discounted when few independent sources stand behind many factors."""
    return F.bround(F.try_divide(weighted, F.nullif(weight, F.lit(0.0))) * (0.5 + 0.5 * F.least(F.lit(1.0), F.try_divide(sources, n))), 4)


def company_scores(pillars: DataFrame, factors: DataFrame, spark, weights: Mapping[str, float] = PILLAR_WEIGHTS, critical: Sequence[str] = CRITICAL_FACTORS, threshold: float = 0.70) -> DataFrame:
    """Overall score per ticker; critical factors and coverage must hold, otherwise there is no score."""
    table = spark.createDataFrame(list(weights.items()), "pillar string, pillar_weight double")
    p = pillars.join(F.broadcast(table), "pillar")
    w = F.col("pillar_weight")
    scored = F.col("score").isNotNull() & (F.col("eligible_weight") > 0)
    s = p.groupBy("ticker").agg(
        F.sum(w * F.col("evidence_coverage")).alias("evidence_coverage"), F.sum(w * F.col("scoring_coverage")).alias("scoring_coverage"), F.try_divide(F.sum(F.when(scored, w * F.col("score"))), F.sum(F.when(scored, w))).alias("_score"),
        F.max(F.when(F.col("pillar") == "BUSINESS_QUALITY", F.col("scoring_coverage"))).alias("_bq"),
    )
    ok = (F.col("status") == "SCORED") & F.col("score").isNotNull()
    missing = F.array_join(F.array_compact(F.array(*[F.when(F.max((F.col("factor") == k) & ok & (F.col("coverage") >= F.col("min_coverage"))), F.lit(None).cast("string")).otherwise(F.lit(k)) for k in critical])), "; ")
    c = factors.groupBy("ticker").agg(
        missing.alias("critical_missing"), F.count_if(ok).alias("scored_factors"), F.count_if(~ok).alias("unscored_factors"), F.sum(F.when(ok, F.col("weight") * F.col("confidence"))).alias("_cf"), F.sum(F.when(ok, F.col("weight"))).alias("_w"), F.countDistinct(F.when(ok, F.col("source_group"))).alias("_src"),
        F.max_by("factor", F.when(ok & (F.col("score") > 50), F.struct("contribution", "factor"))).alias("top_positive"), F.min_by("factor", F.when(ok & (F.col("score") < 50), F.struct("contribution", "factor"))).alias("top_negative"),
    )
    j = s.join(c, "ticker")
    enough = (F.col("critical_missing") == "") & (F.col("scoring_coverage") >= threshold) & (F.coalesce("_bq", F.lit(0.0)) >= threshold)
    return j.select(
        "ticker", F.when(enough, F.col("_score")).alias("overall_score"), F.when(~enough, "INSUFFICIENT_SCORING_COVERAGE").when(F.col("_score").isNotNull(), "SCORED").otherwise("PARTIAL").alias("score_status"), "evidence_coverage", "scoring_coverage",
        F.coalesce(correlated_confidence(F.col("_cf"), F.col("_w"), F.col("_src"), F.col("scored_factors")), F.lit(0.0)).alias("confidence"), "critical_missing", "scored_factors", "unscored_factors", "top_positive", "top_negative",
    )


def factor_audit(parts: DataFrame) -> DataFrame:
    """Explanation rows: input, weight, effective weight, contribution, audit class and why a factor is (not) scored."""
    r = F.upper("reason")
    kind = (
        F.when(F.col("status") == "SCORED", "VALID").when(r.contains("NOT_PROVEN_ABSOLUTE") | r.contains("NON_DIRECTIONAL"), "SEMANTICALLY_NON_DIRECTIONAL")
        .otherwise("INSUFFICIENT_EVIDENCE")
    )
    return parts.select("ticker", "factor", "pillar", "sample", "score", "status", "weight", F.when(F.col("eligible"), F.col("weight")).otherwise(0.0).alias("eligible_weight"), "effective_weight", "contribution", "coverage", "confidence", kind.alias("audit_class"), "reason")


def shared_evidence(support: DataFrame, groups: DataFrame) -> DataFrame:
    """Records that several factors of one dependency group rest on.

    ``support``: ticker, factor, record_id; ``groups``: factor, dependency_group.
    """
    j = support.join(F.broadcast(groups), "factor")
    return j.groupBy("ticker", "dependency_group", "record_id").agg(F.countDistinct("factor").alias("factors")).where("factors > 1")
