"""Claims compared between periods, and combined into current states with trend and confidence."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions import rules as R
from gaugework.functions import text as tx
from gaugework.plans.joins import attach, look_up
from gaugework.plans.settle import settle

# Match thresholds, period kinds that hold actual results, and subjects worth a state of their own.
MATCH_THRESHOLD, LOOSE_THRESHOLD = 0.52, 0.42
LOOSE_DIMENSIONS = ("demand", "customer_growth", "customer_retention")
LOOSE_SUBJECTS = ("ai", "enterprise", "retention", "bookings")
QUARTER, ANNUAL, YTD = "QUARTER_ACTUAL", "ANNUAL_ACTUAL", "YTD_ACTUAL"
USEFUL_SUBJECTS = (
    "acquisition", "ai", "bookings", "capex", "customer_experience", "deferred_revenue", "enterprise", "free_cash_flow_margin", "gross_margin", "international",
    "net_dollar_retention", "online", "operating_margin", "product_named", "profitability", "revenue", "retention", "share_repurchase",
)
SUBJECTS_BY_DIMENSION = {
    "balance_sheet": (), "capital_allocation": ("acquisition", "share_repurchase"), "costs": ("ai",), "customer_growth": ("ai", "enterprise", "customer_experience"), "customer_retention": ("retention",),
    "demand": ("ai", "bookings", "enterprise", "customer_experience", "international"), "geography": ("international",), "guidance": ("acquisition", "capex", "deferred_revenue", "enterprise", "profitability", "revenue"),
    "inventory": ("revenue",), "margins": ("free_cash_flow_margin", "gross_margin", "operating_margin", "revenue"), "pricing": ("online", "retention", "revenue"), "product": ("ai", "international", "product_named"),
    "regulation": ("international",), "revenue": ("enterprise", "international", "net_dollar_retention", "product_named", "profitability"), "risks": ("revenue",),
}


def period_pair(claims: DataFrame) -> DataFrame:
    """Tag claims of each ticker's latest and previous comparable period (``side`` = current or previous).

    Quarters compare with quarters; without quarters, annual periods; else any actual period. Guidance-only and
    unknown periods never take part. Periods are ranked on one row per (ticker, period).
    """
    kinds = claims.where(F.col("period_type").isin(QUARTER, ANNUAL, YTD)).groupBy("ticker", "period_type", "fiscal_year", F.coalesce("fiscal_quarter", F.lit(5)).alias("q")).agg(F.count("*").alias("n"))
    rank = F.when(F.col("period_type") == QUARTER, 1).when(F.col("period_type") == ANNUAL, 2).otherwise(3)
    best = Window.partitionBy("ticker")
    chosen = kinds.withColumn("_k", rank).withColumn("_b", F.min("_k").over(best)).where(F.col("_k") == F.col("_b"))
    order = Window.partitionBy("ticker").orderBy(F.desc("fiscal_year"), F.desc("q"))
    placed = chosen.withColumn("_p", F.dense_rank().over(order)).where("_p <= 2").select("ticker", "period_type", "fiscal_year", "q", F.when(F.col("_p") == 1, "current").otherwise("previous").alias("side"))
    tagged = claims.withColumn("q", F.coalesce("fiscal_quarter", F.lit(5)))
    return attach(tagged, placed, ["ticker", "period_type", "fiscal_year", "q"], how="inner").drop("q")


def described(claims: DataFrame) -> DataFrame:
    """Add subject, comparison key, metric unit, tokens and metric observation to claims."""
    s, d = F.col("evidence_text"), F.col("dimension")
    named = claims.withColumns({"subject": tx.subject(s, d, F.col("topic")), "unit": tx.metric_unit(s, F.col("magnitude")), "tokens": tx.claim_tokens(s), "metric": tx.metric_observation(F.col("magnitude"))})
    key = F.when(F.col("subject") == "capex", "capex|capex|capex").otherwise(F.concat_ws("|", "dimension", F.coalesce("topic", "dimension"), "subject"))
    return named.withColumn("base_key", key)


def match_claims(pairs: DataFrame) -> DataFrame:
    """One-to-one matches of current to previous claims inside (ticker, base_key), in claim-id order.

    Each current claim takes the best unused previous one at or above the threshold. The rule is sequential by
    definition; its group is what one company said about one subject in two reporting periods.
    Returns (ticker, base_key, claim_id, previous_id, score, incompatible).
    """
    need = pairs.select("ticker", "base_key", "side", "claim_id", "unit", "tokens", "dimension", "subject")
    names = ["ticker", "base_key", "claim_id", "previous_id", "score", "incompatible"]

    def greedy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows arrive sorted by group, previous claims first, so only one group's previous side is held."""
        group, before, used = None, [], set()
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if (row.ticker, row.base_key) != group:
                    group, before, used = (row.ticker, row.base_key), [], set()
                mine = set(row.tokens)
                if row.side == "previous":
                    before.append((row.claim_id, row.unit, mine))
                    continue
                best, clash = (None, -1.0), False
                for pid, unit, tokens in before:
                    if pid in used:
                        continue
                    if unit and row.unit and unit != row.unit:
                        clash = True
                        continue
                    union = len(mine | tokens)
                    alike = len(mine & tokens) / union if mine and tokens else 0.0
                    score = 0.35 + (0.25 if unit and unit == row.unit else 0.0) + min(0.40, alike)
                    if score > best[1]:
                        best = (pid, score)
                loose = row.dimension in LOOSE_DIMENSIONS and row.subject in LOOSE_SUBJECTS
                if best[0] is not None and best[1] >= (LOOSE_THRESHOLD if loose else MATCH_THRESHOLD):
                    used.add(best[0])
                    out.append((*group, row.claim_id, best[0], best[1], False))
                else:
                    out.append((*group, row.claim_id, None, None, clash))
            yield pd.DataFrame(out, columns=names)

    types = {f.name: f.dataType.simpleString() for f in need.schema.fields}
    placed = need.repartition("ticker", "base_key").sortWithinPartitions("ticker", "base_key", F.desc("side"), "claim_id")
    return placed.mapInPandas(greedy, f"ticker {types['ticker']}, base_key string, claim_id {types['claim_id']}, previous_id {types['claim_id']}, score double, incompatible boolean")


def _rank(direction: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in R.DIRECTION_RANK.items() for x in pair])
    return F.coalesce(F.try_element_at(table, direction), F.lit(0))


def classify_change(p: str = "p", c: str = "c") -> Column:
    """Struct (change_type, direction, confidence, method) of a matched pair of claim structs; rejected pairs have type 'rejected'."""
    P, C = F.col(p), F.col(c)

    def out(kind, direction, confidence, method) -> Column:
        wrap = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(wrap(kind).cast("string").alias("change_type"), wrap(direction).cast("string").alias("direction"), wrap(confidence).cast("double").alias("confidence"), F.lit(method).alias("method"))

    pm, cm = P["metric"], C["metric"]
    both = pm.isNotNull() & cm.isNotNull()
    dim, alike = C["dimension"], tx.jaccard(P["tokens"], C["tokens"])
    ph, ch = tx.horizon(P["evidence_text"]), tx.horizon(C["evidence_text"])
    pb, cb = tx.reporting_basis(P["evidence_text"]), tx.reporting_basis(C["evidence_text"])
    pt, ct = tx.metric_terms(P["evidence_text"]), tx.metric_terms(C["evidence_text"])
    has = F.array_contains
    eps_clash = (has(pt, "eps") & has(ct, "profitability") & ~has(ct, "eps")) | (has(ct, "eps") & has(pt, "profitability") & ~has(pt, "eps"))
    unit = F.coalesce(pm["unit"], cm["unit"], C["unit"])
    pr, cr = _rank(P["direction"]), _rank(C["direction"])
    single = (F.size(pm["values"]) == 1) & (F.size(cm["values"]) == 1)
    before, after = pm["values"][0], cm["values"][0]
    guided = dim == "guidance"
    numeric = F.when(after == before, F.when((alike >= 0.25) | guided, "reiterated").otherwise("stable")).when(after > before, F.when(guided, "raised").otherwise("increasing")).otherwise(F.when(guided, "lowered").otherwise("decreasing"))
    numeric_direction = F.when(after == before, "stable").otherwise(numeric)
    risk = dim == "risks"
    same_direction = P["direction"] == C["direction"]
    unknown = (P["direction"] == "unknown") & (C["direction"] == "unknown")
    better = F.when(guided & (C["direction"] == "raised"), "raised").otherwise("improving")
    worse = F.when(guided & (C["direction"] == "lowered"), "lowered").otherwise("deteriorating")
    return (
        F.when(both & (pm["unit"] != cm["unit"]), out("rejected", "unknown", 0.0, "numeric_unit_check"))
        .when(guided & (P["certainty"] == "actual") & (C["certainty"] == "actual"), out("insufficient_evidence", "unknown", 0.72, "actual_result_not_guidance"))
        .when(ph != ch, out("rejected", "unknown", 0.0, "fiscal_horizon_check")).when(pb != cb, out("rejected", "unknown", 0.0, "reporting_basis_check")).when(eps_clash, out("rejected", "unknown", 0.0, "explicit_metric_check"))
        .when(pm.isNull() != cm.isNull(), out("insufficient_evidence", "unknown", 0.45, "metric_shape_mismatch"))
        .when(risk & C["evidence_text"].rlike(R.REMOVAL), out("risk_removed", "improving", 0.84, "explicit_risk_removal"))
        .when(risk & (alike >= 0.45) & same_direction, out("reiterated", "stable", 0.88, "risk_text_reiteration"))
        .when(risk & (cr < pr), out("risk_intensified", "deteriorating", 0.82, "risk_direction")).when(risk & (cr > pr), out("risk_eased", "improving", 0.82, "risk_direction"))
        .when(both & ~single & (pm["values"] == cm["values"]) & (alike >= 0.45), out("reiterated", "stable", 0.82, "disaggregated_metric_reiteration"))
        .when(both & ~single, out("insufficient_evidence", "unknown", 0.60, "disaggregated_metric_shape"))
        .when(both, out(numeric, numeric_direction, F.when(unit.isNotNull(), 0.92).otherwise(0.72), "numeric_metric_comparison"))
        .when((dim == "strategy") & (alike >= 0.30), out("strategy_reiterated", "stable", 0.78, "strategy_text_similarity")).when(dim == "strategy", out("strategy_changed", "mixed", 0.68, "strategy_text_difference"))
        .when(unknown & (alike >= 0.30), out("reiterated", "stable", 0.72, "qualitative_text_similarity")).when(unknown, out("insufficient_evidence", "unknown", 0.40, "insufficient_direction"))
        .when(same_direction, out(F.when(alike >= 0.25, "reiterated").otherwise("stable"), "stable", F.when(alike >= 0.25, 0.78).otherwise(0.66), "qualitative_direction_match"))
        .when((pr == cr) & (pr != 0), out(F.when(alike >= 0.20, "reiterated").otherwise("stable"), "stable", 0.70, "qualitative_direction_equivalence"))
        .when(pr < cr, out(better, better, 0.76, "qualitative_direction_comparison")).when(pr > cr, out(worse, worse, 0.76, "qualitative_direction_comparison"))
        .otherwise(out("mixed", "mixed", 0.76, "qualitative_direction_comparison"))
    )


Matcher = Callable[[DataFrame], DataFrame]


def worth_mentioning(claim: str = "a") -> Column:
    """Whether a claim without a counterpart states more than general praise: catalysts need a direction, a metric or a finished act."""
    a = F.col(claim)
    acted = F.lower(a["evidence_text"]).rlike(r"\b(?:launched|approved|closed|completed|acquired|revised|raised|lowered)\b")
    return (a["dimension"] != "catalysts") | (F.coalesce(a["direction"], F.lit("unknown")) != "unknown") | a["metric"].isNotNull() | acted


def compare_periods(claims: DataFrame, matcher: Matcher = match_claims, keep_new: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Changes between each ticker's previous and current period, and the claims behind each change.

    Opposite signs inside one period of a subject give one ``mixed`` change. Silence is never a removal.
    ``matcher`` may be replaced; ``keep_new``, a test of the struct ``a`` that leads a subject's unmatched current claims, says
    whether they are worth a change (:func:`worth_mentioning` by default).
    Returns (changes, members): members are (change_id, claim_id, side) rows.
    """
    # Described claims and judged pairs feed several branches each; the text rules run once.
    pairs = settle(described(period_pair(claims)))
    sign = F.when(F.col("direction").isin(*R.POSITIVE_DIRECTIONS), 1).when(F.col("direction").isin(*R.NEGATIVE_DIRECTIONS), -1).otherwise(0)
    signed = pairs.withColumn("_sign", sign)
    side = lambda s, v: F.max((F.col("side") == s) & (F.col("_sign") == v))
    groups = signed.groupBy("ticker", "base_key").agg(
        F.max(F.col("side") == "previous").alias("_prev"), F.max(F.col("side") == "current").alias("_cur"),
        side("previous", 1).alias("_pp"), side("previous", -1).alias("_pn"), side("current", 1).alias("_cp"), side("current", -1).alias("_cn"),
        F.min_by("dimension", F.when(F.col("side") == "current", F.col("claim_id"))).alias("_dim"), F.min_by("subject", F.when(F.col("side") == "current", F.col("claim_id"))).alias("_subject"),
    ).where("_cur")
    mixed = F.col("_prev") & ((F.col("_pp") & F.col("_pn")) | (F.col("_cp") & F.col("_cn")))
    groups = groups.withColumn("_mixed", mixed)
    flagged = attach(pairs, groups.select("ticker", "base_key", "_mixed"), ["ticker", "base_key"], how="inner")
    rest = flagged.where(~F.col("_mixed")).drop("_mixed")
    matched = settle(matcher(rest))
    columns = ["claim_id", "evidence_text", "dimension", "direction", "certainty", "metric", "unit", "tokens", "topic", "subject"]
    packed = lambda name, s: rest.where(F.col("side") == s).select(F.col("claim_id").alias(f"_{name}"), F.struct(*columns).alias(name))
    judged = matched.where(F.col("previous_id").isNotNull()).withColumnsRenamed({"claim_id": "_c", "previous_id": "_p"}).join(packed("c", "current"), "_c").join(packed("p", "previous"), "_p")
    judged = settle(judged.withColumn("k", classify_change()))
    real = judged.where(~F.col("k.change_type").isin("rejected", "insufficient_evidence"))
    change_id = lambda *parts: tx.stable_id("tch_", **{f"p{i}": x for i, x in enumerate(parts)})
    pair_changes = real.select(
        change_id(F.col("ticker"), F.col("base_key"), F.col("_p"), F.col("_c")).alias("change_id"), "ticker", "base_key", F.col("c.dimension").alias("dimension"), F.col("c.subject").alias("subject"), "k.*", F.col("_p").alias("from_claim"), F.col("_c").alias("to_claim")
    )
    open_claims = matched.where(F.col("previous_id").isNull() & ~F.col("incompatible")).select("claim_id").join(rest.where("side = 'current'"), "claim_id")
    # A replaced pair stays silent, unless the current claim states a removal outright.
    removals = judged.where(F.col("k.change_type").isin("rejected", "insufficient_evidence") & F.col("c.evidence_text").rlike(R.REMOVAL)).select(F.col("_c").alias("claim_id")).join(rest.where("side = 'current'"), "claim_id")
    done = tx.completed(F.col("evidence_text"))
    lead = F.min_by(F.struct("claim_id", "dimension", "subject", "evidence_text", "direction", "metric", done.alias("done")), F.struct((~done).alias("a"), "claim_id")).alias("a")
    worth = open_claims.groupBy("ticker", "base_key").agg(lead).where(worth_mentioning() if keep_new is None else keep_new).select("ticker", "base_key")
    fresh = settle(look_up(open_claims, worth, ["ticker", "base_key"], "left_semi").unionByName(removals))
    anchor = fresh.groupBy("ticker", "base_key").agg(lead)
    new_changes = anchor.select(
        change_id(F.col("ticker"), F.col("base_key"), F.lit("new"), F.col("a.claim_id")).alias("change_id"), "ticker", "base_key", F.col("a.dimension").alias("dimension"), F.col("a.subject").alias("subject"),
        F.when(F.col("a.dimension") == "risks", "new_risk").when(F.col("a.done"), "newly_occurred").otherwise("newly_mentioned").alias("change_type"),
        F.when(F.col("a.dimension") == "risks", "deteriorating").otherwise("unknown").alias("direction"),
        F.when(F.col("a.dimension") == "risks", 0.78).when(F.col("a.done"), 0.74).otherwise(0.64).alias("confidence"), F.lit("current_period_only").alias("method"),
        F.lit(None).cast("string").alias("from_claim"), F.col("a.claim_id").alias("to_claim"),
    )
    mixed_changes = groups.where("_mixed").select(
        change_id(F.col("ticker"), F.col("base_key"), F.lit("mixed")).alias("change_id"), "ticker", "base_key", F.col("_dim").alias("dimension"), F.col("_subject").alias("subject"),
        F.lit("mixed").alias("change_type"), F.lit("mixed").alias("direction"), F.lit(0.78).alias("confidence"), F.lit("within_period_conflict").alias("method"), F.lit(None).cast("string").alias("from_claim"), F.lit(None).cast("string").alias("to_claim"),
    )
    changes = pair_changes.unionByName(new_changes).unionByName(mixed_changes)
    members = (
        pair_changes.select("change_id", F.col("from_claim").alias("claim_id"), F.lit("previous").alias("side")).unionByName(pair_changes.select("change_id", F.col("to_claim").alias("claim_id"), F.lit("current").alias("side")))
        .unionByName(attach(fresh.select("ticker", "base_key", "claim_id"), new_changes.select("ticker", "base_key", "change_id"), ["ticker", "base_key"], how="inner").select("change_id", "claim_id", F.lit("current").alias("side")))
        .unionByName(attach(flagged.where("_mixed").select("ticker", "base_key", "claim_id", "side"), mixed_changes.select("ticker", "base_key", "change_id"), ["ticker", "base_key"], how="inner").select("change_id", "claim_id", "side"))
    )
    return changes, members


def synthesize_states(claims: DataFrame, changes: DataFrame) -> DataFrame:
    """State, trend and confidence per (ticker, dimension, topic) of the current period; a NULL topic is the whole dimension.

    ``claims``: current-period claims (see :func:`period_pair`); ``changes``: output of :func:`compare_periods`.
    Repeated wording counts once: claims collapse to evidence groups before any weighing.
    """
    s, d = F.col("evidence_text"), F.col("dimension")
    named = claims.withColumns({
        "subject": tx.subject(s, d, F.col("topic")), "polarity": tx.claim_polarity(s, F.col("direction"), d), "absolute": tx.absolute_signal(s, d), "quality": tx.evidence_quality(F.col("certainty")),
        "comparative": tx.is_comparative(s), "wording": F.lower(F.trim(F.regexp_replace("evidence_text", r"\s+", " "))),
    })
    useful = F.col("subject").isin(*USEFUL_SUBJECTS) & (F.col("subject") != d)
    for dim, allowed in SUBJECTS_BY_DIMENSION.items():
        useful = useful & ((d != dim) | (F.col("subject").isin(*allowed) if allowed else F.lit(False)))
    scopes = named.withColumn("scope", F.explode(F.when(useful, F.array(F.lit(""), F.col("subject"))).otherwise(F.array(F.lit("")))))
    groups = scopes.groupBy("ticker", "dimension", "scope", "wording").agg(
        F.max_by(F.struct("polarity", "absolute", "quality", "comparative", "document_id", "claim_id"), F.struct("quality", "claim_id")).alias("g"), F.count("*").alias("copies"), F.max(F.col("period_label").isNotNull()).alias("_labelled"),
    )
    p, q, ab = F.col("g.polarity"), F.col("g.quality"), F.col("g.absolute")
    directed = p != 0
    stats = groups.groupBy("ticker", "dimension", "scope").agg(
        F.count("*").alias("evidence_groups"), F.sum(F.col("copies") - 1).alias("duplicates_removed"), F.avg(q).alias("quality"), F.countDistinct("g.document_id").alias("documents"),
        F.count_if(p > 0).alias("positive"), F.count_if(p < 0).alias("negative"), F.count_if(p == 0).alias("neutral"), F.count_if(ab > 0).alias("abs_positive"), F.count_if(ab < 0).alias("abs_negative"),
        F.try_divide(F.sum(F.when(directed, p * q)), F.sum(F.when(directed, q))).alias("_w"), F.max("_labelled").alias("_labelled"),
        F.max(F.col("g.comparative") & (p > 0)).alias("_up"), F.max(F.col("g.comparative") & (p < 0)).alias("_down"),
    )
    polarity = tx.change_polarity(F.col("change_type"), F.col("direction"))
    scoped_changes = changes.withColumn("scope", F.explode(F.array(F.lit(""), F.col("subject")))).withColumn("_pol", polarity)
    moves = scoped_changes.groupBy("ticker", "dimension", "scope").agg(
        F.count_if(F.col("_pol") > 0).alias("up_changes"), F.count_if(F.col("_pol") < 0).alias("down_changes"), F.count_if(F.col("change_type").isin("stable", "reiterated")).alias("stable_changes"),
        F.max((F.col("_pol") > 0) & F.col("change_type").isin("accelerating", "raised")).alias("_fast"), F.max((F.col("_pol") < 0) & F.col("change_type").isin("decelerating", "lowered")).alias("_slow"),
    )
    j = stats.join(moves, ["ticker", "dimension", "scope"], "left").fillna(0, ["up_changes", "down_changes", "stable_changes"]).fillna(False, ["_fast", "_slow"])
    w = F.coalesce("_w", F.lit(0.0))
    clash = (F.col("positive") > 0) & (F.col("negative") > 0)
    pos = F.when(clash & (w <= -0.45), 0).otherwise(F.col("positive"))
    neg = F.when(clash & (w >= 0.45), 0).otherwise(F.col("negative"))
    neu, total = F.col("neutral") > 0, F.col("evidence_groups")
    up, down = pos > 0, neg > 0

    def words(yes: str, no: str, none: str) -> Column:
        return F.when(up, yes).when(down, no).when(neu, none).otherwise("unknown")

    strength = (
        F.when(w >= 0.65, F.when((F.col("abs_positive") > 0) | (pos >= 3), "strong").otherwise("healthy")).when(w > 0, "healthy")
        .when(w <= -0.65, F.when((F.col("abs_negative") > 0) | (neg >= 3), "stressed").otherwise("weak")).when(w < 0, "weak").otherwise(F.when(neu, "neutral").otherwise("unknown"))
    )
    heavy = (F.col("abs_negative") > 0) | (neg >= 2)
    risk = F.when(down, F.when((w < -0.70) & heavy, "increasing").when(heavy, "elevated").otherwise("unknown")).when(up, F.when((F.col("abs_positive") > 0) | (pos >= 2), "low").otherwise("unknown")).when(neu, "moderate").otherwise("unknown")
    state = (
        F.when(clash & (F.abs(w) < 0.45), "mixed").when(total == 0, "unknown").when(F.col("dimension") == "guidance", words("raised", "lowered", "maintained")).when(F.col("dimension") == "margins", words("expanding", "compressing", "stable"))
        .when(F.col("dimension") == "risks", risk).when(F.col("dimension") == "product", words("progressing", "delayed", "stable")).when(F.col("dimension") == "capital_allocation", words("expansionary", "conservative", "neutral")).otherwise(strength)
    )
    ups, downs = F.col("up_changes") > 0, F.col("down_changes") > 0
    trend = (
        F.when(ups & downs, "mixed").when(ups, F.when(F.col("_fast"), "accelerating").otherwise("improving")).when(downs, F.when(F.col("_slow"), "decelerating").otherwise("deteriorating"))
        .when(F.col("stable_changes") > 0, "stable").when(F.col("_up") & F.col("_down"), "mixed").when(F.col("_up"), "improving").when(F.col("_down"), "deteriorating").otherwise("unknown")
    )
    contradictions = F.when(clash, F.least("positive", "negative")).otherwise(0)
    temporal = F.when(ups | downs | (F.col("stable_changes") > 0), 1.0).when(F.col("_up") | F.col("_down"), 0.72).otherwise(0.45)
    specific = F.when(F.col("scope") != "", 1.0).otherwise(0.86)
    raw = 0.15 + 0.20 * F.least(F.lit(1.0), total / 3.0) + 0.22 * F.col("quality") + 0.20 * F.greatest(F.lit(0.25), 1 - 0.65 * contradictions) + 0.10 * temporal + 0.08 * specific + 0.05 * F.when(F.col("_labelled"), 1.0).otherwise(0.6)
    staged = j.withColumns({"current_state": state, "trend": trend, "contradictions": contradictions, "_c": raw})
    capped = F.when((F.col("documents") <= 1) & (total > 1), F.least("_c", F.lit(0.90))).otherwise(F.col("_c"))
    capped = F.when(F.col("current_state") == "unknown", F.least(capped, F.lit(0.58))).otherwise(capped)
    out = staged.withColumn("confidence", F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), capped)), 4))
    kept = out.where((F.col("scope") == "") | (F.col("current_state") != "unknown") | (F.col("trend") != "unknown"))
    return kept.select(
        tx.stable_id("state_", ticker=F.upper("ticker"), dimension=d, topic=F.col("scope")).alias("state_id"), "ticker", "dimension", F.nullif("scope", F.lit("")).alias("topic"), "current_state", "trend", F.round("_w", 9).alias("weighted_polarity"),
        "evidence_groups", "duplicates_removed", "positive", "negative", "neutral", "contradictions", "documents", "quality", "confidence",
    )
