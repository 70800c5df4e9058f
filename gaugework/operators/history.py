"""Multi-year history: features per ticker, robust trends, shortlist scores, integrity audits, hand-off.

A ticker's history is first reduced to one row per fiscal year, so the per-ticker array it is folded
into holds at most the number of fiscal years; every feature is a column expression on that array.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions.numbers import clamp, close_to, joined_reasons, present_mean
from gaugework.operators.crosssection import group_statistics
from gaugework.params import HistoryParams
from gaugework.plans.joins import attach, latest_per_key, look_up
from gaugework.plans.ordered import numbered

# Metric -> (family, better direction, group) of the history model.
HISTORY_METRICS = {
    "latest_roa": ("PROFITABILITY", "higher", "returns"),
    "latest_roe": ("PROFITABILITY", "higher", "returns"),
    "latest_net_margin": ("PROFITABILITY", "higher", "margins"),
    "latest_gross_margin": ("PROFITABILITY", "higher", "margins"),
    "latest_pre_tax_margin": ("PROFITABILITY", "higher", "margins"),
    "latest_sales_to_assets": ("PROFITABILITY", "higher", "efficiency"),
    "latest_fcf_margin": ("CASH_FLOW", "higher", "cash_generation"),
    "latest_fcf_yield": ("CASH_FLOW", "higher", "cash_generation"),
    "positive_fcf_share": ("CASH_FLOW", "higher", "cash_generation"),
    "cash_conversion": ("CASH_FLOW", "higher", "cash_conversion"),
    "latest_current_ratio": ("BALANCE_SHEET", "higher", "liquidity"),
    "latest_quick_ratio": ("BALANCE_SHEET", "higher", "liquidity"),
    "latest_working_capital_to_assets": ("BALANCE_SHEET", "higher", "liquidity"),
    "latest_debt_to_equity": ("BALANCE_SHEET", "lower", "leverage"),
    "latest_interest_coverage": ("BALANCE_SHEET", "higher", "leverage"),
    "latest_net_debt_to_ebitda": ("BALANCE_SHEET", "lower", "leverage"),
    "positive_net_income_share": ("STABILITY", "higher", "earnings_stability"),
    "revenue_growth_stability": ("STABILITY", "lower", "earnings_stability"),
    "latest_ev_ebitda": ("VALUATION", "lower", "enterprise_value"),
    "latest_ev_ebit": ("VALUATION", "lower", "enterprise_value"),
    "latest_price_fcf": ("VALUATION", "lower", "cash_flow_value"),
    "revenue_cagr": ("GROWTH", "higher", "revenue_growth"),
    "latest_revenue_growth": ("GROWTH", "higher", "revenue_growth"),
    "revenue_growth_acceleration": ("INFLECTION", "higher", "revenue_acceleration"),
    "net_margin_change": ("INFLECTION", "higher", "margin_inflection"),
    "fcf_margin_change": ("INFLECTION", "higher", "cash_flow_inflection"),
    "roa_change": ("INFLECTION", "higher", "margin_inflection"),
    "ebit_margin_change": ("INFLECTION", "higher", "margin_inflection"),
    "debt_to_equity_change": ("INFLECTION", "lower", "deleveraging"),
    "revenue_four_year_trend": ("TREND", "higher", "revenue_trend"),
    "net_margin_four_year_trend": ("TREND", "higher", "margin_trend"),
    "fcf_margin_four_year_trend": ("TREND", "higher", "cash_flow_trend"),
    "roa_four_year_trend": ("TREND", "higher", "margin_trend"),
    "gross_margin_four_year_trend": ("TREND", "higher", "margin_trend"),
    "debt_to_equity_four_year_trend": ("TREND", "lower", "deleveraging_trend"),
    "positive_revenue_growth_share": ("TREND", "higher", "revenue_trend"),
    "trend_direction_breadth": ("TREND", "higher", "trend_breadth"),
}

# Metric -> adverse direction of the short model, by family.
SHORT_METRICS = {
    "operating": {"latest_roa": "lower", "latest_roe": "lower", "latest_net_margin": "lower", "latest_gross_margin": "lower", "latest_pre_tax_margin": "lower", "revenue_cagr": "lower", "latest_revenue_growth": "lower"},
    "cash_flow": {"latest_fcf_margin": "lower", "latest_fcf_yield": "lower", "positive_fcf_share": "lower"},
    "balance_sheet": {"latest_current_ratio": "lower", "latest_quick_ratio": "lower", "latest_working_capital_to_assets": "lower", "latest_debt_to_equity": "higher", "latest_interest_coverage": "lower", "latest_net_debt_to_ebitda": "higher"},
    "trend": {"revenue_four_year_trend": "lower", "net_margin_four_year_trend": "lower", "fcf_margin_four_year_trend": "lower", "roa_four_year_trend": "lower", "gross_margin_four_year_trend": "lower", "debt_to_equity_four_year_trend": "higher", "positive_revenue_growth_share": "lower"},
    "inflection": {"revenue_growth_acceleration": "lower", "net_margin_change": "lower", "fcf_margin_change": "lower", "roa_change": "lower", "ebit_margin_change": "lower", "debt_to_equity_change": "higher"},
    "point_in_time": {"primary_short_score": "higher", "primary_price_change_4w": "lower", "primary_price_change_12w": "lower", "primary_f1_estimate_change_4w": "lower", "primary_f2_estimate_change_4w": "lower"},
}

# Annual measures a history may carry; absent ones are added as missing.
MEASURES = [
    "revenue", "net_income", "ebit", "ebitda", "free_cash_flow", "operating_cash_flow", "total_debt", "cash", "shareholders_equity", "market_cap",
    "net_margin", "gross_margin", "pre_tax_margin", "roa", "roe", "sales_to_assets", "fcf_yield", "current_ratio", "quick_ratio",
    "working_capital_to_assets", "debt_to_equity", "interest_coverage", "ev_ebitda", "ev_ebit", "price_fcf",
]
TRENDS = {"revenue": "higher", "net_margin": "higher", "fcf_margin": "higher", "roa": "higher", "gross_margin": "higher", "debt_to_equity": "lower"}


def _bind(expression: str, name: str, body: str) -> str:
    """SQL text that evaluates ``expression`` once and uses it as ``name`` inside ``body``."""
    return f"transform(array({expression}), {name} -> {body})[0]"


def _total(array: str, item: str) -> str:
    return f"aggregate({array}, 0D, (acc, e) -> acc + {item})"


def _weighted_median(pairs: str) -> str:
    """SQL for the first v at which the running weight of pairs (v, w), sorted by v, reaches half of the total."""
    walk = (
        "aggregate(srt, named_struct('run', 0D, 'hit', CAST(NULL AS DOUBLE)), "
        f"(a, e) -> named_struct('run', a.run + e.w, 'hit', coalesce(a.hit, CASE WHEN a.run + e.w >= {_total('srt', 'e.w')} / 2 THEN e.v END)), a -> a.hit)"
    )
    return _bind(f"array_sort({pairs})", "srt", walk)


def trend(points: str, decay: float, minimum: int, log_values: bool = False) -> Column:
    """Recency-weighted Theil-Sen slope, weighted R2 and point count of a column of (x, v) structs in year order.

    NULL unless ``minimum`` valid points exist and the last year itself is valid. Written as one SQL
    expression over an array of at most four elements, so it costs no shuffle of its own.
    """
    if not 0 < decay <= 1:
        raise ValueError("decay must be in (0, 1]")
    valid = "p.v IS NOT NULL AND p.v > 0" if log_values else "p.v IS NOT NULL"
    last = f"exists(slice({points}, -1, 1), p -> {valid})"
    held = f"transform(filter({points}, p -> {valid}), p -> named_struct('x', p.x, 'y', {'ln(p.v)' if log_values else 'p.v'}))"
    weighted = f"transform(raw, p -> named_struct('x', p.x, 'y', p.y, 'w', pow({decay}D, element_at(raw, -1).x - p.x)))"
    pairs = "flatten(transform(pts, (p, i) -> transform(slice(pts, i + 2, size(pts)), q -> named_struct('v', (q.y - p.y) / (q.x - p.x), 'w', p.w * q.w))))"
    offsets = "transform(pts, p -> named_struct('v', p.y - slope * p.x, 'w', p.w))"
    residual = _total("pts", "e.w * pow(e.y - icpt - slope * e.x, 2)")
    spread = _bind(f"{_total('pts', 'e.w * e.y')} / {_total('pts', 'e.w')}", "mu", _total("pts", "e.w * pow(e.y - mu, 2)"))
    r2 = _bind(f"named_struct('t', {spread}, 'r', {residual})", "d", "CASE WHEN d.t = 0 AND d.r = 0 THEN 1D WHEN d.t > 0 THEN greatest(0D, least(1D, 1 - d.r / d.t)) END")
    slope = "expm1(slope)" if log_values else "slope"
    fitted = _bind(weighted, "pts", _bind(_weighted_median(pairs), "slope", _bind(_weighted_median(offsets), "icpt", f"named_struct('slope', {slope}, 'r2', {r2}, 'n', size(raw))")))
    empty = "named_struct('slope', CAST(NULL AS DOUBLE), 'r2', CAST(NULL AS DOUBLE), 'n', size(raw))"
    return F.expr(_bind(held, "raw", f"CASE WHEN size(raw) >= {max(minimum, 2)} AND {last} THEN {fitted} ELSE {empty} END"))


def yearly(raw: DataFrame) -> DataFrame:
    """One row per (ticker, fiscal_year): the last period, then the last source row; absent measures become NULL."""
    named = raw.withColumn("ticker", F.upper(F.trim(F.coalesce("ticker", F.lit("")))))
    absent = [m for m in MEASURES if m not in raw.columns]
    full = named.where(F.col("ticker") != "").withColumns({m: F.lit(None).cast("double") for m in absent}) if absent else named.where(F.col("ticker") != "")
    for extra in ("error", "missing_notes"):
        if extra not in full.columns:
            full = full.withColumn(extra, F.lit(None).cast("string"))
    order = [F.coalesce("fiscal_period_end", F.to_date(F.lit("0001-01-01"))), "source_row"]
    return latest_per_key(full.where(F.col("fiscal_year").isNotNull()), ["ticker", "fiscal_year"], order)


def history_features(raw: DataFrame, params: HistoryParams = HistoryParams()) -> DataFrame:
    """The feature row of every ticker from its last four distinct fiscal years.

    ``raw``: ticker, source_row, fiscal_year INT, fiscal_period_end DATE, any of :data:`MEASURES`, error, missing_notes.
    """
    counts = raw.where(F.col("fiscal_year").isNotNull()).groupBy(F.upper(F.trim("ticker")).alias("ticker")).agg(F.count("*").alias("_rows"), F.countDistinct("fiscal_year").alias("available_history_years"))
    rows = yearly(raw)
    fields = ["fiscal_year", "fiscal_period_end", "error", "missing_notes", *MEASURES]
    folded = rows.groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct(*[F.col(f).cast("double").alias(f) if f in MEASURES else F.col(f) for f in fields]))).alias("_all"))
    recent = folded.select("ticker", F.slice("_all", F.greatest(F.size("_all") - 3, F.lit(1)), 4).alias("h"))
    based = recent.withColumn("h", F.expr("""transform(h, r -> struct(r.*,
        CASE WHEN r.revenue > 0 THEN r.free_cash_flow / r.revenue END AS fcf_margin,
        CASE WHEN r.revenue > 0 THEN r.ebit / r.revenue END AS ebit_margin,
        CASE WHEN r.debt_to_equity >= 0 THEN r.debt_to_equity END AS debt_to_equity_valid))""".replace("r.*", ", ".join(f"r.{f}" for f in fields))))
    step = "h[greatest(i, 1) - 1]"
    based = based.withColumns({
        "g": F.expr(f"""transform(h, (r, i) -> CASE WHEN i > 0 AND r.fiscal_year - {step}.fiscal_year = 1 AND r.revenue > 0 AND {step}.revenue > 0
            THEN r.revenue / {step}.revenue - 1 END)"""),
        "z": F.expr("element_at(h, -1)"),
        "b": F.expr("CASE WHEN element_at(h, -1).fiscal_year - try_element_at(h, -2).fiscal_year = 1 THEN try_element_at(h, -2) END"),
        **{f"_p_{n}": F.expr(f"transform(h, r -> named_struct('x', CAST(r.fiscal_year AS DOUBLE), 'v', r.{'debt_to_equity_valid' if n == 'debt_to_equity' else n}))") for n in TRENDS},
    })
    with_trends = based.withColumns({f"_t_{n}": trend(f"_p_{n}", params.decay, params.min_points, n == "revenue") for n in TRENDS})

    def share_positive(name: str) -> str:
        return f"CASE WHEN exists(h, r -> r.{name} IS NOT NULL) THEN size(filter(h, r -> coalesce(r.{name} > 0, false))) / size(h) END"

    def trace(name: str) -> str:
        return f"array_join(transform(h, r -> concat(CAST(r.fiscal_year AS STRING), ': ', coalesce(CAST(round(r.{name}, 6) AS STRING), 'NO DATA'))), ' | ')"

    def positive(name: str) -> str:
        return f"CASE WHEN z.{name} > 0 THEN z.{name} END"

    known = "filter(g, v -> v IS NOT NULL)"
    deviation = _bind(f"{_total(known, 'e')} / size({known})", "m", f"sqrt({_total(known, 'pow(e - m, 2)')} / size({known}))")
    simple = {
        "history_years": "size(h)",
        "trend_year_span": "z.fiscal_year - h[0].fiscal_year",
        "max_fiscal_year_gap": f"coalesce(array_max(transform(h, (r, i) -> CASE WHEN i > 0 THEN r.fiscal_year - {step}.fiscal_year END)), 0)",
        "fiscal_years": "array_join(transform(h, r -> CAST(r.fiscal_year AS STRING)), ' | ')",
        "source_error_count": "size(filter(h, r -> trim(coalesce(r.error, '')) <> ''))",
        "latest_fiscal_year": "z.fiscal_year",
        "latest_fiscal_period_end": "z.fiscal_period_end",
        "revenue_cagr": "CASE WHEN h[0].revenue > 0 AND z.revenue > 0 AND z.fiscal_year > h[0].fiscal_year THEN pow(z.revenue / h[0].revenue, 1D / (z.fiscal_year - h[0].fiscal_year)) - 1 END",
        "latest_revenue_growth": "element_at(g, -1)",
        "revenue_growth_acceleration": "CASE WHEN b IS NOT NULL THEN element_at(g, -1) - try_element_at(g, -2) END",
        "revenue_growth_stability": f"CASE WHEN size({known}) >= 2 THEN {deviation} END",
        "positive_revenue_growth_share": f"CASE WHEN size(h) > 1 AND size({known}) > 0 THEN size(filter(g, v -> coalesce(v > 0, false))) / (size(h) - 1) END",
        "positive_net_income_share": share_positive("net_income"),
        "positive_fcf_share": share_positive("free_cash_flow"),
        "cash_conversion": "CASE WHEN z.net_income > 0 THEN z.operating_cash_flow / z.net_income END",
        "latest_net_debt_to_ebitda": "CASE WHEN z.ebitda > 0 THEN (z.total_debt - z.cash) / z.ebitda END",
        "latest_debt_to_equity": "z.debt_to_equity_valid",
        "latest_interest_coverage_raw": "z.interest_coverage",
        "_notes": "z.missing_notes",
    }
    simple |= {f"latest_{n}": f"z.{n}" for n in ("revenue", "net_income", "ebit", "ebitda", "shareholders_equity", "free_cash_flow", "market_cap", "roa", "roe", "net_margin", "gross_margin", "pre_tax_margin", "sales_to_assets", "fcf_margin", "fcf_yield", "working_capital_to_assets")}
    simple |= {f"latest_{n}": positive(n) for n in ("current_ratio", "quick_ratio", "interest_coverage", "ev_ebitda", "ev_ebit", "price_fcf")}
    simple |= {f"{n}_change": f"z.{n} - b.{n}" for n in ("net_margin", "fcf_margin", "roa", "ebit_margin", "gross_margin")}
    simple |= {"debt_to_equity_change": "z.debt_to_equity_valid - b.debt_to_equity_valid"}
    simple |= {f"{n}_history": trace(n) for n in ("revenue", "net_income", "free_cash_flow", "net_margin", "roa", "debt_to_equity")}
    for n in TRENDS:
        simple |= {f"{n}_four_year_trend": f"_t_{n}.slope", f"{n}_four_year_trend_r2": f"_t_{n}.r2", f"{n}_four_year_trend_observations": f"_t_{n}.n"}
    full = with_trends.selectExpr("ticker", *[f"{e} AS {n}" for n, e in simple.items()])

    def breadth(values: Sequence[tuple[str, str]]) -> Column:
        def one(name: str, direction: str) -> Column:
            v = F.col(name) if direction == "higher" else -F.col(name)
            return F.when(v > 0, 1.0).when(v == 0, 0.5).when(v < 0, 0.0)

        return present_mean(*[one(n, d) for n, d in values])

    recent_moves = [("latest_revenue_growth", "higher"), ("net_margin_change", "higher"), ("fcf_margin_change", "higher"), ("roa_change", "higher"), ("gross_margin_change", "higher"), ("debt_to_equity_change", "lower")]
    dropped = F.col("_rows") - F.col("available_history_years")
    out = full.withColumns({
        "trend_direction_breadth": breadth([(f"{n}_four_year_trend", d) for n, d in TRENDS.items()]),
        "recent_favourable_breadth": breadth(recent_moves),
        "recent_direction_observations": sum((F.col(n).isNotNull().cast("int") for n, _ in recent_moves), F.lit(0)),
        "trend_fit_r2_mean": present_mean(*[F.col(f"{n}_four_year_trend_r2") for n in TRENDS]),
    }).join(counts, "ticker")
    warnings = F.array_join(F.array_distinct(F.array_compact(F.array(
        F.when(dropped > 0, F.concat(F.lit("Dropped "), dropped.cast("string"), F.lit(" duplicate fiscal-year row(s); kept latest period"))),
        F.when(F.col("source_error_count") > 0, F.lit("Source Error field populated")),
        F.when(F.trim(F.coalesce("_notes", F.lit(""))) != "", F.trim("_notes")),
    ))), "; ")
    return out.withColumns({"duplicate_fiscal_rows_dropped": dropped, "warnings": warnings}).drop("_rows", "_notes")


def shortlist_scores(long: DataFrame, keys: Sequence[str], params: HistoryParams = HistoryParams()) -> DataFrame:
    """Score each (keys, metric) value inside the shortlist: mid-rank percentile blended with a robust score, shrunk to 50.

    ``long``: keys, ticker, metric, value, direction ('higher' or 'lower').
    """
    group = [*keys, "metric"]
    stats = group_statistics(long, group)
    joined = look_up(long, stats, [*group, "value"])
    n, lower = F.col("n"), F.col("direction") == "lower"
    rank = F.when(lower, n + 1 - F.col("rank")).otherwise(F.col("rank"))
    percentile = (rank - 0.5) / n * 100
    mad_scale, dev = params.mad_scale * F.col("mad"), F.sqrt("variance")
    scale = F.when(mad_scale > 0, mad_scale).when(dev > 0, dev)
    z = clamp(F.try_divide(F.col("value") - F.col("median"), scale), -params.z_cap, params.z_cap)
    robust = F.when(scale.isNull(), 50.0).otherwise(clamp(50 + 50 * F.when(lower, -z).otherwise(z) / params.z_cap, 0.0, 100.0))
    raw = params.percentile_share * percentile + (1 - params.percentile_share) * robust
    reliability = n / (n + params.shrinkage) if params.shrinkage > 0 else F.lit(1.0)
    score = F.when(F.col("value").isNotNull() & (n >= params.min_peers), 50 + (raw - 50) * reliability)
    return joined.select(*long.columns, score.alias("score"))


def weighted_families(scores: DataFrame, registry: DataFrame, families: DataFrame, min_coverage: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metrics to equal-weight groups to families to a final score, with contributions at each level.

    ``scores``: ticker, metric, score. ``registry``: metric, family, duplicate_group, metric_weight.
    ``families``: family, family_weight. Returns (final, family rows, metric rows).
    """
    rated = scores.join(F.broadcast(registry.where(F.col("metric_weight") > 0)), "metric").repartition("ticker")
    w = F.col("metric_weight")
    groups = rated.groupBy("ticker", "family", "duplicate_group").agg(
        F.sum(w).alias("configured"),
        F.sum(F.when(F.col("score").isNotNull(), w).otherwise(0.0)).alias("present"),
        F.sum(F.col("score") * w).alias("points"),
    )
    groups = groups.withColumn("group_score", F.try_divide("points", F.nullif("present", F.lit(0.0)))).withColumn(
        "usable", F.col("group_score").isNotNull() & (F.col("present") / F.col("configured") >= min_coverage)
    )
    fam = groups.groupBy("ticker", "family").agg(F.count("*").alias("group_count"), F.count_if("usable").alias("usable_groups"), F.sum(F.when(F.col("usable"), F.col("group_score"))).alias("_sum"))
    fam = fam.withColumn("metric_coverage", F.col("usable_groups") / F.col("group_count"))
    fam = fam.withColumn("family_score", F.when(F.col("metric_coverage") >= min_coverage, F.try_divide("_sum", F.nullif("usable_groups", F.lit(0)))))
    fam = fam.join(F.broadcast(families), "family").drop("_sum")
    whole = Window.partitionBy("ticker")
    fw, has = F.col("family_weight"), F.col("family_score").isNotNull()
    applied = F.when(has, fw).otherwise(0.0)
    fam = fam.withColumn("applied_weight", applied)
    fam = fam.withColumn("contribution", F.try_divide(F.col("family_score") * F.col("applied_weight"), F.nullif(F.sum("applied_weight").over(whole), F.lit(0.0))))
    without = F.try_divide(F.sum(F.col("family_score") * F.col("applied_weight")).over(whole) - F.coalesce(F.col("family_score") * F.col("applied_weight"), F.lit(0.0)), F.nullif(F.sum("applied_weight").over(whole) - F.col("applied_weight"), F.lit(0.0)))
    fam = fam.withColumn("score_without", F.when(fw > 0, without))
    final = fam.groupBy("ticker").agg(
        F.sum("applied_weight").alias("applied_weight"),
        F.sum(fw).alias("configured_weight"),
        F.sum(F.col("family_score") * fw).alias("numerator"),
        F.min("score_without").alias("leave_one_out_min"),
    )
    final = final.withColumns({
        "weight_coverage": F.try_divide("applied_weight", F.nullif("configured_weight", F.lit(0.0))),
        "final_score": F.try_divide("numerator", F.nullif("applied_weight", F.lit(0.0))),
    })
    share = F.col("metric_weight") / F.col("configured")
    metrics = rated.join(groups.select("ticker", "family", "duplicate_group", "configured", "group_score", "usable"), ["ticker", "family", "duplicate_group"]).join(
        fam.select("ticker", "family", "usable_groups", "family_score", F.col("contribution").alias("_fc")), ["ticker", "family"]
    )
    inside = F.when(F.col("usable") & F.col("family_score").isNotNull(), F.try_divide(F.col("group_score") * share, "usable_groups"))
    metrics = metrics.select("ticker", "metric", "family", "score", inside.alias("family_contribution"), (inside * F.try_divide("_fc", F.nullif("family_score", F.lit(0.0)))).alias("final_contribution"))
    return final, fam, metrics


def evidence_domains(families: DataFrame, domains: DataFrame, strong: float) -> DataFrame:
    """Weighted score per evidence domain and counts of strong families and domains (``domains``: family, domain)."""
    counted = families.groupBy("ticker").agg(F.count_if(F.col("family_score") >= strong).alias("strong_families"))
    dom = families.join(F.broadcast(domains), "family").groupBy("ticker", "domain").agg(
        F.try_divide(F.sum(F.col("family_score") * F.col("applied_weight")), F.nullif(F.sum("applied_weight"), F.lit(0.0))).alias("domain_score")
    )
    strong_domains = dom.groupBy("ticker").agg(F.count_if(F.col("domain_score") >= strong).alias("strong_domains"))
    return counted.join(strong_domains, "ticker", "left").withColumn("strong_domains", F.coalesce("strong_domains", F.lit(0)))


def trend_reliability(features: DataFrame, weights: Mapping[str, float], trend_coverage: str, params: HistoryParams = HistoryParams()) -> DataFrame:
    """History and fit reliability of the slope metrics (``weights``: trend name -> metric weight)."""
    total = sum(weights.values())
    history, fit = F.lit(0.0), F.lit(0.0)
    for name, weight in weights.items():
        n = F.coalesce(f"{name}_four_year_trend_observations", F.lit(0))
        step = F.when(n >= 4, 1.0).when(n == 3, params.three_year_reliability).otherwise(0.0)
        history = history + F.when(F.col(f"{name}_four_year_trend").isNotNull(), step).otherwise(0.0) * weight
        r2 = clamp(F.coalesce(f"{name}_four_year_trend_r2", F.lit(0.0)), 0.0, 1.0)
        fit = fit + (params.fit_floor + (1 - params.fit_floor) * r2) * weight
    h, f = (history / total, fit / total) if total > 0 else (F.lit(0.0), F.lit(0.0))
    coverage = clamp(F.coalesce(trend_coverage, F.lit(0.0)), 0.0, 1.0)
    return features.withColumns({"trend_history_reliability": h, "trend_fit_reliability": f, "effective_trend_reliability": clamp(coverage * h * f, 0.0, 1.0)})


def gated(df: DataFrame, gates: Mapping[str, Column], data_checks: Mapping[str, Column], prefix: str = "") -> DataFrame:
    """Economic gates decide eligibility; data checks only decide the data regime. Both list what failed."""
    def failing(tests: Mapping[str, Column]) -> Column:
        return joined_reasons(*[(~F.coalesce(t, F.lit(False)), n) for n, t in tests.items()], sep="; ")

    out = df.withColumns({f"{prefix}gate_fail_reasons": failing(gates), f"{prefix}data_regime_reasons": failing(data_checks)})
    return out.withColumns({
        f"{prefix}eligible": F.col(f"{prefix}gate_fail_reasons") == "",
        f"{prefix}data_regime": F.when(F.col(f"{prefix}data_regime_reasons") == "", "STANDARD_DATA").otherwise("LIMITED_DATA"),
    })


def ranked_by(df: DataFrame, keys: Sequence[str], score: str, tie: str, test: Column, out: str = "rank") -> DataFrame:
    """1..n inside keys by score, then reliability, then ticker; rows failing ``test`` get NULL."""
    ok = F.col(score).isNotNull() & F.coalesce(test, F.lit(False))
    done = numbered(df.where(ok), keys, [F.desc(score), F.desc(tie), F.col("ticker")], out).drop(f"{out}_all")
    return done.unionByName(df.where(~ok).withColumn(out, F.lit(None).cast("long")))


def adverse_breadth(features: DataFrame, revenue_share_limit: float = 0.5) -> DataFrame:
    """Shares of adverse trends and recent moves, and the number of absolutely weak domains."""
    def bad(name: str, direction: str) -> Column:
        v = F.col(name)
        if name == "positive_revenue_growth_share":
            return (v < revenue_share_limit).cast("double")
        return ((v < 0) if direction == "lower" else (v > 0)).cast("double")

    trends = [bad(n, d) for n, d in SHORT_METRICS["trend"].items()]
    recent_moves = {"latest_revenue_growth": "lower", "net_margin_change": "lower", "fcf_margin_change": "lower", "roa_change": "lower", "ebit_margin_change": "lower", "debt_to_equity_change": "higher"}
    recent = [bad(n, d) for n, d in recent_moves.items()]

    def count(parts: Sequence[Column]) -> Column:
        return sum((p.isNotNull().cast("int") for p in parts), F.lit(0))

    def domain(*tests: Column) -> Column:
        """Weak if any stated test holds; unknown only when nothing is stated."""
        known = F.array_compact(F.array(*tests))
        return F.when(F.size(known) > 0, F.exists(known, lambda t: t).cast("int"))

    c = F.col
    domains = [
        domain(c("latest_net_income") < 0, c("latest_net_margin") < 0, c("latest_ebit") <= 0, c("latest_ebitda") <= 0),
        domain(c("latest_free_cash_flow") < 0),
        domain(c("latest_current_ratio") < 1, c("latest_interest_coverage_raw") < 1, c("latest_shareholders_equity") <= 0, c("latest_net_debt_to_ebitda") > 3),
    ]
    some = F.coalesce(*[d for d in domains]).isNotNull()
    return features.withColumns({
        "adverse_trend_observations": count(trends), "adverse_trend_breadth": present_mean(*trends),
        "adverse_recent_observations": count(recent), "adverse_recent_breadth": present_mean(*recent),
        "weak_domains": F.when(some, sum((F.coalesce(d, F.lit(0)) for d in domains), F.lit(0))),
    })


# --- shortlist plumbing -----------------------------------------------------------------------------


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Inner join on a key that must be unique on both sides; the second result lists offending keys."""
    def repeated(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1").select(key, F.lit(side).alias("side"), "rows")

    return left.join(right, key), repeated(left, "left").unionByName(repeated(right, "right"))


def with_lineage(history: DataFrame, lineage: DataFrame, key: str) -> DataFrame:
    """Replace lineage columns of a many-row history by the current lineage of its key (old ones are dropped first)."""
    fields = [c for c in lineage.columns if c != key]
    stale = [c for c in history.columns if c != key and any(c == f or c.startswith(f"{f}_") for f in fields)]
    return attach(history.drop(*stale), lineage, [key], how="inner")


def restrict_to_shortlist(rows: DataFrame, shortlist: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows whose key is on the shortlist (first shortlist row per key counts once)."""
    return rows.join(shortlist.select(key).distinct(), key, "left_semi")


def append_missing(table: DataFrame, shortlist: DataFrame, reason: str = "missing_source_history") -> DataFrame:
    """Shortlisted names without history stay visible as explicit non-eligible rows."""
    gone = shortlist.dropDuplicates(["ticker"]).join(table.select("ticker").distinct(), "ticker", "left_anti")
    fill = {"eligible": F.lit(False), "gate_fail_reasons": F.lit(reason), "history_years": F.lit(0)}
    cols = [F.col("ticker") if c == "ticker" else (fill[c].cast(t) if c in fill else (F.col(c).cast(t) if c in shortlist.columns else F.lit(None).cast(t))).alias(c) for c, t in table.dtypes]
    return table.unionByName(gone.select(*cols))


def merge_histories(sources: Sequence[DataFrame], completeness: Sequence[str]) -> DataFrame:
    """Union of annual histories; per (ticker, fiscal_year) the latest period, then the most complete row, then the later source."""
    tagged = [df.withColumn("_source", F.lit(i)) for i, df in enumerate(sources)]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df, allowMissingColumns=True)
    filled = sum((F.col(c).isNotNull().cast("int") for c in completeness), F.lit(0))
    scored = union.withColumn("_filled", filled)
    best = latest_per_key(scored, ["ticker", "fiscal_year"], [F.coalesce("fiscal_period_end", F.to_date(F.lit("0001-01-01"))), "_filled", "_source", "source_row"])
    return best.drop("_source", "_filled")


def shortlist_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Added and removed (category, ticker) pairs."""
    b, a = before.select("category", "ticker").distinct(), after.select("category", "ticker").distinct()
    return a.exceptAll(b).withColumn("change", F.lit("added")).unionByName(b.exceptAll(a).withColumn("change", F.lit("removed")))


# --- source integrity -------------------------------------------------------------------------------


def audit_rows(rows: DataFrame, snapshot: DataFrame | None, as_of: Column, params: HistoryParams = HistoryParams(),
               essential: Sequence[str] = (), provenance: Sequence[str] = (), statement: Sequence[str] = ()) -> DataFrame:
    """Integrity flags, missing essentials, provenance and data regime of every annual source row.

    ``rows``: source_row (unique), ticker, fiscal_year, fiscal_period_end, market_cap, shares, price, filed
    and optional currencies. Comparisons between rows run on (ticker, year) extracts, never on whole tickers.
    ``snapshot``: ticker, market_cap, security_type.
    """
    base = rows.withColumn("ticker", F.upper(F.trim(F.coalesce("ticker", F.lit("")))))
    for name, kind in (("price_currency", "string"), ("cap_currency", "string"), ("statement_currency", "string"), ("adr_ratio", "string"), ("filed", "date")):
        if name not in base.columns:
            base = base.withColumn(name, F.lit(None).cast(kind))
    year = F.coalesce("fiscal_year", F.lit(-1))

    # A period end reused by another fiscal year: the last row of the earlier and the first of the later year.
    reuse = base.where(F.col("fiscal_period_end").isNotNull()).groupBy("ticker", "fiscal_period_end", year.alias("y")).agg(F.min("source_row").alias("lo"), F.max("source_row").alias("hi"))
    order = Window.partitionBy("ticker", "fiscal_period_end").orderBy("y")
    reuse = reuse.withColumns({"_prev": F.lag("y").over(order), "_next": F.lead("y").over(order)})
    reused = reuse.where("_prev IS NOT NULL").select(F.col("lo").alias("source_row")).union(reuse.where("_next IS NOT NULL").select("hi")).distinct().withColumn("_reused", F.lit(True))

    # Jumps between neighbouring fiscal years, on the first row of each year.
    firsts = base.groupBy("ticker", year.alias("y")).agg(F.min_by(F.struct("source_row", "shares", "market_cap"), "source_row").alias("r"))
    by_year = Window.partitionBy("ticker").orderBy("y")

    def jump(name: str, neighbour: Column) -> Column:
        a, b = F.col("r")[name], neighbour[name]
        return F.coalesce((F.least(a, b) > 0) & (F.greatest(a, b) >= params.jump_factor * F.least(a, b)), F.lit(False))

    around = firsts.withColumns({"_p": F.lag("r").over(by_year), "_n": F.lead("r").over(by_year)})
    jumps = around.select(
        F.col("r.source_row").alias("source_row"),
        (jump("shares", F.col("_p")) | jump("shares", F.col("_n"))).alias("_share_jump"),
        (jump("market_cap", F.col("_p")) | jump("market_cap", F.col("_n"))).alias("_cap_jump"),
    ).where("_share_jump OR _cap_jump")

    joined = base.join(reused, "source_row", "left").join(jumps, "source_row", "left")
    if snapshot is not None:
        last = base.groupBy("ticker").agg(F.max_by("source_row", F.struct(year.alias("a"), "source_row")).alias("source_row")).withColumn("_last", F.lit(True)).drop("ticker")
        facts = snapshot.select(F.upper(F.trim("ticker")).alias("ticker"), F.col("market_cap").alias("_snap_cap"), F.upper("security_type").alias("_type"))
        joined = attach(joined.join(last, "source_row", "left"), facts, ["ticker"])
    else:
        joined = joined.withColumns({"_last": F.lit(None).cast("boolean"), "_snap_cap": F.lit(None).cast("double"), "_type": F.lit(None).cast("string")})
    cap, implied = F.col("market_cap"), F.col("shares") * F.col("price")
    flags = joined_reasons(
        (F.col("_reused"), "DUPLICATE_PERIOD_END_ACROSS_FISCAL_YEARS"),
        ((F.col("shares") > 0) & (F.col("price") > 0) & (F.abs(F.try_divide(cap, implied) - 1) > params.cap_mismatch), "MARKET_CAP_PRICE_SHARES_MISMATCH"),
        (F.col("filed") < F.col("fiscal_period_end"), "FILING_BEFORE_PERIOD_END"),
        (F.col("filed") > as_of, "FILING_AFTER_ANALYSIS_DATE"),
        (F.upper("price_currency") != F.upper("cap_currency"), "PRICE_MARKET_CAP_CURRENCY_MISMATCH"),
        (F.upper("price_currency") != F.upper("statement_currency"), "STATEMENT_PRICE_CURRENCY_REVIEW"),
        (F.col("_type").contains("ADR") & (F.coalesce("adr_ratio", F.lit("")) == ""), "ADR_RATIO_MISSING"),
        (F.col("_share_jump"), "SHARE_COUNT_JUMP_20X"),
        (F.col("_cap_jump"), "MARKET_CAP_JUMP_20X"),
        (F.col("_last") & (F.col("_snap_cap") > 0) & (cap > 0) & (F.greatest(cap, "_snap_cap") >= params.jump_factor * F.least(cap, F.col("_snap_cap"))), "LATEST_HISTORICAL_PRIMARY_CAP_20X_REVIEW"),
        sep="; ",
    )

    def blank(names: Sequence[str]) -> Column:
        def empty(n: str) -> Column:
            return F.lit(True) if n not in joined.columns else F.coalesce(F.trim(F.col(n).cast("string")), F.lit("")) == ""

        return joined_reasons(*[(empty(n), n) for n in names], sep="; ")

    present = sum((F.col(n).isNotNull().cast("double") for n in statement if n in joined.columns), F.lit(0.0))
    coverage = present / len(statement) if statement else F.lit(1.0)
    out = joined.select(
        *rows.columns,
        flags.alias("integrity_flags"), blank(essential).alias("missing_essential"), blank(provenance).alias("missing_provenance"),
        coverage.alias("statement_coverage"), (F.col("fiscal_period_end").isNotNull() & F.col("filed").isNotNull()).cast("double").alias("temporal_coverage"),
    )
    reasons = joined_reasons((F.col("statement_coverage") < 0.75, "INCOMPLETE_FINANCIAL_STATEMENTS"), (F.col("missing_provenance") != "", "INCOMPLETE_PROVENANCE"), sep="; ")
    return out.withColumns({"integrity_pass": F.col("integrity_flags") == "", "regime_reasons": reasons}).withColumn(
        "data_regime", F.when(F.col("regime_reasons") == "", "STANDARD_DATA").otherwise("LIMITED_DATA")
    )


def integrity_gate(analysis: DataFrame, audit: DataFrame) -> DataFrame:
    """Contradictory source rows reject a name; missing data only changes its regime."""
    rolled = audit.groupBy("ticker").agg(
        F.bool_and("integrity_pass").alias("_clean"),
        F.max_by(F.struct("missing_essential", "data_regime", "regime_reasons", "fiscal_period_end"), F.struct(F.coalesce("fiscal_period_end", F.to_date(F.lit("0001-01-01"))), "source_row")).alias("_latest"),
    )
    j = analysis.join(rolled, "ticker", "left")
    clean = F.coalesce("_clean", F.lit(False))
    both = (F.coalesce(F.col("_latest.data_regime"), F.lit("LIMITED_DATA")) == "STANDARD_DATA") & (F.col("data_regime") == "STANDARD_DATA")
    essential = F.coalesce((F.col("_latest.missing_essential") == "") & F.col("_latest.fiscal_period_end").isNotNull(), F.lit(False))
    reasons = F.array_join(F.filter(F.array(F.col("gate_fail_reasons"), F.when(~clean, F.lit("source_integrity"))), lambda r: F.coalesce(r, F.lit("")) != ""), "; ")
    regime_why = F.array_join(F.filter(F.array(F.coalesce(F.col("_latest.regime_reasons"), F.lit("MISSING_SOURCE_AUDIT")), F.col("data_regime_reasons")), lambda r: F.coalesce(r, F.lit("")) != ""), "; ")
    return j.withColumns({
        "source_integrity_pass": clean, "source_essential_pass": essential,
        "eligible": F.coalesce("eligible", F.lit(False)) & clean, "gate_fail_reasons": reasons,
        "data_regime_reasons": regime_why,
        "data_regime": F.when(~clean, "DATA_FAILURE").when(both, "STANDARD_DATA").otherwise("LIMITED_DATA"),
    }).drop("_clean", "_latest")


def handoff(candidates: DataFrame, scored: DataFrame, audit: DataFrame) -> DataFrame:
    """Every shortlisted (category, ticker) with its blockers; no blocker means ready, else it stays on the watch list.

    ``candidates``: category, ticker, pit_status. ``scored``: category, ticker, score, rank, history_years, ttm_verified.
    ``audit``: category, ticker, integrity_flags, missing_provenance.
    """
    exploded = audit.select("category", "ticker", F.explode_outer(F.split("integrity_flags", "; ")).alias("_flag"), (F.col("missing_provenance") == "").alias("_prov"))
    # A ticker has at most the ten defined flags, so the set is bounded.
    rolled = exploded.groupBy("category", "ticker").agg(F.array_sort(F.collect_set(F.nullif("_flag", F.lit("")))).alias("_flags"), F.bool_and("_prov").alias("_prov"))
    j = candidates.join(scored, ["category", "ticker"], "left").join(rolled, ["category", "ticker"], "left")
    flags = F.when(F.col("_flags").isNull(), "NO_SOURCE_AUDIT").otherwise(F.array_join("_flags", "; "))
    blockers = F.filter(F.array(
        F.when(F.coalesce("rank", F.lit(0)) <= 0, "NO_RANKABLE_FOUR_YEAR_SCORE"),
        F.when(F.coalesce("history_years", F.lit(0)) < 4, "MISSING_OR_INCOMPLETE_SOURCE_HISTORY"),
        F.nullif(flags, F.lit("")),
        F.when(~F.coalesce("_prov", F.lit(False)), "FIELD_PROVENANCE_INCOMPLETE"),
        F.when(F.coalesce("pit_status", F.lit("")) != "VERIFIED_POINT_IN_TIME", "PRIMARY_POINT_IN_TIME_UNVERIFIED"),
        F.when(~F.coalesce("ttm_verified", F.lit(False)), "CURRENT_TTM_UNVERIFIED"),
    ), lambda b: b.isNotNull())
    return j.withColumn("blockers", F.array_join(blockers, "; ")).withColumn("disposition", F.when(F.col("blockers") == "", "RESEARCH HANDOFF").otherwise("DATA REVIEW")).drop("_flags", "_prov")


def research_status(handed: DataFrame, audit: DataFrame, top_n: int) -> DataFrame:
    """Score leaders with the reasons that keep them from current-data research."""
    rolled = audit.groupBy("category", "ticker").agg(
        F.bool_and("integrity_pass").alias("_clean"), F.bool_and(F.col("missing_provenance") == "").alias("_trace"),
        F.max_by("missing_essential", F.struct(F.coalesce("fiscal_period_end", F.to_date(F.lit("0001-01-01"))), "source_row")).alias("_miss"),
    )
    j = handed.where(F.col("rank").between(1, top_n)).join(rolled, ["category", "ticker"], "left")
    blockers = joined_reasons(
        (~F.coalesce("_clean", F.lit(False)), "SOURCE_INTEGRITY_REVIEW"),
        (~F.coalesce("_trace", F.lit(False)), "FIELD_LINEAGE_INCOMPLETE"),
        (F.coalesce("_miss", F.lit("")) != "", "LATEST_ESSENTIAL_FIELDS_MISSING"), sep="; ",
    )
    return j.withColumn("research_blockers", blockers).withColumn("research_status", F.when(F.col("research_blockers") == "", "CURRENT-DATA RESEARCH").otherwise("SOURCE REVIEW")).drop("_clean", "_trace", "_miss")


def run_counts(table: DataFrame, category: str) -> DataFrame:
    """Run audit: rows, scored, eligible, ranked and per-regime counts of a category."""
    return table.agg(
        F.count("*").alias("rows"), F.count("final_score").alias("scored"), F.count_if("eligible").alias("eligible"), F.count("rank").alias("ranked"),
        F.count_if(F.col("data_regime") == "STANDARD_DATA").alias("standard_data"), F.count_if(F.col("data_regime") == "LIMITED_DATA").alias("limited_data"),
    ).select(F.lit(category).alias("category"), "*")


def top_summary(table: DataFrame, n: int, columns: Sequence[str], score: str = "final_score", tie: str = "effective_trend_reliability") -> DataFrame:
    """The first n ranked names (a fixed report size), numbered 1..n."""
    return table.where(F.col("rank") <= n).select(F.col("rank").alias("position"), "ticker", *columns)


def score_reconciliation(final: DataFrame, families: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """Tickers whose final score is not the sum of its family contributions."""
    sums = families.groupBy("ticker").agg(F.sum("contribution").alias("rebuilt"))
    return final.join(sums, "ticker", "left").where(~close_to(F.col("final_score"), F.col("rebuilt"), 0.0, tolerance)).select("ticker", "final_score", "rebuilt")


def order_violations(table: DataFrame, score: str = "final_score", tie: str = "effective_trend_reliability") -> DataFrame:
    """Ranked rows that do not sort before their successor: each rank is compared with the next one."""
    r = table.where(F.col("rank").isNotNull()).select("ticker", "rank", F.struct((-F.col(score)).alias("a"), (-F.col(tie)).alias("b"), F.col("ticker").alias("c")).alias("k"))
    nxt = r.select((F.col("rank") - 1).alias("rank"), F.col("ticker").alias("next_ticker"), F.col("k").alias("nk"))
    return r.join(nxt, "rank").where(F.col("k") > F.col("nk")).select("rank", "ticker", "next_ticker")
