"""Registered derived features, unit rules and row-level gates of a cross-section snapshot."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.numbers import clamp, finite, growth_with_reason, inverse_positive, joined_reasons, present_mean, safe_div
from gaugework.params import SnapshotParams
from gaugework.plans.joins import attach


@dataclass(frozen=True)
class Feature:
    name: str
    inputs: tuple[str, ...]
    valid_when: str
    family: str | None
    direction: str | None
    group: str
    formula: Callable[..., Column]


VAL, GRO, PROF, LEV = "VALUATION", "GROWTH", "PROFITABILITY_AND_RETURNS", "BALANCE_SHEET_AND_LEVERAGE"
LIQ, EQ, YLD, MKT = "LIQUIDITY_AND_EFFICIENCY", "EARNINGS_QUALITY", "SHAREHOLDER_AND_YIELD", "MARKET_BEHAVIOUR"
BRK, TRD, RISK = "BROKER_AND_TARGET", "TRADABILITY", "RISK_AND_STABILITY"
UP, DOWN, RANGE = "higher_better", "lower_better", "target_range"


def _over_positive(top: Column, bottom: Column) -> Column:
    return safe_div(top, bottom, positive_only=True)


def _debt_over(debt: Column, base: Column) -> Column:
    return F.when(debt >= 0, _over_positive(debt, base))


def _change(top: Column, bottom: Column) -> Column:
    return F.when((top > 0) & (bottom > 0), F.try_divide(top, bottom) - 1)


def _when(test: Column, value: Column) -> Column:
    return F.when(test, finite(value))


class FeatureRegistry:
    """Named features; a user may add more with :meth:`add`."""

    def __init__(self, features: Sequence[Feature] = ()):
        self.features: dict[str, Feature] = {}
        for f in features:
            self.add(f)

    def add(self, feature: Feature) -> None:
        if feature.name in self.features:
            raise ValueError(f"feature {feature.name} is already registered")
        self.features[feature.name] = feature

    def columns(self, reasons: bool = True) -> list[Column]:
        out = []
        for f in self.features.values():
            value = finite(f.formula(*[F.col(i).cast("double") for i in f.inputs]))
            out.append(value.alias(f.name))
            if reasons:
                out.append(F.when(value.isNull(), F.lit(f"NO DATA/NOT MEANINGFUL: {f.valid_when}")).otherwise("").alias(f"{f.name}__reason"))
        return out

    def apply(self, snapshot: DataFrame, reasons: bool = True) -> DataFrame:
        """Add every feature; an absent input column counts as missing, so coverage keeps its denominator."""
        wanted = {i for f in self.features.values() for i in f.inputs}
        absent = sorted(wanted - set(snapshot.columns))
        complete = snapshot.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else snapshot
        return complete.select("*", *self.columns(reasons))

    def scored(self) -> list[Feature]:
        return [f for f in self.features.values() if f.family and f.direction in (UP, DOWN) and f.name not in DIAGNOSTIC_ONLY]


# Signals kept for audit and never scored.
DIAGNOSTIC_ONLY = (
    "peg_ratio", "f1_growth_estimate", "sales_growth_last_year", "last_eps_surprise", "previous_eps_surprise",
    "average_eps_surprise", "f1_estimate_change", "f2_estimate_change", "q0_estimate_change", "q1_estimate_change",
    "q2_estimate_change", "long_term_estimate_change", "return_1w", "ret_4w", "ret_12w", "return_ytd",
    "relative_return_ytd", "distance_52w_high", "momentum_acceleration", "range_width_52w",
    "upgrade_downgrade_count_balance", "gross_margin", "ebitda_margin", "ebit_margin", "pretax_margin",
    "net_income_margin", "cash_flow_margin", "forward_sales_growth", "growth_adjusted_pe_f1", "eps_growth_acceleration",
)


def default_features() -> FeatureRegistry:
    """The fifty published features (names, inputs, families, directions and groups are fixed values)."""
    f = Feature
    return FeatureRegistry([
        f("debt_equity_ratio", ("debt_equity",), "finite and non-negative", LEV, DOWN, "capital_leverage", lambda x: _when(x >= 0, x)),
        f("debt_total_capital_ratio", ("debt_total_capital_pct",), "finite and non-negative", LEV, DOWN, "capital_leverage", lambda x: _when(x >= 0, x / 100)),
        f("roe_valid", ("reported_roe", "common_equity"), "common equity > 0", PROF, UP, "returns", lambda r, e: _when(e > 0, r)),
        f("earnings_yield_f1", ("pe_f1",), "pe_f1 > 0", None, None, "legacy_pe_yield", inverse_positive),
        f("earnings_yield_f2", ("pe_f2",), "pe_f2 > 0", None, None, "legacy_pe_yield", inverse_positive),
        f("earnings_yield_trailing", ("trailing_pe",), "trailing_pe > 0", None, None, "legacy_pe_yield", inverse_positive),
        f("earnings_yield_pe_valid", ("pe_f1", "pe_f2", "trailing_pe"), "at least one P/E > 0", VAL, UP, "earnings_value",
          lambda a, b, c: present_mean(inverse_positive(a), inverse_positive(b), inverse_positive(c))),
        f("signed_trailing_eps_yield", ("trailing_eps", "last_close"), "price > 0; EPS may be signed", VAL, UP, "earnings_value", _over_positive),
        f("forward_eps_profitability", ("eps_f1", "eps_f2", "last_close"), "price > 0; forward EPS may be signed", VAL, UP, "earnings_value",
          lambda a, b, p: _over_positive(present_mean(a, b), p)),
        f("book_yield", ("price_book",), "price_book > 0", VAL, UP, "price_book_value", inverse_positive),
        f("sales_yield", ("price_sales",), "price_sales > 0", VAL, UP, "price_sales_value", inverse_positive),
        f("cash_flow_yield", ("price_cash_flow",), "multiple > 0", VAL, UP, "price_cash_flow_value", inverse_positive),
        f("growth_adjusted_pe_f1", ("pe_f1", "eg1_pp"), "both > 0", VAL, DOWN, "growth_adjusted_value", lambda p, g: F.when(p > 0, _over_positive(p, g))),
        f("forward_sales_growth", ("forward_sales_estimate", "sales"), "both > 0", GRO, UP, "sales_growth", _change),
        f("forward_pe_change", ("pe_f2", "pe_f1"), "both > 0", None, None, "pe_curve", _change),
        f("forward_pe_spread", ("pe_f2", "pe_f1"), "finite", None, None, "pe_curve", lambda b, a: b - a),
        f("gross_profit_mil", ("sales", "cogs"), "finite", None, None, "gross_profit", lambda s, c: s - c),
        f("gross_margin", ("sales", "cogs"), "sales > 0", PROF, UP, "operating_margins", lambda s, c: _over_positive(s - c, s)),
        f("ebitda_margin", ("ebitda", "sales"), "sales > 0", PROF, UP, "operating_margins", _over_positive),
        f("ebit_margin", ("ebit", "sales"), "sales > 0", PROF, UP, "operating_margins", _over_positive),
        f("pretax_margin", ("pretax_income", "sales"), "sales > 0", PROF, UP, "operating_margins", _over_positive),
        f("net_income_margin", ("net_income", "sales"), "sales > 0", PROF, UP, "operating_margins", _over_positive),
        f("cash_flow_margin", ("cash_flow", "sales"), "sales > 0", EQ, UP, "cash_flow_margin", _over_positive),
        f("cash_conversion", ("cash_flow", "net_income"), "net_income > 0", EQ, RANGE, "cash_conversion", _over_positive),
        f("long_term_debt_equity", ("long_term_debt", "common_equity"), "debt >= 0; equity > 0", LEV, DOWN, "capital_leverage", _debt_over),
        f("long_term_debt_ebitda", ("long_term_debt", "ebitda"), "debt >= 0; ebitda > 0", LEV, DOWN, "debt_coverage_proxy", _debt_over),
        f("long_term_debt_ebit", ("long_term_debt", "ebit"), "debt >= 0; ebit > 0", LEV, DOWN, "debt_coverage_proxy", _debt_over),
        f("preferred_common_equity", ("preferred_equity", "common_equity"), "preferred >= 0; equity > 0", LEV, DOWN, "preferred_equity", _debt_over),
        f("working_capital_mil", ("current_assets", "current_liabilities"), "finite", None, None, "working_capital", lambda a, b: a - b),
        f("working_capital_to_sales", ("current_assets", "current_liabilities", "sales"), "sales > 0", LIQ, RANGE, "working_capital", lambda a, b, s: _over_positive(a - b, s)),
        f("current_liabilities_assets", ("current_liabilities", "current_assets"), "assets > 0", None, None, "current_balance", _over_positive),
        f("receivables_days", ("receivables", "sales"), "receivables >= 0; sales > 0", LIQ, DOWN, "asset_efficiency", lambda r, s: _debt_over(r, s) * 365),
        f("inventory_days", ("inventory", "cogs"), "inventory >= 0; cogs > 0", LIQ, DOWN, "inventory_efficiency", lambda i, c: _debt_over(i, c) * 365),
        f("intangibles_equity", ("intangibles", "common_equity"), "intangibles >= 0; equity > 0", LEV, DOWN, "intangibles", _debt_over),
        f("intangibles_market_cap", ("intangibles", "market_cap"), "intangibles >= 0; market_cap > 0", LEV, DOWN, "intangibles", _debt_over),
        f("average_daily_dollar_volume", ("average_volume", "last_close"), "both > 0", TRD, UP, "liquidity_scale", lambda v, p: _when((v > 0) & (p > 0), v * p)),
        f("sales_per_share", ("sales", "shares"), "shares > 0", None, None, "sales_per_share", _over_positive),
        f("ebitda_per_share", ("ebitda", "shares"), "shares > 0", None, None, "ebitda_per_share", _over_positive),
        f("dividend_payout_ratio", ("dividend", "trailing_eps"), "dividend >= 0; eps > 0", YLD, RANGE, "payout", _debt_over),
        f("dividend_yield_reconstructed", ("dividend", "last_close"), "price > 0", None, None, "dividend_yield", _over_positive),
        f("distance_52w_high", ("last_close", "high_52w"), "high > 0", MKT, UP, "range_position", lambda p, h: _over_positive(p, h) - 1),
        f("distance_52w_low", ("last_close", "low_52w"), "low > 0", None, None, "range_position", lambda p, low: _over_positive(p, low) - 1),
        f("range_position_reconstructed", ("last_close", "low_52w", "high_52w"), "high > low", None, None, "range_position", lambda p, low, h: _over_positive(p - low, h - low)),
        f("momentum_acceleration", ("ret_4w", "ret_12w"), "finite; overlapping-horizon approximation", MKT, UP, "momentum_acceleration", lambda a, b: a - b / 3),
        f("beta_distance_one", ("beta",), "finite", MKT, RANGE, "beta_risk", lambda b: F.abs(b - 1)),
        f("absolute_beta", ("beta",), "finite", RISK, DOWN, "market_risk", lambda b: F.abs(b)),
        f("range_width_52w", ("high_52w", "low_52w", "last_close"), "high >= low and close > 0", RISK, DOWN, "market_risk", lambda h, low, p: F.when(h >= low, _over_positive(h - low, p))),
        f("target_price_upside", ("target_price", "last_close"), "both > 0", BRK, UP, "target_upside", _change),
        f("net_rating_balance", ("bullish_pct", "bearish_pct"), "finite", BRK, UP, "broker_rating", lambda a, b: a / 100 - b / 100),
        f("upgrade_downgrade_count_balance", ("upgrades", "downgrades", "brokers"), "finite", BRK, UP, "rating_revision",
          lambda u, d, n: F.when(n.isNotNull(), F.try_divide(u - d, F.greatest(n, F.lit(1.0))))),
    ])


# Unit, canonical name and plausible range of the vendor fields.
FIELD_UNITS = {
    "debt_equity": ("ratio", "debt_equity_ratio", 0.0, 10.0),
    "debt_total_capital_pct": ("percent", "debt_total_capital_ratio", 0.0, 1.5),
    "net_margin_pct": ("percent", "net_margin_vendor_normalized", -5.0, 5.0),
    "operating_margin_pct": ("percent", "operating_margin_vendor_normalized", -5.0, 5.0),
    "reported_roe_pct": ("percent", "roe_vendor_normalized", -10.0, 10.0),
    "reported_roa_pct": ("percent", "roa_vendor_normalized", -10.0, 10.0),
    "reported_roi_pct": ("percent", "roi_vendor_normalized", -10.0, 10.0),
    "dividend_yield_pct": ("percent", "dividend_yield_normalized", -0.1, 1.0),
    "current_ratio": ("ratio", "current_ratio_normalized", 0.0, 50.0),
    "quick_ratio": ("ratio", "quick_ratio_normalized", 0.0, 50.0),
    "cash_ratio": ("ratio", "cash_ratio_normalized", 0.0, 50.0),
    "pe_f1": ("multiple", "pe_f1_normalized", -1000.0, 1000.0),
    "pe_f2": ("multiple", "pe_f2_normalized", -1000.0, 1000.0),
    "trailing_pe": ("multiple", "pe_ttm_normalized", -1000.0, 1000.0),
    "peg_ratio": ("multiple", "peg_normalized", -1000.0, 1000.0),
}


def normalise_units(snapshot: DataFrame, units: Mapping[str, tuple[str, str, float | None, float | None]] = FIELD_UNITS) -> DataFrame:
    """Add, per configured field: raw, normalised value, unit, rule, range warning; and a row status."""
    out, warnings = [], []
    for source, (unit, stem, low, high) in units.items():
        if source not in snapshot.columns:
            continue
        raw = F.col(source)
        value = finite(raw.try_cast("double")) / 100.0 if unit == "percent" else finite(raw.try_cast("double"))
        odd = F.lit(False)
        if low is not None:
            odd = odd | F.coalesce(value < low, F.lit(False))
        if high is not None:
            odd = odd | F.coalesce(value > high, F.lit(False))
        warnings.append(odd)
        out += [
            raw.alias(f"{stem}__raw"),
            value.alias(f"{stem}__normalized"),
            F.lit(unit).alias(f"{stem}__unit_source"),
            F.lit("DIVIDE_BY_100" if unit == "percent" else "IDENTITY").alias(f"{stem}__rule"),
            odd.alias(f"{stem}__scaling_warning"),
        ]
    status = F.when(F.greatest(F.lit(False), F.lit(False), *warnings), "SCALING_WARNING").otherwise("CONFIGURED_UNITS_APPLIED")
    return snapshot.select("*", *out, status.alias("unit_scaling_status"))


def clean_identities(raw: DataFrame, identities: Sequence[str]) -> DataFrame:
    """Trim identity text and cast every other text column to DOUBLE where it parses."""
    picked = []
    for name, kind in raw.dtypes:
        if name in identities:
            picked.append(F.trim(F.col(f"`{name}`").cast("string")).alias(name))
        elif kind == "string":
            picked.append(F.col(f"`{name}`").try_cast("double").alias(name))
        else:
            picked.append(F.col(f"`{name}`"))
    return raw.select(*picked)


def universe(snapshot: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Add ``exclusion_reason``: the first failing rule, NULL for an eligible row."""
    def text(name: str) -> Column:
        return F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))

    kinds = [a.strip().upper() for a in allowed]
    reason = (
        F.when(text("ticker") == "", "blank ticker")
        .when(text("sector") == "", "blank sector")
        .when(text("industry") == "", "blank industry")
        .when(~F.upper(text("security_type")).isin(kinds), F.concat(F.lit("security type excluded: "), text("security_type")))
    )
    return snapshot.withColumn("exclusion_reason", reason)


def duplicate_tickers(eligible: DataFrame) -> DataFrame:
    """Tickers that occur more than once, case-insensitively; must be empty."""
    return eligible.groupBy(F.lower(F.trim("ticker")).alias("ticker")).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


# Business-type words.
SPECIALIST_WORDS = r"\bbanks?\b|savings and loan|insurance|securities|investment bank|investment management|consumer loans|sbic|investment funds"
AMBIGUOUS_REIT = "reit and equity trust"


def business_type(snapshot: DataFrame, params: SnapshotParams = SnapshotParams(), overrides: DataFrame | None = None) -> DataFrame:
    """Add the economic business type, whether it is verified, and which ratios apply to it.

    ``overrides`` (ticker, business_type) wins over the rules.
    """
    industry, sector = F.lower(F.coalesce("industry", F.lit(""))), F.lower(F.trim(F.coalesce("sector", F.lit(""))))
    rule = (
        F.when(industry.contains("mortgage"), "MORTGAGE_FINANCE")
        .when(industry == AMBIGUOUS_REIT, "UNCLASSIFIED_REIT")
        .when(industry.contains("reit"), "EQUITY_REIT")
        .when(industry.contains("real estate"), "REAL_ESTATE")
        .when(industry.rlike(SPECIALIST_WORDS), "SPECIALIST_FINANCIAL")
        .when(sector.isin([s.lower() for s in params.financial_sectors]), "UNCLASSIFIED_FINANCIAL")
        .otherwise("STANDARD_OPERATING_COMPANY")
    )
    df = snapshot.withColumn("_rule", rule)
    if overrides is not None:
        manual = overrides.select(F.upper(F.trim("ticker")).alias("_key"), F.upper(F.trim("business_type")).alias("_manual"))
        df = attach(df.withColumn("_key", F.upper(F.trim("ticker"))), manual, ["_key"]).drop("_key")
    else:
        df = df.withColumn("_manual", F.lit(None).cast("string"))
    kind = F.coalesce("_manual", "_rule")
    verified = ~kind.startswith("UNCLASSIFIED")
    return df.withColumns({
        "business_type": kind,
        "classification_verified": verified,
        "classification_note": F.when(F.col("_manual").isNotNull(), "CONTROL_OVERRIDE").when(~verified, "REVIEW_REQUIRED").otherwise("INDUSTRY_RULE"),
        "liquidity_applicable": kind == "STANDARD_OPERATING_COMPANY",
        "leverage_applicable": kind.isin("STANDARD_OPERATING_COMPANY", "EQUITY_REIT", "REAL_ESTATE"),
    }).drop("_rule", "_manual")


def applicability(metric: Column, family: Column) -> Column:
    """Structural applicability of a signal on a long (row, family, metric) table."""
    return (
        ~((family == LIQ) & ~F.coalesce("liquidity_applicable", F.lit(False)))
        & ~((family == LEV) & ~F.coalesce("leverage_applicable", F.lit(False)))
        & ~((metric == "payout_sustainability") & F.col("business_type").isin("EQUITY_REIT", "MORTGAGE_FINANCE"))
    )


def eps_growth(snapshot: DataFrame) -> DataFrame:
    """F1 to F2 growth in percent with its reason, and the validity flags of each strategy."""
    f1, f2 = F.col("eps_f1"), F.col("eps_f2")
    value, reason = growth_with_reason(f1, f2)
    both = f1.isNotNull() & f2.isNotNull()
    negative = F.coalesce(f1 <= 0, F.lit(False)) | F.coalesce(f2 <= 0, F.lit(False))
    reading = (
        F.when(~both, "MISSING_FORWARD_EPS")
        .when(f1 == 0, "ZERO_BASE_NOT_MEANINGFUL")
        .when(negative, "NEGATIVE_BASE_CONVENTIONAL_GROWTH_INVALID")
        .otherwise("CONVENTIONAL_GROWTH_VALID")
    )
    return snapshot.withColumns({
        "eps_growth_pct": value,
        "eps_growth_reason": reason,
        "eps_growth_reading": reading,
        "eps_base_negative": F.coalesce(f1 <= 0, F.lit(False)),
        "eps_valid_safe": F.coalesce((f1 > 0) & (f2 > 0), F.lit(False)),
        "eps_valid_high_growth": both,
        "eps_valid_turnaround": both,
        "eps_exemption": negative & both,
    })


def margin_reconciliation(snapshot: DataFrame, pairs: Mapping[str, tuple[str | None, str]], tolerance: float) -> DataFrame:
    """Vendor margin against its derived twin: differences, a status per margin and one row status."""
    out, states = {}, []
    for name, (vendor_name, derived_name) in pairs.items():
        vendor = F.col(vendor_name) if vendor_name else F.lit(None).cast("double")
        derived = F.col(derived_name)
        diff = F.abs(vendor - derived)
        state = (
            F.when(vendor.isNull(), "VENDOR_MARGIN_UNAVAILABLE")
            .when(derived.isNull(), "NUMERATOR_OR_SALES_UNAVAILABLE")
            .when(diff <= tolerance, "WITHIN_TOLERANCE")
            .otherwise("OUTSIDE_TOLERANCE")
        )
        out |= {f"{name}_absolute_difference": diff, f"{name}_relative_difference": safe_div(diff, F.abs(derived)), f"{name}_status": state}
        states.append(state)
    every = F.array(*states)
    out["margin_status"] = (
        F.when(F.array_contains(every, "OUTSIDE_TOLERANCE"), "REVIEW_REQUIRED").when(F.array_contains(every, "WITHIN_TOLERANCE"), "TESTED").otherwise("NOT_TESTABLE")
    )
    return snapshot.withColumns(out)


def reconciliation_flags(snapshot: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """P/B, market cap per share and rating percentages; NULL where the check cannot be made."""
    rebuilt = safe_div(F.col("last_close"), F.col("book_value"), True)
    per_share = safe_div(F.col("market_cap"), F.col("shares"), True)
    ratings = F.col("bullish_pct") + F.col("hold_pct") + F.col("bearish_pct")
    return snapshot.withColumns({
        "price_book_flag": F.when((F.col("price_book") > 0) & (rebuilt > 0), F.abs(F.try_divide(rebuilt, "price_book") - 1) > params.price_book_tolerance),
        "cap_per_share_flag": F.when((F.col("last_close") > 0) & (per_share > 0), F.abs(F.try_divide(per_share, "last_close") - 1) > params.cap_per_share_tolerance),
        "rating_percent_flag": F.when(ratings.isNotNull(), F.abs(ratings - 100) > 2),
    })


def solvency_gate(snapshot: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Balance-sheet gate by business type, with every fail reason."""
    kind = F.col("business_type")
    property_type = kind.isin("EQUITY_REIT", "REAL_ESTATE")
    ebitda, ebit = F.col("long_term_debt_ebitda"), F.col("long_term_debt_ebit")
    de, dc = F.col("debt_equity_ratio"), F.col("debt_total_capital_ratio")
    specific = F.when(~F.col("classification_verified"), "BUSINESS_CLASSIFICATION_REQUIRES_REVIEW").when(
        kind == "MORTGAGE_FINANCE", "MORTGAGE_FINANCE_SPECIALIST_CAPITAL_DATA_UNAVAILABLE"
    )
    property_reasons = joined_reasons(
        (ebitda > params.max_reit_debt_ebitda, "DEBT_EBITDA_ABOVE_LIMIT"),
        (ebitda.isNull() & (ebit > params.max_reit_debt_ebit), "DEBT_EBIT_ABOVE_LIMIT"),
        (ebitda.isNull() & ebit.isNull(), "REIT_LEVERAGE_NOT_TESTABLE"),
    )
    ordinary = joined_reasons(
        (F.col("common_equity") <= 0, "NONPOSITIVE_EQUITY_REQUIRES_REVIEW"),
        ((de < 0) | (de >= params.max_debt_equity), "DEBT_EQUITY_OUTSIDE_LIMIT"),
        ((dc < 0) | (dc >= params.max_debt_capital), "DEBT_TOTAL_CAPITAL_OUTSIDE_LIMIT"),
        (de.isNull() & dc.isNull(), "LEVERAGE_NOT_TESTABLE"),
        (F.col("current_ratio") < params.min_current_ratio, "CURRENT_RATIO_BELOW_SURVIVABILITY_FLOOR"),
    )
    reasons = F.coalesce(specific, F.when(kind == "SPECIALIST_FINANCIAL", "").when(property_type, property_reasons).otherwise(ordinary))
    return snapshot.withColumn("solvency_reasons", reasons).withColumn("solvency_pass", F.col("solvency_reasons") == "")


def tradability_gate(snapshot: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Size, listing and volume gates; long and short differ only in the volume floor."""
    security, exchange = F.upper(F.trim(F.coalesce("security_type", F.lit("")))), F.upper(F.trim(F.coalesce("exchange", F.lit(""))))
    volume = finite(F.col("average_daily_dollar_volume"))
    cap = finite(F.col("market_cap"))
    shared = [
        (cap.isNull() | (cap < params.min_market_cap), "MARKET_CAP_BELOW_MINIMUM_OR_MISSING"),
        (F.lit(not params.allow_otc) & (exchange.contains("OTC") | security.contains("OTC")), "OTC_NOT_ALLOWED"),
        (F.lit(not params.allow_adr) & security.isin("ADR", "ADS", "ASR"), "ADR_NOT_ALLOWED"),
        (F.lit(not params.allow_mlp) & (security == "MLP"), "MLP_NOT_ALLOWED"),
        (F.lit(not params.allow_canadian) & security.isin("CDN", "CANADIAN"), "CANADIAN_NOT_ALLOWED"),
    ]
    long_reasons = joined_reasons(*shared, (volume.isNull() | (volume < params.min_dollar_volume), "DOLLAR_VOLUME_BELOW_MINIMUM_OR_MISSING"))
    short_reasons = joined_reasons(*shared, (volume.isNull() | (volume < params.min_short_dollar_volume), "SHORT_DOLLAR_VOLUME_BELOW_MINIMUM_OR_MISSING"))
    return snapshot.withColumns({"tradability_reasons": long_reasons, "short_tradability_reasons": short_reasons}).withColumns({
        "tradability_pass": F.col("tradability_reasons") == "",
        "short_tradability_pass": F.col("short_tradability_reasons") == "",
    })


def liquidity_policy(df: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Asymmetric 0..50 scores: liquidity only ever hurts, excess working capital and payout fade to zero.

    Needs ``current_ratio_z``, ``quick_ratio_z``, ``cash_ratio_z``, ``working_capital_z``,
    ``dividend_payout_ratio``, ``dividend``, ``trailing_eps`` and ``liquidity_applicable``.
    """
    low = -abs(params.z_cap)
    applies = F.coalesce("liquidity_applicable", F.lit(False))
    out: dict[str, Column] = {}
    for name in ("current_ratio", "quick_ratio", "cash_ratio"):
        z = F.col(f"{name}_z")
        fade = params.liquidity_floor + (50.0 - params.liquidity_floor) * (F.greatest(z, F.lit(low)) - low) / max(params.liquidity_distress_z - low, 1e-12)
        distressed = z < params.liquidity_distress_z
        usable = z.isNotNull() & applies
        out[f"liquidity_{name}_score"] = F.when(usable, clamp(F.when(distressed, fade).otherwise(50.0), 0.0, 50.0))
        out[f"liquidity_{name}_distress"] = F.when(usable, distressed)
    wz, limit = F.col("working_capital_z"), params.excess_working_capital_z
    excess = wz > limit
    wfade = 50.0 * (1 - (F.least(wz, F.lit(abs(params.z_cap))) - limit) / max(abs(params.z_cap) - limit, 1e-12))
    out["working_capital_score"] = F.when(wz.isNotNull() & applies, clamp(F.when(excess, wfade).otherwise(50.0), 0.0, 50.0))
    out["excess_working_capital"] = F.when(wz.isNotNull() & applies, excess)
    payout, dividend, eps = F.col("dividend_payout_ratio"), F.col("dividend"), F.col("trailing_eps")
    pfade = 50.0 * (1 - (F.least(payout, F.lit(params.payout_distress)) - params.payout_warning) / max(params.payout_distress - params.payout_warning, 1e-12))
    loss_funded = (F.coalesce(dividend, F.lit(0.0)) > 0) & F.coalesce(eps <= 0, F.lit(False))
    out["payout_score"] = clamp(
        F.when(loss_funded, 0.0).when((payout >= 0) & (payout > params.payout_warning), pfade).when((dividend == 0) | (payout >= 0), 50.0), 0.0, 50.0
    )
    out["unsustainable_payout"] = F.when(
        dividend.isNotNull() | payout.isNotNull(), loss_funded | F.coalesce(payout > params.payout_warning, F.lit(False))
    )
    return df.withColumns(out)


def optionability(text: Column) -> Column:
    """TRUE / FALSE from free text, NULL where nothing is stated."""
    cell = F.lower(F.trim(text))
    return F.when(~cell.isin("", "nan", "none", "no data"), cell.isin("y", "yes", "true", "1", "optionable"))


def coverage_audit(snapshot: DataFrame, groups: Mapping[str, Sequence[str]], ranking_coverage: str) -> DataFrame:
    """Share of present fields per group, their mean, a 0.6/0.4 blend and a readiness band.

    ``ranking_coverage`` is a 0..1 column; fields absent from the table give their group 0.
    """
    shares, out = [], {}
    for name, fields in groups.items():
        present = [f for f in fields if f in snapshot.columns]
        share = sum((F.col(f).isNotNull().cast("double") for f in present), F.lit(0.0)) / len(present) * 100 if present else F.lit(0.0)
        out[f"{name}_coverage"] = share
        shares.append(share)
    under = sum(shares[1:], shares[0]) / len(shares)
    quant = clamp(F.col(ranking_coverage) * 100, 0.0, 100.0)
    out["underwriting_coverage"] = under
    out["data_quality"] = clamp(0.6 * quant + 0.4 * under, 0.0, 100.0)
    out["data_regime"] = F.when(quant >= 70, "STANDARD_DATA").otherwise("LIMITED_DATA")
    out["readiness"] = (
        F.when(under < 60, "SCREENING_QUALITY_ONLY").when(under < 75, "MATERIALLY_INCOMPLETE").when(under < 90, "ANALYST_REVIEW_REQUIRED").otherwise("CLOSE_TO_MEMO_READINESS")
    )
    return snapshot.withColumns(out)


def metric_availability(snapshot: DataFrame, requirements: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per metric: required, present and missing columns, active flag and the share of fully populated rows."""
    have = set(snapshot.columns)
    complete = {}
    for i, (metric, fields) in enumerate(requirements.items()):
        if all(f in have for f in fields):
            complete[metric] = F.avg(F.forall(F.array(*[F.col(f).isNotNull() for f in fields]), lambda x: x).cast("double")).alias(f"m{i}")
    counted = snapshot.agg(F.count("*").alias("rows"), *complete.values())
    rows = []
    for i, (metric, fields) in enumerate(requirements.items()):
        missing = [f for f in fields if f not in have]
        rows.append(F.struct(
            F.lit(metric).alias("metric"),
            F.lit(" | ".join(fields)).alias("required_fields"),
            F.lit(" | ".join(f for f in fields if f in have)).alias("present_fields"),
            F.lit(" | ".join(missing)).alias("missing_fields"),
            F.lit(not missing).alias("active"),
            (F.col(f"m{i}") if metric in complete else F.lit(None).cast("double")).alias("populated_share"),
        ))
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def registry_frame(spark, registry: FeatureRegistry) -> DataFrame:
    """The feature registry as a table for audit."""
    rows = [(f.name, " | ".join(f.inputs), f.valid_when, f.family, f.direction, f.group, f.name in DIAGNOSTIC_ONLY) for f in registry.features.values()]
    return spark.createDataFrame(rows, "feature string, inputs string, valid_when string, family string, direction string, duplicate_group string, diagnostic_only boolean")
