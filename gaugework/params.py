"""Model parameters: frozen defaults, overridable from a controls table with type and range checks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default family weights of the snapshot model.
FAMILY_WEIGHTS = {
    "VALUATION": 20.0,
    "GROWTH": 10.0,
    "PROFITABILITY_AND_RETURNS": 25.0,
    "BALANCE_SHEET_AND_LEVERAGE": 25.0,
    "LIQUIDITY_AND_EFFICIENCY": 15.0,
    "SHAREHOLDER_AND_YIELD": 5.0,
}
SHORT_FAMILY_WEIGHTS = {
    "VALUATION": 25.0,
    "GROWTH": 5.0,
    "PROFITABILITY_AND_RETURNS": 25.0,
    "BALANCE_SHEET_AND_LEVERAGE": 30.0,
    "LIQUIDITY_AND_EFFICIENCY": 15.0,
}
STRATEGY_WEIGHTS = {
    "Safe": {"VALUATION": 10.0, "GROWTH": 5.0, "PROFITABILITY_AND_RETURNS": 25.0, "BALANCE_SHEET_AND_LEVERAGE": 35.0, "LIQUIDITY_AND_EFFICIENCY": 20.0, "SHAREHOLDER_AND_YIELD": 5.0},
    "High Growth Potential": {"VALUATION": 15.0, "GROWTH": 35.0, "PROFITABILITY_AND_RETURNS": 25.0, "BALANCE_SHEET_AND_LEVERAGE": 15.0, "LIQUIDITY_AND_EFFICIENCY": 10.0},
    "Turnaround Story": {"VALUATION": 30.0, "GROWTH": 10.0, "PROFITABILITY_AND_RETURNS": 15.0, "BALANCE_SHEET_AND_LEVERAGE": 30.0, "LIQUIDITY_AND_EFFICIENCY": 15.0},
}


@dataclass(frozen=True)
class SnapshotParams:
    # Default controls of the snapshot model.
    min_observations: int = 5
    shrinkage: float = 8.0
    z_cap: float = 3.0
    percentile_weight: float = 0.5
    min_factor_coverage: float = 0.70
    min_family_coverage: float = 0.50
    confidence_factor_weight: float = 0.60
    confidence_family_weight: float = 0.40
    top_per_industry: int = 3
    max_longs: int = 10
    max_shorts: int = 50
    min_long_score: float = 55.0
    min_short_score: float = 58.9
    max_debt_equity: float = 2.0
    max_debt_capital: float = 0.75
    min_current_ratio: float = 0.75
    max_reit_debt_ebitda: float = 10.0
    max_reit_debt_ebit: float = 12.0
    min_market_cap: float = 3000.0
    min_dollar_volume: float = 25_000_000.0
    min_short_dollar_volume: float = 50_000_000.0
    liquidity_distress_z: float = -1.0
    liquidity_floor: float = 0.0
    excess_working_capital_z: float = 2.0
    payout_warning: float = 0.80
    payout_distress: float = 1.50
    margin_tolerance: float = 0.05
    price_book_tolerance: float = 0.15
    cap_per_share_tolerance: float = 0.20
    strategy_min_coverage: float = 0.65
    strategy_min_components: int = 4
    turnaround_min_value: float = 55.0
    turnaround_max_profitability: float = 50.0
    short_min_weak_families: int = 2
    short_weak_score: float = 60.0
    allow_otc: bool = False
    allow_adr: bool = True
    allow_mlp: bool = True
    allow_canadian: bool = True
    financial_sectors: tuple[str, ...] = ("Finance", "Financials", "Financial Services")
    allowed_types: tuple[str, ...] = ("COM", "ADR", "CDN", "MLP", "ADS", "ASR")
    family_weights: Mapping[str, float] = field(default_factory=lambda: dict(FAMILY_WEIGHTS))
    short_family_weights: Mapping[str, float] = field(default_factory=lambda: dict(SHORT_FAMILY_WEIGHTS))
    strategy_weights: Mapping[str, Mapping[str, float]] = field(default_factory=lambda: {k: dict(v) for k, v in STRATEGY_WEIGHTS.items()})


@dataclass(frozen=True)
class HistoryParams:
    # Default controls of the history model.
    decay: float = 0.70
    min_points: int = 4
    mad_scale: float = 1.4826
    z_cap: float = 2.5
    percentile_share: float = 0.70
    min_peers: int = 10
    shrinkage: float = 10.0
    three_year_reliability: float = 0.75
    fit_floor: float = 0.5
    cap_mismatch: float = 0.05
    jump_factor: float = 20.0


def with_overrides(params, controls: DataFrame, bounds: Mapping[str, tuple[float, float]] | None = None):
    """Apply a ``name, value`` controls table to a parameter object.

    A controls table is a handful of named settings; unknown names, values of the wrong type and
    values outside ``bounds`` are errors.
    """
    known = {f.name: f for f in fields(params)}
    named = controls.groupBy("name").agg(F.count("*").alias("n"), F.min("value").alias("value"))
    ours = F.coalesce(F.col("name").isin(*known), F.lit(False))
    unknown, repeated = named.agg(F.min(F.when(~ours, F.coalesce("name", F.lit("NULL")))), F.min(F.when(ours & (F.col("n") > 1), F.col("name")))).first()
    if unknown is not None:
        raise ValueError(f"unknown parameter {unknown!r}")
    if repeated is not None:
        raise ValueError(f"parameter {repeated!r} given twice")
    changes: dict[str, object] = {}
    for row in named.where(ours).collect():  # at most one row per known parameter
        current = getattr(params, row["name"])
        if isinstance(current, bool):
            if str(row["value"]).lower() not in ("true", "false"):
                raise ValueError(f"{row['name']} must be true or false")
            value: object = str(row["value"]).lower() == "true"
        elif isinstance(current, (int, float)):
            value = type(current)(float(row["value"]))
            low, high = (bounds or {}).get(row["name"], (float("-inf"), float("inf")))
            if value != value or not low <= value <= high:
                raise ValueError(f"{row['name']}={value} outside {low}..{high}")
        else:
            raise ValueError(f"{row['name']} cannot be set from a controls table")
        changes[row["name"]] = value
    return replace(params, **changes)


def checked_weights(weights: Mapping[str, float], total: float | None = None) -> dict[str, float]:
    """Non-negative weights, optionally summing to ``total`` within 1e-9."""
    out = {k: float(v) for k, v in weights.items()}
    if any(v < 0 or v != v for v in out.values()):
        raise ValueError("weights must be non-negative numbers")
    if total is not None and abs(sum(out.values()) - total) > 1e-9:
        raise ValueError(f"weights sum to {sum(out.values())}, expected {total}")
    return out
