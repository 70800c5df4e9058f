"""Peer statistics, composite scores, strategies and candidate selection.

Metrics are long: (ticker, source_row, industry, sector, metric, value). Industry and sector groups
may be arbitrarily large, so medians, percentiles and ranks come from range-partitioned positions
(:mod:`gaugework.plans.ordered`), moments from partially aggregated sums, and both return to the
rows through salted joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions.numbers import clamp, close_to
from gaugework.params import SnapshotParams
from gaugework.plans.joins import attach, look_up
from gaugework.plans.ordered import medians, numbered, running_totals, value_positions
from gaugework.plans.settle import settle


def melt(snapshot: DataFrame, identities: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide to long; missing cells stay as NULL rows so coverage keeps its denominator."""
    return snapshot.select(*identities, *[F.col(m).cast("double") for m in metrics]).unpivot(list(identities), list(metrics), "metric", "value")


def group_statistics(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Per (group, distinct value): percentile, and the group's n, mean, population variance, median, MAD.

    Keys and value identify a row of the result; attach it to the data on both.
    """
    keys = list(keys)
    held = long.where(F.col(value).isNotNull())
    moments = held.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("variance"))
    positions = value_positions(held, keys, value)
    centre = medians(positions, keys, value)
    gaps = (
        attach(positions, centre, keys)
        .withColumn("_gap", F.abs(F.col(value) - F.col("median")))
        .groupBy(*keys, "_gap")
        .agg(F.sum("ties").alias("ties"))
    )
    spread = medians(running_totals(gaps, keys, [F.col("_gap")], {"upto": F.col("ties")}), keys, "_gap", "mad")
    facts = moments.join(centre, keys).join(spread, keys)
    rank = F.col("upto") - (F.col("ties") - 1) / 2
    percentile = F.when(F.col("n") == 1, 50.0).otherwise(F.try_divide(rank - 1, F.col("n") - 1) * 100)
    return attach(positions, facts, keys).select(*keys, value, *["n", "mean", "variance", "median", "mad"], rank.alias("rank"), percentile.alias("percentile"))


def standard_scores(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Tie-aware percentile, z and robust z of each row inside its group."""
    stats = group_statistics(long, keys, value)
    joined = look_up(long, stats, [*keys, value])
    return joined.select(
        *long.columns,
        "percentile",
        F.when(F.col("variance") > 0, (F.col(value) - F.col("mean")) / F.sqrt("variance")).alias("z"),
        F.when(F.col("mad") > 0, 0.6745 * (F.col(value) - F.col("median")) / F.col("mad")).alias("robust_z"),
    )


def peer_statistics(long: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Industry statistics shrunk towards the sector, and the blended 0..100 peer score of every row.

    ``long`` holds (ticker, source_row, industry, sector, metric, value) with inapplicable values
    already NULL. Rows without a value stay with a NULL score.
    """
    base = long.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    levels = base.where(F.col("value").isNotNull()).select(
        "metric", "value", F.explode(F.array(F.struct(F.lit("i").alias("level"), F.col("industry").alias("peer")), F.struct(F.lit("s").alias("level"), F.col("sector").alias("peer")))).alias("g")
    ).select("metric", "value", "g.level", "g.peer")
    stats = settle(group_statistics(levels, ["level", "peer", "metric"]))

    def side(level: str, column: str) -> DataFrame:
        named = [F.col(c).alias(f"{level}_{c}") for c in ("n", "mean", "variance", "median", "mad", "percentile")]
        return stats.where(F.col("level") == level).select(F.col("peer").alias(column), "metric", "value", *named)

    joined = look_up(look_up(base, side("i", "industry"), ["industry", "metric", "value"]), side("s", "sector"), ["sector", "metric", "value"])
    n = F.col("i_n").cast("double")
    valid = F.col("s_n") >= params.min_observations
    strength = max(params.shrinkage, 0.0)
    weight = F.when(valid, n / (n + strength) if strength > 0 else F.lit(1.0))
    shrunk = joined.withColumn("industry_weight", weight)
    w, v = F.col("industry_weight"), F.col("value")

    def blend(name: str) -> Column:
        return w * F.col(f"i_{name}") + (1 - w) * F.col(f"s_{name}")

    shrunk = shrunk.withColumns({"peer_mean": blend("mean"), "peer_median": blend("median"), "peer_mad": blend("mad"), "percentile": blend("percentile")})
    m = F.col("peer_mean")
    pooled = w * (F.col("i_variance") + (F.col("i_mean") - m) ** 2) + (1 - w) * (F.col("s_variance") + (F.col("s_mean") - m) ** 2)
    # A spread at rounding level of the mean is a constant set.
    spread = F.sqrt(pooled)
    shrunk = shrunk.withColumn("peer_std", F.when(spread <= 1e-12 * F.greatest(F.lit(1.0), F.abs(m)), 0.0).otherwise(spread))
    constant = F.col("peer_std") == 0
    cap = params.z_cap
    z = F.when(constant, 0.0).when(F.col("peer_std") > 0, (v - m) / F.col("peer_std"))
    robust = F.when(~constant & (F.col("peer_mad") > 0), 0.6745 * (v - F.col("peer_median")) / F.col("peer_mad"))
    scaled = F.when(constant, 50.0).otherwise(50.0 + 50.0 * clamp(F.coalesce(robust, z), -cap, cap) / cap)
    share = min(max(params.percentile_weight, 0.0), 1.0)
    scored = shrunk.withColumns({"z": z, "robust_z": robust, "robust_score": scaled})
    return scored.select(
        *long.columns,
        F.when(valid, "Industry/sector shrinkage").otherwise("INSUFFICIENT SECTOR PEERS").alias("comparison"),
        F.col("i_n").alias("industry_n"), F.col("s_n").alias("sector_n"), "industry_weight", "peer_mean", "peer_median", "peer_std", "peer_mad",
        F.col("i_percentile").alias("industry_percentile"), F.col("s_percentile").alias("sector_percentile"), "percentile", "z", "robust_z", "robust_score",
        (share * F.col("percentile") + (1 - share) * F.col("robust_score")).alias("peer_score"),
    )


def weight_table(spark, weights: Mapping[str, float], key: str, column: str) -> DataFrame:
    """A dictionary of weights as a dimension-sized table."""
    return spark.createDataFrame([(k, float(v)) for k, v in weights.items()], f"{key} string, {column} double")


def composite(signals: DataFrame, registry: DataFrame, families: DataFrame, params: SnapshotParams = SnapshotParams()) -> tuple[DataFrame, DataFrame]:
    """Signals to duplicate groups to families to one long and one short score.

    ``signals``: ticker, metric, score (0..100 or NULL), applicable. ``registry``: metric, family,
    direction, duplicate_group, signal_weight, group_weight. ``families``: family, long_weight,
    short_weight. Returns (scores per ticker, family rows with contributions). All levels share one
    hash partitioning on ticker, whose rows are bounded by the registry.
    """
    rated = signals.join(F.broadcast(registry), "metric").repartition("ticker")
    higher = F.col("direction") == "higher_better"
    usable = F.when(F.col("applicable"), F.col("score"))
    weighted = rated.join(F.broadcast(families), "family", "left").fillna(0.0, ["long_weight", "short_weight"]).select(
        "ticker", "metric", "family", "duplicate_group", "signal_weight", "group_weight", "long_weight", "short_weight", "applicable",
        F.when(higher, usable).otherwise(100 - usable).alias("ls"),
        F.when(higher, 100 - usable).otherwise(usable).alias("ss"),
    )
    active = (F.col("signal_weight") > 0) & (F.col("long_weight") > 0)
    counted = active & (F.col("group_weight") > 0)
    ls, sw = F.col("ls"), F.col("signal_weight")
    groups = weighted.groupBy("ticker", "family", "duplicate_group").agg(
        F.first("group_weight").alias("gw"),
        F.first("long_weight").alias("lw"),
        F.first("short_weight").alias("shw"),
        F.try_divide(F.sum(ls * sw), F.sum(F.when(ls.isNotNull(), sw))).alias("gl"),
        F.try_divide(F.sum(F.col("ss") * sw), F.sum(F.when(ls.isNotNull(), sw))).alias("gs"),
        F.max(F.col("applicable") & (sw > 0) & (F.col("group_weight") > 0)).alias("ga"),
        F.count_if(ls.isNotNull() & active).alias("have"),
        F.count_if(F.col("applicable") & active).alias("want"),
        F.count_if((ls > 50) & counted).alias("pos"),
        F.count_if((ls < 50) & counted).alias("neg"),
        F.count_if((ls == 50) & counted).alias("neu"),
    )
    gw, present, applies = F.col("gw"), F.col("gl").isNotNull(), F.col("ga")

    def total(test: Column, amount: Column = gw) -> Column:
        return F.sum(F.when(test, amount).otherwise(0.0))

    long_active, short_active = F.col("lw") > 0, F.col("shw") > 0
    family = groups.groupBy("ticker", "family").agg(
        F.first("lw").alias("lw"), F.first("shw").alias("shw"),
        total(present).alias("avail"), total(applies).alias("tot"),
        F.sum(F.col("gl") * gw).alias("ln"), F.sum(F.col("gs") * gw).alias("sn"),
        total(present & applies & long_active).alias("g_have"), total(applies & long_active).alias("g_want"),
        total(present & applies & short_active).alias("sg_have"), total(applies & short_active).alias("sg_want"),
        *[F.sum(c).alias(c) for c in ("have", "want", "pos", "neg", "neu")],
    )
    coverage = F.when(F.col("tot") > 0, F.col("avail") / F.col("tot"))
    open_ = F.when((coverage >= params.min_family_coverage) & (F.col("avail") > 0), F.lit(True))
    family = family.select(
        "*", coverage.alias("coverage"), (F.col("tot") > 0).alias("applicable"),
        F.when(open_, F.try_divide("ln", "avail")).alias("long_score"), F.when(open_, F.try_divide("sn", "avail")).alias("short_score"),
    )
    scored = F.col("long_score").isNotNull()
    sums = family.groupBy("ticker").agg(
        F.sum(F.when(scored, F.col("lw")).otherwise(0.0)).alias("long_denominator"),
        F.sum(F.when(scored, F.col("shw")).otherwise(0.0)).alias("short_denominator"),
        F.sum(F.col("long_score") * F.col("lw")).alias("long_numerator"),
        F.sum(F.col("short_score") * F.col("shw")).alias("short_numerator"),
        F.try_divide(F.sum("have"), F.sum("want")).alias("raw_signal_coverage"),
        F.try_divide(F.sum("g_have"), F.sum("g_want")).alias("group_coverage"),
        F.try_divide(F.sum("sg_have"), F.sum("sg_want")).alias("short_group_coverage"),
        F.try_divide(F.sum(F.when(scored, F.col("lw")).otherwise(0.0)), F.sum(F.when(F.col("applicable"), F.col("lw")).otherwise(0.0))).alias("family_coverage"),
        F.try_divide(F.sum(F.when(scored, F.col("shw")).otherwise(0.0)), F.sum(F.when(F.col("applicable"), F.col("shw")).otherwise(0.0))).alias("short_family_coverage"),
        F.sum("pos").alias("positive_evidence"), F.sum("neg").alias("negative_evidence"), F.sum("neu").alias("neutral_evidence"),
    )
    a, b = params.confidence_factor_weight, params.confidence_family_weight

    def confidence(group: str, fam: str) -> Column:
        return clamp(100 * (a * F.col(group) + b * F.col(fam)) / (a + b), 0.0, 100.0)

    def enough(group: str, fam: str, denominator: str) -> Column:
        floor = params.min_factor_coverage
        return F.coalesce((F.col(group) >= floor) & (F.col(fam) >= floor) & (F.col(denominator) > 0), F.lit(False))

    scores = sums.withColumns({
        "long_score": clamp(F.when(F.col("long_denominator") > 0, F.try_divide("long_numerator", "long_denominator")), 0.0, 100.0),
        "short_score": clamp(F.when(F.col("short_denominator") > 0, F.try_divide("short_numerator", "short_denominator")), 0.0, 100.0),
        "confidence": confidence("group_coverage", "family_coverage"),
        "short_confidence": confidence("short_group_coverage", "short_family_coverage"),
        "data_status": F.when(enough("group_coverage", "family_coverage", "long_denominator"), "SUFFICIENT").otherwise("LIMITED DATA"),
        "short_data_status": F.when(enough("short_group_coverage", "short_family_coverage", "short_denominator"), "SUFFICIENT").otherwise("LIMITED DATA"),
    }).withColumn("net_score", F.col("long_score") - F.col("short_score"))
    whole = Window.partitionBy("ticker")
    parts = family.select(
        "ticker", "family", "applicable", "coverage", "long_score", "short_score",
        F.when(scored, F.col("lw")).otherwise(0.0).alias("applied_weight"),
        F.when(scored, F.col("shw")).otherwise(0.0).alias("short_applied_weight"),
    )
    parts = parts.withColumns({
        "long_contribution": F.try_divide(F.col("long_score") * F.col("applied_weight"), F.sum("applied_weight").over(whole)),
        "short_contribution": F.try_divide(F.col("short_score") * F.col("short_applied_weight"), F.sum("short_applied_weight").over(whole)),
    })
    return scores, parts


def strategy_scores(families: DataFrame, weights: DataFrame, gates: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Per (ticker, strategy): re-normalised score, coverage, components, gate and published score.

    ``weights``: strategy, family, weight. ``gates``: ticker, strategy, gate_pass.
    """
    used = families.join(F.broadcast(weights.where(F.col("weight") > 0)), "family")
    present = F.col("long_score").isNotNull() & F.col("applicable")
    w = F.col("weight")
    totals = used.groupBy("ticker", "strategy").agg(
        F.sum(F.when(present, w).otherwise(0.0)).alias("applied_weight"),
        F.sum(F.when(F.col("applicable"), w).otherwise(0.0)).alias("configured_weight"),
        F.sum(F.when(present, F.col("long_score") * w)).alias("numerator"),
        F.count_if(present).alias("components"),
        F.count_if(F.col("applicable")).alias("structural_components"),
    )
    raw = clamp(F.try_divide("numerator", "applied_weight"), 0.0, 100.0)
    coverage = F.try_divide("applied_weight", "configured_weight")
    scored = totals.join(gates, ["ticker", "strategy"], "left").withColumns({"raw_score": raw, "weight_coverage": coverage})
    eligible = F.coalesce("gate_pass", F.lit(False)) & F.col("raw_score").isNotNull()
    return scored.select(
        "ticker", "strategy", "numerator", "applied_weight", "configured_weight", "weight_coverage", "components",
        (F.col("structural_components") - F.col("components")).alias("components_missing"),
        F.coalesce((F.col("weight_coverage") >= params.strategy_min_coverage) & (F.col("components") >= params.strategy_min_components), F.lit(False)).alias("minimum_data_pass"),
        "raw_score", eligible.alias("eligible"), F.when(eligible, F.col("raw_score")).alias("score"),
    )


def turnaround_setup(families: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Cheap and currently unprofitable: the setup gate of the turnaround strategy."""
    def of(name: str) -> Column:
        return F.max(F.when(F.col("family") == name, F.col("long_score")))

    pivoted = families.groupBy("ticker").agg(of("VALUATION").alias("value_score"), of("PROFITABILITY_AND_RETURNS").alias("profitability_score"))
    ok = (F.col("value_score") >= params.turnaround_min_value) & (F.col("profitability_score") <= params.turnaround_max_profitability)
    return pivoted.withColumn("setup_pass", F.coalesce(ok, F.lit(False)))


def short_thesis(families: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Enough weak families, at least one of them not valuation."""
    # Families that count towards a short thesis.
    names = ["VALUATION", "PROFITABILITY_AND_RETURNS", "BALANCE_SHEET_AND_LEVERAGE", "LIQUIDITY_AND_EFFICIENCY"]
    used = [n for n in names if params.short_family_weights.get(n, 0) > 0]
    weak = (F.col("short_score") >= params.short_weak_score) & F.col("family").isin(used)
    counts = families.groupBy("ticker").agg(F.count_if(weak).alias("weak_families"), F.count_if(weak & (F.col("family") != "VALUATION")).alias("weak_beyond_value"))
    ok = (F.col("weak_families") >= params.short_min_weak_families) & (F.col("weak_beyond_value") > 0)
    return counts.withColumn("thesis_pass", ok)


def ranked(df: DataFrame, keys: Sequence[str], score: str, out: str, pool: Column | None = None) -> DataFrame:
    """Rank inside groups of any size: score descending, ticker casefolded, source row. Others get NULL."""
    test = F.col(score).isNotNull() if pool is None else F.col(score).isNotNull() & F.coalesce(pool, F.lit(False))
    inside = df.where(test)
    order = [F.desc(score), F.lower("ticker"), F.col("source_row")]
    done = numbered(inside, keys, order, out).drop(f"{out}_all")
    rest = df.where(~test).withColumn(out, F.lit(None).cast("long"))
    return done.unionByName(rest)


def _top(df: DataFrame, test: Column, order: Sequence[Column], n: int, out: str) -> DataFrame:
    """Mark the best n rows of the whole table (a fixed report size) with ``out`` = True."""
    best = df.where(test).orderBy(*order).limit(n).select("ticker", "source_row", F.lit(True).alias(out))
    return df.join(F.broadcast(best), ["ticker", "source_row"], "left").withColumn(out, F.coalesce(out, F.lit(False)))


def select_candidates(df: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Gates, then long/short conflict, then per-industry places, then the global cap.

    ``df``: ticker, source_row, industry, long_score, short_score, confidence, short_confidence and
    boolean ``long_gate`` / ``short_gate``. A name passing both sides goes to the larger score.
    """
    longs = F.coalesce(F.col("long_gate") & (F.col("long_score") >= params.min_long_score), F.lit(False))
    shorts = F.coalesce(F.col("short_gate") & (F.col("short_score") >= params.min_short_score), F.lit(False))
    pools = df.withColumns({"_l": longs, "_s": shorts}).withColumn("conflict", F.col("_l") & F.col("_s"))
    prefer = F.col("long_score") >= F.col("short_score")
    pools = pools.withColumns({"_l": F.col("_l") & (~F.col("conflict") | prefer), "_s": F.col("_s") & (~F.col("conflict") | ~prefer)})
    placed = ranked(ranked(pools, ["industry"], "long_score", "long_rank", F.col("_l")), ["industry"], "short_score", "short_rank", F.col("_s"))
    placed = placed.withColumns({
        "long_eligible": F.coalesce(F.col("long_rank") <= params.top_per_industry, F.lit(False)),
        "short_eligible": F.coalesce(F.col("short_rank") <= params.top_per_industry, F.lit(False)),
    })
    tie = [F.lower("ticker"), F.col("source_row")]
    capped = _top(placed, F.col("long_eligible"), [F.desc("long_score"), F.desc("confidence"), *tie], params.max_longs, "_long")
    capped = _top(capped, F.col("short_eligible"), [F.desc("short_score"), F.desc("short_confidence"), *tie], params.max_shorts, "_short")
    side = F.when(F.col("_long"), "QUANT LONG").when(F.col("_short"), "QUANT SHORT").otherwise("")
    return capped.withColumn("candidate", side).drop("_l", "_s", "_long", "_short")


def short_view(selected: DataFrame, gates: Mapping[str, str], params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Short list: every gate, joined rejection reasons, universe rank and display rank.

    ``gates`` maps a label to a boolean column; score and industry-rank gates are added here.
    """
    checks = {"Scored": F.col("short_score").isNotNull(), "Score": F.col("short_score") >= params.min_short_score}
    checks |= {label: F.col(c) for label, c in gates.items()}
    checks["Industry rank"] = F.col("short_rank") <= params.top_per_industry
    failed = F.array_join(F.array_compact(F.array(*[F.when(~F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in checks.items()])), " | ")
    viewed = selected.withColumn("rejection_reasons", failed)
    order = [F.desc("short_score"), F.desc("short_confidence"), F.lower("ticker"), F.col("source_row")]
    inside = numbered(viewed.where(F.col("short_eligible")), [], order, "universe_rank").drop("universe_rank_all")
    rest = viewed.where(~F.col("short_eligible")).withColumn("universe_rank", F.lit(None).cast("long"))
    out = inside.unionByName(rest)
    return out.withColumn("short_display_rank", F.when(F.col("universe_rank") <= params.max_shorts, F.col("universe_rank")))


def industry_summary(df: DataFrame, flags: Sequence[str] = ()) -> DataFrame:
    """One row per industry: counts, medians, population deviation, mean confidence, the top name of each side."""
    order_l = F.struct("long_score", F.lower("ticker").alias("t"))
    order_s = F.struct("short_score", F.lower("ticker").alias("t"))
    facts = df.groupBy("industry").agg(
        F.count("*").alias("stocks"),
        F.count_if(F.col("data_status") == "SUFFICIENT").alias("sufficient_stocks"),
        F.count_if(F.col("candidate") == "QUANT LONG").alias("quant_longs"),
        F.count_if(F.col("candidate") == "QUANT SHORT").alias("quant_shorts"),
        F.stddev_pop("net_score").alias("net_score_std"),
        F.avg("confidence").alias("average_confidence"),
        F.max_by("ticker", F.when(F.col("long_score").isNotNull(), order_l)).alias("top_long"),
        F.max("long_score").alias("top_long_score"),
        F.max_by("ticker", F.when(F.col("short_score").isNotNull(), order_s)).alias("top_short"),
        F.max("short_score").alias("top_short_score"),
        *[F.count_if(F.coalesce(f, F.lit(False))).alias(f"{f}_count") for f in flags],
    )
    votes = df.where(F.col("sector").isNotNull()).groupBy("industry", "sector").agg(F.count("*").alias("_votes"))
    sector = votes.groupBy("industry").agg(F.max_by("sector", F.struct("_votes", "sector")).alias("sector"))
    long = df.select("industry", "long_score", "short_score", "net_score").unpivot(["industry"], ["long_score", "short_score", "net_score"], "metric", "value")
    middle = medians(value_positions(long, ["industry", "metric"], "value"), ["industry", "metric"], "value")
    wide = middle.groupBy("industry").agg(*[F.max(F.when(F.col("metric") == m, F.col("median"))).alias(f"median_{m}") for m in ("long_score", "short_score", "net_score")])
    return facts.join(sector, "industry", "left").join(wide, "industry", "left")


# --- assertions: each returns violation rows -----------------------------------------------------


def selection_violations(df: DataFrame, params: SnapshotParams = SnapshotParams()) -> DataFrame:
    """Score range, both-sides names, per-industry and global limits, thresholds."""
    chosen = df.where(F.col("candidate") != "")
    out = [
        df.where(~F.col("long_score").between(0, 100) | ~F.col("short_score").between(0, 100)).select(F.lit("score outside 0..100").alias("rule"), F.col("ticker").cast("string").alias("subject")),
        chosen.groupBy("ticker").agg(F.min("candidate").alias("a"), F.max("candidate").alias("b")).where("a <> b").select(F.lit("ticker on both sides"), F.col("ticker").cast("string")),
        chosen.groupBy("industry", "candidate").count().where(F.col("count") > params.top_per_industry).select(F.lit("industry limit"), F.concat_ws(":", "industry", "candidate")),
        chosen.groupBy("candidate").count().where(
            F.col("count") > F.when(F.col("candidate") == "QUANT LONG", params.max_longs).otherwise(params.max_shorts)
        ).select(F.lit("global limit"), F.col("candidate")),
        chosen.where(
            ((F.col("candidate") == "QUANT LONG") & (~F.col("long_gate") | (F.col("long_score") < params.min_long_score)))
            | ((F.col("candidate") == "QUANT SHORT") & (~F.col("short_gate") | (F.col("short_score") < params.min_short_score)))
        ).select(F.lit("gate or threshold"), F.col("ticker").cast("string")),
    ]
    merged = out[0]
    for part in out[1:]:
        merged = merged.union(part)
    return merged


def contribution_violations(scores: DataFrame, parts: DataFrame, tolerance: float = 1e-10) -> DataFrame:
    """Tickers whose published score is not numerator/denominator or not the sum of its contributions."""
    sums = parts.groupBy("ticker").agg(F.sum("long_contribution").alias("rebuilt_long"), F.sum("short_contribution").alias("rebuilt_short"))
    both = scores.join(sums, "ticker", "left")
    gap = lambda a, b: ~close_to(a, b, 0.0, tolerance)
    bad = (
        gap(F.col("long_score"), F.try_divide("long_numerator", F.nullif("long_denominator", F.lit(0.0))))
        | gap(F.col("long_score"), F.col("rebuilt_long"))
        | gap(F.col("short_score"), F.col("rebuilt_short"))
    )
    return both.where(bad).select("ticker", "long_score", "rebuilt_long", "short_score", "rebuilt_short")


def rank_gaps(df: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """Groups whose ranks are not exactly 1..n."""
    return (
        df.where(F.col(rank).isNotNull()).groupBy(*keys)
        .agg(F.count("*").alias("n"), F.countDistinct(rank).alias("distinct"), F.min(rank).alias("low"), F.max(rank).alias("high"))
        .where((F.col("low") != 1) | (F.col("high") != F.col("n")) | (F.col("distinct") != F.col("n")))
    )
