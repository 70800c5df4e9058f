"""Validation statistics: point-in-time rules, information coefficients, quantiles, bootstrap, splits."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions.numbers import finite
from gaugework.plans.joins import attach, latest_per_key, look_up
from gaugework.plans.ordered import medians, numbered, value_positions, with_previous

# Public-availability fields in order of preference; seed and thresholds of the validation profile.
AVAILABILITY_FIELDS = ["filing_date", "publication_date", "source_date", "retrieved_at", "event_date", "issued_date", "commitment_date", "created_at"]
SEED = 20260924
MIN_OBSERVATIONS, MIN_COMPANIES, MIN_DATES = 30, 10, 4


def availability(df: DataFrame, cutoff: Column, fields: Sequence[str] = AVAILABILITY_FIELDS) -> DataFrame:
    """PASS, FAIL or UNKNOWN against the cutoff, by the first stated availability date (never a period end)."""
    present = [F.col(f).cast("date") for f in fields if f in df.columns]
    dated = df.withColumn("available_on", F.coalesce(*present))
    status = F.when(F.col("available_on").isNull() | cutoff.isNull(), "UNKNOWN").when(F.col("available_on") <= cutoff, "PASS").otherwise("FAIL")
    return dated.withColumn("availability", status)


def as_of(df: DataFrame, date: str, cutoff: Column, unknown: str = "keep") -> DataFrame:
    """Rows dated on or before the cutoff; ``unknown`` says whether undated rows stay ('keep') or go ('drop')."""
    if unknown not in ("keep", "drop"):
        raise ValueError("unknown must be keep or drop")
    inside = F.col(date) <= cutoff
    return df.where(F.col(date).isNull() | inside) if unknown == "keep" else df.where(inside)


def pearson(df: DataFrame, keys: Sequence[str], x: str, y: str, out: str = "ic") -> DataFrame:
    """Correlation of the pairs present on both sides; NULL below two pairs or without variance."""
    a, b = finite(F.col(x)), finite(F.col(y))
    paired = df.select(*keys, a.alias("_x"), b.alias("_y")).where("_x IS NOT NULL AND _y IS NOT NULL")
    s = paired.groupBy(*keys).agg(F.count("*").alias("sample_count"), F.covar_samp("_x", "_y").alias("_c"), F.stddev_samp("_x").alias("_sx"), F.stddev_samp("_y").alias("_sy"))
    r = F.when((F.col("_sx") > 0) & (F.col("_sy") > 0), F.try_divide("_c", F.col("_sx") * F.col("_sy")))
    return s.select(*keys, "sample_count", r.alias(out))


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str, out: str = "rank_ic") -> DataFrame:
    """Correlation of tie-averaged ranks among the paired rows; ranks are computed by range, not per group task."""
    a, b = finite(F.col(x)), finite(F.col(y))
    paired = df.select(*keys, a.alias("_x"), b.alias("_y")).where("_x IS NOT NULL AND _y IS NOT NULL")

    def ranks(name: str) -> DataFrame:
        return value_positions(paired, keys, name).select(*keys, name, (F.col("upto") - (F.col("ties") - 1) / 2).alias(f"{name}r"))

    both = look_up(look_up(paired, ranks("_x"), [*keys, "_x"]), ranks("_y"), [*keys, "_y"])
    return pearson(both, keys, "_xr", "_yr", out)


def factor_correlations(long: DataFrame, entity: str, factor: str, value: str) -> DataFrame:
    """Correlation of every factor pair over shared entities from one Gram matrix per batch of entities.

    Each entity contributes one vector of its factors (a list bounded by the number of factors). A batch of vectors
    becomes a matrix whose products give counts and moments of all pairs at once, so what is shuffled is factors
    squared per batch, not per entity. Values are centred on factor means first. A factor that an entity states several times
    counts with the mean of its values.
    """
    long = long.where(F.col(value).isNotNull()).groupBy(entity, factor).agg(F.avg(value).alias(value))
    centre = long.groupBy(factor).agg(F.avg(value).alias("_mean"))
    shifted = attach(long, centre, [factor]).select(entity, F.col(factor).cast("string").alias("f"), (F.col(value) - F.col("_mean")).cast("double").alias("v"))
    vectors = shifted.groupBy(entity).agg(F.collect_list(F.struct("f", "v")).alias("fs")).select(F.col("fs.f").alias("names"), F.col("fs.v").alias("numbers"))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            names = lists.flatten().dictionary_encode()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            column = names.indices.to_numpy(zero_copy_only=False)
            x = np.zeros((batch.num_rows, len(names.dictionary)))
            there = np.zeros_like(x)
            x[row, column], there[row, column] = batch.column(1).flatten().to_numpy(zero_copy_only=False), 1.0
            one, two = np.divmod(np.arange(x.shape[1] ** 2), x.shape[1] or 1)
            sums = [there.T @ there, x.T @ there, there.T @ x, (x * x).T @ there, there.T @ (x * x), x.T @ x]
            yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(one)), names.dictionary.take(pa.array(two)), *[pa.array(m.ravel()) for m in sums]], ["fa", "fb", "n", "a", "b", "aa", "bb", "ab"])

    parts = vectors.mapInArrow(moments, "fa string, fb string, n double, a double, b double, aa double, bb double, ab double").where("n > 0")
    s = parts.groupBy("fa", "fb").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")])
    spread = lambda c: F.col(f"{c}{c}") - F.col(c) * F.col(c) / F.col("n")
    r = F.when((spread("a") > 0) & (spread("b") > 0), F.try_divide(F.col("ab") - F.col("a") * F.col("b") / F.col("n"), F.sqrt(spread("a")) * F.sqrt(spread("b"))))
    return s.select(F.col("fa").alias("factor_a"), F.col("fb").alias("factor_b"), F.col("n").cast("long").alias("sample_count"), r.alias("correlation"))


def describe(long: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, mean, exact median, sample deviation (0 for one value), min, max."""
    held = long.withColumn(value, finite(F.col(value))).where(F.col(value).isNotNull())
    base = held.groupBy(*keys).agg(F.count("*").alias("count"), F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    middle = medians(value_positions(held, keys, value), keys, value)
    return base.join(middle, list(keys)) if keys else base.crossJoin(middle)


def missingness(long: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Share of present values per key."""
    return long.groupBy(*keys).agg(F.count("*").alias("rows"), F.count(value).alias("present"), (F.count(value) / F.count("*")).alias("availability"))


def coverage_bands(df: DataFrame, coverage: str) -> DataFrame:
    """Counts per coverage band."""
    c = F.col(coverage)
    band = F.when(c.isNull(), "MISSING")
    # Band limits.
    for limit in (0.4, 0.5, 0.6, 0.7, 0.8):
        band = band.when(c < limit, f"<{limit:.1f}")
    return df.groupBy(band.otherwise(">=0.8").alias("band")).agg(F.count("*").alias("observations"))


def factor_matrix(long: DataFrame, entity: Sequence[str], factor: str, value: str, factors: Sequence[str]) -> DataFrame:
    """Wide factor table; a factor an entity lacks stays NULL."""
    return long.groupBy(*entity).agg(*[F.max(F.when(F.col(factor) == f, F.col(value))).alias(f) for f in factors])


def quantile_outcomes(df: DataFrame, keys: Sequence[str], score: str, outcome: str, tie: Sequence[str], groups: int = 3, minimum: int = 10) -> DataFrame:
    """Outcome per score group (rank * groups / n): count, mean, upper median, top minus bottom; small samples get no groups."""
    valid = df.where(F.col(score).isNotNull() & F.col(outcome).isNotNull()).select(*keys, score, outcome, *tie)
    placed = numbered(valid, keys, [F.col(score), *[F.col(t) for t in tie]], "_r")
    # Chunk g holds positions [g*n/groups, (g+1)*n/groups) with integer division, so the group of position p is the last g whose start is <= p.
    start = lambda g: F.floor(F.lit(g) * F.col("_r_all") / groups)
    position = F.col("_r") - 1
    group = sum((F.when(position >= start(g), 1).otherwise(0) for g in range(1, groups)), F.lit(1))
    cut = placed.withColumn("quantile", group).where(F.col("_r_all") >= groups * minimum)
    inside = [*keys, "quantile"]
    stats = cut.groupBy(*inside).agg(F.count("*").alias("count"), F.avg(outcome).alias("mean"))
    places = value_positions(cut, inside, outcome)
    upper = F.floor(F.col("upto_all") / 2) + 1
    median = places.groupBy(*inside).agg(F.max(F.when((F.col("upto") >= upper) & (F.col("upto") - F.col("ties") < upper), F.col(outcome))).alias("median"))
    joined = stats.join(median, inside)
    whole = Window.partitionBy(*keys)
    spread = F.max(F.when(F.col("quantile") == groups, F.col("mean"))).over(whole) - F.max(F.when(F.col("quantile") == 1, F.col("mean"))).over(whole)
    return joined.withColumn("spread_top_minus_bottom", spread)


def sample_adequacy(df: DataFrame, keys: Sequence[str], score: str, outcome: str, groups: int = 3, minimum: int = 10) -> DataFrame:
    """AVAILABLE or INSUFFICIENT_SAMPLE for quantile analysis."""
    n = df.groupBy(*keys).agg(F.count_if(F.col(score).isNotNull() & F.col(outcome).isNotNull()).alias("sample_count"))
    return n.withColumn("status", F.when(F.col("sample_count") < groups * minimum, "INSUFFICIENT_SAMPLE").otherwise("AVAILABLE"))


def regression(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares slope, intercept and correlation; fewer than three pairs is insufficient."""
    paired = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    s = paired.groupBy(*keys).agg(F.count("*").alias("sample_count"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    r = pearson(paired, keys, x, y, "correlation").drop("sample_count")
    joined = s.join(r, list(keys)) if keys else s.crossJoin(r)
    small = F.col("sample_count") < 3
    return joined.select(*keys, "sample_count", *[F.when(~small, F.col(c)).alias(c) for c in ("slope", "intercept", "correlation")], F.when(small, "INSUFFICIENT_SAMPLE").otherwise("EXPLORATORY").alias("status"))


def uniform_hash(seed: int, *parts: Column) -> Column:
    """Deterministic uniform in [0, 1) from the first 32 bits of an MD5 over the parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def poisson_weights(row: np.ndarray, iterations: int) -> np.ndarray:
    """Independent Poisson(1) draws, one row per iteration and one column per 32-bit row hash, from a counter-based hash."""
    # Cumulative Poisson(1) probabilities, and the multipliers of a public 32-bit mixer.
    cuts = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119]
    x = row.astype(np.uint32)[None, :] + (np.arange(iterations, dtype=np.uint64) * 2654435769).astype(np.uint32)[:, None]
    x = (x ^ (x >> np.uint32(16))) * np.uint32(2146121005)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(2221713035)
    x = x ^ (x >> np.uint32(16))
    return sum((x >= np.uint32(np.ceil(c * 2.0**32))).astype(np.uint8) for c in cuts)


def bootstrap_mean(df: DataFrame, keys: Sequence[str], row_id: str, value: str, iterations: int = 1000, seed: int = SEED) -> DataFrame:
    """Seeded percentile interval of the mean.

    Every row gets an independent Poisson(1) weight per iteration, the distributed form of resampling
    n of n with replacement. Weights of a block of rows are drawn as one array inside the task and summed there, so
    one pair of sums per key, iteration and batch is shuffled, never a row per iteration.
    """
    mark = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string"))), 1, 8), 16, 10).cast("long")
    rows = df.where(F.col(value).isNotNull()).select(*keys, mark.alias("_mark"), F.col(value).cast("double").alias("_value"))
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = pa.Table.from_batches([batch]).append_column("_row", pa.array(np.arange(batch.num_rows)))
            found = group.group_by(list(keys)).aggregate([("_row", "list")])
            marks, values = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_mark", "_value"))
            weight, weighted = [], []
            for at in found.column("_row_list").to_pylist():
                n, total = np.zeros(iterations), np.zeros(iterations)
                for k in range(0, len(at), 512):  # a block of draws stays in the processor's cache
                    w = poisson_weights(marks[at[k : k + 512]], iterations).astype(np.float64)
                    n += w.sum(axis=1)
                    total += w @ values[at[k : k + 512]]
                weight.append(n)
                weighted.append(total)
            offsets = pa.array(np.arange(len(weight) + 1) * iterations, type=pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else np.zeros(0))) for x in (weight, weighted)]
            yield pa.RecordBatch.from_arrays([*[found.column(k).combine_chunks() for k in keys], *lists], [*keys, "_n", "_total"])

    drawn = rows.mapInArrow(sums, f"{fields}, _n array<double>, _total array<double>").select(*keys, F.posexplode(F.arrays_zip("_n", "_total")).alias("_it", "_s"))
    runs = drawn.groupBy(*keys, "_it").agg(F.try_divide(F.sum("_s._total"), F.sum("_s._n")).alias("_m"))
    # One mean per iteration is left: a bounded list per key.
    w = Window.partitionBy(*keys).orderBy("_m", "_it")
    placed = runs.withColumn("_k", F.row_number().over(w) - 1)
    low, high = max(0, int(iterations * 0.025) - 1), min(iterations - 1, int(iterations * 0.975))
    return placed.groupBy(*keys).agg(
        F.count("*").alias("iterations"), F.avg("_m").alias("mean"),
        F.max(F.when(F.col("_k") == low, F.col("_m"))).alias("lower"), F.max(F.when(F.col("_k") == high, F.col("_m"))).alias("upper"),
    )


def score_stability(df: DataFrame, key: str, date: str, score: str) -> DataFrame:
    """Mean and largest absolute change between consecutive observations of a key."""
    stepped = with_previous(df.select(key, date, score), [key], [date], [score])
    change = F.abs(F.col(score) - F.col(f"prev_{score}"))
    return stepped.agg(F.count(change).alias("count"), F.avg(change).alias("mean_absolute_change"), F.max(change).alias("largest_change")).withColumn(
        "status", F.when(F.col("count") > 0, "AVAILABLE").otherwise("INSUFFICIENT_SAMPLE")
    )


def observation_audit(observations: DataFrame) -> DataFrame:
    """Counts, date span, scored share and exploratory adequacy of a panel."""
    valid = F.col("point_in_time_valid")
    return observations.agg(
        F.count("*").alias("observations"), F.count_if(valid).alias("valid"), F.count_if(~valid).alias("excluded"),
        F.countDistinct(F.when(valid, F.col("ticker"))).alias("companies"), F.countDistinct(F.when(valid, F.col("as_of_date"))).alias("dates"),
        F.min(F.when(valid, F.col("as_of_date"))).alias("first_date"), F.max(F.when(valid, F.col("as_of_date"))).alias("last_date"),
        F.try_divide(F.count_if(valid & F.col("overall_score").isNotNull()), F.count_if(valid)).alias("score_availability"),
    ).withColumn("adequate_exploratory", (F.col("valid") >= MIN_OBSERVATIONS) & (F.col("companies") >= MIN_COMPANIES) & (F.col("dates") >= 2))


def exclusion_reasons(observations: DataFrame) -> DataFrame:
    return observations.where(~F.col("point_in_time_valid")).groupBy(F.coalesce("exclusion_reason", F.lit("UNKNOWN")).alias("reason")).agg(F.count("*").alias("observations"))


def leakage_findings(observations: DataFrame, outcomes: DataFrame) -> DataFrame:
    """FAIL and UNKNOWN findings: invalid rows, cutoff misalignment, unknown sources, outcomes starting too early."""
    def found(df: DataFrame, status: str, check: str) -> DataFrame:
        return df.select("observation_id", F.lit(status).alias("status"), F.lit(check).alias("check"))

    early = outcomes.join(observations.select("observation_id", "information_cutoff"), "observation_id").where(F.col("execution_date") <= F.col("information_cutoff"))
    return (
        found(observations.where(~F.col("point_in_time_valid")), "FAIL", "observation_valid")
        .union(found(observations.where(F.col("as_of_date") != F.col("information_cutoff")), "FAIL", "cutoff_alignment"))
        .union(found(observations.where("source_availability_unknown"), "UNKNOWN", "source_timestamp"))
        .union(found(early, "FAIL", "outcome_after_cutoff"))
    )


def leakage_status(findings: DataFrame) -> DataFrame:
    return findings.agg(F.count_if(F.col("status") == "FAIL").alias("failed"), F.count_if(F.col("status") == "UNKNOWN").alias("unknown")).withColumn(
        "status", F.when(F.col("failed") > 0, "FAIL").when(F.col("unknown") > 0, "UNKNOWN").otherwise("PASS")
    )


def build_observations(scores: DataFrame, factors: DataFrame, pillars: DataFrame) -> DataFrame:
    """Latest score per ticker with its factor and pillar maps and a content fingerprint.

    Maps per ticker are bounded by the factor and pillar registries. Inputs carry ``available_on``;
    a part published after the cutoff makes the observation invalid, an undated part marks it unknown.
    """
    latest = latest_per_key(scores, ["ticker"], ["as_of_date"])
    def parts(df: DataFrame, name: str, prefix: str) -> DataFrame:
        mine = df.join(latest.select("ticker", "as_of_date"), ["ticker", "as_of_date"])
        entries = F.array_sort(F.collect_list(F.struct(F.col(name).alias("key"), F.col("score").alias("value"))))
        return mine.groupBy("ticker").agg(
            F.map_from_entries(entries).alias(f"{prefix}_values"), F.max("available_on").alias(f"_{prefix}_last"), F.max(F.col("available_on").isNull()).alias(f"_{prefix}_unknown"),
        )

    j = latest.join(parts(factors, "factor", "factor"), "ticker", "left").join(parts(pillars, "pillar", "pillar"), "ticker", "left")
    future = F.greatest(F.col("available_on"), F.col("_factor_last"), F.col("_pillar_last")) > F.col("as_of_date")
    mark = F.sha2(F.to_json(F.struct("ticker", "as_of_date", "overall_score", "factor_values", "pillar_values")), 256)
    return j.select(
        "ticker", "as_of_date", F.col("as_of_date").alias("information_cutoff"), "overall_score", "factor_values", "pillar_values", mark.alias("input_fingerprint"),
        F.concat_ws(":", F.lit("obs"), "ticker", F.col("as_of_date").cast("string"), F.substring(mark, 1, 16)).alias("observation_id"),
        (~F.coalesce(future, F.lit(False))).alias("point_in_time_valid"), F.when(future, "LEAKAGE_DETECTED").alias("exclusion_reason"),
        (F.col("available_on").isNull() | F.coalesce("_factor_unknown", F.lit(False)) | F.coalesce("_pillar_unknown", F.lit(False))).alias("source_availability_unknown"),
    )


def deduplicate(observations: DataFrame, key: str = "observation_id") -> tuple[DataFrame, DataFrame]:
    """One row per id, and the number of duplicates dropped."""
    dropped = observations.agg((F.count("*") - F.countDistinct(key)).alias("duplicates"))
    return observations.dropDuplicates([key]), dropped


def chronological_split(observations: DataFrame, date: str, train_end: Column | None = None, validation_end: Column | None = None) -> DataFrame:
    """Label every row train, validation or holdout by date order; fewer than three dates leaves all in train."""
    dates = observations.select(date).distinct()
    # One row per distinct date: bounded by calendar days.
    order = F.array_sort(F.collect_set(date))
    cuts = dates.agg(order.alias("_d")).select(
        F.size("_d").alias("_n"),
        F.coalesce(train_end, F.try_element_at("_d", F.greatest(F.floor(F.size("_d") / 2).cast("int"), F.lit(1)))).alias("_t") if train_end is not None else F.try_element_at("_d", F.greatest(F.floor(F.size("_d") / 2).cast("int"), F.lit(1))).alias("_t"),
        (validation_end if validation_end is not None else F.try_element_at("_d", F.lit(-2))).alias("_v"),
    )
    marked = observations.crossJoin(F.broadcast(cuts))
    label = F.when((F.col("_n") < 3) | (F.col(date) <= F.col("_t")), "train").when(F.col(date) <= F.col("_v"), "validation").otherwise("holdout")
    status = F.when(F.col("_n") < 3, "INSUFFICIENT_HISTORY_FOR_CALIBRATION").otherwise("AVAILABLE")
    return marked.withColumns({"split": label, "split_status": status}).drop("_n", "_t", "_v")


def walk_forward_folds(observations: DataFrame, date: str, minimum_train_dates: int = 2) -> DataFrame:
    """Expanding folds as date ranges: (fold, train_end, validation_date); join observations by date to use them."""
    days = observations.select(date).distinct()
    w = Window.orderBy(date)  # one row per distinct date
    n = Window.partitionBy()
    placed = days.select(F.col(date), (F.row_number().over(w) - 1).alias("_i"), F.lag(date).over(w).alias("train_end"), F.count("*").over(n).alias("_n"))
    return placed.where((F.col("_i") >= minimum_train_dates) & (F.col("_i") < F.col("_n") - 1)).select((F.col("_i") - minimum_train_dates).alias("fold"), "train_end", F.col(date).alias("validation_date"))


def fold_sizes(observations: DataFrame, folds: DataFrame, date: str) -> DataFrame:
    """Train and validation row counts of every fold from one row per date."""
    per_date = observations.groupBy(date).agg(F.count("*").alias("_c"))
    upto = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    run = per_date.withColumn("_run", F.sum("_c").over(upto))
    return folds.join(run.select(F.col(date).alias("train_end"), F.col("_run").alias("train_rows")), "train_end").join(
        per_date.select(F.col(date).alias("validation_date"), F.col("_c").alias("validation_rows")), "validation_date"
    ).select("fold", "train_end", "validation_date", "train_rows", "validation_rows")


def constrained_weights(weights: DataFrame, keys: Sequence[str], weight: str, cap: float = 1.0) -> DataFrame:
    """Clip to [0, cap] and normalise per key."""
    clipped = weights.withColumn("_w", F.greatest(F.lit(0.0), F.least(F.lit(cap), F.coalesce(weight, F.lit(0.0)))))
    totals = clipped.groupBy(*keys).agg(F.sum("_w").alias("_t"))
    joined = attach(clipped, totals, keys) if keys else clipped.crossJoin(F.broadcast(totals))
    return joined.withColumn("constrained", F.when(F.col("_t") > 0, F.col("_w") / F.col("_t")).otherwise(0.0)).drop("_w", "_t")


def calibration_refusal(observations: DataFrame, min_observations: int = MIN_OBSERVATIONS, min_companies: int = MIN_COMPANIES, min_dates: int = MIN_DATES) -> DataFrame:
    """Why calibration is refused, or that it is ready for exploration."""
    c = observations.agg(F.count("*").alias("n"), F.countDistinct("ticker").alias("c"), F.countDistinct("as_of_date").alias("d"))
    reasons = F.array_compact(F.array(
        F.when(F.col("n") < min_observations, "MINIMUM_OBSERVATIONS_NOT_MET"), F.when(F.col("c") < min_companies, "MINIMUM_UNIQUE_COMPANIES_NOT_MET"), F.when(F.col("d") < min_dates, "MINIMUM_UNIQUE_DATES_NOT_MET"),
    ))
    return c.select(
        F.when(F.size(reasons) > 0, "INSUFFICIENT_HISTORICAL_DATA").otherwise("READY_FOR_EXPLORATORY_CALIBRATION").alias("status"), F.array_join(reasons, "; ").alias("reasons")
    )


def candidate_profile(weights: DataFrame, fixed: Mapping[str, Column], key: str = "factor", weight: str = "weight") -> DataFrame:
    """Content id of a candidate profile: the same settings always get the same id (factors are a short list)."""
    entries = weights.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, weight)))).alias("weights"))
    payload = F.to_json(F.struct(*[c.alias(n) for n, c in sorted(fixed.items())], "weights"))
    return entries.select(F.concat(F.lit("candidate:"), F.substring(F.sha2(payload, 256), 1, 20)).alias("candidate_id"), "weights")


def random_baseline(df: DataFrame, row_id: str, seed: int = SEED) -> DataFrame:
    """Seeded no-signal score of each row, stable under repartitioning."""
    return df.withColumn("random_signal", uniform_hash(seed, F.col(row_id)))


def factor_diagnostics(long: DataFrame, factor: str, score: str, outcome: str, row_id: str, groups: int = 3, minimum: int = 10) -> DataFrame:
    """Distribution, both information coefficients and top-minus-bottom spread per factor."""
    d = describe(long, [factor], score)
    p = pearson(long, [factor], score, outcome, "pearson_ic")
    s = spearman(long, [factor], score, outcome, "spearman_ic").drop("sample_count")
    q = quantile_outcomes(long, [factor], score, outcome, [row_id], groups, minimum).groupBy(factor).agg(F.max("spread_top_minus_bottom").alias("spread_top_minus_bottom"))
    return d.join(p, factor, "left").join(s, factor, "left").join(q, factor, "left")
