"""Dated series, look-ahead-free pair scores and monthly selection.

Series are long: ``series STRING, obs_date DATE, value DOUBLE``, one row per series and day, so a
window partition (one series or one pair) is bounded by the number of calendar days, never by the
number of raw observations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions.dates import same_day_last_year
from gaugework.functions.numbers import close_to, finite
from gaugework.plans.joins import latest_per_key, look_up
from gaugework.plans.ordered import running_maxima


def pair_names(series: DataFrame) -> DataFrame:
    """All unordered pairs of the series names (a list the size of the name dimension squared)."""
    names = series.select("series").distinct()
    left, right = names.withColumnRenamed("series", "x"), names.withColumnRenamed("series", "y")
    return left.join(right, F.col("x") < F.col("y")).select(F.concat_ws("~", "x", "y").alias("pair_id"), "x", "y")


def check_pairs(definitions: DataFrame, series: DataFrame) -> DataFrame:
    """Attach ``error`` to each (x, y): NULL for a usable pair."""
    names = series.select("series").distinct()
    known = (
        definitions.join(names.select(F.col("series").alias("x"), F.lit(True).alias("_x")), "x", "left")
        .join(names.select(F.col("series").alias("y"), F.lit(True).alias("_y")), "y", "left")
    )
    no_x, no_y = F.coalesce("x", F.lit("")) == "", F.coalesce("y", F.lit("")) == ""
    error = (
        F.when(no_x & no_y, "empty pair")
        .when(no_x | no_y, "missing pair side")
        .when(F.col("_x").isNull() | F.col("_y").isNull(), "unknown indicator")
    )
    return known.select(*definitions.columns, error.alias("error"))


def pair_values(series: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, obs_date, xv, yv) on every date of the source grid; absent values are NULL.

    The series table crosses once to (pair, side) rows and is folded by one aggregation, so no
    date-by-date join of two big inputs is needed.
    """
    dates = series.select("obs_date").distinct()
    sides = pairs.select("pair_id", F.col("x").alias("series"), F.lit("x").alias("side")).unionByName(
        pairs.select("pair_id", F.col("y").alias("series"), F.lit("y").alias("side"))
    )
    held = (
        series.join(sides, "series")
        .groupBy("pair_id", "obs_date")
        .agg(
            F.max(F.when(F.col("side") == "x", F.col("value"))).alias("xv"),
            F.max(F.when(F.col("side") == "y", F.col("value"))).alias("yv"),
        )
    )
    # The published matrix is (registered pairs) x (calendar dates); the dates are at most one row per day.
    grid = pairs.select("pair_id").crossJoin(F.broadcast(dates))
    return grid.join(held, ["pair_id", "obs_date"], "left").select(
        "pair_id", "obs_date", finite(F.col("xv")).alias("xv"), finite(F.col("yv")).alias("yv")
    )


def _prior(keys: Sequence[str], valid: str, date: str, window: int):
    """The last ``window`` valid rows strictly before the current valid row.

    Valid and invalid rows form separate partitions, so a gap neither fills nor consumes history.
    """
    if window < 2:
        raise ValueError("window must be at least 2")
    return Window.partitionBy(*keys, valid).orderBy(date).rowsBetween(-window, -1)


def prior_windows(df: DataFrame, keys: Sequence[str], value: str, window: int, date: str = "obs_date") -> DataFrame:
    """Add ``history``: the last ``window`` finite values strictly before each row, NULL until that many exist."""
    if window < 2:
        raise ValueError("window must be at least 2")
    marked = df.withColumn("_ok", F.col(value).isNotNull())
    upto = Window.partitionBy(*keys, "_ok").orderBy(date).rowsBetween(1 - window, 0)
    stacked = marked.withColumn("_upto", F.when(F.col("_ok"), F.collect_list(value).over(upto)))
    earlier = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    history = F.last("_upto", ignorenulls=True).over(earlier)
    return stacked.withColumn("history", F.when(F.size(history) == window, history)).drop("_ok", "_upto")


def pair_correlation(pairs: DataFrame, window: int, keys: Sequence[str] = ("pair_id",)) -> DataFrame:
    """Fisher-transformed Pearson r over the prior ``window`` paired values; NULL where undefined."""
    ready = pairs.withColumn("_ok", F.col("xv").isNotNull() & F.col("yv").isNotNull())
    w = _prior(keys, "_ok", "obs_date", window)
    sx, sy = F.stddev_samp("xv").over(w), F.stddev_samp("yv").over(w)
    usable = F.col("_ok") & (F.count("xv").over(w) == window) & (sx > 0) & (sy > 0)
    r = F.when(usable, F.try_divide(F.covar_samp("xv", "yv").over(w), sx * sy))
    scored = ready.withColumn("_r", r)
    fisher = F.when(F.abs("_r") < 1 - 1e-14, F.atanh("_r"))
    return scored.select(*pairs.columns, F.col("_r").alias("pearson_r"), fisher.alias("fisher"))


def standardised(df: DataFrame, keys: Sequence[str], value: str, window: int, out: str, date: str = "obs_date") -> DataFrame:
    """Add z of ``value`` on the mean and sample deviation of its ``window`` prior valid values."""
    marked = df.withColumn("_ok", F.col(value).isNotNull())
    w = _prior(keys, "_ok", date, window)
    mean, dev = F.avg(value).over(w), F.stddev_samp(value).over(w)
    usable = F.col("_ok") & (F.count(value).over(w) == window) & (dev > 0)
    z = F.when(usable, finite(F.try_divide(F.col(value) - mean, dev)))
    return marked.withColumn(out, z).drop("_ok")


def pair_spread(pairs: DataFrame, window: int, keys: Sequence[str] = ("pair_id",)) -> DataFrame:
    """Spread x - y and its z-score against prior spreads."""
    return standardised(pairs.withColumn("spread", F.col("xv") - F.col("yv")), keys, "spread", window, "spread_z")


def observation_change(df: DataFrame, keys: Sequence[str], value: str, lookback: int, out: str = "change", date: str = "obs_date") -> DataFrame:
    """Change against the value ``lookback`` valid observations earlier."""
    if lookback < 1:
        raise ValueError("lookback must be at least 1")
    marked = df.withColumn("_ok", F.col(value).isNotNull())
    w = Window.partitionBy(*keys, "_ok").orderBy(date)
    change = F.when(F.col("_ok"), finite(F.col(value) - F.lag(value, lookback).over(w)))
    return marked.withColumn(out, change).drop("_ok")


def momentum(df: DataFrame, keys: Sequence[str], value: str, lookback: int, window: int, out: str = "momentum_z", date: str = "obs_date") -> DataFrame:
    """z-score of the observation change against its own prior changes."""
    return standardised(observation_change(df, keys, value, lookback, date=date), keys, "change", window, out, date)


def update_clock(scores: DataFrame, pairs: DataFrame, keys: Sequence[str] = ("pair_id",)) -> DataFrame:
    """Mark output dates that saw a new paired input since the previous output date.

    ``scores`` carries the output dates, ``pairs`` the dated inputs. Adds ``is_update`` and
    ``last_paired_date``.
    """
    paired = pairs.where(F.col("xv").isNotNull() & F.col("yv").isNotNull()).select(
        *keys, "obs_date", F.lit(1).alias("_pair")
    )
    line = scores.withColumn("_out", F.lit(1)).join(paired, [*keys, "obs_date"], "full")
    upto = Window.partitionBy(*keys).orderBy("obs_date").rowsBetween(Window.unboundedPreceding, 0)
    counted = line.select(
        "*",
        F.sum(F.coalesce("_pair", F.lit(0))).over(upto).alias("_n"),
        F.last(F.when(F.col("_pair") == 1, F.col("obs_date")), ignorenulls=True).over(upto).alias("last_paired_date"),
    ).where(F.col("_out") == 1)
    step = Window.partitionBy(*keys).orderBy("obs_date")
    fresh = F.col("_n") > F.coalesce(F.lag("_n").over(step), F.lit(0))
    return counted.withColumn("is_update", fresh).select(*scores.columns, "is_update", "last_paired_date")


def fisher_momentum(scores: DataFrame, pairs: DataFrame, lookback: int, window: int) -> DataFrame:
    """Momentum of the Fisher score that counts only true paired updates."""
    clocked = update_clock(scores, pairs).withColumn("event_value", F.when(F.col("is_update"), F.col("fisher")))
    return momentum(clocked, ["pair_id"], "event_value", lookback, window, "fisher_momentum_z")


def pair_scores(series: DataFrame, pairs: DataFrame, window: int, lookback: int) -> DataFrame:
    """All four pair scores in one lineage; every step shares the (pair) partitioning."""
    values = pair_values(series, pairs)
    scored = pair_correlation(pair_spread(values, window), window)
    with_spread = momentum(scored, ["pair_id"], "spread", lookback, window, "spread_momentum_z").drop("change")
    update = F.col("xv").isNotNull() & F.col("yv").isNotNull()
    clocked = with_spread.withColumn("event_value", F.when(update, F.col("fisher")))
    return momentum(clocked, ["pair_id"], "event_value", lookback, window, "fisher_momentum_z").drop("change", "event_value", "pearson_r")


def run_report(scores: DataFrame, value: str, lookback: int) -> DataFrame:
    """Per pair: update count, first/last scored date, the date ``lookback`` updates back, status."""
    valid = scores.where(F.col(value).isNotNull()).select("pair_id", "obs_date", value)
    nth = F.row_number().over(Window.partitionBy("pair_id").orderBy(F.desc("obs_date")))
    facts = valid.withColumn("_n", nth).groupBy("pair_id").agg(
        F.count("*").alias("update_count"),
        F.min("obs_date").alias("first_date"),
        F.max("obs_date").alias("last_date"),
        F.max(F.when(F.col("_n") == lookback + 1, F.col("obs_date"))).alias("lag_date"),
    )
    ends = scores.groupBy("pair_id").agg(F.max("obs_date").alias("grid_end"))
    status = (
        F.when(F.col("last_date").isNull(), "No finite momentum history")
        .when(F.col("last_date") == F.col("grid_end"), "OK")
        .otherwise("No current momentum score")
    )
    return ends.join(facts, "pair_id", "left").select(
        "pair_id",
        F.coalesce("update_count", F.lit(0)).alias("update_count"),
        "first_date",
        "last_date",
        "lag_date",
        status.alias("status"),
    )


def score_trace(pairs: DataFrame, window: int) -> DataFrame:
    """Every intermediate of the correlation and spread of each row, with a status text."""
    ready = pairs.withColumn("_ok", F.col("xv").isNotNull() & F.col("yv").isNotNull()).withColumn(
        "spread", F.col("xv") - F.col("yv")
    )
    w = _prior(["pair_id"], "_ok", "obs_date", window)
    traced = ready.select(
        "pair_id", "obs_date", "xv", "yv", "spread", "_ok",
        F.count("spread").over(w).alias("history_count"),
        F.first("obs_date").over(w).alias("window_first"),
        F.last("obs_date").over(w).alias("window_last"),
        F.avg("spread").over(w).alias("spread_mean"),
        F.stddev_samp("spread").over(w).alias("spread_std"),
        F.covar_samp("xv", "yv").over(w).alias("covariance"),
        F.stddev_samp("xv").over(w).alias("x_std"),
        F.stddev_samp("yv").over(w).alias("y_std"),
    )
    r = F.when((F.col("x_std") > 0) & (F.col("y_std") > 0), F.try_divide("covariance", F.col("x_std") * F.col("y_std")))
    status = (
        F.when(~F.col("_ok"), "CURRENT PAIR MISSING")
        .when(F.col("history_count") < window, "INSUFFICIENT HISTORY")
        .when(F.coalesce("spread_std", F.lit(0.0)) <= 0, "ZERO VARIANCE")
        .otherwise("SCORED")
    )
    return traced.withColumn("pearson_r", r).withColumn("status", status).drop("_ok")


def on_output_grid(results: DataFrame, grid: DataFrame) -> DataFrame:
    """Align results to a given date grid (``obs_date``)."""
    keys = results.select("pair_id").distinct()
    # The grid holds at most one row per calendar day.
    return keys.crossJoin(F.broadcast(grid.select("obs_date").distinct())).join(results, ["pair_id", "obs_date"], "left")


def dates_missing_from_grid(series: DataFrame, grid: DataFrame) -> DataFrame:
    """Source dates the grid lacks; must be empty before results are published."""
    return series.select("obs_date").distinct().join(grid.select("obs_date").distinct(), "obs_date", "left_anti")


def matrix_comparison(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str, date: str = "obs_date") -> DataFrame:
    """Counts of compared, mismatching, blank-mismatching and tail cells, per first key column set of ``old``/``new``."""
    both = old.select(*keys, date, F.col(value).alias("_old")).join(
        new.select(*keys, date, F.col(value).alias("_new")), [*keys, date], "full"
    )
    last_old = old.where(F.col(value).isNotNull()).agg(F.max(date).alias("_last_old"))
    cells = both.crossJoin(F.broadcast(last_old))
    o, n = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    tail = ~o & n & (F.col(date) > F.col("_last_old"))
    return cells.agg(
        F.count_if(o).alias("existing_numeric"),
        F.count_if(n).alias("new_numeric"),
        F.count_if(o & n).alias("compared_numeric"),
        F.count_if(o & n & ~close_to(F.col("_new"), F.col("_old"))).alias("numeric_mismatches"),
        F.count_if(o != n).alias("blank_mismatches"),
        F.count_if(~o & n).alias("added_numeric"),
        F.count_if(o & ~n).alias("removed_numeric"),
        F.count_if(tail).alias("new_tail_numeric"),
        F.count_if((o != n) & ~tail).alias("historical_blank_mismatches"),
        F.max(F.when(o & n, F.abs(F.col("_old") - F.col("_new")))).alias("max_absolute_difference"),
    )


def second_opinion(pairs: DataFrame, window: int) -> DataFrame:
    """Recompute spread z and Fisher from raw window sums; rows that disagree with the operators at 1e-9."""
    first = pair_correlation(pair_spread(pairs, window), window)
    ready = pairs.withColumn("_ok", F.col("xv").isNotNull() & F.col("yv").isNotNull())
    w = _prior(["pair_id"], "_ok", "obs_date", window)
    items = ready.withColumn("_h", F.collect_list(F.struct("xv", "yv")).over(w)).where(
        F.col("_ok") & (F.size("_h") == window)
    )

    def mean(side: str) -> Column:
        return F.aggregate("_h", F.lit(0.0), lambda a, e: a + e[side]) / window

    centred = items.withColumns({"_mx": mean("xv"), "_my": mean("yv")})

    def moment(f) -> Column:
        return F.aggregate("_h", F.lit(0.0), lambda a, e: a + f(e["xv"] - F.col("_mx"), e["yv"] - F.col("_my")))

    sums = centred.select(
        "pair_id", "obs_date",
        (F.col("xv") - F.col("yv") - F.col("_mx") + F.col("_my")).alias("_gap"),
        moment(lambda x, y: x * x).alias("_xx"),
        moment(lambda x, y: y * y).alias("_yy"),
        moment(lambda x, y: x * y).alias("_xy"),
    )
    dev = F.sqrt((F.col("_xx") + F.col("_yy") - 2 * F.col("_xy")) / (window - 1))
    again = sums.select(
        "pair_id", "obs_date",
        F.when(dev > 0, F.try_divide("_gap", dev)).alias("spread_z_2"),
        F.when(
            (F.col("_xx") > 0) & (F.col("_yy") > 0),
            F.try_divide("_xy", F.sqrt("_xx") * F.sqrt("_yy")),
        ).alias("_r2"),
    ).withColumn("fisher_2", F.when(F.abs("_r2") < 1 - 1e-14, F.atanh("_r2")))
    joined = first.join(again, ["pair_id", "obs_date"], "left")
    agree = close_to(F.col("spread_z"), F.col("spread_z_2"), 1e-9, 1e-9) & close_to(F.col("fisher"), F.col("fisher_2"), 1e-9, 1e-9)
    return joined.where(~agree).select("pair_id", "obs_date", "spread_z", "spread_z_2", "fisher", "fisher_2")


def stale_lineage(stored: DataFrame, pairs: DataFrame, window: int) -> DataFrame:
    """Stored Fisher cells that do not equal a recomputation from the dated inputs."""
    fresh = pair_correlation(pairs, window).select("pair_id", "obs_date", F.col("fisher").alias("expected"))
    both = stored.select("pair_id", "obs_date", F.col("fisher").alias("stored")).join(fresh, ["pair_id", "obs_date"], "left")
    return both.where(~close_to(F.col("stored"), F.col("expected")))


# --- monthly selection -------------------------------------------------------------------------


def monthly_values(records: DataFrame) -> DataFrame:
    """Newest vintage per (series, day), then ``latest`` or ``mean`` per month.

    ``records``: series, observation_date, release_date, realtime_start, value, monthly_aggregation.
    A month whose records name several methods gets ``method_conflict`` = true and no value.
    """
    newest = latest_per_key(
        records.where(F.col("observation_date").isNotNull() & F.col("value").isNotNull()),
        ["series", "observation_date"],
        [F.coalesce("release_date", F.to_date(F.lit("0001-01-01"))), F.coalesce("realtime_start", F.to_date(F.lit("0001-01-01")))],
    )
    method = F.coalesce("monthly_aggregation", F.lit("latest"))
    months = newest.withColumn("month", F.trunc("observation_date", "MM")).groupBy("series", "month").agg(
        F.min(method).alias("method"),
        (F.min(method) != F.max(method)).alias("method_conflict"),
        F.max_by("value", F.struct("observation_date", "release_date")).alias("_latest"),
        F.avg("value").alias("_mean"),
    )
    value = F.when(~F.col("method_conflict"), F.when(F.col("method") == "mean", F.col("_mean")).otherwise(F.col("_latest")))
    return months.select("series", "month", "method", "method_conflict", value.alias("value"))


def month_end_selection(records: DataFrame) -> DataFrame:
    """For each (series, month end): the record(s) selected in that month, observed and released by then.

    Never carried forward: a month without an eligible record has no row.
    """
    selected = F.coalesce("selection_date", "release_date")
    row_date = F.last_day(selected)
    eligible = records.withColumn("row_date", row_date).where(
        (F.col("observation_date") <= F.col("row_date"))
        & (F.coalesce("period_aligned", F.lit(False)) | (F.col("release_date") <= F.col("row_date")))
    )
    method = F.coalesce("monthly_aggregation", F.lit("latest"))
    order = F.struct("observation_date", "release_date")
    grouped = eligible.groupBy("series", "row_date").agg(
        F.count("*").alias("records"),
        F.min(method).alias("method"),
        F.max_by("value", order).alias("_latest"),
        F.avg("value").alias("_mean"),
        F.max("observation_date").alias("observation_date"),
        F.max("release_date").alias("release_date"),
    )
    use_mean = (F.col("method") == "mean") & (F.col("records") > 1)
    return grouped.withColumn("value", F.when(use_mean, F.col("_mean")).otherwise(F.col("_latest"))).drop("_mean", "_latest")


def selection_reasons(selected: DataFrame, months: DataFrame, series: DataFrame) -> DataFrame:
    """Why each cell of the (series, month end) grid has its value or none."""
    grid = series.select("series").distinct().crossJoin(F.broadcast(months.select("row_date").distinct()))
    joined = grid.join(selected, ["series", "row_date"], "left")
    why = (
        F.when(F.col("value").isNull(), "no eligible observation released by the row date")
        .when((F.col("method") == "mean") & (F.col("records") > 1), F.concat(F.lit("mean of "), F.col("records").cast("string"), F.lit(" observations")))
        .otherwise(F.concat(F.lit("latest observation "), F.col("observation_date").cast("string")))
    )
    return joined.withColumn("reason", why)


def first_release(records: DataFrame) -> DataFrame:
    """First publication date of each (series, observation)."""
    return records.groupBy("series", "observation_date").agg(F.min("realtime_start").alias("first_release"))


def ratio_series(top: DataFrame, bottom: DataFrame, on: str) -> DataFrame:
    """top/bottom per ``on``; missing or zero denominators give NULL and a warning text."""
    both = top.select(on, F.col("value").alias("top")).join(bottom.select(on, F.col("value").alias("bottom")), on, "left")
    warning = (
        F.when(F.col("bottom").isNull(), "MISSING_DENOMINATOR").when(F.col("bottom") == 0, "ZERO_DENOMINATOR")
    )
    return both.select(on, F.when(warning.isNull(), F.try_divide("top", "bottom")).alias("ratio"), warning.alias("warning"))


def year_over_year(records: DataFrame, weekly: bool = False, tolerance_days: int = 8) -> DataFrame:
    """Percent change on the same date last year (weekly: latest within 8 days before it).

    Records are one row per (series, observation_date).
    """
    base = records.select(
        "series",
        F.col("observation_date").alias("prior_date"),
        F.col("value").alias("prior_value"),
        F.col("release_date").alias("prior_release"),
    )
    current = records.withColumn("target", same_day_last_year(F.col("observation_date")))
    if weekly:
        line = current.select("series", F.col("target").alias("day"), F.lit(None).cast("struct<d:date,v:double,r:date>").alias("q"), F.lit(1).alias("side")).unionByName(
            base.select("series", F.col("prior_date").alias("day"), F.struct(F.col("prior_date").alias("d"), F.col("prior_value").alias("v"), F.col("prior_release").alias("r")).alias("q"), F.lit(0).alias("side"))
        )
        back = Window.partitionBy("series").orderBy("day", "side").rowsBetween(Window.unboundedPreceding, 0)
        hit = line.withColumn("q", F.last("q", ignorenulls=True).over(back)).where("side = 1").distinct()
        found = hit.where(F.datediff("day", "q.d") <= tolerance_days).select(
            "series", F.col("day").alias("target"), F.col("q.d").alias("prior_date"), F.col("q.v").alias("prior_value"), F.col("q.r").alias("prior_release")
        )
        joined = current.join(found, ["series", "target"])
    else:
        joined = current.join(base.withColumn("target", F.col("prior_date")), ["series", "target"])
    return joined.where(F.col("prior_value") != 0).select(
        "series",
        "observation_date",
        "prior_date",
        F.greatest("release_date", "prior_release").alias("release_date"),
        ((F.try_divide("value", "prior_value") - 1) * 100.0).alias("value"),
    )


def month_grid(series: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Long month-end table over min..max month for every series; blanks kept as NULL.

    ``existing`` (series, row_date, value, verified_invalid) wins unless its cell is verified invalid.
    """
    span = series.agg(F.min("row_date").alias("a"), F.max("row_date").alias("b"))
    months = span.select(
        F.explode(F.sequence(F.trunc("a", "MM"), F.trunc("b", "MM"), F.expr("interval 1 month"))).alias("m")
    ).select(F.last_day("m").alias("row_date"))
    grid = series.select("series").distinct().crossJoin(F.broadcast(months))
    filled = grid.join(series.select("series", "row_date", "value"), ["series", "row_date"], "left")
    if existing is None:
        return filled
    old = existing.select("series", "row_date", F.col("value").alias("_old"), F.coalesce("verified_invalid", F.lit(False)).alias("_bad"))
    merged = filled.join(old, ["series", "row_date"], "full")
    keep = F.when(F.col("_bad"), F.col("value")).otherwise(F.coalesce("_old", "value"))
    return merged.select("series", "row_date", keep.alias("value"))


def misplaced_sparse_rows(stored: DataFrame, incoming_months: DataFrame, rule: str) -> DataFrame:
    """Stored rows of a quarterly/annual series in a wrong month whose replacement month arrives."""
    month = F.trunc("obs_date", "MM")
    if rule == "annual":
        target = F.make_date(F.year("obs_date"), F.lit(12), F.lit(1))
    elif rule == "quarterly":
        target = F.make_date(F.year("obs_date"), F.quarter("obs_date") * 3, F.lit(1))
    else:
        raise ValueError("rule must be annual or quarterly")
    wrong = stored.withColumn("month", target).where(month != target)
    return wrong.join(incoming_months.select("month").distinct(), "month", "left_semi").withColumnRenamed("month", "replacement_month")


def release_shift(observations: DataFrame, lag_months: int, wanted: DataFrame) -> DataFrame:
    """Move monthly observations into their publication month; keep the wanted months (``month``)."""
    moved = observations.withColumn("month", F.add_months(F.trunc("obs_date", "MM"), lag_months))
    return moved.join(wanted.select("month").distinct(), "month", "left_semi").select("series", "month", "value")


def latest_contiguous_months(rows: DataFrame, keys: Sequence[str], months: int) -> DataFrame:
    """The latest block of ``months`` gap-free months per key; without one, the last ``months`` rows."""
    index = F.year("month") * 12 + F.month("month")
    w = Window.partitionBy(*keys).orderBy("month")
    island = rows.withColumn("_island", index - F.row_number().over(w))
    size = Window.partitionBy(*keys, "_island").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    sized = island.withColumn("_run", F.count("*").over(size)).withColumn("_index", index)
    end = F.max(F.when(F.col("_run") >= months, F.col("_index"))).over(Window.partitionBy(*keys))
    back = Window.partitionBy(*keys).orderBy(F.desc("month"))
    ranked = sized.withColumn("_end", end).withColumn("_back", F.row_number().over(back))
    in_block = F.col("_index").between(F.col("_end") - months + 1, F.col("_end"))
    chosen = F.when(F.col("_end").isNotNull(), in_block).otherwise(F.col("_back") <= months)
    return ranked.where(chosen).select(*rows.columns)


# --- prices ------------------------------------------------------------------------------------


def average_dollar_volume(bars: DataFrame, sessions: int = 20) -> DataFrame:
    """Mean of price*volume over the last ``sessions`` completed sessions per ticker; NULL before that many."""
    w = Window.partitionBy("ticker").orderBy("session_date").rowsBetween(1 - sessions, 0)
    traded = F.col("close") * F.col("volume")
    return bars.withColumn("average_dollar_volume", F.when(F.count(traded).over(w) == sessions, F.avg(traded).over(w)))


def forward_outcome(cutoffs: DataFrame, prices: DataFrame, benchmark: DataFrame, horizon: int) -> DataFrame:
    """Close-to-close return from the first session after the cutoff over ``horizon`` sessions.

    The end is the horizon-th session after execution's predecessor, or the last one when the tail is
    short. A return needs two sessions: with one, or a start price of 0, it is NULL and UNAVAILABLE. ``cutoffs``: observation_id, ticker, cutoff; ``prices``: ticker, session_date, close;
    ``benchmark``: session_date, close. Both price tables hold one row per (ticker, day).
    """
    w = Window.partitionBy("ticker").orderBy("session_date")
    forward = w.rowsBetween(0, horizon - 1)
    windows = prices.select(
        "ticker",
        F.col("session_date").alias("execution_date"),
        F.col("close").alias("start_close"),
        F.last("session_date").over(forward).alias("end_date"),
        F.last("close").over(forward).alias("end_close"),
    )
    asked = cutoffs.select("ticker", "cutoff").distinct()
    marks = asked.select("ticker", F.col("cutoff").alias("day"), F.lit(1).alias("ask"), F.lit(None).cast("date").alias("session")).unionByName(
        windows.select("ticker", F.col("execution_date").alias("day"), F.lit(0).alias("ask"), F.col("execution_date").alias("session"))
    )
    # Backwards in time the frame only grows, so the next session costs one step per row.
    after = Window.partitionBy("ticker").orderBy(F.desc("day"), F.desc("ask")).rowsBetween(Window.unboundedPreceding, -1)
    found = marks.withColumn("execution_date", F.last("session", ignorenulls=True).over(after)).where("ask = 1")
    placed = found.select("ticker", F.col("day").alias("cutoff"), "execution_date").join(windows, ["ticker", "execution_date"], "left")
    bench_start = benchmark.select(F.col("session_date").alias("execution_date"), F.col("close").alias("b0"))
    bench_end = benchmark.select(F.col("session_date").alias("end_date"), F.col("close").alias("b1"))
    priced = placed.join(bench_start, "execution_date", "left").join(bench_end, "end_date", "left")
    several = F.col("end_date") > F.col("execution_date")
    ret = F.when(several & (F.col("start_close") != 0), F.try_divide("end_close", "start_close") - 1)
    bench = F.when(several & (F.col("b0") != 0), F.try_divide("b1", "b0") - 1)
    outcome = priced.select(
        "ticker", "cutoff", "execution_date", "end_date",
        ret.alias("forward_return"), bench.alias("benchmark_return"), (ret - bench).alias("excess_return"),
        F.when(ret.isNull(), "UNAVAILABLE").otherwise("AVAILABLE").alias("status"),
    )
    return cutoffs.join(outcome, ["ticker", "cutoff"], "left")


def overlapping_windows(windows: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Flag windows that overlap another of the same key, for keys of any size.

    Sorted by start, a window overlaps an earlier one if the running maximum end reaches it and a later one if the least
    later start lies inside it; both are scans over ranges. Equal (start, end) rows are counted, not paired.
    """
    distinct = windows.groupBy(*keys, start).agg(F.max(end).alias("_far"), F.count("*").alias("_same"))
    moment = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    reached = running_maxima(distinct, keys, [F.col(start)], {"_earlier_end": F.col("_far")})
    marked = running_maxima(reached, keys, [F.col(start).desc()], {"_back": -moment(start)})
    flag = (
        (F.col("_same") > 1)
        | F.coalesce(F.col("_earlier_end") > F.col(start), F.lit(False))
        | F.coalesce(-F.col("_back") < moment(end), F.lit(False))
    )
    return look_up(windows, marked.drop("_far"), [*keys, start], "inner").withColumn("overlaps", flag).select(*windows.columns, "overlaps")
