"""Table comparison, report-date audits and series checks. Violations are rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions.numbers import equal_within
from gaugework.plans.intervals import points_in_spans


def compare_cells(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Cell-by-cell difference of two tables: (keys, column, before, after, change).

    Values that parse as numbers are equal within 1e-9 relative or absolute, others as trimmed text.
    """
    def cells(df: DataFrame, name: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.trim(F.col(c).cast("string")).alias(name)) for c in columns])
        long = df.select(*keys, F.explode(pairs).alias("c")).select(*keys, "c.column", f"c.{name}")
        return long.where(F.coalesce(name, F.lit("")) != "")

    both = cells(old, "before").join(cells(new, "after"), [*keys, "column"], "full")
    a, b = F.col("before").try_cast("double"), F.col("after").try_cast("double")
    close = F.abs(a - b) <= F.greatest(F.lit(1e-9), 1e-9 * F.greatest(F.abs(a), F.abs(b)))
    same = F.coalesce(close, F.col("before") == F.col("after"))
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(~same, "updated")
    return both.withColumn("change", change).where(F.col("change").isNotNull())


def change_counts(changes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Added / updated / removed counts per output."""
    return changes.groupBy(*by).agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("added", "updated", "removed")])


# --- report dates ----------------------------------------------------------------------------------


def _gap_texts(dates: Column, days: int) -> Column:
    """Texts of the steps longer than ``days`` in a sorted array of dates."""
    steps = F.filter(F.arrays_zip(F.slice(dates, 1, F.greatest(F.size(dates) - 1, F.lit(0))).alias("a"), F.slice(dates, 2, F.greatest(F.size(dates) - 1, F.lit(0))).alias("b")),
                     lambda s: F.datediff(s["b"], s["a"]) > days)
    return F.transform(steps, lambda s: F.concat(s["a"].cast("string"), F.lit(" -> "), s["b"].cast("string"), F.lit(" ("), F.datediff(s["b"], s["a"]).cast("string"), F.lit(" days)")))


def long_gaps(dates: DataFrame, keys: Sequence[str], date: str, threshold_days: int = 10) -> DataFrame:
    """Consecutive distinct dates of a key more than ``threshold_days`` apart."""
    w = Window.partitionBy(*keys).orderBy(date)
    stepped = dates.where(F.col(date).isNotNull()).select(*keys, date).distinct().withColumn("previous_date", F.lag(date).over(w))
    return stepped.withColumn("gap_days", F.datediff(date, "previous_date")).where(F.col("gap_days") > threshold_days)


def report_audit(reports: DataFrame, today: Column, stale_after_days: int = 10, inactive_after: int = 3, gap_days: int = 10) -> DataFrame:
    """One row per contract: date coverage against the source's own report dates, lags, duplicates, flags, status.

    ``reports``: source_row, market, code, report_date (DATE or NULL when unparseable). Rows collapse to
    (contract, date) counts before anything is gathered, so arrays are bounded by calendar days.
    """
    market = F.trim(F.coalesce("market", F.lit("")))
    code = F.regexp_replace(F.trim(F.coalesce("code", F.lit(""))), r'^"|"$|\.0$', "")
    work = reports.select(
        "source_row", market.alias("market"), code.alias("code"),
        F.when(F.col("report_date") <= today, F.col("report_date")).alias("date"),
        F.col("report_date").isNull().alias("invalid"),
        F.coalesce(F.col("report_date") > today, F.lit(False)).alias("future"),
    ).withColumn("key", F.when(F.col("code") != "", F.concat(F.lit("code:"), "code")).otherwise(F.concat(F.lit("name:"), "market")))
    source = work.agg(F.array_sort(F.collect_set("date")).alias("source_dates"))
    per_date = work.where(F.col("date").isNotNull()).groupBy("key", "date").agg(F.count("*").alias("n"))
    dated = per_date.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("date", "n"))).alias("seen"),
        F.sum(F.col("n") - 1).alias("duplicate_rows"),
    )
    facts = work.groupBy("key").agg(
        F.max_by("market", F.when(F.col("market") != "", F.struct(F.coalesce("date", F.to_date(F.lit("0001-01-01"))), "source_row"))).alias("asset"),
        F.min_by("code", "source_row").alias("code"),
        F.count("*").alias("rows"), F.count("date").alias("valid_rows"), F.count_if("invalid").alias("invalid_rows"), F.count_if("future").alias("future_rows"),
        F.max(F.col("market") == "").alias("no_name"), F.max(F.col("code") == "").alias("no_code"),
    )
    # The list of distinct report dates of the whole source is at most one entry per calendar day.
    joined = facts.join(dated, "key", "left").crossJoin(F.broadcast(source))
    dates = F.transform("seen", lambda s: s["date"])
    placed = joined.withColumns({"dates": dates, "source_latest": F.element_at("source_dates", -1)}).withColumns({
        "earliest": F.try_element_at("dates", F.lit(1)), "latest": F.try_element_at("dates", F.lit(-1)),
    }).withColumns({"_i0": F.array_position("source_dates", F.col("earliest")), "_i1": F.array_position("source_dates", F.col("latest"))})
    has = F.col("latest").isNotNull()
    expected = F.when(has, F.col("_i1") - F.col("_i0") + 1)
    missing = F.when(has, F.array_except(F.slice("source_dates", F.col("_i0").cast("int"), expected.cast("int")), "dates"))
    behind = F.when(has, F.size("source_dates") - F.col("_i1"))
    lag = F.when(has, F.datediff("source_latest", "latest"))
    source_age = F.datediff(today, F.col("source_latest"))
    measured = placed.withColumns({
        "expected_dates": expected, "missing": missing, "reports_behind": behind, "lag_days": lag, "source_age_days": source_age,
        "gaps": F.when(has, _gap_texts(F.col("dates"), gap_days)),
        "duplicates": F.transform(F.filter("seen", lambda s: s["n"] > 1), lambda s: F.concat(s["date"].cast("string"), F.lit(" ("), s["n"].cast("string"), F.lit(" rows)"))),
    })
    measured = measured.withColumn("source_status", F.when(F.col("source_age_days") > stale_after_days, "SOURCE_DELAYED").otherwise("CURRENT"))
    freshness = F.when(~has, "NO_VALID_DATES").when(F.col("lag_days") > 0, "ASSET_LAGGING").otherwise(F.col("source_status"))
    reporting = (
        F.when(~has, "UNKNOWN_NO_VALID_DATES").when(F.col("reports_behind") == 0, "REPORTED_IN_LATEST_SOURCE")
        .when(F.col("reports_behind") < inactive_after, "RECENTLY_NOT_REPORTED").otherwise("POSSIBLY_INACTIVE_OR_DISCONTINUED")
    )
    gaps_n, missing_n = F.coalesce(F.size("gaps"), F.lit(0)), F.coalesce(F.size("missing"), F.lit(0))
    duplicate_n = F.coalesce("duplicate_rows", F.lit(0))
    flags = F.array_compact(F.array(
        F.when(missing_n > 0, "MISSING_SOURCE_DATES"), F.when(gaps_n > 0, "LONG_CALENDAR_GAPS"), F.when(duplicate_n > 0, "DUPLICATE_DATES"),
        F.when(F.col("invalid_rows") > 0, "INVALID_DATES"), F.when(F.col("future_rows") > 0, "FUTURE_DATES"),
        F.when(F.col("no_name"), "MISSING_ASSET_NAME"), F.when(F.col("no_code"), "MISSING_CONTRACT_CODE"),
    ))
    labelled = measured.withColumns({"freshness": freshness, "reporting_status": reporting, "_flags": flags})
    extra = F.when(~F.col("reporting_status").isin("REPORTED_IN_LATEST_SOURCE", "UNKNOWN_NO_VALID_DATES"), F.col("reporting_status"))
    status = F.array_join(F.concat(F.array_compact(F.array("freshness", extra)), "_flags"), " | ")
    serious = (F.col("invalid_rows") > 0) | (F.col("future_rows") > 0) | (duplicate_n > 0)
    priority = (
        F.when(serious, 0).when(((missing_n > 0) | (gaps_n > 0)) & (F.col("reporting_status") != "POSSIBLY_INACTIVE_OR_DISCONTINUED"), 1)
        .when(F.col("reporting_status") == "RECENTLY_NOT_REPORTED", 2).when(F.col("reporting_status") == "POSSIBLY_INACTIVE_OR_DISCONTINUED", 4).otherwise(5)
    )
    return labelled.select(
        "key", F.coalesce("asset", F.lit("(missing market name)")).alias("asset"), "code", status.alias("status"), "freshness", "reporting_status",
        F.array_join("_flags", " | ").alias("flags"), "source_status", today.alias("audit_date"), F.lit(stale_after_days).alias("stale_after_days"),
        "earliest", "latest", F.element_at("source_dates", 1).alias("source_earliest"), "source_latest",
        F.when(has, F.datediff(today, F.col("latest"))).alias("age_days"), "source_age_days", "lag_days", "reports_behind",
        "rows", "valid_rows", "invalid_rows", "future_rows", F.coalesce(F.size("dates"), F.lit(0)).alias("unique_dates"), "expected_dates",
        F.round(100 * F.size("dates") / F.col("expected_dates"), 2).alias("coverage_pct"),
        F.when(has, missing_n).alias("missing_count"), F.coalesce(F.array_join("missing", ", "), F.lit("")).alias("missing_dates"),
        gaps_n.alias("gap_count"), F.coalesce(F.array_join("gaps", " | "), F.lit("")).alias("gaps"),
        duplicate_n.alias("duplicate_rows"), F.coalesce(F.array_join("duplicates", " | "), F.lit("")).alias("duplicate_dates"),
        F.size("source_dates").alias("source_date_count"), priority.alias("priority"),
    )


def report_audit_summary(audit: DataFrame) -> DataFrame:
    """One row of totals over the contract audit."""
    def n(test: Column) -> Column:
        return F.count_if(test)

    return audit.agg(
        F.count("*").alias("assets"), F.sum("rows").alias("rows"), F.max("source_latest").alias("source_latest"), F.min("source_status").alias("source_status"),
        n(F.col("freshness") == "CURRENT").alias("current"), n(F.col("freshness") == "SOURCE_DELAYED").alias("source_delayed"),
        n(F.col("freshness") == "ASSET_LAGGING").alias("lagging"), n(F.col("freshness") == "NO_VALID_DATES").alias("no_valid_dates"),
        n(F.col("reporting_status") == "RECENTLY_NOT_REPORTED").alias("recently_not_reported"), n(F.col("reporting_status") == "POSSIBLY_INACTIVE_OR_DISCONTINUED").alias("possibly_inactive"),
        n(F.col("reporting_status") == "REPORTED_IN_LATEST_SOURCE").alias("reported_latest"), n(F.col("status") == "CURRENT").alias("clean"),
        n(F.col("flags") != "").alias("with_flags"), n(F.col("flags").contains("MISSING_SOURCE_DATES")).alias("with_missing_dates"),
        n(F.col("gap_count") > 0).alias("with_gaps"), n(F.col("duplicate_rows") > 0).alias("with_duplicates"),
        F.sum("invalid_rows").alias("invalid_rows"), F.sum("future_rows").alias("future_rows"),
    )


# --- series checks ---------------------------------------------------------------------------------


def _finding(df: DataFrame, severity: str, message: Column, name: str = "series") -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.col(name).cast("string").alias("indicator"), message.alias("message"))


def value_range_findings(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """Values outside the configured range of their series (``ranges``: series, minimum, maximum)."""
    checked = records.join(F.broadcast(ranges), "series").where(F.col("value").isNotNull() & ~F.col("value").between(F.col("minimum"), F.col("maximum")))
    return _finding(checked, "ERROR", F.concat_ws(" ", F.lit("value outside range on"), F.col("observation_date").cast("string")))


def freshness_findings(records: DataFrame, as_of: Column, deadline_day: int) -> DataFrame:
    """Stale or future newest release month; before ``deadline_day`` last month's release is still enough."""
    this_month = F.trunc(as_of, "MM")
    oldest = F.when(F.dayofmonth(as_of) >= deadline_day, this_month).otherwise(F.add_months(this_month, -1))
    newest = records.groupBy("series").agg(F.trunc(F.max("release_date"), "MM").alias("m"))
    stale = _finding(newest.where(F.col("m") < oldest), "ERROR", F.concat_ws(" ", F.lit("stale: latest release month"), F.col("m").cast("string")))
    return stale.union(_finding(newest.where(F.col("m") > this_month), "ERROR", F.concat_ws(" ", F.lit("future release month"), F.col("m").cast("string"))))


def monthly_date_findings(months: DataFrame, as_of: Column, continuity: int = 24) -> DataFrame:
    """Duplicate, future or recently gapped monthly dates per series (``month`` = first of month)."""
    counted = months.groupBy("series", "month").agg(F.count("*").alias("n"))
    index = F.year("month") * 12 + F.month("month")
    last = counted.groupBy("series").agg(F.max(index).alias("_last"), F.max("month").alias("_max"), F.count("*").alias("_have"))
    tail = counted.join(last, "series").withColumn("_want", F.least(F.lit(continuity), F.col("_have"))).where(index > F.col("_last") - F.col("_want"))
    gaps = tail.groupBy("series", "_want").agg(F.count("*").alias("_got")).where(F.col("_got") < F.col("_want"))
    return (
        _finding(counted.where("n > 1"), "ERROR", F.concat_ws(" ", F.lit("duplicate month"), F.col("month").cast("string")))
        .union(_finding(last.where(F.col("_max") > F.trunc(as_of, "MM")), "ERROR", F.concat_ws(" ", F.lit("future month"), F.col("_max").cast("string"))))
        .union(_finding(gaps, "ERROR", F.concat_ws(" ", F.lit("gap in recent history: missing"), (F.col("_want") - F.col("_got")).cast("string"), F.lit("months"))))
    )


def tail_findings(months: DataFrame, expected_months: int) -> DataFrame:
    """Series whose newest ``expected_months`` months are not each present exactly once with a value."""
    index = F.year("month") * 12 + F.month("month")
    last = months.groupBy("series").agg(F.max(index).alias("_last"))
    recent = months.join(last, "series").where(index > F.col("_last") - expected_months)
    stat = recent.groupBy("series").agg(F.count("*").alias("n"), F.countDistinct("month").alias("d"), F.count("value").alias("v"))
    bad = stat.where((F.col("n") != expected_months) | (F.col("d") != expected_months) | (F.col("v") != expected_months))
    return _finding(bad, "ERROR", F.concat_ws(" ", F.lit("tail has"), F.col("v").cast("string"), F.lit("values of"), F.lit(str(expected_months))))


def record_findings(records: DataFrame) -> DataFrame:
    """Missing dates, releases before observations, missing values, repeated (observation, release, selection)."""
    missing = records.where(F.col("observation_date").isNull() | F.col("release_date").isNull())
    early = records.where(F.col("release_date") < F.col("observation_date"))
    empty = records.where(F.col("value").isNull())
    repeated = records.groupBy("series", "observation_date", "release_date", "selection_date").count().where("count > 1")
    return (
        _finding(missing, "ERROR", F.lit("missing observation or release date"))
        .union(_finding(early, "WARNING", F.concat_ws(" ", F.lit("released before observed"), F.col("observation_date").cast("string"))))
        .union(_finding(empty, "ERROR", F.concat_ws(" ", F.lit("missing value on"), F.col("observation_date").cast("string"))))
        .union(_finding(repeated, "ERROR", F.concat_ws(" ", F.lit("duplicate record"), F.col("observation_date").cast("string"), F.col("release_date").cast("string"))))
    )


def provenance_findings(records: DataFrame, required: Sequence[str], name: str = "series") -> DataFrame:
    """Rows whose required provenance fields are blank."""
    blank = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in required]))
    bad = records.withColumn("_blank", blank).where(F.size("_blank") > 0)
    return _finding(bad, "ERROR", F.concat(F.lit("missing provenance: "), F.array_join("_blank", ", ")), name)


def validation_report(parts: Sequence[DataFrame]) -> DataFrame:
    """One (severity, indicator, message, count) table from several findings tables."""
    return reduce(DataFrame.unionByName, parts).groupBy("severity", "indicator", "message").agg(F.count("*").alias("occurrences"))


def table_against_source(table: DataFrame, source: DataFrame, as_of: Column, stale_months: int = 2) -> DataFrame:
    """Per series: rows, duplicate dates, blanks, non-numeric cells, mismatches with the source, staleness.

    ``table``: series, obs_date, cell (text); ``source``: series, obs_date, value (one per day).
    """
    number = F.col("cell").try_cast("double")
    cells = table.withColumns({"number": number, "blank": F.coalesce(F.trim("cell"), F.lit("")) == ""})
    stats = cells.groupBy("series").agg(
        F.count("*").alias("rows"), F.max("obs_date").alias("latest"), F.count_if("blank").alias("blanks"),
        F.count_if(~F.col("blank") & F.col("number").isNull()).alias("non_numeric"),
    )
    repeated = cells.groupBy("series", "obs_date").count().where("count > 1").groupBy("series").agg(F.count("*").alias("duplicate_dates"))
    last = cells.groupBy("series", "obs_date").agg(F.max("number").alias("number"))
    wrong = source.where(F.col("value").isNotNull()).join(last, ["series", "obs_date"]).where(~F.coalesce(equal_within(F.col("value"), F.col("number")), F.lit(False)))
    mismatched = wrong.groupBy("series").agg(F.count("*").alias("mismatches"), F.min("obs_date").alias("first_mismatch"))
    joined = stats.join(repeated, "series", "left").join(mismatched, "series", "left")
    return joined.select(
        "series", "rows", "latest", "blanks", "non_numeric", F.coalesce("duplicate_dates", F.lit(0)).alias("duplicate_dates"),
        F.coalesce("mismatches", F.lit(0)).alias("mismatches"), "first_mismatch",
        (F.months_between(F.trunc(as_of, "MM"), F.trunc("latest", "MM")) > stale_months).alias("stale"),
    )


def missing_references(rows: DataFrame, ids: str, target: DataFrame, key: str, owner: str) -> DataFrame:
    """Lineage ids (array column ``ids``) that do not exist in ``target``."""
    asked = rows.select(F.col(owner).alias("owner"), F.explode(ids).alias("missing_id"))
    return asked.join(target.select(F.col(key).alias("missing_id")).distinct(), "missing_id", "left_anti")


def shape_errors(rows: DataFrame, required: Sequence[str], positive: Sequence[str] = ()) -> DataFrame:
    """Add ``errors``: missing required fields and non-positive counts of a record."""
    tests = [F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(f"missing {c}")) for c in required]
    tests += [F.when(~(F.col(c) > 0), F.lit(f"{c} not positive")) for c in positive]
    return rows.withColumn("errors", F.array_join(F.array_compact(F.array(*tests)), "; "))


def members_on(universe: DataFrame, dates: DataFrame) -> DataFrame:
    """Universe members of each date: valid_from <= date < valid_to (open end allowed), with a delisted flag.

    Dates may be as many as the rows: dates and memberships are cut at shared bounds and joined by range.
    """
    asked = dates.select("as_of_date").distinct()
    return points_in_spans(asked, universe, "as_of_date", "valid_from", "valid_to").select(
        *universe.columns, "as_of_date", (F.col("delisted_date").isNotNull() & (F.col("delisted_date") <= F.col("as_of_date"))).alias("delisted")
    )
