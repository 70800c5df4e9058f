"""Filing facts: flattening, concept choice, annual rows, trailing values, canonical facts and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions.dates import to_utc
from gaugework.functions.numbers import joined_reasons, safe_div
from gaugework.plans.joins import attach, look_up

# Forms, window lengths and currencies of annual and interim facts.
ANNUAL_FORMS = ["10-K", "10-K/A", "20-F", "20-F/A", "40-F", "40-F/A"]
INTERIM_FORMS = ["10-Q", "10-Q/A", "6-K", "6-K/A"]
ANNUAL_DAYS = (250, 450)
INTERIM_DAYS = (60, 320)
FACT = "struct<start:string,end:string,val:double,form:string,accn:string,filed:string,fy:int,fp:string>"
FACT_SCHEMA = f"map<string,map<string,struct<units:map<string,array<{FACT}>>>>>"


def flatten_facts(companies: DataFrame, key: str, facts: str = "facts") -> DataFrame:
    """namespace -> concept -> unit -> facts JSON to one row per fact."""
    parsed = companies.select(key, F.from_json(facts, FACT_SCHEMA).alias("m"))
    concepts = parsed.select(key, F.explode("m").alias("namespace", "c")).select(key, "namespace", F.explode("c").alias("concept", "u"))
    units = concepts.select(key, "namespace", "concept", F.explode("u.units").alias("unit", "f"))
    rows = units.select(key, "namespace", "concept", "unit", F.explode("f").alias("f"))
    return rows.select(
        key, "namespace", "concept", "unit", F.col("f.start").try_cast("date").alias("start"), F.col("f.end").try_cast("date").alias("end"), "f.val", "f.form", "f.accn",
        F.col("f.filed").try_cast("date").alias("filed"), "f.fy", "f.fp",
    )


def submission_index(submissions: DataFrame, key: str, zone: str = "America/New_York") -> DataFrame:
    """Parallel arrays (accessions, accepted, forms, report dates) to rows with UTC acceptance times."""
    zipped = F.arrays_zip("accessions", "accepted", "forms", "report_dates")
    rows = submissions.select(key, F.explode(zipped).alias("s"))
    return rows.select(key, F.col("s.accessions").alias("accn"), to_utc(F.col("s.accepted"), zone).alias("accepted_at"), F.col("s.forms").alias("form"), F.col("s.report_dates").try_cast("date").alias("report_end"))


def statement_currency(facts: DataFrame, key: str, currencies: DataFrame) -> DataFrame:
    """The currency with the broadest annual concept coverage per company (``currencies``: unit, preference)."""
    used = facts.where(F.col("form").isin(ANNUAL_FORMS) & F.col("val").isNotNull()).join(F.broadcast(currencies), "unit")
    n = used.groupBy(key, "unit").agg(F.countDistinct("concept").alias("n"), F.min("preference").alias("p"))
    return n.groupBy(key).agg(F.max_by("unit", F.struct("n", -F.col("p"))).alias("currency"))


def annual_facts(facts: DataFrame, key: str, concepts: DataFrame) -> DataFrame:
    """One value per (company, metric, period end).

    ``concepts``: metric, namespace, concept, priority, duration BOOLEAN. The value comes from the preferred
    concept, then a fiscal-year fact, then the latest filing; the year label is that of the first filing.
    """
    named = facts.where(F.col("form").isin(ANNUAL_FORMS) & F.col("fy").isNotNull() & F.col("val").isNotNull() & F.col("end").isNotNull()).join(F.broadcast(concepts), ["namespace", "concept"])
    days = F.datediff("end", "start")
    yearly = named.where(~F.col("duration") | days.between(*ANNUAL_DAYS))
    payload = F.struct(F.col("val").alias("value"), "start", "filed", "accn", "form", "unit", "namespace", "concept")
    best = F.struct("priority", (F.col("fp") != "FY").alias("a"), (-F.datediff("filed", F.lit("1970-01-01").cast("date"))).alias("b"), "accn")
    g = yearly.groupBy(key, "metric", "end").agg(F.min_by(payload, best).alias("r"), F.min_by("fy", F.struct("filed", "priority", "accn")).alias("fy"))
    return g.select(key, "metric", "end", "fy", "r.*")


def broad_concepts(narrow: DataFrame, broad: DataFrame, key: str, factor: float = 2.0) -> DataFrame:
    """Companies whose broad concept is at least ``factor`` times the narrow one on the latest period both report in one filing."""
    both = narrow.select(key, "end", "accn", F.col("value").alias("narrow")).join(broad.select(key, "end", "accn", F.col("value").alias("broad")), [key, "end", "accn"])
    last = both.where(F.coalesce(F.trim("accn"), F.lit("")) != "").groupBy(key).agg(F.max_by(F.struct("narrow", "broad"), F.struct("end", "accn")).alias("r"))
    return last.select(key, "r.narrow", "r.broad", ((F.col("r.narrow") > 0) & (F.col("r.broad") >= factor * F.col("r.narrow"))).alias("prefer_broad"))


def annual_statements(annual: DataFrame, key: str) -> DataFrame:
    """Statement rows per (company, period end) with derived values; ratios only between same-unit facts.

    Year labels are rebuilt backwards from the newest one by the period gaps.
    """
    def v(name: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.col("value")))

    def u(name: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.upper("unit")))

    # Statement metrics and the long-term debt concepts that exclude the current portion.
    names = ["revenue", "net_income", "ebit", "da", "interest", "current_assets", "current_liabilities", "assets", "liabilities", "equity", "ocf", "capex", "cash", "debt", "debt_current", "shares", "gross_profit", "cost_of_revenue", "pretax"]
    noncurrent = ["LongTermDebt", "LongTermDebtNoncurrent", "LongTermDebtAndFinanceLeaseObligationsNoncurrent"]
    wide = annual.groupBy(key, "end").agg(
        *[v(n).alias(n) for n in names], *[u(n).alias(f"_u_{n}") for n in names],
        F.max(F.when(F.col("metric") == "debt", F.col("concept"))).alias("_debt_concept"),
        F.coalesce(*[F.max(F.when(F.col("metric") == n, F.col("fy"))) for n in ("revenue", "net_income", "ocf", "ebit")]).alias("source_fy"),
        F.countDistinct(F.when(F.col("metric") != "shares", F.upper("unit"))).alias("_units"),
    ).where(F.col("source_fy").isNotNull())
    newest_first = Window.partitionBy(key).orderBy(F.desc("end"))
    newer = F.lag("end").over(newest_first)
    step = F.when(newer.isNotNull(), F.greatest(F.lit(1), F.bround(F.datediff(newer, F.col("end")) / 365.25).cast("int"))).otherwise(0)
    stepped = wide.withColumn("_step", step)
    dated = stepped.withColumn("fiscal_year", F.first("source_fy").over(newest_first.rowsBetween(Window.unboundedPreceding, 0)) - F.sum("_step").over(newest_first.rowsBetween(Window.unboundedPreceding, 0)))

    def same(*n: str) -> Column:
        test = F.lit(True)
        for other in n[1:]:
            test = test & (F.col(f"_u_{n[0]}") == F.col(f"_u_{other}"))
        return test

    def ratio(a: str, b: str) -> Column:
        return F.when(same(a, b), safe_div(F.col(a), F.col(b)))

    c = F.col
    capex = F.abs("capex")
    fcf = F.when(same("ocf", "capex"), c("ocf") - capex)
    gross = F.coalesce("gross_profit", F.when(same("revenue", "cost_of_revenue"), c("revenue") - F.abs("cost_of_revenue")))
    composed = same("debt", "debt_current") & c("_debt_concept").isin(noncurrent)
    debt = F.when(composed, c("debt") + c("debt_current")).when(c("debt").isNotNull() & c("debt_current").isNull(), c("debt")).when(c("debt").isNull(), c("debt_current"))
    meaning = F.when(composed, "COMPOSED_NONCURRENT_PLUS_CURRENT").when(c("debt").isNotNull() & c("debt_current").isNull(), "REPORTED_LONG_TERM_ONLY").when(c("debt").isNull() & c("debt_current").isNotNull(), "REPORTED_CURRENT_ONLY").otherwise("UNAVAILABLE_OR_DEFINITION_REVIEW_REQUIRED")
    balanced = same("assets", "liabilities", "equity") & (F.abs(c("assets") - c("liabilities") - c("equity")) <= F.greatest(F.lit(1.0), F.abs("assets") * 0.01))
    out = dated.withColumns({"free_cash_flow": fcf, "gross": gross, "total_debt": debt, "total_debt_definition": meaning})
    return out.select(
        key, "fiscal_year", c("end").alias("fiscal_period_end"), "source_fy", *names, "free_cash_flow", "total_debt", "total_debt_definition",
        F.when(same("ebit", "da"), c("ebit") + c("da")).alias("ebitda"),
        safe_div(c("gross"), c("revenue")).alias("gross_margin"), ratio("net_income", "revenue").alias("net_margin"), ratio("pretax", "revenue").alias("pre_tax_margin"),
        ratio("net_income", "assets").alias("roa"), ratio("net_income", "equity").alias("roe"), ratio("revenue", "assets").alias("sales_to_assets"), ratio("current_assets", "current_liabilities").alias("current_ratio"),
        F.when(same("current_assets", "current_liabilities", "assets"), safe_div(c("current_assets") - c("current_liabilities"), c("assets"))).alias("working_capital_to_assets"),
        F.when(same("ebit", "interest"), safe_div(c("ebit"), F.abs("interest"))).alias("interest_coverage"),
        F.when(F.coalesce("_u_debt", "_u_debt_current") == c("_u_equity"), safe_div(c("total_debt"), c("equity"))).alias("debt_to_equity"),
        F.when(F.coalesce(balanced, F.lit(False)) & c("free_cash_flow").isNotNull(), "RECONCILED").otherwise("REVIEW_REQUIRED").alias("reconciliation"),
        F.when(c("_units") > 1, "MIXED_STATEMENT_CURRENCIES").otherwise("").alias("error"),
    )


def with_market(statements: DataFrame, prices: DataFrame, key: str) -> DataFrame:
    """Attach the year-end price (``key``, fiscal_period_end, price) and derive cap, enterprise value and yields."""
    c = F.col
    j = attach(statements, prices, [key, "fiscal_period_end"])
    cap = c("price") * c("shares")
    ev = cap + c("total_debt") - c("cash")
    return j.withColumns({
        "market_cap": cap, "enterprise_value": ev, "fcf_yield": safe_div(c("free_cash_flow"), cap), "ev_ebit": safe_div(ev, c("ebit")), "ev_ebitda": safe_div(ev, c("ebitda")),
        "price_fcf": safe_div(c("price"), safe_div(c("free_cash_flow"), c("shares"))),
    })


def trailing_twelve_months(facts: DataFrame, reports: DataFrame, key: str) -> DataFrame:
    """Annual value plus current year-to-date minus the matching prior year-to-date.

    ``facts``: key, metric, concept, unit, start, end, val, form, accn, filed, accepted_at, priority, fp.
    ``reports``: key, decision_at, report_end. Only facts accepted by the decision time take part; every
    join after the first is on a single chosen fact per (company, metric).
    """
    known = attach(facts, reports, [key], how="inner").where(F.col("accepted_at") <= F.col("decision_at"))
    day = F.lit("1970-01-01").cast("date")
    yearly = known.where(F.col("form").isin(ANNUAL_FORMS) & F.datediff("end", "start").between(*ANNUAL_DAYS))
    pick = F.struct("end", (-F.col("priority")).alias("p"), (F.col("fp") == "FY").alias("fy"), F.datediff("filed", day).alias("f"), "accn")
    base = yearly.groupBy(key, "metric").agg(F.max_by(F.struct("val", "end", "concept", "unit"), pick).alias("b"), F.first("report_end").alias("report_end"))
    interim = known.where(F.col("form").isin(INTERIM_FORMS) & F.datediff("end", "start").between(*INTERIM_DAYS) & F.col("val").isNotNull()).select(
        key, "metric", F.col("concept").alias("qc"), F.col("unit").alias("qu"), F.col("start").alias("qs"), F.col("end").alias("qe"), F.col("val").alias("qv"), F.struct("filed", "accn").alias("qo")
    )
    same = (F.col("qc") == F.col("b.concept")) & (F.col("qu") == F.col("b.unit"))
    now = attach(interim, base, [key, "metric"], how="inner").where(
        same & (F.col("qe") == F.col("report_end")) & (F.datediff("qs", "b.end") > 0) & (F.datediff("qs", "b.end") <= 7)
    ).groupBy(key, "metric").agg(F.max_by(F.struct("qs", "qe", "qv"), "qo").alias("n"))
    chosen = base.join(now, [key, "metric"], "left")
    gap = lambda a, b: F.datediff(F.col(a), F.col(b)).between(330, 400)
    before = attach(interim, chosen, [key, "metric"], how="inner").where(
        same & gap("n.qs", "qs") & gap("n.qe", "qe") & (F.abs(F.datediff("n.qe", "n.qs") - F.datediff("qe", "qs")) <= 14)
    ).groupBy(key, "metric").agg(F.max_by("qv", "qo").alias("prior"))
    names = reports.select(key).join(facts.select(key, "metric").distinct(), key)
    j = names.join(chosen.join(before, [key, "metric"], "left").drop("report_end"), [key, "metric"], "left").join(reports, key)
    conflict, annual_only = F.col("report_end") < F.col("b.end"), F.col("report_end") == F.col("b.end")
    method = (
        F.when(F.col("b").isNull(), "ANNUAL_FACT_MISSING").when(conflict, "REPORT_PERIOD_CONFLICT").when(annual_only, "ANNUAL_AS_TTM")
        .when(F.col("n").isNull(), "CURRENT_YTD_MISSING_OR_CONCEPT_CHANGED").when(F.col("prior").isNull(), "PRIOR_YTD_MISSING").otherwise("ANNUAL_PLUS_YTD_MINUS_PRIOR_YTD")
    )
    value = F.when(method == "ANNUAL_AS_TTM", F.col("b.val")).when(method == "ANNUAL_PLUS_YTD_MINUS_PRIOR_YTD", F.col("b.val") + F.col("n.qv") - F.col("prior"))
    return j.select(key, "metric", value.alias("ttm"), method.alias("method"))


def current_evidence(ttm: DataFrame, market: DataFrame, shares: DataFrame, key: str, min_volume: float = 5_000_000.0, min_price: float = 5.0, max_close_age: int = 7, max_report_age: int = 200) -> DataFrame:
    """Current values with their blockers.

    ``market``: key, decision_date, close_date, close, average_dollar_volume, sessions, report_end, currency_match. ``shares``: key, shares.
    """
    def of(name: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.col("ttm")))

    gaps = F.array_join(F.array_sort(F.collect_list(F.when(F.col("ttm").isNull(), F.concat(F.lit("TTM_"), F.upper("metric"), F.lit("_"), F.col("method"))))), "; ")
    wide = ttm.groupBy(key).agg(of("revenue").alias("ttm_revenue"), of("net_income").alias("ttm_net_income"), of("ocf").alias("ttm_ocf"), of("capex").alias("ttm_capex"), gaps.alias("_gaps"))
    j = wide.join(market, key).join(shares, key, "left")
    fcf = F.col("ttm_ocf") - F.abs("ttm_capex")
    cap = F.when(F.col("currency_match"), F.col("shares") * F.col("close"))
    own = joined_reasons(
        (F.col("shares").isNull(), "CURRENT_SHARE_COUNT_UNVERIFIED"), (F.datediff("decision_date", "close_date") > max_close_age, "CLOSE_STALE"), (~F.col("currency_match"), "PRICE_STATEMENT_CURRENCY_MISMATCH"),
        (F.col("sessions") < 15, "INSUFFICIENT_COMPLETED_PRICE_SESSIONS"), (F.col("average_dollar_volume") < min_volume, "DOLLAR_LIQUIDITY_BELOW_FLOOR"), (F.col("close") < min_price, "SHARE_PRICE_BELOW_FLOOR"),
        (F.datediff("decision_date", "report_end") > max_report_age, "FINANCIAL_REPORT_STALE"), sep="; ",
    )
    blockers = F.array_join(F.filter(F.array("_gaps", own), lambda x: x != ""), "; ")
    return j.withColumns({"ttm_fcf": fcf, "market_cap": cap, "fcf_yield": safe_div(fcf, cap, True), "blockers": blockers}).withColumn("status", F.when(F.col("blockers") == "", "CURRENT_REVIEW_EVIDENCE_COMPLETE").otherwise("REVIEW_REQUIRED")).drop("_gaps")


# --- canonical facts and outcomes ------------------------------------------------------------------------


def canonical_facts(facts: DataFrame, ranks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Newest filing per (ticker, concept, unit, period), then one concept per (ticker, metric, unit, period) by tag rank.

    ``facts``: ticker, concept, unit, period_start, period_end, fiscal_period, value, filed, accn; ``ranks``: concept, metric, tag_rank.
    Returns (canonical, revisions): superseded values stay as rows, never in one collected list.
    """
    period = ["ticker", "concept", "unit", "period_start", "period_end", "fiscal_period"]
    order = F.struct("filed", "accn")
    newest = facts.groupBy(*period).agg(F.max_by(F.struct("value", "filed", "accn"), order).alias("r"), F.count("*").alias("versions"))
    chosen = newest.select(*period, "r.*", "versions")
    old = look_up(facts, newest.select(*period, F.col("r.accn").alias("_current")), period, how="inner").where(F.col("accn") != F.col("_current")).drop("_current")
    named = chosen.join(F.broadcast(ranks), "concept")
    economic = ["ticker", "metric", "unit", "period_start", "period_end", "fiscal_period"]
    best = named.groupBy(*economic).agg(F.min_by(F.struct("concept", "value", "filed", "accn", "versions"), F.struct("tag_rank", "concept")).alias("r"))
    return best.select(*economic, "r.*"), old


def derived_facts(canonical: DataFrame) -> DataFrame:
    """Free cash flow and margins from canonical facts of one (ticker, unit, period)."""
    key = ["ticker", "unit", "period_start", "period_end", "fiscal_period"]

    def of(name: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.col("value")))

    w = canonical.groupBy(*key).agg(*[of(n).alias(n) for n in ("revenue", "gross_profit", "operating_income", "net_income", "operating_cash_flow", "capital_expenditure")])
    made = F.array(
        F.struct(F.lit("free_cash_flow").alias("metric"), (F.col("operating_cash_flow") - F.abs("capital_expenditure")).alias("value")),
        *[F.struct(F.lit(m).alias("metric"), (F.when(F.col("revenue") > 0, F.col(n) / F.col("revenue") * 100)).alias("value")) for m, n in (("gross_margin", "gross_profit"), ("operating_margin", "operating_income"), ("net_margin", "net_income"))],
    )
    return w.select(*key, F.explode(made).alias("d")).where(F.col("d.value").isNotNull()).select(*key, "d.metric", "d.value")


def period_in_tenure(period_start: Column, period_end: Column, start: Column, end: Column) -> Column:
    """PRE, POST, FULL or PARTIAL overlap of a period with a tenure whose NULL end is open."""
    return (
        F.when(start.isNull() | period_end.isNull(), "UNKNOWN").when(period_end < start, "PRE").when(end.isNotNull() & (period_start > end), "POST")
        .when((period_start >= start) & (end.isNull() | (period_end <= end)), "FULL").otherwise("PARTIAL")
    )


def operating_outcomes(facts: DataFrame, tenures: DataFrame) -> DataFrame:
    """First against last fully covered period per (tenure, metric, fiscal period type): absolute, percent, CAGR.

    Tenures are few per ticker; facts meet them on ticker with the tenure side attached.
    """
    joined = attach(facts, tenures.select("tenure_id", "ticker", F.col("start").alias("_s"), F.col("end").alias("_e")), ["ticker"], how="inner")
    inside = joined.where(period_in_tenure(F.col("period_start"), F.col("period_end"), F.col("_s"), F.col("_e")) == "FULL")
    kind = F.when(F.col("fiscal_period") == "FY", "FY").otherwise(F.col("fiscal_period"))
    g = inside.groupBy("tenure_id", "metric", kind.alias("fiscal_period")).agg(
        F.min_by("value", "period_end").alias("first_value"), F.max_by("value", "period_end").alias("last_value"), F.min("period_end").alias("first_period"), F.max("period_end").alias("last_period"), F.count("*").alias("periods"),
    ).where(F.col("last_period") > F.col("first_period"))
    years = F.datediff("last_period", "first_period") / 365.25
    a, b = F.col("first_value"), F.col("last_value")
    return g.withColumns({
        "absolute_change": b - a, "percent_change": safe_div((b - a) * 100, F.abs(a)),
        "cagr": F.when((a > 0) & (b > 0), F.pow(b / a, 1 / years) - 1),
    })
