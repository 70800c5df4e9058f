"""Filing facts: order lines as facts, customers and suppliers as companies."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.catalog.registry import query, table
from gaugework.operators import facts as fo
from gaugework.plans.settle import settle

C = F.col


@query("flattened_facts", "SELECT event_id, event_type AS concept, 'USD' AS unit, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS val, CAST(CAST(ts AS DATE) AS VARCHAR) AS filed FROM events UNION ALL SELECT event_id, event_type, 'shares', value, CAST(CAST(ts AS DATE) AS VARCHAR) FROM events")
def _(spark, folder):
    day = F.to_date("ts").cast("string")
    fact = lambda v: F.format_string('[{"end":"2024-01-31","val":%s,"form":"10-K","filed":"%s","fy":2024,"fp":"FY"}]', v.cast("string"), day)
    body = F.concat(F.lit('{"us-gaap":{"'), "event_type", F.lit('":{"units":{"USD":'), fact(F.get_json_object("props", "$.k")), F.lit(',"shares":'), fact(C("value")), F.lit("}}}}"))
    return fo.flatten_facts(table(spark, folder, "events").select("event_id", body.alias("facts")), "event_id").select("event_id", "concept", "unit", "val", C("filed").cast("string").alias("filed"))


@query("submission_index", "SELECT event_id, 'a' || event_id AS accn, strftime(date_trunc('second', ts) + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS accepted_at FROM events UNION ALL SELECT event_id, 'b' || event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') FROM events")
def _(spark, folder):
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    s = table(spark, folder, "events").select("event_id", F.array(F.concat(F.lit("a"), C("event_id").cast("string")), F.concat(F.lit("b"), C("event_id").cast("string"))).alias("accessions"), F.array(local, F.concat(local, F.lit("Z"))).alias("accepted"), F.array(F.lit("10-K"), F.lit("10-Q")).alias("forms"), F.array(F.lit("2023-12-31"), F.lit("2023-09-30")).alias("report_dates"))
    return fo.submission_index(s, "event_id").select("event_id", "accn", F.date_format("accepted_at", "yyyy-MM-dd HH:mm:ss").alias("accepted_at"))


LINES = """
lf AS (SELECT l_suppkey AS ticker, CASE l_returnflag WHEN 'A' THEN 'Revenues' WHEN 'R' THEN 'SalesNet' ELSE 'NetIncome' END AS concept, year(l_shipdate) AS y, CAST(l_shipdate AS DATE) + 400 AS filed, l_extendedprice AS val, CASE WHEN l_linenumber = 1 THEN 'Q4' ELSE 'FY' END AS fp, year(l_shipdate) + (l_linenumber > 5)::INT AS fy,
  lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || l_partkey || '-' || l_linenumber AS accn FROM lineitem),
cc(concept, metric, pr) AS (VALUES ('Revenues', 'revenue', 1), ('SalesNet', 'revenue', 0), ('NetIncome', 'net_income', 0))"""


def line_facts(spark, folder):
    flag = C("l_returnflag")
    y = F.year("l_shipdate")
    return table(spark, folder, "lineitem").select(
        C("l_suppkey").alias("ticker"), F.lit("us-gaap").alias("namespace"), F.when(flag == "A", "Revenues").when(flag == "R", "SalesNet").otherwise("NetIncome").alias("concept"), F.lit("USD").alias("unit"),
        F.make_date(y, F.lit(1), F.lit(1)).alias("start"), F.make_date(y, F.lit(12), F.lit(31)).alias("end"), C("l_extendedprice").alias("val"), F.lit("10-K").alias("form"),
        F.concat_ws("-", F.lpad(C("l_orderkey").cast("string"), 10, "0"), C("l_partkey").cast("string"), C("l_linenumber").cast("string")).alias("accn"), F.date_add(F.to_date("l_shipdate"), 400).alias("filed"),
        (y + (C("l_linenumber") > 5).cast("int")).alias("fy"), F.when(C("l_linenumber") == 1, "Q4").otherwise("FY").alias("fp"),
    )


def concepts(spark):
    return spark.createDataFrame([("revenue", "us-gaap", "Revenues", 1, True), ("revenue", "us-gaap", "SalesNet", 0, True), ("net_income", "us-gaap", "NetIncome", 0, True)], "metric string, namespace string, concept string, priority int, duration boolean")


ANNUAL = f"""{LINES}, af AS (SELECT ticker, metric, y, val, lf.concept, accn, row_number() OVER (PARTITION BY ticker, metric, y ORDER BY pr, fp <> 'FY', filed DESC, accn) AS k, first_value(fy) OVER (PARTITION BY ticker, metric, y ORDER BY filed, pr, accn) AS fy FROM lf JOIN cc USING (concept))"""


@query("annual_facts", f"WITH {ANNUAL} SELECT ticker, metric, CAST(make_date(y, 12, 31) AS VARCHAR) AS period_end, CAST(fy AS BIGINT) AS fy, val AS value, concept, accn FROM af WHERE k = 1")
def _(spark, folder):
    a = fo.annual_facts(line_facts(spark, folder), "ticker", concepts(spark))
    return a.select("ticker", "metric", C("end").cast("string").alias("period_end"), C("fy").cast("long").alias("fy"), "value", "concept", "accn")


@query("statement_currency", "WITH u AS (SELECT s_suppkey AS ticker, CASE WHEN l_returnflag = 'A' THEN 'EUR' ELSE 'USD' END AS unit, l_linenumber AS c FROM lineitem JOIN supplier ON s_suppkey = l_suppkey), n AS (SELECT ticker, unit, count(DISTINCT c) AS n FROM u GROUP BY 1, 2) SELECT ticker, arg_max(unit, n * 10 + (unit = 'USD')::INT) AS currency FROM n GROUP BY 1")
def _(spark, folder):
    f = table(spark, folder, "lineitem").select(C("l_suppkey").alias("ticker"), F.when(C("l_returnflag") == "A", "EUR").otherwise("USD").alias("unit"), C("l_linenumber").alias("concept"), F.lit("10-K").alias("form"), C("l_extendedprice").alias("val"))
    return fo.statement_currency(f, "ticker", spark.createDataFrame([("USD", 0), ("EUR", 1)], "unit string, preference int"))


@query("broad_concept_choice", """WITH p AS (SELECT l_suppkey AS ticker, year(l_shipdate) AS y, sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS n, sum(l_extendedprice) AS b FROM lineitem GROUP BY 1, 2), k AS (SELECT ticker, arg_max(n, y) AS n, arg_max(b, y) AS b FROM p WHERE n IS NOT NULL GROUP BY 1)
    SELECT ticker, round(n, 3) AS narrow, round(b, 3) AS broad, n > 0 AND b >= 3 * n AS prefer_broad FROM k""")
def _(spark, folder):
    y = F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(31))
    rows = table(spark, folder, "lineitem").groupBy(C("l_suppkey").alias("ticker"), y.alias("end")).agg(F.sum(F.when(C("l_returnflag") == "A", C("l_extendedprice"))).alias("n"), F.sum("l_extendedprice").alias("b")).withColumn("accn", F.concat(F.lit("x"), C("end").cast("string")))
    out = fo.broad_concepts(rows.where("n IS NOT NULL").select("ticker", "end", "accn", C("n").alias("value")), rows.select("ticker", "end", "accn", C("b").alias("value")), "ticker", 3.0)
    return out.select("ticker", F.round("narrow", 3).alias("narrow"), F.round("broad", 3).alias("broad"), "prefer_broad")


STATEMENTS = """
sv AS (SELECT l_suppkey AS ticker, year(l_shipdate) AS y, sum(l_extendedprice) AS revenue, sum(l_extendedprice * (l_discount - 0.04)) AS net_income, sum(l_extendedprice * l_tax) AS ocf, sum(l_quantity) * 100 AS capex, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS assets, sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS debt FROM lineitem GROUP BY 1, 2)"""


def statements(spark, folder):
    v, d, t = C("l_extendedprice"), C("l_discount"), C("l_tax")
    wide = table(spark, folder, "lineitem").groupBy(C("l_suppkey").alias("ticker"), F.year("l_shipdate").alias("fy")).agg(
        F.sum(v).alias("revenue"), F.sum(v * (d - 0.04)).alias("net_income"), F.sum(v * t).alias("ocf"), (F.sum("l_quantity") * 100).alias("capex"), F.sum(F.when(C("l_returnflag") == "R", v)).alias("assets"), F.sum(F.when(C("l_returnflag") == "A", v)).alias("debt")
    )
    metrics = ["revenue", "net_income", "ocf", "capex", "assets", "debt"]
    long = wide.unpivot(["ticker", "fy"], metrics, "metric", "value").where("value IS NOT NULL")
    return long.select("ticker", "metric", F.make_date(C("fy"), F.lit(12), F.lit(31)).alias("end"), "fy", "value", F.when(C("metric") == "assets", "EUR").otherwise("USD").alias("unit"), F.when(C("metric") == "debt", "LongTermDebt").otherwise(C("metric")).alias("concept"))


@query("annual_statements", f"""WITH {STATEMENTS} SELECT ticker, CAST(y AS BIGINT) AS fiscal_year, round(ocf - abs(capex), 3) AS free_cash_flow, round(net_income / revenue, 6) AS net_margin, NULL::DOUBLE AS roa, round(debt, 2) AS total_debt,
    CASE WHEN debt IS NOT NULL THEN 'REPORTED_LONG_TERM_ONLY' ELSE 'UNAVAILABLE_OR_DEFINITION_REVIEW_REQUIRED' END AS total_debt_definition, 'REVIEW_REQUIRED' AS reconciliation, CASE WHEN assets IS NOT NULL THEN 'MIXED_STATEMENT_CURRENCIES' ELSE '' END AS error FROM sv""")
def _(spark, folder):
    s = fo.annual_statements(statements(spark, folder), "ticker")
    return s.select("ticker", C("fiscal_year").cast("long").alias("fiscal_year"), F.round("free_cash_flow", 3).alias("free_cash_flow"), F.round("net_margin", 6).alias("net_margin"), "roa", F.round("total_debt", 2).alias("total_debt"), "total_debt_definition", "reconciliation", "error")


@query("statements_with_market", f"""WITH {STATEMENTS} SELECT ticker, CAST(y AS BIGINT) AS fiscal_year, round((ocf - abs(capex)) / (s_acctbal + 2000) / revenue * revenue, 6) AS fcf_per_price FROM sv JOIN supplier ON s_suppkey = ticker WHERE s_acctbal + 2000 <> 0""")
def _(spark, folder):
    s = fo.annual_statements(statements(spark, folder), "ticker")
    prices = s.select("ticker", "fiscal_period_end").join(table(spark, folder, "supplier").select(C("s_suppkey").alias("ticker"), (C("s_acctbal") + 2000).alias("price")), "ticker")
    m = fo.with_market(s.withColumn("shares", F.lit(1.0)), prices, "ticker")
    return m.where("price <> 0").select("ticker", C("fiscal_year").cast("long").alias("fiscal_year"), F.round("fcf_yield", 6).alias("fcf_per_price"))


TTM = """
ox AS (SELECT o_custkey AS ticker, sum(CASE WHEN year(o_orderdate) = 1999 THEN o_totalprice END) AS a, sum(CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2000-07-01' THEN o_totalprice END) AS n, sum(CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '1999-07-01' THEN o_totalprice END) AS p FROM orders GROUP BY 1)"""


def interim_facts(spark, folder):
    d = F.to_date("o_orderdate")
    day = lambda t: F.lit(t).cast("date")
    spans = [("10-K", "1999-01-01", "1999-12-31", "FY"), ("10-Q", "2000-01-01", "2000-06-30", "Q2"), ("10-Q", "1999-01-01", "1999-06-30", "Q2")]
    entries = F.array(*[F.struct(F.lit(f).alias("form"), day(a).alias("start"), day(b).alias("end"), F.lit(p).alias("fp")) for f, a, b, p in spans])
    rows = table(spark, folder, "orders").select(C("o_custkey").alias("ticker"), d.alias("d"), "o_totalprice", F.explode(entries).alias("e")).where((C("d") >= C("e.start")) & (C("d") <= C("e.end")))
    return rows.groupBy("ticker", "e.form", "e.start", "e.end", "e.fp").agg(F.sum("o_totalprice").alias("val")).select(
        "ticker", F.lit("revenue").alias("metric"), F.lit("Revenues").alias("concept"), F.lit("USD").alias("unit"), "start", "end", "val", "form", F.concat_ws("-", "form", C("end").cast("string")).alias("accn"), F.date_add("end", 40).alias("filed"),
        F.date_add("end", 40).cast("timestamp_ntz").alias("accepted_at"), F.lit(0).alias("priority"), "fp",
    )


@query("trailing_twelve_months", f"""WITH {TTM} SELECT ticker, CASE WHEN a IS NULL THEN 'ANNUAL_FACT_MISSING' WHEN n IS NULL THEN 'CURRENT_YTD_MISSING_OR_CONCEPT_CHANGED' WHEN p IS NULL THEN 'PRIOR_YTD_MISSING' ELSE 'ANNUAL_PLUS_YTD_MINUS_PRIOR_YTD' END AS method, round(a + n - p, 2) AS ttm FROM ox WHERE NOT (a IS NULL AND n IS NULL AND p IS NULL)""")
def _(spark, folder):
    f = settle(interim_facts(spark, folder))
    reports = f.select("ticker").distinct().select("ticker", F.lit("2000-10-01 00:00:00").cast("timestamp_ntz").alias("decision_at"), F.lit("2000-06-30").cast("date").alias("report_end"))
    return fo.trailing_twelve_months(f, reports, "ticker").select("ticker", "method", F.round("ttm", 2).alias("ttm"))


@query("current_evidence", f"""WITH {TTM}, q AS (SELECT ticker, a + n - p AS t, CASE WHEN a IS NULL THEN 'ANNUAL_FACT_MISSING' WHEN n IS NULL THEN 'CURRENT_YTD_MISSING_OR_CONCEPT_CHANGED' WHEN p IS NULL THEN 'PRIOR_YTD_MISSING' END AS m, c_acctbal AS b FROM ox JOIN customer ON c_custkey = ticker WHERE NOT (a IS NULL AND n IS NULL AND p IS NULL))
    SELECT ticker, array_to_string(list_filter(['TTM_REVENUE_' || m, CASE WHEN b < 0 THEN 'CURRENT_SHARE_COUNT_UNVERIFIED' END, CASE WHEN b / 500 < 5 THEN 'SHARE_PRICE_BELOW_FLOOR' END], lambda x: x IS NOT NULL), '; ') AS blockers FROM q""")
def _(spark, folder):
    f = settle(interim_facts(spark, folder))
    reports = f.select("ticker").distinct().select("ticker", F.lit("2000-10-01 00:00:00").cast("timestamp_ntz").alias("decision_at"), F.lit("2000-06-30").cast("date").alias("report_end"))
    b = table(spark, folder, "customer").select(C("c_custkey").alias("ticker"), C("c_acctbal").alias("b"))
    market = b.select("ticker", F.lit("2000-10-01").cast("date").alias("decision_date"), F.lit("2000-09-29").cast("date").alias("close_date"), (C("b") / 500).alias("close"), F.lit(6e6).alias("average_dollar_volume"), F.lit(20).alias("sessions"), F.lit("2000-06-30").cast("date").alias("report_end"), F.lit(True).alias("currency_match"))
    shares = b.where("b >= 0").select("ticker", F.lit(1e6).alias("shares"))
    return fo.current_evidence(fo.trailing_twelve_months(f, reports, "ticker"), market, shares, "ticker").select("ticker", "blockers")


CANON = """
cf AS (SELECT l_partkey AS ticker, CASE l_returnflag WHEN 'A' THEN 'Rev1' WHEN 'R' THEN 'Rev2' ELSE 'Ocf' END AS concept, year(l_shipdate) AS y, CAST(l_shipdate AS DATE) AS filed, lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || l_suppkey || l_linenumber AS accn, l_extendedprice AS v FROM lineitem),
nw AS (SELECT *, row_number() OVER (PARTITION BY ticker, concept, y ORDER BY filed DESC, accn DESC) AS k, count(*) OVER (PARTITION BY ticker, concept, y) AS n FROM cf),
cn AS (SELECT *, row_number() OVER (PARTITION BY ticker, y, concept = 'Ocf' ORDER BY concept) AS r FROM nw WHERE k = 1)"""


def part_facts(spark, folder):
    flag, y = C("l_returnflag"), F.year("l_shipdate")
    f = table(spark, folder, "lineitem").select(
        C("l_partkey").alias("ticker"), F.when(flag == "A", "Rev1").when(flag == "R", "Rev2").otherwise("Ocf").alias("concept"), F.lit("USD").alias("unit"), F.make_date(y, F.lit(1), F.lit(1)).alias("period_start"), F.make_date(y, F.lit(12), F.lit(31)).alias("period_end"), F.lit("FY").alias("fiscal_period"),
        C("l_extendedprice").alias("value"), F.to_date("l_shipdate").alias("filed"), F.concat(F.lpad(C("l_orderkey").cast("string"), 10, "0"), C("l_suppkey").cast("string"), C("l_linenumber").cast("string")).alias("accn"),
    )
    ranks = spark.createDataFrame([("Rev1", "revenue", 0), ("Rev2", "revenue", 1), ("Ocf", "net_income", 0)], "concept string, metric string, tag_rank int")
    return fo.canonical_facts(f, ranks)


@query("canonical_facts", f"WITH {CANON} SELECT ticker, CASE WHEN concept = 'Ocf' THEN 'net_income' ELSE 'revenue' END AS metric, CAST(y AS BIGINT) AS fiscal_year, concept, v AS value, n AS versions FROM cn WHERE r = 1")
def _(spark, folder):
    return part_facts(spark, folder)[0].select("ticker", "metric", F.year("period_end").cast("long").alias("fiscal_year"), "concept", "value", "versions")


@query("superseded_facts", f"WITH {CANON} SELECT ticker, concept, count(*) AS revisions, round(sum(v), 2) AS total FROM nw WHERE k > 1 GROUP BY 1, 2")
def _(spark, folder):
    return part_facts(spark, folder)[1].groupBy("ticker", "concept").agg(F.count("*").alias("revisions"), F.round(F.sum("value"), 2).alias("total"))


@query("derived_facts", f"WITH {CANON}, w AS (SELECT ticker, y, max(CASE WHEN concept <> 'Ocf' THEN v END) AS r, max(CASE WHEN concept = 'Ocf' THEN v END) AS i FROM cn WHERE r = 1 GROUP BY 1, 2) SELECT ticker, CAST(y AS BIGINT) AS fiscal_year, 'net_margin' AS metric, round(i / r * 100, 4) AS value FROM w WHERE r > 0 AND i IS NOT NULL")
def _(spark, folder):
    return fo.derived_facts(part_facts(spark, folder)[0]).select("ticker", F.year("period_end").cast("long").alias("fiscal_year"), "metric", F.round("value", 4).alias("value"))


@query("operating_outcomes", f"""WITH {CANON}, c AS (SELECT ticker, y, concept, v FROM cn WHERE r = 1 AND concept <> 'Ocf' AND y >= 1997), g AS (SELECT ticker, arg_min(v, y) AS a, arg_max(v, y) AS b, min(y) AS y0, max(y) AS y1, count(*) AS n FROM c GROUP BY 1)
    SELECT ticker, n AS periods, round(b - a, 3) AS absolute_change, round((b - a) / abs(a) * 100, 4) AS percent_change FROM g WHERE y1 > y0""")
def _(spark, folder):
    facts = part_facts(spark, folder)[0].where("metric = 'revenue'")
    tenures = table(spark, folder, "part").select(C("p_partkey").alias("ticker"), C("p_partkey").alias("tenure_id"), F.lit("1996-03-01").cast("date").alias("start"), F.lit(None).cast("date").alias("end"))
    return fo.operating_outcomes(facts, tenures).select(C("tenure_id").alias("ticker"), "periods", F.round("absolute_change", 3).alias("absolute_change"), F.round("percent_change", 4).alias("percent_change"))


@query("period_in_tenure", """SELECT o_orderkey AS orderkey, CASE WHEN year(o_orderdate) < 1997 THEN 'PRE' WHEN year(o_orderdate) > 1999 THEN 'POST' WHEN year(o_orderdate) IN (1997, 1999) THEN 'PARTIAL' ELSE 'FULL' END AS overlap FROM orders""")
def _(spark, folder):
    y = F.year("o_orderdate")
    day = lambda t: F.lit(t).cast("date")
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), fo.period_in_tenure(F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.lit(12), F.lit(31)), day("1997-07-01"), day("1999-06-30")).alias("overlap"))
