"""Parsing, comparison, report audits, keyed stores and incremental loads over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.catalog.registry import query, table
from gaugework.functions import dates as dt
from gaugework.functions import numbers as nb
from gaugework.operators import quality as ql
from gaugework.plans.settle import scratch_folder
from gaugework.sources import tables as st
from gaugework.streaming import incremental as inc


def text_dates(spark, folder):
    """Order dates written in the layout their priority dictates."""
    d, p = F.to_date("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(p == "1-URGENT", d.cast("string")).when(p == "2-HIGH", F.date_format(d, "dd/MM/yyyy")).when(p == "3-MEDIUM", F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string"))
        .when(p == "5-LOW", F.concat(d.cast("string"), F.lit("T00:00:00"))).otherwise(F.concat(d.cast("string"), F.lit("T10:30:00")))
    )
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"), text.alias("text"), d.alias("day"), p.alias("priority"))


@query("strict_date_parsing", "SELECT o_orderkey AS orderkey, CASE WHEN o_orderpriority NOT LIKE '4%' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed, o_orderpriority LIKE '4%' AS malformed FROM orders")
def _(spark, folder):
    t = text_dates(spark, folder)
    return t.select("orderkey", dt.strict_date(F.col("text")).cast("string").alias("parsed"), dt.date_error(F.col("text")).alias("malformed"))


@query("report_date_parsing", "SELECT o_orderkey AS orderkey, CASE WHEN o_orderpriority NOT LIKE '4%' AND NOT (o_orderpriority LIKE '1%' AND year(o_orderdate) < 2000) AND NOT (o_orderpriority LIKE '3%' AND CAST(o_orderdate AS DATE) < DATE '2006-01-01') THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed FROM orders")
def _(spark, folder):
    t = text_dates(spark, folder)
    d, p = F.col("day"), F.col("priority")
    text = (
        F.when(p.startswith("1") & (F.year("day") >= 2000), F.date_format(d, "yyMMdd")).when(p.startswith("1"), "not a date").when(p.startswith("2"), F.date_format(d, "MM/dd/yyyy"))
        .when(p.startswith("3"), F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string")).when(p.startswith("5"), F.date_format(d, "yyyyMMdd")).otherwise("20-xx-01")
    )
    return t.select("orderkey", dt.report_date(text).cast("string").alias("parsed"))


@query("observation_months", "SELECT o_orderkey AS orderkey, CASE WHEN o_orderpriority LIKE '4%' THEN NULL ELSE CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) END AS month FROM orders")
def _(spark, folder):
    d, p = F.col("day"), F.col("priority")
    text = F.when(p.startswith("1"), F.date_format(d, "yyyy-MM")).when(p.startswith("4"), "n/a").when(p.startswith("5"), d.cast("string")).otherwise(F.col("text"))
    return text_dates(spark, folder).select("orderkey", dt.observation_month(text).cast("string").alias("month"))


@query(
    "number_parsing",
    """SELECT p_partkey AS partkey, CASE WHEN p_type IN ('PROMO', 'LARGE') OR (p_type NOT IN ('ECONOMY', 'SMALL') AND round(p_retailprice, 4) < 1000) THEN round(p_retailprice, 2) END AS strict, CASE WHEN p_type <> 'ECONOMY' THEN round(p_retailprice, 2) END AS lenient,
    CAST(round(CAST(p_retailprice / 7 AS DECIMAL(38,12)), 5) AS DOUBLE) AS five FROM part""",
)
def _(spark, folder):
    v, t = F.col("p_retailprice"), F.col("p_type")
    text = F.when(t.isin("PROMO", "LARGE"), v.cast("string")).when(t == "ECONOMY", "N/A").when(t == "SMALL", F.concat(v.cast("string"), F.lit("%"))).otherwise(F.format_number(v, 4))
    p = table(spark, folder, "part").withColumn("text", text)
    return p.select(F.col("p_partkey").alias("partkey"), F.round(nb.strict_number(F.col("text")), 2).alias("strict"), F.round(nb.lenient_number(F.col("text")), 2).alias("lenient"), nb.quantise5(v / 7).cast("double").alias("five"))


@query(
    "tolerant_equality",
    """SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey, l_suppkey AS suppkey, l_tax = 0 OR l_discount = 0 AS within, l_tax <> 0 AND false OR l_tax = 0 AS close FROM lineitem""",
)
def _(spark, folder):
    # Discount 0 adds a gap inside the loose tolerance only, tax 0 adds none.
    other = F.when(F.col("l_tax") == 0, F.col("l_extendedprice")).when(F.col("l_discount") == 0, F.col("l_extendedprice") + 5e-5).otherwise(F.col("l_extendedprice") + 1)
    out = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"),
        nb.equal_within(F.col("l_extendedprice"), other).alias("within"), nb.close_to(F.col("l_extendedprice"), other, 1e-12, 1e-10).alias("close"),
    )
    return out


@query(
    "calendar_arithmetic",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT CAST(d AS VARCHAR) AS day, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start, CAST(last_day(d) AS VARCHAR) AS month_end, CAST(CAST(d + INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS shifted,
      CAST(CAST(d - INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS last_year,
      CAST(CAST(date_trunc('month', d) AS DATE) + CAST((5 - isodow(CAST(date_trunc('month', d) AS DATE)) + 7) % 7 + 7 AS INTEGER) AS VARCHAR) AS second_friday,
      CAST(last_day(d) - CAST((isodow(last_day(d)) - 3 + 7) % 7 AS INTEGER) AS VARCHAR) AS last_wednesday,
      CAST(CAST(date_trunc('month', d) - INTERVAL 2 MONTH AS DATE) AS VARCHAR) AS first_recent FROM d""",
)
def _(spark, folder):
    d = F.col("d")
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    named = {"day": d, "month_start": dt.month_start(d), "month_end": dt.month_end(d), "shifted": dt.shift_months(d, 3), "last_year": dt.same_day_last_year(d), "second_friday": dt.nth_weekday(d, "Fri", 2), "last_wednesday": dt.last_weekday(d, "Wed"), "first_recent": dt.recent_months(d, 3)[0]}
    return days.select(*[c.cast("string").alias(n) for n, c in named.items()])


@query(
    "wide_series_grid",
    """WITH w AS (SELECT CAST(o_orderdate AS DATE) AS d, round(max(CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice END), 2) AS a, round(max(CASE WHEN o_orderpriority LIKE '2%' THEN o_totalprice END), 2) AS b FROM orders GROUP BY 1)
    SELECT 'a' AS series, CAST(d AS VARCHAR) AS obs_date, a AS value FROM w UNION ALL SELECT 'b', CAST(d AS VARCHAR), CASE WHEN b < 400000 THEN b END FROM w""",
)
def _(spark, folder):
    series, _ = st.load_wide_series(*wide_grid(spark, folder))
    return series.select("series", F.col("obs_date").cast("string").alias("obs_date"), "value")


def wide_grid(spark, folder):
    o = table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.round(F.max(F.when(F.col("o_orderpriority").startswith("1"), F.col("o_totalprice"))), 2).alias("a"), F.round(F.max(F.when(F.col("o_orderpriority").startswith("2"), F.col("o_totalprice"))), 2).alias("b")
    )
    # Large second-column values are written as text that is not a number; the third column repeats a header.
    cells = o.select(F.date_format("d", "dd/MM/yyyy").alias("c0"), F.col("a").cast("decimal(20,2)").cast("string").alias("c1"), F.when(F.col("b") >= 400000, F.concat(F.lit("$"), F.col("b").cast("decimal(20,2)").cast("string"))).otherwise(F.col("b").cast("decimal(20,2)").cast("string")).alias("c2"), F.lit("1").alias("c3"), F.lit("2").alias("c4"))
    return cells, ["Date", "a", "b", "twin", "twin"]


@query(
    "wide_series_issues",
    """WITH w AS (SELECT CAST(o_orderdate AS DATE) AS d, round(max(CASE WHEN o_orderpriority LIKE '2%' THEN o_totalprice END), 2) AS b FROM orders GROUP BY 1)
    SELECT 'warning' AS severity, 'nonnumeric cell ' || CAST(d AS VARCHAR) || ' b $' || CAST(CAST(b AS DECIMAL(20,2)) AS VARCHAR) AS message FROM w WHERE b >= 400000 UNION ALL SELECT 'warning', 'duplicate or blank header ''twin'''""",
)
def _(spark, folder):
    return st.load_wide_series(*wide_grid(spark, folder))[1]


@query(
    "json_line_parsing",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'error' AND event_type <> 'view'""",
)
def _(spark, folder):
    e = table(spark, folder, "events")
    body = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(","), F.substring(F.col("props"), 2, 1000000))
    lines = e.select(F.when(F.col("event_type") == "error", F.concat(body, F.lit("}}broken"))).when(F.col("event_type") == "view", F.lit("[1, 2]")).otherwise(body).alias("value"))
    return st.parse_json_lines(lines, "event_id long, k long")


@query("report_column_resolution", "SELECT o_orderpriority AS market, CAST(o_custkey AS VARCHAR) AS code, count(*) AS rows FROM orders GROUP BY 1, 2")
def _(spark, folder):
    raw = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("Market And Exchange_Names"), F.col("o_custkey").cast("string").alias("CONTRACT-Code "), F.col("o_orderdate").alias("Report Date"))
    found = st.resolve_columns(raw, {"market": ["Market_and_Exchange_Names"], "code": ["Contract Market Code", "contract_code"]})
    return found.groupBy("market", "code").agg(F.count("*").alias("rows"))


REPORTS = """
rp AS (SELECT o_orderkey AS source_row, CASE WHEN o_orderpriority LIKE '4%' THEN '' ELSE o_orderpriority END AS market, CASE WHEN o_custkey < 20 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS code,
  CASE WHEN o_totalprice >= 5000 THEN CAST(o_orderdate AS DATE) END AS rd FROM orders),
w AS (SELECT *, CASE WHEN rd <= DATE '2001-06-01' THEN rd END AS d, rd IS NULL AS inv, coalesce(rd > DATE '2001-06-01', false) AS fut, CASE WHEN code <> '' THEN 'code:' || code ELSE 'name:' || market END AS key FROM rp),
sd AS (SELECT d, row_number() OVER (ORDER BY d) AS i FROM (SELECT DISTINCT d FROM w WHERE d IS NOT NULL)), tot AS (SELECT max(i) AS n, max(d) AS ld, min(d) AS fd FROM sd),
pd AS (SELECT key, d, count(*) AS n FROM w WHERE d IS NOT NULL GROUP BY 1, 2), pl AS (SELECT *, lag(d) OVER (PARTITION BY key ORDER BY d) AS pv FROM pd),
k AS (SELECT key, min(d) AS a, max(d) AS b, count(*) AS u, sum(n - 1) AS dup, count(CASE WHEN d - pv > 10 THEN 1 END) AS gaps, string_agg(CASE WHEN n > 1 THEN CAST(d AS VARCHAR) || ' (' || n || ' rows)' END, ' | ' ORDER BY d) AS dups,
  string_agg(CASE WHEN d - pv > 10 THEN CAST(pv AS VARCHAR) || ' -> ' || CAST(d AS VARCHAR) || ' (' || (d - pv) || ' days)' END, ' | ' ORDER BY d) AS gapt FROM pl GROUP BY 1),
b AS (SELECT key, count(*) AS rows, count(d) AS valid, count(CASE WHEN inv THEN 1 END) AS inv, count(CASE WHEN fut THEN 1 END) AS fut, bool_or(market = '') AS nn, bool_or(code = '') AS nc,
  arg_max(market, strftime(coalesce(d, DATE '0001-01-01'), '%Y%m%d') || lpad(CAST(source_row AS VARCHAR), 12, '0')) FILTER (market <> '') AS asset FROM w GROUP BY 1),
j AS (SELECT b.*, k.*, tot.*, s1.i - s0.i + 1 AS ex, tot.n - s1.i AS behind, tot.ld - k.b AS lag FROM b LEFT JOIN k ON b.key = k.key LEFT JOIN sd s0 ON s0.d = k.a LEFT JOIN sd s1 ON s1.d = k.b CROSS JOIN tot),
f AS (SELECT *, CASE WHEN b IS NULL THEN 'NO_VALID_DATES' WHEN lag > 0 THEN 'ASSET_LAGGING' WHEN DATE '2001-06-01' - ld > 10 THEN 'SOURCE_DELAYED' ELSE 'CURRENT' END AS fr,
  CASE WHEN b IS NULL THEN 'UNKNOWN_NO_VALID_DATES' WHEN behind = 0 THEN 'REPORTED_IN_LATEST_SOURCE' WHEN behind < 3 THEN 'RECENTLY_NOT_REPORTED' ELSE 'POSSIBLY_INACTIVE_OR_DISCONTINUED' END AS rs FROM j),
g AS (SELECT *, array_to_string(list_filter([CASE WHEN ex > u THEN 'MISSING_SOURCE_DATES' END, CASE WHEN gaps > 0 THEN 'LONG_CALENDAR_GAPS' END, CASE WHEN dup > 0 THEN 'DUPLICATE_DATES' END, CASE WHEN inv > 0 THEN 'INVALID_DATES' END,
  CASE WHEN fut > 0 THEN 'FUTURE_DATES' END, CASE WHEN nn THEN 'MISSING_ASSET_NAME' END, CASE WHEN nc THEN 'MISSING_CONTRACT_CODE' END], lambda x: x IS NOT NULL), ' | ') AS flags FROM f)"""


def report_rows(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("source_row"), F.when(F.col("o_orderpriority").startswith("4"), "").otherwise(F.col("o_orderpriority")).alias("market"),
        F.when(F.col("o_custkey") < 20, "").otherwise(F.col("o_custkey").cast("string")).alias("code"), F.when(F.col("o_totalprice") >= 5000, F.to_date("o_orderdate")).alias("report_date"),
    )


@query(
    "report_date_audit",
    f"""WITH {REPORTS} SELECT b.key, coalesce(asset, '(missing market name)') AS asset, rows, valid AS valid_rows, inv AS invalid_rows, fut AS future_rows, CAST(a AS VARCHAR) AS earliest, CAST(g.b AS VARCHAR) AS latest,
    CAST(lag AS DOUBLE) AS lag_days, CAST(behind AS DOUBLE) AS reports_behind, CAST(ex AS DOUBLE) AS expected_dates, round(100.0 * u / ex, 2) AS coverage_pct, CAST(ex - u AS DOUBLE) AS missing_count, coalesce(gaps, 0) AS gap_count, coalesce(gapt, '') AS gaps,
    CAST(coalesce(dup, 0) AS BIGINT) AS duplicate_rows, coalesce(dups, '') AS duplicate_dates, fr AS freshness, rs AS reporting_status, flags,
    array_to_string(list_filter([fr, CASE WHEN rs NOT IN ('REPORTED_IN_LATEST_SOURCE', 'UNKNOWN_NO_VALID_DATES') THEN rs END, nullif(flags, '')], lambda x: x IS NOT NULL), ' | ') AS status,
    CASE WHEN inv > 0 OR fut > 0 OR dup > 0 THEN 0 WHEN (ex > u OR gaps > 0) AND rs <> 'POSSIBLY_INACTIVE_OR_DISCONTINUED' THEN 1 WHEN rs = 'RECENTLY_NOT_REPORTED' THEN 2 WHEN rs = 'POSSIBLY_INACTIVE_OR_DISCONTINUED' THEN 4 ELSE 5 END AS priority FROM g JOIN (SELECT key FROM b) b ON b.key = g.key""".replace("SELECT b.key", "SELECT g.key").replace("FROM g JOIN (SELECT key FROM b) b ON b.key = g.key", "FROM g"),
)
def _(spark, folder):
    a = ql.report_audit(report_rows(spark, folder), F.lit("2001-06-01").cast("date"))
    return a.select(
        "key", "asset", "rows", "valid_rows", "invalid_rows", "future_rows", F.col("earliest").cast("string").alias("earliest"), F.col("latest").cast("string").alias("latest"),
        *[F.col(c).cast("double").alias(c) for c in ("lag_days", "reports_behind", "expected_dates", "coverage_pct", "missing_count")], "gap_count", "gaps", "duplicate_rows", "duplicate_dates", "freshness", "reporting_status", "flags", "status", "priority",
    )


@query(
    "report_audit_summary",
    f"""WITH {REPORTS} SELECT count(*) AS assets, CAST(sum(rows) AS BIGINT) AS rows, count(CASE WHEN fr = 'CURRENT' THEN 1 END) AS current, count(CASE WHEN fr = 'ASSET_LAGGING' THEN 1 END) AS lagging, count(CASE WHEN fr = 'NO_VALID_DATES' THEN 1 END) AS no_valid_dates,
    count(CASE WHEN rs = 'POSSIBLY_INACTIVE_OR_DISCONTINUED' THEN 1 END) AS possibly_inactive, count(CASE WHEN flags <> '' THEN 1 END) AS with_flags, count(CASE WHEN gaps > 0 THEN 1 END) AS with_gaps, count(CASE WHEN dup > 0 THEN 1 END) AS with_duplicates,
    CAST(sum(inv) AS BIGINT) AS invalid_rows, CAST(sum(fut) AS BIGINT) AS future_rows FROM g""",
)
def _(spark, folder):
    s = ql.report_audit_summary(ql.report_audit(report_rows(spark, folder), F.lit("2001-06-01").cast("date")))
    return s.select("assets", "rows", "current", "lagging", "no_valid_dates", "possibly_inactive", "with_flags", "with_gaps", "with_duplicates", "invalid_rows", "future_rows")


@query(
    "long_report_gaps",
    """WITH d AS (SELECT DISTINCT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS d FROM orders), g AS (SELECT *, lag(d) OVER (PARTITION BY custkey ORDER BY d) AS p FROM d)
    SELECT custkey, CAST(p AS VARCHAR) AS previous_date, CAST(d AS VARCHAR) AS report_date, d - p AS gap_days FROM g WHERE d - p > 10""",
)
def _(spark, folder):
    d = table(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("report_date"))
    g = ql.long_gaps(d, ["custkey"], "report_date")
    return g.select("custkey", F.col("previous_date").cast("string").alias("previous_date"), F.col("report_date").cast("string").alias("report_date"), F.col("gap_days").cast("long").alias("gap_days"))


# --- comparison -------------------------------------------------------------------------------------


def two_editions(spark, folder):
    c = table(spark, folder, "customer")
    old = c.where(F.col("c_mktsegment") != "BUILDING").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    new = c.where(F.col("c_mktsegment") != "FURNITURE").select(F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") < 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal") + 1e-12).alias("balance"), F.when(F.col("c_acctbal") < 9000, F.col("c_mktsegment")).alias("segment"))
    return old, new


CHANGES = """
o AS (SELECT c_custkey AS k, c_acctbal AS b, c_mktsegment AS s FROM customer WHERE c_mktsegment <> 'BUILDING'),
n AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN c_acctbal + 1 ELSE c_acctbal END AS b, CASE WHEN c_acctbal < 9000 THEN c_mktsegment END AS s FROM customer WHERE c_mktsegment <> 'FURNITURE'),
ch AS (SELECT k, "column", CASE WHEN bo IS NULL THEN 'added' WHEN af IS NULL THEN 'removed' ELSE 'updated' END AS change FROM (
  SELECT coalesce(o.k, n.k) AS k, 'balance' AS "column", CAST(o.b AS VARCHAR) AS bo, CAST(n.b AS VARCHAR) AS af FROM o FULL JOIN n ON o.k = n.k UNION ALL SELECT coalesce(o.k, n.k), 'segment', o.s, n.s FROM o FULL JOIN n ON o.k = n.k)
  WHERE bo IS DISTINCT FROM af)"""


@query("table_cell_changes", f"""WITH {CHANGES} SELECT k, "column", change FROM ch""")
def _(spark, folder):
    old, new = two_editions(spark, folder)
    return ql.compare_cells(old, new, ["k"], ["balance", "segment"]).select("k", "column", "change")


@query("change_journal", f"""WITH {CHANGES} SELECT 'customers' AS output, count(CASE WHEN change = 'added' THEN 1 END) AS added, count(CASE WHEN change = 'updated' THEN 1 END) AS updated, count(CASE WHEN change = 'removed' THEN 1 END) AS removed FROM ch""")
def _(spark, folder):
    old, new = two_editions(spark, folder)
    return inc.journal("customers", old, new, ["k"], ["balance", "segment"])


UPSERT = """
s AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer WHERE c_acctbal < 5000),
i AS (SELECT CASE WHEN c_nationkey = 3 THEN c_custkey + 10000000 ELSE c_custkey END AS id, c_name AS name, c_acctbal + CASE WHEN c_nationkey = 5 THEN 1 ELSE 0 END AS balance, c_mktsegment AS segment FROM customer WHERE c_acctbal > 1000)"""


def upsert_inputs(spark, folder):
    c = table(spark, folder, "customer")
    cols = [F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")]
    stored = c.where(F.col("c_acctbal") < 5000).select(F.col("c_custkey").alias("id"), *cols, F.col("c_acctbal").alias("balance"), F.lit("old").alias("created_at"))
    incoming = c.where(F.col("c_acctbal") > 1000).select(
        F.when(F.col("c_nationkey") == 3, F.col("c_custkey") + 10000000).otherwise(F.col("c_custkey")).alias("id"), *cols, (F.col("c_acctbal") + F.when(F.col("c_nationkey") == 5, 1).otherwise(0)).alias("balance"), F.lit("new").alias("created_at")
    )
    return stored, incoming


@query(
    "keyed_upsert_counts",
    f"""WITH {UPSERT}, rep AS (SELECT s.id AS gone, i.id AS taker FROM s JOIN i ON s.name = i.name AND s.segment = i.segment AND s.id <> i.id),
    b AS (SELECT coalesce(s.id, i.id) AS id, s.id AS o, i.id AS n, s.balance AS ob, i.balance AS nb FROM (SELECT * FROM s WHERE id NOT IN (SELECT gone FROM rep)) s FULL JOIN i ON s.id = i.id)
    SELECT CASE WHEN n IS NULL THEN 'kept' WHEN o IS NULL THEN CASE WHEN id IN (SELECT taker FROM rep) THEN 'updated' ELSE 'added' END WHEN ob = nb THEN 'unchanged' ELSE 'updated' END AS action, count(*) AS rows FROM b GROUP BY 1""",
)
def _(spark, folder):
    return st.action_counts(st.upsert(*upsert_inputs(spark, folder), "id", ["name", "segment"]))


@query("keyed_upsert_rows", f"""WITH {UPSERT}, rep AS (SELECT s.id FROM s JOIN i ON s.name = i.name AND s.id <> i.id)
    SELECT id, balance FROM i UNION ALL SELECT id, balance FROM s WHERE id NOT IN (SELECT id FROM rep) AND id NOT IN (SELECT id FROM i)""")
def _(spark, folder):
    return st.upsert(*upsert_inputs(spark, folder), "id", ["name", "segment"]).select("id", "balance")


@query("scope_replacement", """SELECT segment, count(*) AS rows, round(sum(b), 2) AS balance FROM (SELECT c_mktsegment AS segment, c_acctbal AS b FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE')
    UNION ALL SELECT c_mktsegment, 1.0 FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') AND c_acctbal > 0) GROUP BY 1""")
def _(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("b"))
    fresh = c.where(F.col("segment").isin("BUILDING", "FURNITURE") & (F.col("b") > 0)).withColumn("b", F.lit(1.0))
    return st.replace_scope(c, fresh, ["segment"]).groupBy("segment").agg(F.count("*").alias("rows"), F.round(F.sum("b"), 2).alias("balance"))


@query("document_index", """SELECT 'by_id' AS index_name, CAST(doc_id AS VARCHAR) AS key, doc_id AS document_id FROM documents UNION ALL SELECT 'by_ticker', source, doc_id FROM documents UNION ALL SELECT 'by_type', lang, doc_id FROM documents
    UNION ALL SELECT 'by_period', CASE WHEN n_chars > 1000 THEN 'long' ELSE 'unknown' END, doc_id FROM documents""")
def _(spark, folder):
    d = table(spark, folder, "documents").select(F.col("doc_id").alias("document_id"), F.col("source").alias("ticker"), F.col("lang").alias("document_type"), F.when(F.col("n_chars") > 1000, "long").alias("period_label"))
    return st.document_index(d)


@query(
    "content_snapshot_revisions",
    """WITH r AS (SELECT event_type AS source, CAST(CAST(ts AS DATE) AS VARCHAR) AS period, event_id, CAST(user_id AS VARCHAR) AS u, json_extract_string(props, '$.k') AS k FROM events),
    p AS (SELECT *, lag(u) OVER w AS pu, lag(k) OVER w AS pk, lag(event_id) OVER w AS pe FROM r WINDOW w AS (PARTITION BY source, period ORDER BY event_id))
    SELECT event_id, sha256(u || '|' || k) AS sha256, sha256('k' || chr(10) || 'user') AS schema_fingerprint,
      CASE WHEN pe IS NULL OR (u = pu AND k = pk) THEN '' ELSE 'Changed fields: ' || array_to_string(list_filter([CASE WHEN k <> pk THEN 'k' END, CASE WHEN u <> pu THEN 'user' END], lambda x: x IS NOT NULL), ', ') END AS revision FROM p""",
)
def _(spark, folder):
    k, u = F.get_json_object("props", "$.k"), F.col("user_id").cast("string")
    r = table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("source"), F.to_date("ts").cast("string").alias("period"), F.col("event_id").alias("retrieved_at"), F.concat_ws("|", u, k).alias("content"),
        F.array(F.lit("user"), F.lit("k")).alias("schema"), F.create_map(F.lit("user"), u, F.lit("k"), k).alias("parsed"),
    )
    return st.content_snapshots(r).select("event_id", "sha256", "schema_fingerprint", "revision")


@query("last_record_per_identifier", """WITH x AS (SELECT o_orderkey AS n, CASE WHEN o_orderpriority LIKE '1%' THEN 'c' || o_custkey END AS claim_id, CASE WHEN o_orderpriority NOT LIKE '5%' THEN 'd' || (o_custkey % 50) END AS document_id FROM orders),
    k AS (SELECT *, coalesce(claim_id, document_id) AS key FROM x) SELECT max(n) AS n, key FROM k WHERE key IS NOT NULL GROUP BY key UNION ALL SELECT n, NULL FROM k WHERE key IS NULL""")
def _(spark, folder):
    o = table(spark, folder, "orders")
    x = o.select(F.col("o_orderkey").alias("n"), F.when(F.col("o_orderpriority").startswith("1"), F.concat(F.lit("c"), "o_custkey")).alias("claim_id"), F.when(~F.col("o_orderpriority").startswith("5"), F.concat(F.lit("d"), (F.col("o_custkey") % 50).cast("string"))).otherwise("").alias("document_id"))
    return st.dedupe_by_id(x, ["n"]).select("n", F.coalesce("claim_id", F.nullif("document_id", F.lit(""))).alias("key"))


@query("audit_output_proof", "SELECT c_mktsegment AS industry, count(*) AS source_rows, count(*) AS read_rows, true AS same_content FROM customer GROUP BY 1")
def _(spark, folder):
    c = table(spark, folder, "customer")
    scored = c.select(F.col("c_custkey").alias("ticker"), F.col("c_mktsegment").alias("industry"), F.col("c_acctbal").alias("net_score"), (-F.col("c_acctbal")).alias("long_score"), F.array("c_name", F.col("c_nationkey").cast("string")).alias("drivers"))
    home = scratch_folder(spark, "audit")
    st.write_audit(scored, scored.where("net_score < 0"), scored.select("industry").distinct(), home)
    return st.audit_proof(scored, home)


# --- incremental ------------------------------------------------------------------------------------

MERGE = """
d AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS ds, event_type AS series, CAST(ts AS DATE) AS d, round(avg(value), 6) AS v FROM events GROUP BY 1, 2, 3),
st AS (SELECT ds, series, d, CASE WHEN NOT (series = 'signup' AND day(d) > 10) THEN v END AS v FROM d WHERE d < CASE ds WHEN 'even' THEN DATE '2024-01-20' ELSE DATE '2024-01-12' END AND dayofweek(d) <> 0),
ic AS (SELECT ds, series, d, v + 1 AS v FROM d),
pl AS (SELECT coalesce(st.ds, ic.ds) AS dataset, coalesce(st.series, ic.series) AS series, coalesce(st.d, ic.d) AS obs_date, coalesce(st.v, ic.v) AS value, CASE WHEN EXISTS (SELECT 1 FROM st x WHERE x.ds = coalesce(st.ds, ic.ds) AND x.d = coalesce(st.d, ic.d)) THEN CASE WHEN st.v IS NULL AND ic.v IS NOT NULL THEN 'filled' ELSE 'kept' END
  WHEN coalesce(st.d, ic.d) > (SELECT max(d) FROM st x WHERE x.ds = coalesce(st.ds, ic.ds)) THEN 'appended' ELSE 'late' END AS action FROM st FULL JOIN ic ON st.ds = ic.ds AND st.series = ic.series AND st.d = ic.d)"""


def merge_inputs(spark, folder):
    d = table(spark, folder, "events").groupBy(F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd").alias("dataset"), F.col("event_type").alias("series"), F.to_date("ts").alias("obs_date")).agg(F.round(F.avg("value"), 6).alias("value"))
    end = F.when(F.col("dataset") == "even", F.lit("2024-01-20").cast("date")).otherwise(F.lit("2024-01-12").cast("date"))
    stored = d.where((F.col("obs_date") < end) & (F.dayofweek("obs_date") != 1)).withColumn("value", F.when(~((F.col("series") == "signup") & (F.dayofmonth("obs_date") > 10)), F.col("value")))
    return stored, d.withColumn("value", F.col("value") + 1)


@query("fill_and_append_plan", f"WITH {MERGE} SELECT dataset, series, CAST(obs_date AS VARCHAR) AS obs_date, round(value, 6) AS value, action FROM pl")
def _(spark, folder):
    return inc.plan_merge(*merge_inputs(spark, folder)).select("dataset", "series", F.col("obs_date").cast("string").alias("obs_date"), F.round("value", 6).alias("value"), "action")


@query("late_history_dates", f"WITH {MERGE} SELECT DISTINCT dataset, CAST(obs_date AS VARCHAR) AS obs_date FROM pl WHERE action = 'late'")
def _(spark, folder):
    return inc.late_dates(inc.plan_merge(*merge_inputs(spark, folder))).select("dataset", F.col("obs_date").cast("string").alias("obs_date"))


@query("history_protection", f"WITH {MERGE} SELECT st.ds AS dataset, st.series, CAST(st.d AS VARCHAR) AS obs_date, round(st.v, 6) AS existing, round(ic.v, 6) AS replacement FROM st JOIN ic ON st.ds = ic.ds AND st.series = ic.series AND st.d = ic.d WHERE st.v IS NOT NULL AND st.series <> 'click'")
def _(spark, folder):
    stored, incoming = merge_inputs(spark, folder)
    same = incoming.withColumn("value", F.when(F.col("series") == "click", F.col("value") - 1).otherwise(F.col("value")))
    v = inc.history_violations(stored, same)
    return v.select("dataset", "series", F.col("obs_date").cast("string").alias("obs_date"), F.round("existing", 6).alias("existing"), F.round("replacement", 6).alias("replacement"))


@query("shared_component_table", f"WITH {MERGE} SELECT dataset, series, action, count(*) AS cells FROM pl WHERE action <> 'late' GROUP BY 1, 2, 3")
def _(spark, folder):
    stored, incoming = merge_inputs(spark, folder)
    parts = [incoming.where(F.col("series").isin("click", "view")), incoming.where(~F.col("series").isin("click", "view"))]
    return inc.merge_components(stored, parts).groupBy("dataset", "series", "action").agg(F.count("*").alias("cells"))


def event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parque*").withColumn("ts", F.col("ts").cast("timestamp"))


@query("streamed_fill_and_append", """SELECT event_type AS series, CAST(CAST(ts AS DATE) AS VARCHAR) AS obs_date, max(value) AS value FROM events GROUP BY 1, 2""")
def _(spark, folder):
    home = scratch_folder(spark, "merge")
    store = inc.DeltaStore(spark, f"{home}/table", "dataset string, series string, obs_date date, value double")
    cells = event_stream(spark, folder).select(F.lit("events").alias("dataset"), F.col("event_type").alias("series"), F.to_date("ts").alias("obs_date"), "value")
    inc.stream_merge(cells, store, f"{home}/state", f"{home}/late").awaitTermination()
    cells = store.read().unionByName(spark.read.parquet(f"{home}/late").drop("batch"))
    return cells.select("series", F.col("obs_date").cast("string").alias("obs_date"), "value")


@query(
    "streamed_monthly_values",
    """WITH d AS (SELECT event_type AS series, CAST(ts AS DATE) AS d, arg_max(value, strftime(ts, '%Y%m%d%H%M%S%f') || lpad(CAST(event_id AS VARCHAR), 12, '0')) AS v FROM events GROUP BY 1, 2)
    SELECT series, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month, round(CASE WHEN series = 'view' THEN avg(v) ELSE arg_max(v, d) END, 6) AS value FROM d GROUP BY 1, 2""",
)
def _(spark, folder):
    home = scratch_folder(spark, "monthly")
    rows = event_stream(spark, folder).select(F.col("event_type").alias("series"), "ts", "value", F.col("event_id").alias("vintage"))
    inc.stream_daily(rows, f"{home}/days", f"{home}/state").awaitTermination()
    out = inc.monthly_from_daily(spark, f"{home}/days", F.when(F.col("series") == "view", "mean").otherwise("latest"))
    return out.select("series", F.col("month").cast("string").alias("month"), F.round("value", 6).alias("value"))


# --- series checks ----------------------------------------------------------------------------------

RC = """r AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS od, CASE WHEN o_orderstatus <> 'P' OR o_totalprice > 20000 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INTEGER) - 1 END AS rd, CASE WHEN o_totalprice > 3000 THEN o_totalprice END AS v, o_custkey FROM orders)"""


def check_records(spark, folder):
    d = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("series"), d.alias("observation_date"), F.when((F.col("o_orderstatus") != "P") | (F.col("o_totalprice") > 20000), F.date_add(d, (F.col("o_orderkey") % 9 - 1).cast("int"))).alias("release_date"),
        F.when(F.col("o_totalprice") > 3000, F.col("o_totalprice")).alias("value"), F.lit(None).cast("date").alias("selection_date"), F.when(F.col("o_custkey") > 30, F.col("o_custkey")).alias("source"),
    )


@query(
    "series_validation_report",
    f"""WITH {RC}, m AS (SELECT series, CAST(date_trunc('month', max(rd)) AS DATE) AS m FROM r GROUP BY 1), f AS (
      SELECT 'ERROR' AS severity, series AS indicator, 'value outside range on ' || CAST(od AS VARCHAR) AS message FROM r WHERE v IS NOT NULL AND v > CASE WHEN series LIKE '1%' THEN 400000 ELSE 450000 END
      UNION ALL SELECT 'ERROR', series, 'stale: latest release month ' || CAST(m AS VARCHAR) FROM m WHERE m < DATE '2001-09-01'
      UNION ALL SELECT 'ERROR', series, 'missing observation or release date' FROM r WHERE rd IS NULL
      UNION ALL SELECT 'WARNING', series, 'released before observed ' || CAST(od AS VARCHAR) FROM r WHERE rd < od
      UNION ALL SELECT 'ERROR', series, 'missing value on ' || CAST(od AS VARCHAR) FROM r WHERE v IS NULL
      UNION ALL SELECT 'ERROR', series, 'duplicate record ' || CAST(od AS VARCHAR) || coalesce(' ' || CAST(rd AS VARCHAR), '') FROM r GROUP BY series, od, rd HAVING count(*) > 1
      UNION ALL SELECT 'ERROR', series, 'missing provenance: source' FROM r WHERE o_custkey <= 30)
    SELECT severity, indicator, message, count(*) AS occurrences FROM f GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    r = check_records(spark, folder)
    ranges = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("series")).distinct().select("series", F.lit(0.0).alias("minimum"), F.when(F.col("series").startswith("1"), 400000.0).otherwise(450000.0).alias("maximum"))
    return ql.validation_report([ql.value_range_findings(r, ranges), ql.freshness_findings(r, F.lit("2001-10-05").cast("date"), 10), ql.record_findings(r), ql.provenance_findings(r, ["source"])])


@query(
    "monthly_date_checks",
    """WITH m AS (SELECT o_custkey AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, year(o_orderdate) * 12 + month(o_orderdate) AS ix, o_totalprice AS v FROM orders), c AS (SELECT series, month, ix, count(*) AS n FROM m GROUP BY 1, 2, 3),
    l AS (SELECT series, max(ix) AS lx, max(month) AS mx, count(*) AS h FROM c GROUP BY 1), t AS (SELECT l.series, least(6, h) AS want, count(*) AS got FROM l JOIN c ON c.series = l.series AND c.ix > l.lx - least(6, h) GROUP BY 1, 2),
    u AS (SELECT m.series, count(*) AS n, count(DISTINCT month) AS d, count(v) AS v FROM m JOIN l ON l.series = m.series AND ix > lx - 3 GROUP BY 1)
    SELECT severity, CAST(indicator AS VARCHAR) AS indicator, message, count(*) AS occurrences FROM (SELECT 'ERROR' AS severity, series AS indicator, 'duplicate month ' || CAST(month AS VARCHAR) AS message FROM c WHERE n > 1 UNION ALL SELECT 'ERROR', series, 'future month ' || CAST(mx AS VARCHAR) FROM l WHERE mx > DATE '2001-06-01'
      UNION ALL SELECT 'ERROR', series, 'gap in recent history: missing ' || (want - got) || ' months' FROM t WHERE got < want UNION ALL SELECT 'ERROR', series, 'tail has ' || v || ' values of 3' FROM u WHERE NOT (n = 3 AND d = 3 AND v = 3)) GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    m = table(spark, folder, "orders").select(F.col("o_custkey").alias("series"), F.trunc("o_orderdate", "MM").alias("month"), F.col("o_totalprice").alias("value"))
    return ql.validation_report([ql.monthly_date_findings(m, F.lit("2001-06-15").cast("date"), 6), ql.tail_findings(m, 3)])


@query(
    "table_against_source",
    """WITH t AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderstatus = 'P' AND o_totalprice < 30000 THEN '' WHEN o_totalprice > 490000 THEN 'x' ELSE CAST(o_totalprice AS VARCHAR) END AS cell FROM orders),
    n AS (SELECT series, d, try_cast(cell AS DOUBLE) AS v, cell FROM t), l AS (SELECT series, d, max(v) AS v FROM n GROUP BY 1, 2), s AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) AS v FROM orders GROUP BY 1, 2),
    w AS (SELECT s.series, count(*) AS c, min(s.d) AS f FROM s JOIN l ON s.series = l.series AND s.d = l.d WHERE l.v IS NULL OR abs(l.v - s.v) > 0.001 GROUP BY 1), dd AS (SELECT series, count(*) AS c FROM (SELECT series, d FROM t GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1)
    SELECT n.series, count(*) AS rows, CAST(max(n.d) AS VARCHAR) AS latest, count(CASE WHEN cell = '' THEN 1 END) AS blanks, count(CASE WHEN cell = 'x' THEN 1 END) AS non_numeric, coalesce(max(dd.c), 0) AS duplicate_dates, coalesce(max(w.c), 0) AS mismatches, CAST(max(w.f) AS VARCHAR) AS first_mismatch,
      datediff('month', date_trunc('month', max(n.d)), DATE '2001-10-01') > 2 AS stale FROM n LEFT JOIN dd ON dd.series = n.series LEFT JOIN w ON w.series = n.series GROUP BY 1""",
)
def _(spark, folder):
    o = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("obs_date"), "o_totalprice", "o_orderstatus")
    cell = F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 30000), "").when(F.col("o_totalprice") > 490000, "x").otherwise(F.col("o_totalprice").cast("string"))
    source = o.groupBy("series", "obs_date").agg(F.max("o_totalprice").alias("value"))
    a = ql.table_against_source(o.select("series", "obs_date", cell.alias("cell")), source, F.lit("2001-10-20").cast("date"))
    return a.withColumns({c: F.col(c).cast("string") for c in ("latest", "first_mismatch")})


@query("lineage_references", """SELECT l_orderkey AS owner, l_partkey AS missing_id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def _(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", F.array("l_partkey").alias("ids"))
    return ql.missing_references(rows, "ids", table(spark, folder, "part").where("p_size > 10"), "p_partkey", "l_orderkey")


@query("record_shape_errors", """SELECT c_custkey AS custkey, array_to_string(list_filter([CASE WHEN c_mktsegment = 'BUILDING' THEN 'missing segment' END, CASE WHEN c_acctbal <= 0 THEN 'balance not positive' END], lambda x: x IS NOT NULL), '; ') AS errors FROM customer""")
def _(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"), F.col("c_acctbal").alias("balance"))
    return ql.shape_errors(c, ["segment"], ["balance"]).select("custkey", "errors")


@query("universe_membership", """WITH u AS (SELECT o_custkey AS ticker, min(CAST(o_orderdate AS DATE)) AS vf, CASE WHEN max(o_orderdate) < TIMESTAMP '2001-01-01' THEN max(CAST(o_orderdate AS DATE)) END AS vt FROM orders GROUP BY 1),
    d AS (SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS a FROM orders) SELECT ticker, CAST(a AS VARCHAR) AS as_of_date, false AS delisted FROM u JOIN d ON vf <= a AND (vt IS NULL OR a < vt)""")
def _(spark, folder):
    o = table(spark, folder, "orders")
    u = o.groupBy(F.col("o_custkey").alias("ticker")).agg(F.to_date(F.min("o_orderdate")).alias("valid_from"), F.to_date(F.max("o_orderdate")).alias("last")).withColumn("valid_to", F.when(F.col("last") < F.lit("2001-01-01").cast("date"), F.col("last"))).withColumn("delisted_date", F.col("valid_to"))
    dates = o.select(F.last_day("o_orderdate").alias("as_of_date"))
    return ql.members_on(u, dates).select("ticker", F.col("as_of_date").cast("string").alias("as_of_date"), "delisted")
