"""Trades, people, guidance and boards: events as trades, suppliers and customers as people, composed statements as evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.catalog.registry import query, table
from gaugework.operators import people as pe
from gaugework.plans.settle import settle

C = F.col


def day(text):
    return F.lit(text).cast("date")


def trades(spark, folder):
    """Events as trades: user = person, the event's k mod 10 = ticker, type = code."""
    t, k = C("event_type"), F.get_json_object("props", "$.k").cast("int")
    raw = table(spark, folder, "events").select(
        C("event_id").cast("string").alias("transaction_id"), F.concat(F.lit("T"), (k % 10).cast("string")).alias("ticker"), C("user_id").alias("person_id"), F.to_date("ts").alias("transaction_date"),
        F.when(t == "purchase", "P").when(t == "error", "S").when(t == "click", "M").when(t == "signup", "A").otherwise("G").alias("code"), F.when(t.isin("error", "view"), "D").otherwise("A").alias("acquired_disposed"),
        F.when(t == "signup", "Restricted Stock").otherwise("Common").alias("security_title"), F.when((t == "error") & (C("value") > 20), F.array(F.lit("under a Rule 10b5-1 plan"))).when((t == "error") & (C("value") < 2), F.array(F.lit("scheduled sale"))).otherwise(F.array().cast("array<string>")).alias("footnotes"),
        F.lit(None).cast("boolean").alias("plan"), C("value").alias("shares"), F.lit(10.0).alias("price"), (C("value") * 10).alias("value"), F.lit("non_derivative").alias("security_type"), F.lit("D").alias("ownership_form"), F.lit("").alias("nature"), C("event_id").alias("row_index"),
        (C("value") + 3).alias("shares_after"),
    )
    return pe.classify_trades(raw)


TR = """
tr AS (SELECT event_id, 'T' || CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS ticker, user_id AS person, CAST(ts AS DATE) AS d, value AS v, CASE event_type WHEN 'purchase' THEN 'open_market_purchase' WHEN 'error' THEN CASE WHEN value > 20 THEN 'automatic_sale' WHEN value < 2 THEN 'planned_sale' ELSE 'open_market_sale' END
  WHEN 'click' THEN 'option_exercise' WHEN 'signup' THEN 'restricted_stock_vesting' ELSE 'gift' END AS kind FROM events)"""


@query("trade_classification", f"WITH {TR} SELECT event_id, kind AS transaction_type, kind IN ('open_market_purchase', 'open_market_sale', 'automatic_sale', 'planned_sale') AS is_open_market, kind IN ('automatic_sale', 'planned_sale') AS is_automatic_sale, CASE kind WHEN 'planned_sale' THEN 0.86 ELSE 0.98 END AS confidence FROM tr")
def _(spark, folder):
    return trades(spark, folder).select(C("transaction_id").cast("long").alias("event_id"), "transaction_type", "is_open_market", "is_automatic_sale", "confidence")


@query("holdings_before_trades", "SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN round(2 * value + 3, 4) ELSE 3.0 END AS shares_before, round(value / CASE WHEN event_type IN ('error', 'view') THEN 2 * value + 3 ELSE 3.0 END * 100, 4) AS percent_of_before FROM events")
def _(spark, folder):
    h = pe.holdings_before(trades(spark, folder))
    return h.select(C("transaction_id").cast("long").alias("event_id"), F.round("shares_before", 4).alias("shares_before"), F.round("percent_of_before", 4).alias("percent_of_before"))


@query("coherent_trade_sequences", """WITH s AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, CASE WHEN event_type = 'signup' THEN 'Restricted Stock' ELSE 'Common' END AS title, value + 3 AS after, CASE WHEN event_type IN ('error', 'view') THEN 2 * value + 3 ELSE 3.0 END AS before FROM events),
    p AS (SELECT *, lag(after) OVER (PARTITION BY user_id, d, title ORDER BY event_id) AS pa, count(*) OVER (PARTITION BY user_id, d, title) AS n FROM s), b AS (SELECT user_id, d, title, bool_or(pa IS NOT NULL AND abs(pa - before) > 1e-9) AS bad FROM p GROUP BY 1, 2, 3)
    SELECT event_id, n > 1 AND bad AS unresolved FROM p JOIN b USING (user_id, d, title)""")
def _(spark, folder):
    c = pe.coherent_sequences(pe.holdings_before(trades(spark, folder)))
    return c.select(C("transaction_id").cast("long").alias("event_id"), C("sequence_unresolved").alias("unresolved"))


@query("trade_counts", f"WITH {TR} SELECT ticker, count(CASE WHEN kind = 'open_market_purchase' THEN 1 END) AS open_market_purchases, count(CASE WHEN kind = 'open_market_sale' THEN 1 END) AS open_market_sales, count(CASE WHEN kind = 'automatic_sale' THEN 1 END) AS automatic_sales, count(CASE WHEN kind = 'gift' THEN 1 END) AS gifts_transfers, count(CASE WHEN kind = 'restricted_stock_vesting' THEN 1 END) AS awards_vesting, CAST(0 AS BIGINT) AS other FROM tr GROUP BY 1")
def _(spark, folder):
    return pe.trade_counts(trades(spark, folder), ["ticker"]).select("ticker", "open_market_purchases", "open_market_sales", "automatic_sales", "gifts_transfers", "awards_vesting", "other")


@query("alignment_snapshots", f"""WITH {TR}, x AS (SELECT *, DATE '2024-01-25' - d AS age FROM tr WHERE d <= DATE '2024-01-25') SELECT ticker, count(CASE WHEN kind = 'open_market_purchase' AND age <= 30 THEN 1 END) AS purchases_30d, count(CASE WHEN kind = 'open_market_sale' THEN 1 END) AS sales_365d, round(sum(CASE WHEN kind = 'open_market_purchase' THEN v * 10 ELSE 0 END), 3) AS purchase_value_365d,
    count(DISTINCT CASE WHEN kind = 'open_market_purchase' THEN person END) AS buyers_365d, round(sum(CASE kind WHEN 'open_market_purchase' THEN v * 10 WHEN 'open_market_sale' THEN -v * 10 ELSE 0 END), 3) AS net_value_365d, round(sum(CASE WHEN kind = 'automatic_sale' THEN v * 10 ELSE 0 END), 3) AS automatic_sale_value_365d FROM x GROUP BY 1""")
def _(spark, folder):
    s = pe.alignment_snapshot(trades(spark, folder), day("2024-01-25"))
    return s.select("ticker", "purchases_30d", "sales_365d", F.round("purchase_value_365d", 3).alias("purchase_value_365d"), "buyers_365d", F.round("net_value_365d", 3).alias("net_value_365d"), F.round("automatic_sale_value_365d", 3).alias("automatic_sale_value_365d"))


@query(
    "trade_clusters",
    """WITH RECURSIVE ev AS (SELECT user_id % 3 || '-' || CAST(json_extract_string(props, '$.k') AS INTEGER) % 30 AS ticker, event_type AS side, user_id AS p, CAST(ts AS DATE) AS d, value AS v FROM events),
    dd AS (SELECT ticker, side, d, row_number() OVER (PARTITION BY ticker, side ORDER BY d) AS i FROM (SELECT DISTINCT ticker, side, d FROM ev)),
    pr AS (SELECT a.ticker, a.side, a.i, a.d, count(DISTINCT e.p) >= 2 AS hit, max(e.d) AS last FROM dd a JOIN ev e ON e.ticker = a.ticker AND e.side = a.side AND e.d BETWEEN a.d AND a.d + 2 GROUP BY 1, 2, 3, 4),
    nx AS (SELECT pr.*, CASE WHEN hit THEN (SELECT max(b.i) + 1 FROM dd b WHERE b.ticker = pr.ticker AND b.side = pr.side AND b.d <= pr.last) ELSE pr.i + 1 END AS j FROM pr),
    wk AS (SELECT * FROM nx WHERE i = 1 UNION ALL SELECT n.* FROM wk JOIN nx n ON n.ticker = wk.ticker AND n.side = wk.side AND n.i = wk.j)
    SELECT w.ticker, w.side, CAST(w.d AS VARCHAR) AS start_date, CAST(w.last AS VARCHAR) AS end_date, count(DISTINCT e.p) AS people, count(*) AS trades, round(sum(e.v), 3) AS combined_value FROM wk w JOIN ev e ON e.ticker = w.ticker AND e.side = w.side AND e.d BETWEEN w.d AND w.last WHERE w.hit GROUP BY 1, 2, 3, 4""",
)
def _(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    t = table(spark, folder, "events").select(C("event_id").alias("transaction_id"), F.concat((C("user_id") % 3).cast("string"), F.lit("-"), (k % 30).cast("string")).alias("ticker"), C("event_type").alias("side"), C("user_id").alias("person_id"), F.to_date("ts").alias("transaction_date"), "value")
    c = pe.trade_clusters(t, 2)
    return c.select("ticker", "side", C("start_date").cast("string").alias("start_date"), C("end_date").cast("string").alias("end_date"), "people", "trades", F.round("combined_value", 3).alias("combined_value"))


def positions(spark, folder):
    o = table(spark, folder, "orders")
    return o.select(
        F.lpad(C("o_orderkey").cast("string"), 12, "0").alias("ownership_id"), F.lit("T").alias("ticker"), C("o_custkey").alias("person_id"), C("o_orderstatus").alias("security_title"), F.round(C("o_totalprice") / 50000).alias("shares"), F.when(C("o_orderpriority") < "3", "I").otherwise("D").alias("direct_indirect"),
        F.when(C("o_orderpriority") < "2", "By trust").otherwise("By company").alias("nature"), F.to_date("o_orderdate").alias("as_of_date"), F.to_date("o_orderdate").alias("filing_date"), F.lit("common").alias("security_type"),
    )


@query("overlap_safe_positions", """WITH p AS (SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice / 50000) AS s, o_orderpriority LIKE '1%' AS shared, CAST(o_orderdate AS DATE) AS d FROM orders), f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, s ORDER BY d, o_orderkey) AS k FROM p)
    SELECT o_orderkey AS orderkey, NOT (shared AND k > 1) AS kept FROM f""")
def _(spark, folder):
    return pe.distinct_positions(positions(spark, folder)).select(C("ownership_id").cast("long").alias("orderkey"), "kept")


@query("role_holdings", """WITH p AS (SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice / 50000) AS s, o_orderpriority LIKE '1%' AS shared, CAST(o_orderdate AS DATE) AS d FROM orders), f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, s ORDER BY d, o_orderkey) AS k FROM p), g AS (SELECT * FROM f WHERE NOT (shared AND k > 1))
    SELECT sum(CASE WHEN c_mktsegment = 'BUILDING' THEN s END) AS ceo_shares, sum(CASE WHEN c_acctbal > 0 THEN s END) AS director_shares, sum(s) AS known_insider_shares FROM g JOIN customer ON c_custkey = o_custkey""")
def _(spark, folder):
    people = table(spark, folder, "customer").select(F.lit("T").alias("ticker"), C("c_custkey").alias("person_id"), (C("c_mktsegment") == "BUILDING").alias("is_ceo"), F.lit(False).alias("is_cfo"), F.lit(False).alias("is_founder"), (C("c_acctbal") > 0).alias("is_director"))
    return pe.role_holdings(pe.distinct_positions(positions(spark, folder)), people).select("ceo_shares", "director_shares", "known_insider_shares")


@query("current_holdings", """SELECT o_custkey AS person_id, o_orderstatus AS security_title, CASE WHEN o_orderpriority < '3' THEN 'I' ELSE 'D' END AS direct_indirect, arg_max(o_orderkey, strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS orderkey FROM orders GROUP BY 1, 2, 3""")
def _(spark, folder):
    return pe.current_holdings(positions(spark, folder)).select("person_id", "security_title", "direct_indirect", C("ownership_id").cast("long").alias("orderkey"))


@query("latest_baseline_rows", "SELECT o_orderkey AS orderkey FROM orders JOIN (SELECT o_custkey AS c, max(o_orderdate) AS d FROM orders GROUP BY 1) ON c = o_custkey AND d = o_orderdate")
def _(spark, folder):
    b = table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), C("o_custkey").alias("ticker"), C("o_orderdate").alias("filing_date"))
    return pe.latest_baselines(b).select("orderkey")


@query("baseline_reconciliation", """WITH b AS (SELECT c_custkey AS id, c_acctbal AS s, c_mktsegment AS seg FROM customer), t AS (SELECT o_custkey AS id, sum(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * o_shippriority) AS dl, count(*) AS n FROM (SELECT *, 5 AS o_shippriority FROM orders) WHERE o_orderdate > TIMESTAMP '1998-01-01' GROUP BY 1)
    SELECT b.id, round(CASE WHEN seg <> 'BUILDING' AND n IS NOT NULL THEN s + dl END, 4) AS reconstructed_shares, CASE WHEN seg <> 'BUILDING' AND n IS NOT NULL THEN 'proxy_plus_section16_reconciled' ELSE 'proxy_only' END AS method, CASE WHEN seg = 'BUILDING' THEN 'GROUP_OR_MAJOR_OWNER' WHEN n IS NULL THEN 'NO_COMPARABLE_POSITION' END AS warning FROM b LEFT JOIN t ON t.id = b.id""")
def _(spark, folder):
    b = table(spark, folder, "customer").select(C("c_custkey").alias("baseline_id"), F.lit("T").alias("ticker"), C("c_custkey").alias("person_id"), C("c_acctbal").alias("beneficial_shares"), day("1998-01-01").alias("as_of_date"), (C("c_mktsegment") == "BUILDING").alias("is_group"), F.lit("common").alias("security_class"), F.lit("").alias("notes"))
    t = table(spark, folder, "orders").select(F.lit("T").alias("ticker"), C("o_custkey").alias("person_id"), F.to_date("o_orderdate").alias("transaction_date"), F.lit("common").alias("security_type"), F.lit("D").alias("ownership_form"), F.lit("").alias("nature"), F.when(C("o_orderstatus") == "F", "D").otherwise("A").alias("acquired_disposed"), F.lit(5.0).alias("shares"))
    empty = positions(spark, folder).where(C("person_id") < 0)
    r = pe.reconcile_baselines(b, t, empty)
    return r.select(C("baseline_id").alias("id"), F.round("reconstructed_shares", 4).alias("reconstructed_shares"), "method", "warning")


@query("ownership_form_trades", """SELECT o_orderkey AS orderkey, 'P' AS code, 'non_derivative' AS security_type, round(o_totalprice, 2) AS shares, 'plan note' AS note FROM orders WHERE o_orderpriority NOT LIKE '3%' UNION ALL SELECT o_orderkey, 'M', 'derivative', 7.0, NULL FROM orders WHERE o_orderpriority NOT LIKE '3%'""")
def _(spark, folder):
    t = pe.form_trades(pe.ownership_forms(ownership_xml(spark, folder), parts=pe.TRADE_PARTS))
    return t.select(C("accession").cast("long").alias("orderkey"), "code", "security_type", F.round("shares", 2).alias("shares"), F.try_element_at("footnotes", F.lit(1)).alias("note"))


def ownership_xml(spark, folder):
    """One ownership form per order; medium-priority orders are initial reports, which hold positions only."""
    v = lambda tag, body: F.concat(F.lit(f"<{tag}><value>"), body, F.lit(f"</value></{tag}>"))
    shares = F.format_string("%.2f", C("o_totalprice"))
    trade = lambda code, n, note: F.concat(
        v("securityTitle", F.lit("Common")), v("transactionDate", F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit(f"<transactionCoding><transactionCode>{code}</transactionCode>{note}</transactionCoding><transactionAmounts>"), v("transactionShares", n), v("transactionPricePerShare", F.lit("5")),
        v("transactionAcquiredDisposedCode", F.lit("A")), F.lit("</transactionAmounts><postTransactionAmounts>"), v("sharesOwnedFollowingTransaction", F.lit("99")), F.lit("</postTransactionAmounts><ownershipNature>"), v("directOrIndirectOwnership", F.lit("D")), F.lit("</ownershipNature>"),
    )
    holding = F.concat(v("securityTitle", F.lit("Common")), F.lit("<postTransactionAmounts>"), v("sharesOwnedFollowingTransaction", F.lit("42")), F.lit("</postTransactionAmounts><ownershipNature>"), v("directOrIndirectOwnership", F.lit("I")), F.lit("</ownershipNature>"))
    kind = F.when(C("o_orderpriority").startswith("3"), "3").otherwise("4")
    xml = F.concat(
        F.lit("<ownershipDocument><documentType>"), kind, F.lit("</documentType><periodOfReport>2000-01-31</periodOfReport><issuer><issuerTradingSymbol>c"), C("o_custkey").cast("string"), F.lit("</issuerTradingSymbol></issuer><reportingOwner><reportingOwnerId><rptOwnerCik>"), C("o_custkey").cast("string"),
        F.lit("</rptOwnerCik><rptOwnerName>DOE JANE</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isDirector>1</isDirector><officerTitle>CFO</officerTitle></reportingOwnerRelationship></reportingOwner><nonDerivativeTable><nonDerivativeTransaction>"),
        trade("P", shares, '<footnoteId id="F1"/>'), F.lit("</nonDerivativeTransaction><nonDerivativeHolding>"), holding, F.lit("</nonDerivativeHolding></nonDerivativeTable><derivativeTable><derivativeTransaction>"), trade("M", F.lit("7"), ""),
        F.lit('</derivativeTransaction></derivativeTable><footnotes><footnote id="F1">plan note</footnote></footnotes></ownershipDocument>'),
    )
    return table(spark, folder, "orders").select(C("o_orderkey").cast("string").alias("accession"), xml.alias("xml"))


@query("ownership_form_people", "SELECT o_orderkey AS orderkey, 'C' || o_custkey AS ticker, 'DOE JANE' AS name, true AS is_director, 'CFO' AS title FROM orders")
def _(spark, folder):
    return pe.form_people(pe.ownership_forms(ownership_xml(spark, folder), parts=pe.PEOPLE_PARTS)).select(C("accession").cast("long").alias("orderkey"), "ticker", "name", "is_director", "title")


@query("ownership_form_holdings", "SELECT o_orderkey AS orderkey, 42.0 AS shares, 'I' AS direct_indirect, '2000-01-31' AS as_of_date FROM orders")
def _(spark, folder):
    return pe.form_holdings(pe.ownership_forms(ownership_xml(spark, folder), parts=pe.HOLDING_PARTS)).select(C("accession").cast("long").alias("orderkey"), "shares", "direct_indirect", C("as_of_date").cast("string").alias("as_of_date"))


# --- composed statements --------------------------------------------------------------------------------------


def by_priority(spark, folder, *texts):
    """Orders with one statement per priority class (five texts)."""
    p = F.substring("o_orderpriority", 1, 1)
    text = F.coalesce(*[F.when(p == str(i + 1), t if not isinstance(t, str) else F.lit(t)) for i, t in enumerate(texts)])
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), C("o_custkey").alias("ticker"), F.to_date("o_orderdate").alias("day"), C("o_totalprice").alias("amount"), p.alias("p"), text.alias("text"))


def case(*values) -> str:
    return "CASE substr(o_orderpriority, 1, 1) " + " ".join(f"WHEN '{i + 1}' THEN {('NULL' if v is None else repr(v) if isinstance(v, str) else v)}" for i, v in enumerate(values)) + " END"


@query("role_classes", f"SELECT o_orderkey AS orderkey, {case('director,CEO,executive', 'CFO,executive', 'chair', 'general_counsel', 'president,executive')} AS roles, {case('CEO', 'CFO', None, 'general_counsel', None)} AS canonical FROM orders")
def _(spark, folder):
    o = by_priority(spark, folder, "Director and Chief Executive Officer", "Chief Financial Officer", "Chairman", "General Counsel", "Executive Vice President")
    classes = pe.role_classes(C("text"))
    category = F.when(C("p") == "5", "president").otherwise(F.try_element_at(classes, F.lit(-1)))
    return o.select("orderkey", F.array_join(classes, ",").alias("roles"), pe.canonical_role(category, C("text"), F.lit("")).alias("canonical"))


@query("partial_date_precision", f"SELECT o_orderkey AS orderkey, {case('year', 'month', 'day', 'reported', None)} AS precision FROM orders")
def _(spark, folder):
    d = F.to_date("o_orderdate")
    text = F.when(C("p") == "1", F.date_format("day", "yyyy")).when(C("p") == "2", F.date_format("day", "yyyy-MM")).when(C("p") == "3", C("day").cast("string")).when(C("p") == "4", "spring 2000")
    return by_priority(spark, folder, "", "", "", "", "").select("orderkey", pe.date_precision(text, F.lit(None).cast("string")).alias("precision"))


@query("merged_entities", """SELECT o_custkey AS ticker, arg_min(o_orderpriority, o_orderkey) AS first_priority, bool_or(o_orderstatus = 'F') AS any_final, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY 1""")
def _(spark, folder):
    o = table(spark, folder, "orders").select(C("o_custkey").alias("ticker"), "o_orderkey", C("o_orderpriority").alias("first_priority"), (C("o_orderstatus") == "F").alias("any_final"), F.array("o_orderstatus").alias("statuses"))
    return pe.merge_entities(o, "ticker", ["statuses"], ["first_priority"], ["any_final"], "o_orderkey").withColumn("statuses", F.array_join("statuses", ","))


@query("built_tenures", f"""WITH a AS (SELECT o_custkey AS ticker, {case('CEO', 'CFO', 'executive', 'executive', 'CEO')} AS role, year(o_orderdate) AS y FROM orders), m AS (SELECT ticker, role, y, count(*) AS n FROM a GROUP BY 1, 2, 3)
    SELECT ticker, role AS canonical_role, y || '-01-01' AS start_date, n AS assertions, true AS is_current FROM m WHERE NOT (role = 'executive' AND EXISTS (SELECT 1 FROM m b WHERE b.ticker = m.ticker AND b.y = m.y AND b.role <> 'executive'))""")
def _(spark, folder):
    o = by_priority(spark, folder, "Chief Executive Officer", "Chief Financial Officer", "Secretary", "Treasurer", "CEO")
    a = o.select("ticker", F.lit("x").alias("person_id"), F.when(C("p").isin("1", "5"), "CEO").when(C("p") == "2", "CFO").otherwise("executive").alias("role_category"), F.lit("").alias("role"), C("text").alias("title"), F.date_format("day", "yyyy").alias("start"), F.lit(None).cast("string").alias("end"), F.lit(None).cast("string").alias("precision"), C("orderkey").alias("evidence"))
    return pe.build_tenures(a, day("2002-01-01")).select("ticker", "canonical_role", C("start_date").cast("string").alias("start_date"), "assertions", "is_current")


@query(
    "linked_people",
    """WITH k AS (SELECT c_custkey AS k FROM customer) SELECT 'm' || k AS person_id, 'i' || k AS insider_id, CASE WHEN k % 3 = 0 THEN 'issuer_exact_name' ELSE 'issuer_name_variant' END || CASE WHEN k % 2 = 0 THEN '+owner_cik' ELSE '' END AS method,
      CASE WHEN k % 5 = 0 THEN 'ambiguous' WHEN k % 2 = 0 THEN 'high' ELSE 'probable' END AS confidence FROM k WHERE k % 3 < 2
    UNION ALL SELECT 'm' || k, 'j' || k, 'issuer_name_variant', CASE WHEN k % 3 < 2 THEN 'ambiguous' ELSE 'probable' END FROM k WHERE k % 5 = 0""",
)
def _(spark, folder):
    c = table(spark, folder, "customer").select(C("c_custkey").alias("k"), F.concat(F.lit("T"), C("c_custkey").cast("string")).alias("ticker"))
    own = lambda letter: F.concat(F.lit(letter), C("k").cast("string")).alias("person_id")
    managers = c.select("ticker", own("m"), F.lit("Robert Fielding").alias("name"))
    name = F.when(C("k") % 3 == 0, "FIELDING ROBERT").when(C("k") % 3 == 1, "FIELDING ROB").otherwise("SMITHSON ANNE")
    insiders = c.select("ticker", own("i"), name.alias("name"), F.when(C("k") % 2 == 0, C("ticker")).alias("owner_id"))
    more = c.where("k % 5 = 0").select("ticker", own("j"), F.lit("FIELDING ROBERTA").alias("name"), F.lit(None).cast("string").alias("owner_id"))
    return pe.link_people(managers, insiders.unionByName(more)).select("person_id", "insider_id", "method", "confidence")


@query("resolved_identities", "SELECT c_custkey AS row_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'strong_identifier' WHEN c_mktsegment = 'FURNITURE' THEN 'same_issuer' WHEN c_mktsegment = 'MACHINERY' THEN 'biography_supported' ELSE 'ambiguous' END AS identity_status FROM customer")
def _(spark, folder):
    s = C("c_mktsegment")
    p = table(spark, folder, "customer").select(C("c_custkey").alias("row_id"), F.when(s == "FURNITURE", "F").otherwise(C("c_custkey").cast("string")).alias("ticker"), F.concat(s, F.lit(" Person")).alias("name"), F.when(s == "BUILDING", C("c_custkey").cast("string")).alias("strong_id"), F.when(s == "MACHINERY", "Also serves on the board of Acme").alias("biography"))
    return pe.resolve_identities(p).select("row_id", "identity_status")


@query(
    "resolved_organisations",
    """SELECT s_name AS name, s_name || ' Inc' AS matched_title, 'T' || s_suppkey AS ticker, 'PUBLIC_COMPANY_CONFIRMED' AS status FROM supplier
    UNION ALL SELECT 'The ' || s_nationkey || '-' || s_suppkey, s_name || ' Inc', 'T' || s_suppkey, 'PUBLIC_COMPANY_CONFIRMED' FROM supplier WHERE s_acctbal > 5000
    UNION ALL SELECT n_name || ' University', NULL, NULL, 'NON_COMPANY_ORGANIZATION' FROM nation UNION ALL SELECT n_name || ' School of Law', NULL, NULL, 'NON_COMPANY_ORGANIZATION' FROM nation
    UNION ALL SELECT r_name || ' Partners', NULL, NULL, 'UNRESOLVED' FROM region UNION ALL SELECT r_name || ' Family Office', NULL, NULL, 'PRIVATE_COMPANY' FROM region UNION ALL SELECT DISTINCT 'Supplier', NULL, NULL, 'UNRESOLVED' FROM supplier""",
)
def _(spark, folder):
    s = table(spark, folder, "supplier")
    nick = F.concat(F.lit("The "), C("s_nationkey").cast("string"), F.lit("-"), C("s_suppkey").cast("string"))
    aliases = s.where("s_acctbal > 5000").select(nick.alias("alias"), F.concat("s_name", F.lit(" Inc")).alias("title"))
    ends = lambda name, column, *words: [table(spark, folder, name).select(F.concat(column, F.lit(f" {w}")).alias("name")) for w in words]
    names = s.select(C("s_name").alias("name")).union(aliases.select("alias")).union(s.select(F.lit("Supplier")).distinct())
    for more in [*ends("nation", "n_name", "University", "School of Law"), *ends("region", "r_name", "Partners", "Family Office")]:
        names = names.union(more)
    return pe.resolve_organizations(names, s.select(F.concat(F.lit("T"), C("s_suppkey").cast("string")).alias("ticker"), F.concat("s_name", F.lit(" Inc")).alias("title")), aliases)


@query("issuer_metadata_precedence", "SELECT c_custkey AS ticker, CASE WHEN c_acctbal > 5000 THEN c_name ELSE c_mktsegment END AS name, CASE WHEN c_acctbal > 8000 THEN 'first' ELSE 'second' END AS exchange FROM customer")
def _(spark, folder):
    c = table(spark, folder, "customer")
    one = c.select(C("c_custkey").alias("ticker"), F.when(C("c_acctbal") > 5000, C("c_name")).otherwise("").alias("name"), F.when(C("c_acctbal") > 8000, "first").alias("exchange"))
    two = c.select(C("c_custkey").alias("ticker"), C("c_mktsegment").alias("name"), F.lit("second").alias("exchange"))
    return pe.issuer_metadata([one, two], ["name", "exchange"])


def guidance_claims(spark, folder):
    n = F.round(C("o_totalprice") / 1000).cast("int")
    low, high = n.cast("string"), (n + 50).cast("string")
    y = (F.year("o_orderdate") + 5).cast("string")
    o = by_priority(
        spark, folder, F.concat(F.lit("We expect revenue guidance of $"), low, F.lit(" to $"), high, F.lit(" million for FY"), y), F.concat(F.lit("We raised revenue outlook to $"), low, F.lit(" million for FY"), y), F.concat(F.lit("We withdraw our revenue guidance for FY"), y),
        F.concat(F.lit("Gross margin target of "), F.lit("40% to 45% for FY"), y), F.lit("Nothing stated here"),
    )
    return o.select(C("orderkey").cast("string").alias("claim_id"), "ticker", C("text").alias("evidence_text"), F.lit("Q1 2000").alias("period_label"), C("day").alias("issued_date"))


@query("guidance_parsing", f"""WITH g AS (SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS p, CAST(round(o_totalprice / 1000) AS INTEGER) AS n, year(o_orderdate) + 5 AS y FROM orders) SELECT o_orderkey AS claim, CASE WHEN p = '4' THEN 'gross_margin' ELSE 'revenue' END AS metric, 'FY' || y AS horizon, CASE p WHEN '1' THEN n * 1e6 WHEN '4' THEN 40.0 END AS low,
    CASE p WHEN '1' THEN (n + 50) * 1e6 WHEN '4' THEN 45.0 END AS high, CASE p WHEN '1' THEN 'issued' WHEN '2' THEN 'raised' WHEN '3' THEN 'withdrawn' ELSE 'issued' END AS status FROM g WHERE p <> '5'""")
def _(spark, folder):
    return pe.guidance_from_claims(guidance_claims(spark, folder)).select(C("claim_id").cast("long").alias("claim"), "metric", "horizon", "low", "high", "status")


@query("guidance_revisions", """WITH g AS (SELECT o_orderkey, o_custkey, substr(o_orderpriority, 1, 1) AS p, year(o_orderdate) AS y, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderpriority < '5') SELECT o_custkey AS ticker, count(*) AS revisions, max(k) AS highest FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, y, CASE p WHEN '3' THEN 1 WHEN '4' THEN 2 ELSE 0 END ORDER BY d, o_orderkey) AS k FROM g) GROUP BY 1""")
def _(spark, folder):
    g = pe.guidance_revisions(pe.guidance_from_claims(guidance_claims(spark, folder)))
    return g.groupBy("ticker").agg(F.count("*").alias("revisions"), F.max("revision_number").alias("highest"))


@query("guidance_outcomes", """WITH g AS (SELECT o_orderkey, o_custkey, substr(o_orderpriority, 1, 1) AS p, CAST(round(o_totalprice / 1000) AS INTEGER) * 1e6 AS n, year(o_orderdate) + 5 AS y FROM orders WHERE o_orderpriority < '5'), a AS (SELECT o_custkey, year(o_orderdate) + 5 AS y, avg(o_totalprice) * 1000 AS v FROM orders WHERE year(o_orderdate) < 2000 GROUP BY 1, 2)
    SELECT o_orderkey AS claim, CASE WHEN p = '3' THEN 'WITHDRAWN' WHEN p = '4' OR v IS NULL THEN 'UNRESOLVED' WHEN p = '1' AND v BETWEEN n AND n + 5e7 OR p = '2' AND abs(v - n) <= n * 0.01 THEN 'MET' WHEN v > n THEN 'BEAT' ELSE 'MISS' END AS outcome FROM g LEFT JOIN a ON a.o_custkey = g.o_custkey AND a.y = g.y""")
def _(spark, folder):
    g = pe.guidance_from_claims(guidance_claims(spark, folder))
    y = F.year("o_orderdate")
    facts = table(spark, folder, "orders").where(y < 2000).groupBy(C("o_custkey").alias("ticker"), (y + 5).alias("fiscal_year")).agg((F.avg("o_totalprice") * 1000).alias("value")).select("ticker", F.lit("revenue").alias("metric"), "fiscal_year", F.lit("FY").alias("fiscal_period"), F.lit("USD").alias("unit"), F.lit("GAAP").alias("basis"), "value", F.make_date(C("fiscal_year"), F.lit(12), F.lit(31)).alias("period_end"), day("2001-01-01").alias("filed"))
    return pe.guidance_outcomes(g, facts, day("2009-12-31")).select(C("claim_id").cast("long").alias("claim"), "outcome")


@query("guidance_coverage", """WITH c AS (SELECT o_custkey AS ticker, count(*) AS n, count(CASE WHEN o_orderpriority < '5' THEN 1 END) AS l, count(CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '4') THEN 1 END) AS num FROM orders GROUP BY 1) SELECT c_custkey AS ticker, CASE WHEN num > 0 THEN 'GUIDANCE_PRESENT_BUT_NOT_COMPARABLE' WHEN l > 0 THEN 'GUIDANCE_PRESENT_BUT_NOT_NUMERIC' WHEN n IS NULL THEN 'GUIDANCE_DOCUMENTS_PRESENT_BUT_NOT_EXTRACTED' ELSE 'GUIDANCE_EVIDENCE_NOT_FOUND' END AS reason FROM customer LEFT JOIN c ON ticker = c_custkey""")
def _(spark, folder):
    claims = guidance_claims(spark, folder)
    docs = table(spark, folder, "customer").select(C("c_custkey").alias("ticker"))
    return pe.guidance_coverage(claims, docs, docs.where("ticker < 0")).select("ticker", "reason")


@query("capital_events", f"SELECT o_orderkey AS orderkey, {case('acquisition', 'buyback_authorization', 'dividend', 'debt_repayment', None)} AS type, {case('announced', 'authorized', 'declared', 'executed', None)} AS status, {case(5e9, 2e6, None, None, None)} AS amount, {case('Acme Tools', None, None, None, None)} AS target FROM orders")
def _(spark, folder):
    o = by_priority(spark, folder, "We announced the acquisition of Acme Tools for $5 billion", "The board authorized a $2 million share repurchase", "A dividend was declared", "We repaid all debt", "Weather was fine")
    e = pe.capital_event(C("text"))
    return o.select("orderkey", e["type"].alias("type"), e["status"].alias("status"), e["amount"].alias("amount"), e["target"].alias("target"))


@query("commitment_filter", f"SELECT o_orderkey AS orderkey, {case('true', 'false', 'false', 'true', 'false')}::BOOLEAN AS commitment, {case('product_launch', 'revenue_target', 'other', 'capacity', 'other')} AS category FROM orders".replace("'true'", "true").replace("'false'", "false"))
def _(spark, folder):
    o = by_priority(spark, folder, "We will launch the new platform", "We expect revenue to be up and will deliver", "It may add some things to the mix", "We plan to expand manufacturing", "Thanks to all")
    return o.select("orderkey", pe.is_commitment(C("text")).alias("commitment"), pe.commitment_category(C("text")).alias("category"))


@query("commitment_outcomes", """WITH f AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d, substr(o_orderpriority, 1, 1) AS p FROM orders), c AS (SELECT * FROM f WHERE p = '1'), l AS (SELECT * FROM f WHERE p IN ('1', '2', '3')),
    j AS (SELECT c.o_orderkey, arg_max(l.p, strftime(l.d, '%Y%m%d') || lpad(CAST(l.o_orderkey AS VARCHAR), 12, '0')) AS p FROM c JOIN l ON l.o_custkey = c.o_custkey AND l.o_orderkey <> c.o_orderkey AND (c.o_orderkey % 7 = 0 OR l.d > c.d) GROUP BY 1)
    SELECT c.o_orderkey AS orderkey, CASE j.p WHEN '2' THEN 'ACHIEVED' WHEN '3' THEN 'DELAYED' ELSE 'UNRESOLVED' END AS outcome FROM c LEFT JOIN j ON j.o_orderkey = c.o_orderkey""")
def _(spark, folder):
    o = settle(by_priority(spark, folder, "We will launch the harbor warehouse", "Both warehouses were launched", "The harbor warehouse is subject to delay", "Unrelated remark about weather", "Another"))
    pad = F.lpad(C("orderkey").cast("string"), 12, "0")
    undated = F.when(C("orderkey") % 7 != 0, C("day"))
    commitments = o.where("p = '1'").select(pad.alias("commitment_id"), "ticker", C("text").alias("commitment_text"), undated.alias("commitment_date"), pad.alias("source_claim_id"))
    claims = o.select(pad.alias("claim_id"), "ticker", C("text").alias("evidence_text"), C("day").alias("document_date"))
    return pe.commitment_outcomes(commitments, claims).select(C("commitment_id").cast("long").alias("orderkey"), "outcome")


@query("attribution_levels", f"SELECT o_orderkey AS orderkey, {case('DIRECT', 'TEAM', 'ROLE_BASED', 'TENURE_OVERLAP', 'TENURE_OVERLAP')} AS level FROM orders")
def _(spark, folder):
    o = by_priority(spark, folder, "Jane Margaret Doe announced the plan", "The management team decided", "Margins rose", "Margins rose", "Doe spoke about nothing")
    return o.select("orderkey", pe.attribution(C("text"), F.lit("Jane Doe"), F.when(C("p") == "3", "CFO")).alias("level"))


@query("attribution_violations", f"SELECT o_orderkey AS orderkey, {case(None, 'DIRECT requires the named person in evidence', 'unsupported attribution level', None, None)} AS error FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('2', '3')")
def _(spark, folder):
    o = by_priority(spark, folder, "Jane Doe announced it", "They announced it", "x", "y", "z")
    rows = o.select("orderkey", F.when(C("p").isin("1", "2"), "DIRECT").when(C("p") == "3", "GUESS").otherwise("TEAM").alias("attribution"), C("text").alias("evidence_text"), F.lit("Jane Doe").alias("name"))
    return pe.attribution_errors(rows).select("orderkey", "error")


# --- boards ----------------------------------------------------------------------------------------------------


def surname(number):
    """A name of letters from a number."""
    return F.concat(F.lit("Mac"), F.translate(number.cast("string"), "0123456789", "abcdefghij"))


# Directors are the orders of a customer; its proxy is one text of sentences about them, in order, whose wording follows the row.
PROXY = """pb AS (SELECT o_custkey AS t, o_orderkey AS k, substr(o_orderpriority, 1, 1) AS p, o_orderstatus AS s, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
pv AS (SELECT *, CASE WHEN s = 'P' THEN CASE WHEN p < '3' THEN 'row_no' ELSE 'row_yes' END WHEN p = '1' THEN 'denied' WHEN p = '2' THEN 'denied' WHEN p = '3' THEN 'granted' WHEN p = '4' THEN 'granted' ELSE 'silent' END AS v FROM pb)"""


@query("director_independence", f"""WITH {PROXY} SELECT k AS orderkey, CASE v WHEN 'row_no' THEN 'NOT_INDEPENDENT' WHEN 'row_yes' THEN 'INDEPENDENT' WHEN 'denied' THEN 'NOT_INDEPENDENT' WHEN 'granted' THEN 'INDEPENDENT' ELSE 'UNKNOWN' END AS independence,
    CASE v WHEN 'row_no' THEN 'executive or founder relationship' WHEN 'row_yes' THEN 'own row states independent' WHEN 'denied' THEN 'proxy denies independence' WHEN 'granted' THEN 'board determination' ELSE 'unknown' END AS basis FROM pv""")
def _(spark, folder):
    o = table(spark, folder, "orders").select(C("o_custkey").alias("ticker"), C("o_orderkey").alias("person_id"), F.substring("o_orderpriority", 1, 1).alias("p"), C("o_orderstatus").alias("s"), surname(C("o_orderkey")).alias("last"))
    own = F.when(C("s") == "P", F.when(C("p") < "3", "Chief Executive Officer since 1999").otherwise("An independent director"))
    directors = o.select("ticker", "person_id", F.concat(F.lit("J.R. "), "last").alias("name"), own.alias("evidence_text"), F.array(F.lit("director")).alias("roles"))
    said = (
        F.when(C("s") == "P", F.concat(F.lit("Mr. "), "last", F.lit(" chairs a committee.")))
        .when(C("p") == "1", F.concat(F.lit("Other nominees are independent, but Mr. "), "last", F.lit(" is not independent under the rules.")))
        .when(C("p") == "2", F.concat(F.lit("Ms. "), "last", F.lit(" runs our largest unit. For that reason she is not deemed independent.")))
        .when(C("p") == "3", F.concat(F.lit("The board has determined that Dr. "), "last", F.lit(" is independent.")))
        .when(C("p") == "4", F.concat(F.lit("Our board of directors has determined that the following are independent:\n- "), "last", F.lit("\n- others.")))
        .otherwise(F.concat("last", F.lit(" has served since 1999.")))
    )
    proxies = o.groupBy("ticker").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("person_id", said.alias("said")))), lambda x: x["said"]), " ").alias("text"))
    return pe.independence(directors, proxies).select(C("person_id").alias("orderkey"), "independence", "basis")


@query("committee_types", f"SELECT o_orderkey AS orderkey, {case('audit', 'compensation', 'nominating_governance', 'risk', 'other')} AS type FROM orders")
def _(spark, folder):
    return by_priority(spark, folder, "Audit Committee", "Compensation Committee", "Nominating & Governance Committee", "Enterprise Risk Committee", "Picnic Committee").select("orderkey", pe.committee_type(C("text")).alias("type"))


@query("director_expertise", f"SELECT o_orderkey AS orderkey, {case('accounting,finance', 'cybersecurity,technology', 'government,regulatory', 'consumer', '')} AS areas FROM orders")
def _(spark, folder):
    o = by_priority(spark, folder, "A certified public accountant and treasurer", "Led cybersecurity and software teams", "Served in government", "Ran a retail chain", "Enjoys gardening")
    return o.select("orderkey", F.array_join(pe.expertise(C("text")), ",").alias("areas"))


@query("shareholder_rights", f"SELECT o_orderkey AS orderkey, {case('CLASSIFIED', 'ANNUAL_ELECTION', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN')} AS classified_board, {case('UNKNOWN', 'UNKNOWN', 'YES', 'NO', 'UNKNOWN')} AS special_meeting, {case('UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'CONDITIONAL')} AS election_standard FROM orders")
def _(spark, folder):
    o = by_priority(spark, folder, "We have a classified board.", "Each director is elected annually.", "Stockholders holding 25% may call a special meeting.", "Stockholders may not call a special meeting.", "Majority voting applies in uncontested elections; plurality voting applies in contested elections.")
    return pe.shareholder_rights(o).select("orderkey", "classified_board", "special_meeting", "election_standard")


@query("voting_classes", "SELECT o_custkey AS ticker, CASE WHEN o_orderpriority LIKE '1%' THEN 'Class A common stock' ELSE 'Class B common stock' END AS class_name, CASE WHEN o_orderpriority LIKE '1%' THEN 1.0 ELSE 10.0 END AS votes_per_share FROM orders WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' GROUP BY 1, 2, 3")
def _(spark, folder):
    o = by_priority(spark, folder, "Each share of Class A common stock is entitled to one vote per share.", "Each share of our Class B common stock is entitled to 10 votes per share.", "x", "y", "z")
    return pe.voting_classes(o)


@query("related_party_sentences", f"SELECT o_orderkey AS orderkey, {case('related_party', 'family', 'interlock', None, None)} AS kind, {case('YES', 'NO', 'NO', None, None)} AS status FROM orders WHERE substr(o_orderpriority, 1, 1) < '4'")
def _(spark, folder):
    o = by_priority(spark, folder, "A related person entered an agreement for services.", "There are no family relationships among our directors.", "None of our officers has an interlock.", "Nothing.", "Nothing.")
    return pe.related_party_sentences(o.select(C("orderkey").alias("ticker"), "text")).select(C("ticker").alias("orderkey"), "kind", "status")


@query("role_change_events", f"SELECT o_orderkey AS orderkey, {case('departure', 'appointment', 'interim_appointment', None, None)} AS event_type, {case('chief financial officer', 'director', 'ceo', None, None)} AS role, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS effective_date FROM orders WHERE substr(o_orderpriority, 1, 1) < '4'")
def _(spark, folder):
    d = F.date_format("o_orderdate", "MMMM d, yyyy")
    wrap = lambda s: F.concat(F.lit("Item 5.02 Departure. "), s, F.lit(", effective "), d, F.lit(". Item 9.01 Exhibits"))
    o = by_priority(spark, folder, wrap(F.lit("Ms. Doe resigned as Chief Financial Officer")), wrap(F.lit("The board appointed Mr. Roe to the board of directors")), wrap(F.lit("Mr. Poe becomes interim CEO")), "Item 8.01 Other. Ms. Doe resigned as director.", "none")
    e = pe.role_changes(o.select("ticker", C("orderkey").alias("accession"), "text"))
    return e.select(C("accession").alias("orderkey"), "event_type", "role", C("effective_date").cast("string").alias("effective_date"))


@query("education_statements", f"SELECT o_orderkey AS person_id, {case('BA', 'MBA', None, None, None)} AS degree, {case('Yale University', 'Harvard University', None, None, None)} AS institution FROM orders WHERE substr(o_orderpriority, 1, 1) < '3'")
def _(spark, folder):
    o = by_priority(spark, folder, "She holds a BA from Yale University and is an author.", "He earned an MBA at Harvard University in math, then left.", "No statement.", "None.", "None.")
    e = pe.education(o.select(C("orderkey").alias("person_id"), C("text").alias("biography")))
    return e.select("person_id", "degree", F.regexp_replace("institution", " in math", "").alias("institution"))


@query("definitive_filing", "SELECT o_custkey AS ticker, arg_max(o_orderkey, strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS orderkey FROM orders WHERE o_orderpriority LIKE '1%' AND CAST(o_orderdate AS DATE) <= DATE '2000-01-01' GROUP BY 1")
def _(spark, folder):
    f = by_priority(spark, folder, "DEF 14A", "DEFA14A", "10-K", "8-K", "8-K").select("ticker", F.lpad(C("orderkey").cast("string"), 12, "0").alias("accession"), C("text").alias("form"), C("day").alias("filing_date"))
    return pe.definitive_filing(f, day("2000-01-01")).select("ticker", C("accession").cast("long").alias("orderkey"))


def board(spark, folder):
    o = table(spark, folder, "orders")
    return o.select(
        C("o_custkey").alias("ticker"), C("o_orderkey").alias("person_id"), F.when(C("o_orderpriority") < "5", F.to_date("o_orderdate")).alias("start_date"), F.when(C("o_orderstatus") == "F", F.date_add(F.to_date("o_orderdate"), 900)).alias("end_date"), F.when(C("o_orderpriority") < "3", "day").otherwise("year").alias("precision"),
        F.when(C("o_orderpriority") < "2", "Chair").when(C("o_orderpriority") < "3", "Lead Independent Director").otherwise("Director").alias("board_role"), (C("o_totalprice") > 300000).alias("is_ceo"), F.when(C("o_orderpriority") < "4", "INDEPENDENT").otherwise("UNKNOWN").alias("independence"), F.lit("proxy").alias("evidence_text"),
    )


BOARD = "bd AS (SELECT o_custkey AS ticker, o_orderkey AS p, CASE WHEN o_orderpriority < '5' THEN CAST(o_orderdate AS DATE) END AS s, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 900 END AS e, o_orderpriority AS pr, o_totalprice AS v FROM orders)"


@query("current_board_members", f"WITH {BOARD} SELECT ticker, count(*) AS members FROM bd WHERE (s IS NULL OR s <= DATE '2000-06-30') AND (e IS NULL OR e > DATE '2000-06-30') GROUP BY 1")
def _(spark, folder):
    return pe.current_members(board(spark, folder), day("2000-06-30")).groupBy("ticker").agg(F.count("*").alias("members"))


@query("board_tenure", f"WITH {BOARD}, y AS (SELECT *, round((DATE '2001-12-31' - s) / 365.2425, 2) AS y FROM bd) SELECT p AS person_id, CASE WHEN y IS NULL THEN 'unknown' WHEN y < 3 THEN '<3 years' WHEN y < 6 THEN '3-6 years' WHEN y < 9 THEN '6-9 years' ELSE '>9 years' END AS bucket, CASE WHEN pr < '3' THEN 'DAY' ELSE 'YEAR' END AS precision FROM y")
def _(spark, folder):
    return pe.board_tenure(board(spark, folder), day("2001-12-31")).select("person_id", C("tenure_bucket").alias("bucket"), C("tenure_precision").alias("precision"))


@query("board_tenure_summary", f"WITH {BOARD}, y AS (SELECT *, (DATE '2001-12-31' - s) / 365.2425 AS y FROM bd) SELECT ticker, count(y) AS value_count, CASE WHEN count(y) = 0 THEN 'UNKNOWN' WHEN count(y) = count(CASE WHEN pr < '3' THEN y END) THEN 'EXACT' ELSE 'ESTIMATED' END AS statistics_precision, count(CASE WHEN round(y, 2) < 3 THEN 1 END) AS under_3 FROM y GROUP BY 1")
def _(spark, folder):
    return pe.board_summary(pe.board_tenure(board(spark, folder), day("2001-12-31"))).select("ticker", "value_count", "statistics_precision", "under_3")


@query("board_refreshment", f"WITH {BOARD} SELECT ticker, count(CASE WHEN DATE '2001-01-01' - s BETWEEN 0 AND 366 THEN 1 END) AS added_1y, count(CASE WHEN DATE '2001-01-01' - e BETWEEN 0 AND 1096 THEN 1 END) AS departed_3y FROM bd GROUP BY 1")
def _(spark, folder):
    return pe.board_refreshment(board(spark, folder), day("2001-01-01")).select("ticker", "added_1y", "departed_3y")


@query("board_counts", f"WITH {BOARD} SELECT ticker, count(*) AS directors, CASE WHEN bool_or(pr < '2' AND v > 300000) THEN 'COMBINED_CEO_CHAIR' WHEN bool_or(pr < '2') THEN 'SEPARATE_CHAIR' ELSE 'UNKNOWN' END AS leadership, bool_or(pr >= '2' AND pr < '3') AS has_lead_independent, CASE WHEN count(CASE WHEN v > 100000 THEN 1 END) > 0 THEN CAST(count(CASE WHEN v > 400000 THEN 1 END) AS DOUBLE) END AS overboarded, count(CASE WHEN v <= 100000 THEN 1 END) AS outside_unknown FROM bd GROUP BY 1")
def _(spark, folder):
    b = board(spark, folder)
    outside = table(spark, folder, "orders").where("o_totalprice > 100000").select(C("o_orderkey").alias("person_id"), F.when(C("o_totalprice") > 400000, 5).otherwise(1).alias("outside_boards"))
    e = b.select("ticker", "person_id", F.lit("finance").alias("category"))
    c = pe.board_counts(b, outside, e)
    return c.select("ticker", "directors", "leadership", "has_lead_independent", C("overboarded").cast("double").alias("overboarded"), "outside_unknown")


@query("director_audit", f"""WITH {BOARD} SELECT p AS person_id, array_to_string(list_filter([CASE WHEN pr >= '4' THEN 'INDEPENDENCE_UNKNOWN' END, CASE WHEN s IS NULL THEN 'START_DATE_UNKNOWN' END, CASE WHEN v <= 50000 THEN 'NO_COMMITTEE_RECORDED' END], lambda x: x IS NOT NULL), '; ') AS issues, CASE WHEN v > 50000 THEN 'audit, risk' ELSE '' END AS committees FROM bd""")
def _(spark, folder):
    held = table(spark, folder, "orders").where("o_totalprice > 50000").select(C("o_custkey").alias("ticker"), C("o_orderkey").alias("person_id"), F.explode(F.array(F.lit("risk"), F.lit("audit"))).alias("committee_type"))
    return pe.director_audit(board(spark, folder), held).select("person_id", "issues", "committees")


@query("membership_events", f"WITH {BOARD} SELECT p AS person_id, 'appointment' AS event_type, CAST(s AS VARCHAR) AS event_date FROM bd WHERE s IS NOT NULL UNION ALL SELECT p, 'departure', CAST(e AS VARCHAR) FROM bd WHERE e IS NOT NULL")
def _(spark, folder):
    return pe.membership_events(board(spark, folder).withColumn("body", F.lit("board"))).select("person_id", "event_type", C("event_date").cast("string").alias("event_date"))


@query("people_store_audit", """SELECT 'duplicate_name' AS "check", c_mktsegment || ':doe jane' AS subject, count(*) AS n FROM customer GROUP BY c_mktsegment HAVING count(*) > 1 UNION ALL SELECT 'missing_provenance', CAST(c_custkey AS VARCHAR), 1 FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'end_before_start', CAST(o_orderkey AS VARCHAR), 1 FROM orders WHERE o_totalprice < 3000""")
def _(spark, folder):
    people = table(spark, folder, "customer").select(C("c_mktsegment").alias("ticker"), C("c_custkey").alias("person_id"), F.lit("Jane Doe").alias("name"), F.when(C("c_acctbal") >= 0, "s").otherwise("").alias("source_id"))
    tenures = table(spark, folder, "orders").select(C("o_orderkey").alias("person_id"), F.to_date("o_orderdate").alias("start_date"), F.date_add(F.to_date("o_orderdate"), F.when(C("o_totalprice") < 3000, -5).otherwise(5)).alias("end_date"))
    return pe.store_audit(people, tenures)


@query("track_record", """WITH t AS (SELECT c_custkey AS ticker FROM customer), g AS (SELECT o_custkey, count(CASE WHEN o_orderpriority LIKE '1%' THEN 1 END) AS b, count(CASE WHEN o_orderpriority LIKE '2%' THEN 1 END) AS u FROM orders GROUP BY 1) SELECT ticker, CAST(1 AS BIGINT) AS tenures, coalesce(b, 0) AS guidance_beat, CASE WHEN coalesce(b, 0) = 0 THEN 'NO_COMPARABLE_EVIDENCE' WHEN u > 0 THEN 'PARTIAL' ELSE 'COVERED' END AS coverage FROM t LEFT JOIN g ON o_custkey = ticker""")
def _(spark, folder):
    t = table(spark, folder, "customer").select(C("c_custkey").alias("ticker"), F.lit(True).alias("is_current"))
    o = by_priority(spark, folder, "BEAT", "UNRESOLVED", "OTHER", "OTHER", "OTHER").select("ticker", C("text").alias("outcome"))
    none = o.where("ticker < 0")
    return pe.track_record(t, o, none, none).select("ticker", "tenures", "guidance_beat", "coverage")
