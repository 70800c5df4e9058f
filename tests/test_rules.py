"""Finance rules on hand-written sentences, snapshot rules, histories, incremental loads, trades and boards."""

import datetime as dt
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from gaugework.functions import dates, numbers
from gaugework.functions import rules as R
from gaugework.functions import text as tx
from gaugework.operators import crosssection as cs
from gaugework.operators import facts as fo
from gaugework.operators import features as ft
from gaugework.operators import history as hs
from gaugework.operators import people as pe
from gaugework.operators import quality as ql
from gaugework.operators import state as sa
from gaugework.operators import text as ops
from gaugework.params import HistoryParams, SnapshotParams, checked_weights, with_overrides
from gaugework.sources import tables as st
from gaugework.streaming import incremental as inc

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,want", [("31/03/2020", D(2020, 3, 31)), ("2020-01-31", D(2020, 1, 31)), ("29/02/2020", D(2020, 2, 29)), ("43861", D(2020, 1, 31)), ("01/02/03", None), ("2020-02-30", None), ("true", None), ("43861.5", None)])
def test_strict_dates(spark, text, want):
    assert one(spark, dates.strict_date(F.lit(text))) == want


@pytest.mark.parametrize("text,want", [("260106", D(2026, 1, 6)), ("01/20/2026", D(2026, 1, 20)), ("46058", D(2026, 2, 5))])
def test_report_dates(spark, text, want):
    assert one(spark, dates.report_date(F.lit(text))) == want


def test_utc_and_leap_years(spark):
    assert str(one(spark, dates.to_utc(F.lit("2026-09-29T12:30:00")))) == "2026-09-29 16:30:00"
    assert one(spark, dates.same_day_last_year(F.lit("2024-02-29").cast("date"))) == D(2023, 2, 28)


def test_numbers(spark):
    assert one(spark, numbers.strict_number(F.lit("1,000"))) is None and one(spark, numbers.lenient_number(F.lit("1,000%"))) == 1000
    assert str(one(spark, numbers.quantise5(F.lit(2.000005)))) == "2.00001"
    assert one(spark, numbers.equal_within(F.lit(None).cast("double"), F.lit(None).cast("double"))) is True


def test_eps_growth(spark):
    df = spark.createDataFrame([(2.0, 3.0), (0.0, 3.0), (-2.0, 3.0), (2.0, None)], "eps_f1 double, eps_f2 double")
    got = [(r["eps_growth_pct"], r["eps_growth_reason"]) for r in ft.eps_growth(df).collect()]
    assert got == [(50.0, None), (None, "ZERO_BASE"), (None, "NONPOSITIVE_BASE"), (None, "MISSING_INPUT")]


def snapshot(spark, n_industry):
    rows = [(f"T{i}", i, f"I{i % n_industry}", "S", "m", float(i)) for i in range(12)]
    return spark.createDataFrame(rows, "ticker string, source_row long, industry string, sector string, metric string, value double")


def test_peer_shrinkage_and_small_sectors(spark):
    rows = [("A", i) for i in range(4)] + [("B", i) for i in range(2)]
    df = spark.createDataFrame([(f"{g}{i}", i, g, "S", "m", float(i + len(g))) for g, i in rows], "ticker string, source_row long, industry string, sector string, metric string, value double")
    got = {r["industry"]: r["industry_weight"] for r in cs.peer_statistics(df).collect()}
    assert got["A"] == pytest.approx(4 / 12) and got["B"] == pytest.approx(2 / 10)
    small = df.withColumn("sector", F.col("industry"))
    assert {r["comparison"] for r in cs.peer_statistics(small).collect()} == {"INSUFFICIENT SECTOR PEERS"}


def test_constant_set_scores_fifty(spark):
    df = spark.createDataFrame([(f"T{i}", i, "I", "S", "m", 0.1 if i < 10 else None) for i in range(11)], "ticker string, source_row long, industry string, sector string, metric string, value double")
    assert sorted(str(r["peer_score"]) for r in cs.peer_statistics(df).collect()) == ["50.0"] * 10 + ["None"]


def test_candidate_ties_and_conflicts(spark):
    base = "ticker string, source_row long, industry string, long_score double, short_score double, confidence double, short_confidence double, long_gate boolean, short_gate boolean"
    tie = spark.createDataFrame([(t, i, "I", 60.0, 0.0, 90.0, 90.0, True, False) for i, t in enumerate("DBAC")], base)
    picked = {r["ticker"] for r in cs.select_candidates(tie).where("candidate = 'QUANT LONG'").collect()}
    assert picked == {"A", "B", "C"}
    both = spark.createDataFrame([("A", 1, "I", 90.0, 80.0, 90.0, 90.0, True, True), ("B", 2, "I", 10.0, 95.0, 90.0, 90.0, True, True)], base)
    got = {r["ticker"]: (r["candidate"], r["conflict"]) for r in cs.select_candidates(both).collect()}
    assert got == {"A": ("QUANT LONG", True), "B": ("QUANT SHORT", False)}


def test_solvency_by_business_type(spark):
    rows = [("Equity REIT", "Property", 11.0), ("Regional Banks", "Finance", None), ("Unknown lending", "Finance", None), ("Mortgage REIT", "Finance", None)]
    df = spark.createDataFrame([(f"T{i}", a, b, c) for i, (a, b, c) in enumerate(rows)], "ticker string, industry string, sector string, long_term_debt_ebitda double")
    full = ft.business_type(df).withColumns({c: F.lit(None).cast("double") for c in ("long_term_debt_ebit", "debt_equity_ratio", "debt_total_capital_ratio", "common_equity", "current_ratio")})
    assert [r["solvency_pass"] for r in ft.solvency_gate(full).orderBy("ticker").collect()] == [False, True, False, False]


def test_user_feature_and_parameters(spark):
    registry = ft.default_features()
    assert len(registry.features) == 50
    registry.add(ft.Feature("cash_share", ("cash", "market_cap"), "cap > 0", "VALUATION", "higher_better", "cash", lambda a, b: a / b))
    with pytest.raises(ValueError):
        registry.add(registry.features["cash_share"])
    got = registry.apply(spark.createDataFrame([(1.0, 4.0)], "cash double, market_cap double"), reasons=False).first()
    assert got["cash_share"] == 0.25 and got["book_yield"] is None
    controls = spark.createDataFrame([("decay", "0.5"), ("min_points", "3")], "name string, value string")
    assert with_overrides(HistoryParams(), controls).min_points == 3
    with pytest.raises(ValueError):
        with_overrides(SnapshotParams(), spark.createDataFrame([("nope", "1")], "name string, value string"))
    with pytest.raises(ValueError):
        checked_weights({"a": 0.4}, 1.0)


def test_history_and_contributions(spark):
    rows = [(t, 10 * k + i, 2022 + i, D(2022 + i, 12, 31), 100.0 * s * g, 10.0 * s * g) for k, (t, s) in enumerate((("AAA", 1.0), ("BBB", 0.7), ("CCC", 0.4))) for i, g in enumerate((1.0, 1.1, 1.25, 1.5))]
    f = hs.history_features(spark.createDataFrame(rows, "ticker string, source_row long, fiscal_year int, fiscal_period_end date, revenue double, net_income double")).collect()
    assert {r["history_years"] for r in f} == {4}
    assert all(r["revenue_cagr"] == pytest.approx(1.5 ** (1 / 3) - 1) and r["revenue_four_year_trend"] > 0 and 0 <= r["revenue_four_year_trend_r2"] <= 1 for r in f)
    scores = spark.createDataFrame([("AAA", "a", 60.0), ("AAA", "b", 80.0), ("AAA", "c", None), ("AAA", "d", 20.0)], "ticker string, metric string, score double")
    registry = spark.createDataFrame([("a", "F", "g1", 1.0), ("b", "F", "g1", 3.0), ("c", "F", "g2", 1.0), ("d", "H", "g3", 1.0)], "metric string, family string, duplicate_group string, metric_weight double")
    final, fam, metric = hs.weighted_families(scores, registry, spark.createDataFrame([("F", 3.0), ("H", 1.0)], "family string, family_weight double"))
    score = final.first()["final_score"]
    assert score == pytest.approx((75 * 3 + 20) / 4)
    assert sum(r["final_contribution"] or 0 for r in metric.collect()) == pytest.approx(score, abs=1e-9)
    assert hs.score_reconciliation(final, fam).count() == 0


def test_fill_and_append(spark):
    def cells(rows):
        return spark.createDataFrame([("d", s, D.fromisoformat(d), v) for d, a, b in rows for s, v in (("a", a), ("b", b))], "dataset string, series string, obs_date date, value double")

    stored = cells([("2026-01-31", 1.0, None), ("2026-02-28", None, 2.0)])
    incoming = cells([("2026-01-31", 99.0, 11.0), ("2026-02-28", 22.0, 20.0), ("2026-03-31", 3.0, 4.0)])
    plan = inc.plan_merge(stored, incoming)
    got = {(str(r["obs_date"]), r["series"]): r["value"] for r in inc.merged_table(plan).collect()}
    assert got == {("2026-01-31", "a"): 1, ("2026-01-31", "b"): 11, ("2026-02-28", "a"): 22, ("2026-02-28", "b"): 2, ("2026-03-31", "a"): 3, ("2026-03-31", "b"): 4}
    again = inc.plan_merge(inc.merged_table(plan), incoming)
    assert {r["action"] for r in again.select("action").distinct().collect()} == {"kept"}
    gap = inc.plan_merge(cells([("2026-01-31", 1.0, 1.0), ("2026-03-31", 1.0, 1.0)]), cells([("2026-02-28", 5.0, 5.0)]))
    assert [str(r["obs_date"]) for r in inc.late_dates(gap).collect()] == ["2026-02-28"]


def test_report_audit(spark):
    rows = [("A old", "001", "2026-01-06"), ("A old", "001", "2026-01-20"), ("A new", "001", "2026-01-20"), ("A new", "001", "2026-01-27"), ("A new", "001", "bad"), ("A new", "001", "2026-02-03"), ("B", "002", "2026-01-06"), ("B", "002", "2026-01-13"), ("C", "003", "bad")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "source_row long, market string, code string, text string").withColumn("report_date", dates.report_date(F.col("text")))
    got = {r["code"]: r for r in ql.report_audit(df, F.lit("2026-01-30").cast("date"), inactive_after=2).collect()}
    a = got["001"]
    assert (a["asset"], a["missing_dates"], a["duplicate_rows"], a["invalid_rows"], a["future_rows"]) == ("A new", "2026-01-13", 1, 1, 1)
    assert got["002"]["reports_behind"] == 2 and got["002"]["reporting_status"] == "POSSIBLY_INACTIVE_OR_DISCONTINUED" and got["002"]["missing_count"] == 0
    assert got["003"]["freshness"] == "NO_VALID_DATES" and str(a["source_latest"]) == "2026-01-27"


def test_trailing_twelve_months(spark):
    schema = "ticker string, metric string, concept string, unit string, start string, end string, val double, form string, accn string, filed string, accepted_at string, priority int, fp string"
    rows = [
        ("T", "revenue", "R", "USD", "2025-01-01", "2025-12-31", 100.0, "10-K", "a", "2026-02-01", "2026-02-01", 0, "FY"), ("T", "revenue", "R", "USD", "2025-01-01", "2025-12-31", 200.0, "10-K/A", "b", "2026-10-01", "2026-10-01", 0, "FY"),
        ("T", "revenue", "R", "USD", "2026-01-01", "2026-06-30", 60.0, "10-Q", "c", "2026-08-01", "2026-08-01", 0, "Q2"), ("T", "revenue", "R", "USD", "2025-01-01", "2025-06-30", 45.0, "10-Q", "d", "2025-08-01", "2025-08-01", 0, "Q2"),
    ]
    facts = spark.createDataFrame(rows, schema).withColumns({c: F.col(c).cast("date") for c in ("start", "end", "filed")}).withColumn("accepted_at", F.col("accepted_at").cast("timestamp_ntz"))

    def run(report_end):
        reports = spark.createDataFrame([("T",)], "ticker string").select("ticker", F.lit("2026-09-29 16:00:00").cast("timestamp_ntz").alias("decision_at"), F.lit(report_end).cast("date").alias("report_end"))
        r = fo.trailing_twelve_months(facts, reports, "ticker").first()
        return r["ttm"], r["method"]

    assert run("2026-06-30") == (115.0, "ANNUAL_PLUS_YTD_MINUS_PRIOR_YTD")
    assert run("2026-09-30") == (None, "CURRENT_YTD_MISSING_OR_CONCEPT_CHANGED")


def test_trade_rules_and_clusters(spark):
    rows = [("1", "P", "A", [], 1000.0, 11000.0), ("2", "S", "D", ["pursuant to a Rule 10b5-1 plan"], 500.0, 10500.0), ("3", "M", "A", [], 200.0, None), ("4", "A", "A", ["RSU vesting"], 1.0, None)]
    t = pe.classify_trades(spark.createDataFrame([(i, c, s, "x", n, None, q, a) for i, c, s, n, q, a in rows], "transaction_id string, code string, acquired_disposed string, security_title string, footnotes array<string>, plan boolean, shares double, shares_after double"))
    assert [r["transaction_type"] for r in t.orderBy("transaction_id").collect()] == ["open_market_purchase", "automatic_sale", "option_exercise", "rsu_vesting"]
    assert [r["shares_before"] for r in pe.holdings_before(t).orderBy("transaction_id").collect()] == [10000, 11000, None, None]
    c = spark.createDataFrame([("a", "T", "purchase", "p1", D(2026, 9, 1), 1.0), ("b", "T", "purchase", "p2", D(2026, 9, 10), 2.0), ("c", "T", "purchase", "p1", D(2026, 12, 1), 4.0)], "transaction_id string, ticker string, side string, person_id string, transaction_date date, value double")
    got = pe.trade_clusters(c).collect()
    assert len(got) == 1 and got[0]["people"] == 2 and got[0]["combined_value"] == 3.0


def test_guidance_outcomes(spark):
    schema = "guidance_id string, ticker string, metric string, horizon string, low double, high double, point double, unit string, basis string, status string"
    mk = lambda i, **k: tuple({**dict(guidance_id=i, ticker="T", metric="revenue", horizon="FY2025", low=90.0, high=100.0, point=None, unit="USD", basis=None, status="issued"), **k}.values())
    g = spark.createDataFrame([mk("in"), mk("w", status="withdrawn"), mk("unit", unit="PERCENT"), mk("far", horizon="FY2030"), mk("basis", basis="NON_GAAP")], schema)
    facts = spark.createDataFrame([("T", "revenue", 2025, "FY", "USD", "GAAP", 95.0, D(2025, 12, 31), D(2026, 2, 1))], "ticker string, metric string, fiscal_year int, fiscal_period string, unit string, basis string, value double, period_end date, filed date")
    outcome = lambda v: {r["guidance_id"]: r["outcome"] for r in pe.guidance_outcomes(g, facts.withColumn("value", F.lit(v)), F.lit("2026-12-31").cast("date")).collect()}
    got = outcome(95.0)
    assert got == {"in": "MET", "w": "WITHDRAWN", "unit": "NOT_COMPARABLE", "far": "UNRESOLVED", "basis": "NOT_COMPARABLE"}
    assert outcome(110.0)["in"] == "BEAT" and outcome(80.0)["in"] == "MISS"


def test_tenure_overlap(spark):
    day = lambda t: F.lit(t).cast("date")
    at = lambda y: one(spark, fo.period_in_tenure(day(f"{y}-01-01"), day(f"{y}-12-31"), day("2024-07-01"), day("2026-06-30")))
    assert [at(y) for y in (2023, 2024, 2025, 2027)] == ["PRE", "PARTIAL", "FULL", "POST"]


def claims(spark, rows):
    base = spark.createDataFrame([Row(claim_id=c, ticker="T", document_id="d" + c, fiscal_year=y, fiscal_quarter=q, period_label=f"Q{q} {y}", period_type=t, dimension=dim, topic=dim, direction=di, certainty=ce, evidence_text=e) for c, y, q, t, dim, di, ce, e in rows])
    return base.withColumn("magnitude", tx.magnitudes(F.col("evidence_text")))


Q = "QUARTER_ACTUAL"


@pytest.mark.parametrize("after,want", [("1.9", "raised"), ("1.7", "lowered"), ("1.8", "reiterated")])
def test_guidance_change(spark, after, want):
    c = claims(spark, [("1", 2026, 1, Q, "guidance", "unknown", "guidance", "Revenue guidance is $1.8 billion"), ("2", 2026, 2, Q, "guidance", "unknown", "guidance", f"Revenue guidance is ${after} billion")])
    assert [r["change_type"] for r in sa.compare_periods(c)[0].collect()] == [want]


def test_silence_and_removed_risk(spark):
    c = claims(spark, [("1", 2026, 1, Q, "risks", "negative", "risk", "Supplier concentration risk remains high"), ("2", 2026, 2, Q, "risks", "unknown", "risk", "Supplier concentration is no longer a risk"), ("3", 2026, 1, Q, "demand", "increasing", "actual", "Demand grew strongly")])
    got = [(r["dimension"], r["change_type"]) for r in sa.compare_periods(c)[0].collect()]
    assert ("demand", "removed") not in got and all(d == "risks" for d, _ in got)
    assert [r["side"] for r in sa.period_pair(claims(spark, [("a", 2026, 1, Q, "x", "unknown", "actual", "t"), ("b", 2026, 2, Q, "x", "unknown", "actual", "t"), ("c", 2026, None, "FULL_YEAR_GUIDANCE", "x", "unknown", "guidance", "t")])).orderBy("claim_id").collect()] == ["previous", "current"]


@pytest.mark.parametrize("text,dimension,direction,certainty", [
    ("We raised our revenue guidance for the year to $2 billion.", "guidance", "raised", "guidance"),
    ("Revenue grew 12% year over year in the quarter.", "revenue", "increasing", "actual"),
    ("Supply shortage risk may increase costs next year.", "costs", "increasing", "risk"),
])
def test_claim_rules(spark, text, dimension, direction, certainty):
    got = ops.sentence_claims(spark.createDataFrame([("d", text)], "doc string, sentence string")).first()
    assert (got["dimension"], got["direction"], got["certainty"]) == (dimension, direction, certainty)


def test_noise_and_user_dimension(spark):
    df = spark.createDataFrame([("d", "Thank you for the question on revenue growth."), ("d", "Could you discuss revenue growth?"), ("d", "The water supply expanded by 4% in the region.")], "doc string, sentence string")
    rules = R.ClaimRules().with_dimension(R.Rule("water", "water", (r"\bwater\b",)))
    assert [r["dimension"] for r in ops.sentence_claims(df, rules).collect()] == ["water"]


def test_near_duplicates_and_offsets(spark):
    text = "Revenue grew to $5 million in the quarter. Our revenue grew to $5 million during the quarter. Revenue grew to $5 million in the quarter."
    docs = spark.createDataFrame([("d", text)], "doc string, text string")
    got = ops.extract_claims(docs, "doc").collect()
    assert len(got) == 1 and text[got[0]["start_char"]:got[0]["end_char"]] == got[0]["sentence"]
    assert ops.evidence_errors(ops.extract_claims(docs, "doc"), docs, "doc").where("errors <> ''").count() == 0


def test_rolling_captions(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [("d", i, 24.0 * i, 24.0 * i + 25, "s", " ".join(words[max(0, 5 * i - 3):5 * i + 5])) for i in range(25)]
    got = ops.rolling_captions(spark.createDataFrame(rows, "doc string, cue_no int, start double, end double, speaker string, text string"), "doc").collect()
    assert len(got) == 25 and sum(r["removed_words"] for r in got) == 72


def test_captions_and_pages(spark):
    body = "WEBVTT\n\nNOTE x\n\n00:00:01.000 --> 00:00:02.500\n<v Ann>Tom &amp; Jo</v>\n\nchapter-1\n00:00:03.000 --> 00:00:04.000\nIntro"
    got = ops.cues(spark.createDataFrame([("d", body)], "doc string, body string"), "doc").orderBy("cue_no").collect()
    assert [(r["start"], r["end"], r["speaker"], r["text"], r["chapter"]) for r in got] == [(1.0, 2.5, "Ann", "Tom & Jo", False), (3.0, 4.0, None, "Intro", True)]
    html = "<html><nav>menu</nav><p>Hello <b>you</b></p><div class='cookie-bar'><div>no</div></div><script>x()</script><table><tr><td>Total</td><td>1,250</td><td>-</td></tr></table></html>"
    page = spark.createDataFrame([(1, html)], "id int, html string")
    assert ops.visible_text(page, "id").first()["text"].split("\n")[0] == "Hello you" and "menu" not in ops.visible_text(page, "id").first()["text"]
    assert ops.table_row_numbers(page, "id", "total").first()["numbers"] == [1250.0]


def test_addresses(spark):
    assert one(spark, tx.navigation_url(F.lit("HTTPS://Ex.com:443/a/?utm_source=x&b=2&a=1#f"))) == "https://ex.com/a?a=1&b=2"
    assert one(spark, tx.is_public(F.lit("http://192.168.1.2/x"))) is False and one(spark, tx.is_blocked(F.lit("https://www.reuters.com/x"))) is True
    assert one(spark, tx.redact(F.lit("see https://a.b/c?token=abc&k=1 or me@x.com"))) == "see https://a.b/c?token=REDACTED&k=1 or [configured email]"


def test_json_lines_and_stores(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "1", "v": 2}\nnot json\n[1]\n{"id": "2", "v": 3}\n')
    rows = st.read_json_lines(spark, str(tmp_path / "x.jsonl"), "id string, v int")
    assert sorted((r["id"], r["v"]) for r in rows.collect()) == [("1", 2), ("2", 3)]
    scored = spark.createDataFrame([("A", "I1", 1.0, 2.0), ("B", "I2", 3.0, 4.0)], "ticker string, industry string, net_score double, long_score double")
    st.write_audit(scored, scored.limit(0), scored.limit(1), str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit/scored")).count() == 2
    (tmp_path / "grid.csv").write_text("Date,a,b,b\n31/01/2020,1,x,1\n29/02/2020,,2,2\n")
    series, issues = st.wide_from_csv(spark, str(tmp_path / "grid.csv"))
    assert sorted((r["series"], str(r["obs_date"]), r["value"]) for r in series.collect() if r["value"]) == [("a", "2020-01-31", 1.0)]
    assert {r["severity"] for r in issues.collect()} == {"warning"}


def test_claim_rules_bound_words_as_ascii_and_take_framing_from_the_rules(spark):
    from gaugework.catalog.text import PROSE

    # "on" between accented letters is a word to the SQL's engine; the finance framing "what are" is no rule of PROSE.
    df = spark.createDataFrame([("a", "Esble that onoust pa \u00e9on\u00e8 du"), ("b", "Estion of what are to tothnded now"), ("c", "Could you say that the plant is kind of new")], "doc string, sentence string")
    assert {r["doc"]: r["dimension"] for r in ops.sentence_claims(df, PROSE).collect()} == {"a": "place", "b": "owner", "c": "owner"}
    assert [r["v"] for r in df.orderBy("doc").select(tx.is_noise(F.col("sentence")).alias("v")).collect()] == [False, True, True]


def test_annual_sums_do_not_depend_on_row_order(spark, tmp_path):
    from gaugework.catalog.history import annual_rows

    # Supplier 2 has the lines of supplier 1 in reverse order; plain sums gave 0.6000000000000001 and 0.6.
    lines = [(s, p) for s in (1, 2) for p in ((0.1, 0.2, 0.3) if s == 1 else (0.3, 0.2, 0.1))]
    rows = [(s, i, i, 1, 1.0, p, 0.05, 0.04, "O", dt.datetime(1998, 1, 1)) for i, (s, p) in enumerate(lines)]
    spark.createDataFrame(rows, "l_suppkey long, l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_linestatus string, l_shipdate timestamp").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = annual_rows(spark, str(tmp_path)).collect()
    assert {r["revenue"] for r in got} == {0.6} and len({(r["net_income"], r["free_cash_flow"], r["gross_margin"], r["roa"], r["debt_to_equity"]) for r in got}) == 1
    odd = spark.createDataFrame([("a", 1e30), ("a", 1.0), ("n", float("nan")), ("z", None)], "k string, v double").groupBy("k").agg(numbers.steady_sum(F.col("v")).alias("s"))
    by = {r["k"]: r["s"] for r in odd.collect()}
    assert by["a"] == 1e30 and by["n"] != by["n"] and by["z"] is None


def test_customer_sums_do_not_depend_on_row_order(spark, tmp_path):
    from gaugework.catalog.crosssection import customer_snapshot

    # Customer 2 has the orders of customer 1 in reverse order; plain sums ranked one above the other.
    prices = [0.1, 0.2, 0.3, 1234.56, 75462.67]
    orders = [(c, p) for c in (1, 2) for p in (prices if c == 1 else prices[::-1])]
    spark.createDataFrame(orders, "o_custkey long, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(c, f"C{c}", 0, 1.0, "S") for c in (1, 2, 3)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    by = {r["source_row"]: (r["order_count"], r["order_value"], r["average_order"]) for r in customer_snapshot(spark, str(tmp_path)).collect()}
    assert by[1] == by[2] and by[3] == (None, None, None)
    assert by[1][:2] == (5.0, 76697.83) and abs(by[1][2] - sum(math.log(p) for p in prices) / 5) < 1e-14


def test_sentences_and_chunks_are_whole_across_slices(spark):
    body = "One two three. " * 2_000
    docs = spark.createDataFrame([(i, body) for i in range(150)], "doc_id long, text string").coalesce(1)  # 4.5 million characters, more than two slices
    assert 150 * len(body) > 2 * ops.SLICE
    found = ops.sentences(docs, "doc_id").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("sentence_no").alias("last"), F.max("end_char").alias("end")).collect()
    assert len(found) == 150 and {(r["n"], r["last"], r["end"]) for r in found} == {(2_000, 1_999, len(body) - 1)}
    assert {r["end"] for r in ops.chunks(docs, "doc_id").groupBy("doc_id").agg(F.max("end_char").alias("end")).collect()} == {len(body) - 1}


def test_ownership_forms_are_parsed_once(spark):
    texts = [
        "<?xml version='1.0' encoding='ISO-8859-1'?>\n<f xmlns='u'><documentType> 4 </documentType><documentType>5</documentType><issuer><issuerName>A\u00f1 &amp; b</issuerName><issuerTradingSymbol>x</issuerTradingSymbol></issuer>"
        "<reportingOwner><reportingOwnerId><rptOwnerCik>1</rptOwnerCik></reportingOwnerId></reportingOwner><reportingOwner/><nonDerivativeTable><nonDerivativeTransaction><securityTitle><value>Com<!-- c -->mon</value><footnoteId id='F1'/><footnoteId id='F2'/></securityTitle>"
        "<transactionAmounts><transactionShares><value>3</value></transactionShares></transactionAmounts></nonDerivativeTransaction></nonDerivativeTable><derivativeTable><derivativeTransaction/></derivativeTable>"
        "<footnotes><footnote id='F1'>a <![CDATA[<b>]]> c</footnote><footnote id='F2'/></footnotes></f>",
        "<f><documentType>4", "", "none", None, "<f/>", "<f><documentType><i>x</i> y</documentType></f>",
    ]
    forms = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "accession string, xml string")
    want = {r[0]: r[1] for r in forms.select("accession", F.to_json(F.from_xml("xml", pe.OWNERSHIP_SCHEMA))).collect()}
    parsed = pe.ownership_forms(forms)
    assert {r[0]: r[1] for r in parsed.select("accession", F.to_json("form")).collect()} == want
    for some in (parsed, pe.ownership_forms(forms, parts=pe.TRADE_PARTS)):
        trades = pe.form_trades(some)
        assert trades._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
        assert sorted((r.security_type, r.row_index, r.shares, r.footnotes) for r in trades.where("accession = '0'").collect()) == [("derivative", 0, None, []), ("non_derivative", 0, 3.0, ["a <b> c"])]
    assert pe.form_people(pe.ownership_forms(forms, parts=pe.PEOPLE_PARTS)).count() == 2
