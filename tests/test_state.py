"""Claims between periods against the sequential rule, subjects as blocks, and the audit's read-back proof."""

import random

from pyspark.sql import functions as F

from gaugework.functions import text as tx
from gaugework.operators import state, summary
from gaugework.sources import tables

CLAIM = "ticker string, claim_id string, document_id string, fiscal_year int, fiscal_quarter int, period_label string, period_type string, dimension string, topic string, direction string, certainty string, evidence_text string"


def claims(spark, rows):
    full = [("T", i, i, y, None, f"FY {y}", "ANNUAL_ACTUAL", dim, dim, direction, "actual", said) for i, y, dim, direction, said in rows]
    return spark.createDataFrame(full, CLAIM).withColumn("magnitude", tx.magnitudes(F.col("evidence_text")))


def test_matches_equal_the_sequential_rule_with_300_claims_a_side(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(40)]
    rows = []
    for side in ("current", "previous"):
        for i in range(300):
            rows.append(("T", rng.choice("ab"), side, f"{side[0]}{i:03d}", rng.choice([None, "currency", "percent"]), rng.sample(words, rng.randrange(1, 9)), rng.choice(["demand", "costs"]), rng.choice(["ai", "other"])))
    want = {}
    for key in "ab":
        free = [r for r in sorted(rows, key=lambda r: r[3]) if r[1] == key and r[2] == "previous"]
        for _, _, _, cid, unit, tokens, dim, subject in sorted((r for r in rows if r[1] == key and r[2] == "current"), key=lambda r: r[3]):
            best, score = None, -1.0
            for p in free:
                if p[4] and unit and p[4] != unit:
                    continue
                s = 0.35 + (0.25 if p[4] and p[4] == unit else 0.0) + min(0.40, len(set(tokens) & set(p[5])) / len(set(tokens) | set(p[5])))
                if s > score:
                    best, score = p, s
            loose = dim == "demand" and subject == "ai"
            if best and score >= (0.42 if loose else 0.52):
                free.remove(best)
                want[cid] = best[3]
            else:
                want[cid] = None
    frame = spark.createDataFrame(rows, "ticker string, base_key string, side string, claim_id string, unit string, tokens array<string>, dimension string, subject string").repartition(5)
    assert {r.claim_id: r.previous_id for r in state.match_claims(frame).collect()} == want


def test_differently_worded_statements_of_one_subject_are_compared(spark):
    c = claims(spark, [
        ("p1", 2023, "costs", "increasing", "Freight and packaging costs rose sharply at all of our sites in the spring"), ("c1", 2024, "costs", "decreasing", "Freight and packaging costs rose sharply before they fell back at most sites"),
        ("p2", 2023, "costs", "unknown", "Wages of the northern plants were a burden"),
    ])
    changes, _ = state.compare_periods(c)
    got = [(r.from_claim, r.to_claim, r.change_type) for r in changes.collect()]
    assert got == [("p1", "c1", "deteriorating")] or got == [("p1", "c1", "improving")]


def test_general_praise_without_a_counterpart_is_no_change(spark):
    c = claims(spark, [
        ("p", 2023, "costs", "unknown", "Rent of the old plant was a burden"), ("c1", 2024, "catalysts", "unknown", "Our momentum excites the whole team every day"),
        ("c2", 2024, "catalysts", "unknown", "Regulators approved the second generation device"), ("c3", 2024, "strategy", "unknown", "We focus on fewer markets than before"),
    ])
    kept, _ = state.compare_periods(c)
    assert {r.to_claim for r in kept.collect()} == {"c2", "c3"}
    everything, _ = state.compare_periods(c, keep_new=F.lit(True))
    assert {r.to_claim for r in everything.collect()} == {"c1", "c2", "c3"}


def test_audit_proof_finds_lost_and_changed_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", 1.0, 2.0), ("b", "x", 2.0, 1.0), ("c", "y", 3.0, 0.0), ("d", "z", 4.0, 0.0)], "ticker string, industry string, net_score double, long_score double")
    folder = str(tmp_path / "audit")
    tables.write_audit(rows, rows.limit(0), rows.limit(1), folder)
    assert all(r.same_content and r.source_rows == r.read_rows for r in tables.audit_proof(rows, folder).collect())
    other = rows.where("ticker <> 'b'").withColumn("net_score", F.when(F.col("ticker") == "c", 9.0).otherwise(F.col("net_score")))
    got = {r.industry: (r.source_rows, r.read_rows, r.same_content) for r in tables.audit_proof(other, folder).collect()}
    assert got == {"x": (1, 2, False), "y": (1, 1, False), "z": (1, 1, True)}
    assert "industry" in str(spark.read.parquet(f"{folder}/scored").where("industry = 'x'")._jdf.queryExecution().executedPlan())


def test_outcome_of_a_company_without_a_listed_one_and_without_selected_events(spark):
    schema = "ticker string, status string, method string, resumed boolean, qa_status string, protected_media_type string, selected boolean, webcast_url string, transcript_found boolean, captions_found boolean, transcript_saved boolean, captions_saved boolean, generated_created boolean, media_attempted boolean"
    none = (None,) * 6
    rows = [("A", "DISCOVERED", None, None, None, None, True, None, *none), ("A", "NO_WEBCAST", None, None, None, None, True, None, *none), ("B", "DISCOVERED", None, None, None, None, False, "u", *none), ("C", "PLAYER_BLOCKED", None, None, None, None, True, "", *none), ("C", "CAPTCHA_REQUIRED", None, None, None, None, True, "", *none)]
    got = {r.ticker: (r.event_outcome, r.events_with_webcasts, r.event_failures) for r in summary.event_metrics(spark.createDataFrame(rows, schema), ["ticker"]).collect()}
    assert got == {"A": ("NO_WEBCAST", 0, 1), "B": ("EVENTS_FOUND", 1, 0), "C": ("CAPTCHA_REQUIRED", 0, 1)}
