"""Interval joins, running maxima and round-based choices against brute force; the rules that use them on hand fixtures."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from gaugework.functions import rules as R
from gaugework.operators import people, quality, text, timeseries, validate
from gaugework.plans.intervals import points_in_spans
from gaugework.plans.matching import first_independent, one_to_one, similar_sets
from gaugework.plans.ordered import running_maxima


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_in_spans_equal_brute_force_without_a_nested_loop(spark):
    rng = random.Random(1)
    points = [(i, rng.choice([None, *range(100)])) for i in range(400)]
    spans = [(i, rng.choice([None, *range(100)]), rng.choice([None, *range(100)])) for i in range(200)]
    left, right = spark.createDataFrame(points, "p long, at int"), spark.createDataFrame(spans, "s long, a int, b int")
    joined = points_in_spans(left, right, "at", "a", "b", ranges=16)
    want = sorted((p, s) for p, at in points for s, a, b in spans if at is not None and a is not None and a <= at and (b is None or at < b))
    assert sorted((r.p, r.s) for r in joined.collect()) == want
    assert "NestedLoop" not in plan_of(joined)
    assert points_in_spans(left.where("at < 0"), right, "at", "a", "b").count() == 0


def test_members_of_many_dates_need_no_nested_loop(spark):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    universe = spark.createDataFrame([("a", day(0), day(10), None), ("b", day(5), None, day(7)), ("c", None, day(3), None)], "ticker string, valid_from date, valid_to date, delisted_date date")
    dates = spark.createDataFrame([(day(i),) for i in range(12)], "as_of_date date")
    found = quality.members_on(universe, dates)
    assert "NestedLoop" not in plan_of(found)
    got = sorted((r.ticker, (r.as_of_date - day(0)).days, r.delisted) for r in found.collect())
    assert got == sorted([("a", i, False) for i in range(10)] + [("b", i, i >= 7) for i in range(5, 12)])


def test_running_maxima_of_one_group_over_all_tasks(spark):
    rng = random.Random(2)
    values = [rng.choice([None, rng.randrange(1000)]) for _ in range(3000)]
    rows = spark.createDataFrame([("one", i, v) for i, v in enumerate(values)], "k string, i long, v long").repartition(7)
    got = {r.i: r.m for r in running_maxima(rows, ["k"], ["i"], {"m": F.col("v")}).collect()}
    best = None
    for i, v in enumerate(values):
        assert got[i] == best
        best = v if best is None else best if v is None else max(best, v)


def test_time_coverage_of_one_track_equals_the_union_of_its_cues(spark):
    rng = random.Random(3)
    cues = [(s := rng.uniform(0, 5000), s + rng.uniform(0.1, 9)) for _ in range(2000)]
    rows = spark.createDataFrame([("t", i, a, b, "s", "x", False) for i, (a, b) in enumerate(cues)], "k string, cue_no int, start double, end double, speaker string, text string, chapter boolean")
    covered, reach = 0.0, 0.0
    for a, b in sorted(cues):
        covered += max(0.0, b - max(a, reach))
        reach = max(reach, b)
    got = text.caption_diagnostics(rows, "k").first()
    assert got.time_coverage == pytest.approx(covered / (max(b for _, b in cues) - min(a for a, _ in cues)))


def test_overlapping_windows_equal_brute_force(spark):
    rng = random.Random(4)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    rows = [(rng.choice("ab"), i, day(s := rng.randrange(400)), day(s + rng.randrange(1, 6))) for i in range(120)]
    got = {r.i: r.overlaps for r in timeseries.overlapping_windows(spark.createDataFrame(rows, "k string, i int, s date, e date"), ["k"], "s", "e").collect()}
    for k, i, s, e in rows:
        assert got[i] == any(k == k2 and i != i2 and s < e2 and s2 < e for k2, i2, s2, e2 in rows)


def test_first_independent_set_follows_the_visiting_order(spark):
    rng = random.Random(5)
    pairs = {tuple(sorted(rng.sample(range(80), 2))) for _ in range(150)} | {(i, i + 1) for i in range(40)}
    kept = []
    for n in range(90):
        if not any((k, n) in pairs for k in kept):
            kept.append(n)
    nodes = spark.createDataFrame([(i,) for i in range(90)], "n long")
    got = first_independent(nodes, spark.createDataFrame(list(pairs), "earlier long, later long"), "n")
    assert sorted(r.n for r in got.collect()) == kept


def test_one_to_one_equals_the_sequential_choice(spark):
    rng = random.Random(6)
    links = {(rng.randrange(300), rng.randrange(300)): rng.randrange(5) for _ in range(900)}
    used, want = set(), []
    for c in range(300):
        options = sorted((-s, p) for (left, p), s in links.items() if left == c and p not in used)
        if options:
            used.add(options[0][1])
            want.append((c, options[0][1]))
    rows = spark.createDataFrame([(c, p, s) for (c, p), s in links.items()], "c long, p long, s int")
    assert sorted((r.c, r.p) for r in one_to_one(rows, "c", "p", [-F.col("s")]).collect()) == want


def test_similar_sets_lose_no_pair(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(25)]
    sets = [(i % 3, i, rng.sample(words, rng.randrange(0, 9))) for i in range(150)]
    want = {(i, j) for g, i, a in sets for h, j, b in sets if g == h and i < j and a and b and len(set(a) & set(b)) >= 0.7 * min(len(a), len(b)) - 1e-9}
    got = similar_sets(spark.createDataFrame(sets, "g int, i long, t array<string>"), ["g"], "i", "t", 0.7)
    assert {(r.a, r.b) for r in got.collect()} == want


def test_near_copies_of_claims_go_as_in_the_sequential_rule(spark):
    rng = random.Random(8)
    words = ["revenue", "margin", "growth", "cloud", "orders", "units", "the", "of", "strong", "weak", "it", "backlog"]
    rows = []
    for doc in range(4):
        for i in range(60):
            rows.append((doc, rng.choice(["revenue", "costs"]), i * 10, " ".join(rng.choices(words, k=rng.randrange(1, 8))), [rng.choice(["5%", "6%"])] if rng.random() < 0.9 else []))
    stop = set(R.OVERLAP_STOPWORDS)
    want = set()
    seen: dict = {}
    for doc, dim, at, sentence, amount in sorted(rows):
        tokens = {t for t in re.findall("[a-z0-9]+", sentence) if t not in stop and len(t) > 2}
        if amount:
            held = seen.setdefault((doc, dim, tuple(amount)), [])
            if tokens and any(p and len(tokens & p) / min(len(tokens), len(p)) >= 0.7 for p in held):
                continue
            held.append(tokens)
        want.add((doc, dim, at))
    claims = spark.createDataFrame(rows, "doc long, dimension string, start_char int, sentence string, magnitude array<string>")
    found = text.drop_near_duplicates(claims, "doc")
    assert {(r.doc, r.dimension, r.start_char) for r in found.collect()} == want
    assert "MapInPandas" not in plan_of(found)


TEN = ["Ada Smith (Ret", "J.R. Jones", "Lee Brown", "Kim Green", "Max Black", "Eva White", "Tom Stone", "Ann Wood", "Joe Field", "Sue Rivers"]


def directors_of(spark, roles=(), evidence=None):
    rows = [("T", i, n, (evidence or {}).get(i), ["Chief Executive Officer"] if i in roles else ["Director"]) for i, n in enumerate(TEN)]
    return spark.createDataFrame(rows, "ticker string, person_id int, name string, evidence_text string, roles array<string>")


def verdicts(spark, proxy, **options):
    found = people.independence(directors_of(spark, **options), spark.createDataFrame([("T", proxy)], "ticker string, text string"))
    return {r.person_id: r.independence for r in found.collect()}


def test_one_denial_names_one_director_of_ten(spark):
    got = verdicts(spark, "The board has determined that " + ", ".join(n.split()[1] for n in TEN[1:]) + " are independent. Filler sentence. Mr. Brown is not independent because he runs a unit. Ms. Green chairs the committee.")
    assert got[2] == "NOT_INDEPENDENT"
    assert got[0] == "UNKNOWN"
    assert all(got[i] == "INDEPENDENT" for i in range(10) if i not in (0, 2))


def test_denials_bind_inside_lists_and_to_the_last_name_before_them(spark):
    got = verdicts(spark, "Mr. Jones is independent and Mr. Brown is not independent. Dr. Green founded the firm. For that reason she is not deemed independent. The following are not independent:\n- Stone\n- Wood. Mr. Field was elected.")
    assert {i for i, v in got.items() if v == "NOT_INDEPENDENT"} == {2, 3, 6, 7}
    assert got[1] == "UNKNOWN" and got[8] == "UNKNOWN"  # no board determination


def test_exception_for_the_chief_executive_decides_by_role(spark):
    got = verdicts(spark, "Overview: all directors independent, except for our CEO.", roles=(4,), evidence={5: "co-founder", 6: "an independent director"})
    assert got == {i: "NOT_INDEPENDENT" if i in (4, 5) else "INDEPENDENT" for i in range(10)}


def test_events_are_matched_once_and_only_where_dates_and_webcasts_agree(spark):
    schema = "ticker string, event_id string, event_url string, date string, webcast_url string, media_url string, provider_event_id string, title string, transcript string"
    page = "https://ir.acme.com/events#event-q1"
    fresh = [
        ("A", "f1", page, "2026-08-25", "https://zoom.us/rec/1?sig=9", None, None, "Q1 Call", None), ("A", "f2", page, None, None, None, None, "again", None),
        ("A", "f3", None, "2026-01-01", None, None, "77", "Other", None), ("A", "f4", None, "2026-02-01", None, None, None, "Fire-side Chat!", None), ("A", "f5", "https://ir.acme.com/plain", "2026-03-01", None, None, None, "Plain", "own"), ("B", "f6", None, None, None, None, None, "", None),
    ]
    stored = [
        ("A", "s1", page, "2026-08-25", "https://zoom.us/rec/1", None, None, "old", "t1"), ("A", "s2", page, "2025-08-26", None, None, None, "last year", "t2"), ("A", "s3", None, None, None, None, "77", "x", "t3"),
        ("A", "s4", None, "2026-02-01", None, None, "88", "fireside chat", "t4"), ("A", "s5", "https://ir.acme.com/plain", None, None, None, None, "y", "t5"), ("B", "s6", None, None, None, None, None, "", "t6"),
    ]
    out = text.reconcile_events(spark.createDataFrame(fresh, schema), spark.createDataFrame(stored, schema), ["transcript"])
    got = {r.event_id: (r.stored_id, r.match_method, r.reconciliation, r.transcript) for r in out.collect()}
    assert got == {
        "f1": ("s1", "canonical_url", "matched", "t1"), "f2": ("s2", "canonical_url", "matched", "t2"), "f3": ("s3", "provider_event_id", "matched", "t3"), "f4": ("s4", "date_title", "matched", "t4"),
        "f5": (None, None, "new", "own"), "f6": (None, None, "new", None), "s5": ("s5", None, "kept", "t5"), "s6": ("s6", None, "kept", "t6"),
    }
    moved = [("A", "f1", page, "2026-08-26", None, None, "5", "Q1 Call", None)]
    kept = [("A", "s1", page, "2026-08-25", None, None, "5", "Q1 Call", "t1")]
    assert text.reconcile_events(spark.createDataFrame(moved, schema), spark.createDataFrame(kept, schema), []).where("reconciliation = 'matched'").count() == 0


def test_guidance_for_a_quarter_without_a_year_takes_the_latest_filed_one(spark):
    d = lambda s: dt.date.fromisoformat(s)
    guidance = spark.createDataFrame([("g1", "T", "revenue", "Q2", "USD", 100.0, 120.0, None, "issued", None), ("g2", "T", "revenue", "Q2 2020", "USD", 100.0, 120.0, None, "issued", None), ("g3", "T", "revenue", "FY2020", "USD", None, None, 200.0, "issued", None)],
                                     "guidance_id string, ticker string, metric string, horizon string, unit string, low double, high double, point double, status string, basis string")
    facts = spark.createDataFrame([("T", "revenue", 2020, "Q2", "USD", None, 90.0, d("2020-06-30"), d("2020-08-01")), ("T", "revenue", 2021, "Q2", "USD", None, 110.0, d("2021-06-30"), d("2021-08-01")), ("T", "revenue", 2022, "Q2", "USD", None, 500.0, d("2022-06-30"), d("2022-08-01")), ("T", "revenue", 2020, None, "USD", None, 201.0, d("2020-12-31"), None)],
                                  "ticker string, metric string, fiscal_year int, fiscal_period string, unit string, basis string, value double, period_end date, filed date")
    got = {r.guidance_id: (r.outcome, r.actual) for r in people.guidance_outcomes(guidance, facts, F.lit("2022-07-15").cast("date")).collect()}
    assert got == {"g1": ("MET", 110.0), "g2": ("MISS", 90.0), "g3": ("MET", 201.0)}


def test_transcripts_are_judged_against_their_audio(spark):
    rows = [("a", i, i * 1.0, i * 1.0 + 1, f"word{i}") for i in range(300)] + [("b", 0, 0.0, 10.0, "x " * 12)]
    segments = spark.createDataFrame(rows, "k string, segment_no int, start double, end double, text string")
    q = {r.k: r for r in text.transcript_quality(segments, "k", spark.createDataFrame([("a", 200.0)], "k string, duration double")).collect()}
    assert q["a"].warnings == "dense_short_segments; timestamps_beyond_audio"
    assert (q["a"].median_segment_duration, q["a"].duration_minutes) == (1.0, pytest.approx(200 / 60))
    assert q["b"].warnings == "local_word_repetition_review_required" and q["b"].first_timestamp == 0.0
    assert [r.segment_no for r in text.repeated_words(segments, "k").collect()] == [0]


def test_a_factor_stated_twice_counts_with_its_mean(spark):
    rows = [("e1", "a", 1.0), ("e1", "a", 3.0), ("e1", "b", 1.0), ("e2", "a", 4.0), ("e2", "b", 5.0), ("e3", "a", 0.0), ("e3", "b", -2.0)]
    one = spark.createDataFrame(rows, "e string, f string, v double")
    got = {(r.factor_a, r.factor_b): r.correlation for r in validate.factor_correlations(one, "e", "f", "v").collect()}
    again = {(r.factor_a, r.factor_b): r.correlation for r in validate.factor_correlations(one.orderBy(F.desc("v")), "e", "f", "v").collect()}
    assert got[("a", "b")] == pytest.approx(0.9958, abs=1e-3) and again[("a", "b")] == pytest.approx(got[("a", "b")])
