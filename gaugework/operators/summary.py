"""Per-ticker summaries: candidate reasons, concentration, alignment, histories, dossiers, collection accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions.numbers import joined_reasons, safe_div
from gaugework.plans.joins import attach
from gaugework.plans.ordered import numbered


def shown(value: Column, digits: int = 1, suffix: str = "") -> Column:
    return F.coalesce(F.concat(F.format_number(value, digits), F.lit(suffix)), F.lit("unavailable"))


def risk_flags(df: DataFrame) -> Column:
    """Text of every raised flag of a candidate row; columns that are absent raise nothing."""
    # Flag columns and their labels.
    labels = [
        ("excess_working_capital", "EXCESS WORKING CAPITAL"), ("unsustainable_payout", "UNSUSTAINABLE PAYOUT"), ("liquidity_current_ratio_distress", "CURRENT RATIO DISTRESS"), ("liquidity_quick_ratio_distress", "QUICK RATIO DISTRESS"),
        ("liquidity_cash_ratio_distress", "CASH RATIO DISTRESS"), ("price_book_flag", "P/B RECONCILIATION"), ("cap_per_share_flag", "MARKET CAP/SHARE RECONCILIATION"), ("rating_percent_flag", "RATING PERCENT RECONCILIATION"),
    ]
    tests = [(F.col("data_status") != "SUFFICIENT", "LIMITED DATA")] if "data_status" in df.columns else []
    tests += [(F.col(c), text) for c, text in labels if c in df.columns]
    if "solvency_pass" in df.columns:
        tests.append((~F.col("solvency_pass"), "LEVERAGE GATE FAIL"))
    text = joined_reasons(*tests, sep="; ") if tests else F.lit("")
    return F.when(text == "", "NONE").otherwise(text)


def candidate_summary(selected: DataFrame, parts: DataFrame, most_drivers: int | None = None) -> DataFrame:
    """Chosen candidates with side, score, family contributions (largest first, all unless ``most_drivers`` limits them) and flags.

    ``parts``: ticker, family, long_contribution, short_contribution, long_score, short_score (a few families per ticker).
    """
    chosen = selected.where(F.col("candidate") != "")
    j = parts.join(chosen.select("ticker", "candidate"), "ticker")
    is_long = F.col("candidate") == "QUANT LONG"
    points = F.when(is_long, F.col("long_contribution")).otherwise(F.col("short_contribution"))
    score = F.when(is_long, F.col("long_score")).otherwise(F.col("short_score"))
    entry = F.struct((-points).alias("p"), "family", F.concat(F.lower(F.regexp_replace("family", "_", " ")), F.lit(" "), shown(points), F.lit(" score points (peer score "), shown(score), F.lit(")")).alias("t"))
    texts = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["t"])
    drivers = j.where(points.isNotNull()).groupBy("ticker").agg(F.array_join(texts if most_drivers is None else F.slice(texts, 1, most_drivers), ", ").alias("drivers"))
    out = chosen.join(drivers, "ticker", "left")
    side = F.when(F.col("candidate") == "QUANT LONG", "long").otherwise("short")
    shown_score = F.when(F.col("candidate") == "QUANT LONG", F.col("long_score")).otherwise(F.col("short_score"))
    rank = F.when(F.col("candidate") == "QUANT LONG", F.col("long_rank")).otherwise(F.col("short_rank"))
    text = F.concat(
        F.col("ticker"), F.lit(" selected as a quantitative "), side, F.lit(" candidate in "), F.col("industry"), F.lit(" (industry rank "), rank.cast("string"), F.lit(", score "), shown(shown_score), F.lit("). Largest contributions: "),
        F.coalesce("drivers", F.lit("unavailable")), F.lit("."),
    )
    return out.select("ticker", "industry", "candidate", shown_score.alias("score"), rank.alias("industry_rank"), text.alias("reason"), risk_flags(out).alias("risk_flags"))


def strategy_summary(scored: DataFrame, top: int, minimum: float) -> DataFrame:
    """The first ``top`` eligible names per strategy at or above ``minimum`` (a fixed report size)."""
    kept = scored.where(F.col("eligible") & (F.col("score") >= minimum))
    w = Window.partitionBy("strategy").orderBy(F.desc("score"), F.lower("ticker"))
    placed = kept.withColumn("position", F.row_number().over(w)).where(F.col("position") <= top)
    text = F.concat(shown(F.col("score")), F.lit(" from "), F.col("components").cast("string"), F.lit(" families; "), F.format_number(F.col("weight_coverage") * 100, 0), F.lit("% weighted coverage"))
    return placed.select("strategy", "position", "ticker", "score", text.alias("reason"))


def contribution_concentration(parts: DataFrame, keys: Sequence[str], name: str, value: str) -> DataFrame:
    """Top 1/3/5 shares of positive contributions, top share of absolute ones, strongest and weakest part.

    Contributions per key are bounded by the metric registry.
    """
    v = F.col(value)
    held = parts.where(v.isNotNull())
    up = Window.partitionBy(*keys).orderBy(F.desc(value), name)
    placed = held.withColumn("_r", F.row_number().over(up))
    pos = F.when(v > 0, v)
    top = lambda n: F.sum(F.when(F.col("_r") <= n, pos))
    return placed.groupBy(*keys).agg(
        F.count_if(v > 0).alias("positive_count"), F.count_if(v < 0).alias("negative_count"), *[safe_div(top(n), F.sum(pos)).alias(f"top_{n}_share") for n in (1, 3, 5)],
        safe_div(F.max(F.abs(value)), F.sum(F.abs(value))).alias("top_1_absolute_share"), F.max_by(name, F.struct(v, F.col(name))).alias("strongest"), F.min_by(name, F.struct(v, F.col(name))).alias("weakest"),
    )


def alignment_label(breadth: Column) -> Column:
    """How far the history supports the snapshot; descriptive only."""
    return F.when(breadth.isNull(), "insufficient evidence").when(breadth >= 0.75, "strong confirmation").when(breadth >= 0.5, "partial confirmation").otherwise("contradiction")


def model_lookup(primary: DataFrame, secondary: DataFrame, dataset: DataFrame) -> DataFrame:
    """Primary x secondary x dataset per (category, ticker) with duplicate flags and match failures.

    A duplicated key contributes its first row and a flag, so the join never multiplies.
    """
    def once(df: DataFrame, keys: Sequence[str], prefix: str, fields: Sequence[str]) -> DataFrame:
        return df.groupBy(*keys).agg(F.min(F.struct("source_row", *fields)).alias("_r"), F.count("*").alias(f"{prefix}_rows")).select(*keys, *[F.col(f"_r.{f}").alias(f"{prefix}_{f}") for f in fields], f"{prefix}_rows")

    p = once(primary, ["category", "ticker"], "primary", ["score", "rank"])
    s = once(secondary, ["category", "ticker"], "secondary", ["score", "rank", "breadth"])
    d = once(dataset, ["ticker"], "dataset", ["industry"])
    j = p.join(s, ["category", "ticker"], "left").join(d, "ticker", "left")
    warnings = joined_reasons(
        (F.col("primary_rows") > 1, "primary_duplicate"), (F.col("secondary_rows") > 1, "secondary_duplicate"), (F.col("dataset_rows") > 1, "dataset_duplicate"),
        (F.col("secondary_rows").isNull(), "secondary_analysis_match_missing"), (F.col("dataset_rows").isNull(), "primary_dataset_match_missing"), sep="; ",
    )
    return j.withColumns({"warnings": warnings, "alignment": alignment_label(F.col("secondary_breadth"))}).withColumn("quality", F.when(F.col("warnings") == "", "complete").otherwise("warning"))


def match_failures(joined: DataFrame) -> DataFrame:
    return joined.groupBy("category").agg(F.count("*").alias("names"), F.count_if(F.col("secondary_rows").isNull()).alias("without_secondary"), F.count_if(F.col("dataset_rows").isNull()).alias("without_dataset"), F.count_if(F.col("warnings").contains("duplicate")).alias("with_duplicates"))


def threshold_distance(df: DataFrame, cap: int, floor: float) -> DataFrame:
    """Distance of a name to the last displayed rank and to the score floor."""
    return df.withColumns({"rank_distance": F.lit(cap) - F.col("rank"), "score_distance": F.col("score") - F.lit(floor)})


def missing_fields(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Missing fields of each row as a list and a count; nothing is replaced by zero."""
    gone = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))
    return df.select(*keys, gone.alias("missing")).withColumn("missing_count", F.size("missing"))


def consolidated_history(rows: DataFrame, content: Sequence[str], ticker: str = "ticker") -> DataFrame:
    """Exact duplicate history rows collapsed, with the categories and number of locations they came from.

    ``rows`` carries ``category`` and ``location``. Categories are a short fixed list.
    """
    mark = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    cats = rows.select(mark.alias("row_hash"), "category").distinct().groupBy("row_hash").agg(F.array_join(F.array_sort(F.collect_list("category")), ", ").alias("categories"))
    once = rows.withColumn("row_hash", mark).groupBy("row_hash").agg(F.min(F.struct("location", *content)).alias("_r"), F.countDistinct("location").alias("locations"), F.count("*").alias("copies"))
    return once.select("row_hash", *[F.col(f"_r.{c}").alias(c) for c in content], "locations", "copies").join(cats, "row_hash")


def statement_package(history: DataFrame, keys: Sequence[str], items: Sequence[str]) -> DataFrame:
    """Available items of each fiscal period as a map, unavailable ones as a list."""
    pairs = F.filter(F.array(*[F.struct(F.lit(i).alias("k"), F.col(i).cast("double").alias("v")) for i in items]), lambda p: p["v"].isNotNull())
    gone = F.array_compact(F.array(*[F.when(F.col(i).isNull(), F.lit(i)) for i in items]))
    return history.select(*keys, F.map_from_entries(pairs).alias("items"), gone.alias("unavailable"))


def numbered_sources(facts: DataFrame, url: str = "source_url") -> tuple[DataFrame, DataFrame]:
    """Number the distinct sources of each ticker in order of first use; returns (facts with number, source list)."""
    first = facts.where(F.coalesce(F.trim(url), F.lit("")) != "").groupBy("ticker", url).agg(F.min(F.struct("section", "position")).alias("_first"), F.count("*").alias("uses"))
    placed = numbered(first, ["ticker"], [F.col("_first"), F.col(url)], "source_number").drop("source_number_all")
    return attach(facts, placed.select("ticker", url, "source_number"), ["ticker", url]), placed.select("ticker", "source_number", url, "uses")


def dossier(facts: DataFrame, per_section: int = 12) -> DataFrame:
    """Facts of each ticker ranked inside their section by confidence, with positives, negatives and gaps labelled.

    ``facts``: ticker, section, record_id, text, confidence, direction, state.
    """
    known = F.lower(F.coalesce("state", F.lit("unknown"))) != "unknown"
    stance = F.when(~known, "gap").when(F.col("direction").isin("improving", "accelerating", "positive", "increasing", "raised"), "positive").when(F.col("direction").isin("deteriorating", "decelerating", "negative", "decreasing", "lowered"), "negative").otherwise("neutral")
    marked = facts.withColumn("stance", stance)
    w = Window.partitionBy("ticker", "section", "stance").orderBy(F.desc(F.coalesce("confidence", F.lit(0.0))), "record_id")
    return marked.withColumn("position", F.row_number().over(w)).where(F.col("position") <= per_section)


# --- collection accounting -----------------------------------------------------------------------------------

# Failure codes of acquisition records.
BLOCKED_CODES = ("SITE_BLOCKED", "ACCESS_BLOCKED", "CAPTCHA_REQUIRED")
TRANSIENT_CODES = ("HTTP_FAILED", "TRANSIENT_HTTP_ERROR", "TIMEOUT", "NAVIGATION_FAILED")


def is_report_candidate(url: Column, pdf_url: Column, category: Column, source: Column) -> Column:
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1))
    return (F.coalesce(category, F.lit("")) == "reports") & ((F.coalesce(source, F.lit("")) == "SEC_EDGAR") | pdf_url.isNotNull() | path.endswith(".pdf") | path.contains("/static-files/"))


def report_type(title: Column, url: Column) -> Column:
    t = F.lower(F.concat_ws(" ", title, url))
    return (
        F.when(t.contains("annual"), "annual_report").when(t.rlike(r"quarterly|q[1-4](?:\b|[-_])"), "quarterly_report").when(t.rlike(r"presentation|investor[- ]?deck|business update"), "presentation")
        .when(t.rlike("sustainability|esg"), "sustainability_report").otherwise("report_document")
    )


def failure_class(code: Column, message: Column, http: Column, status: Column, duplicate: Column, existing: Column, candidate: Column) -> Column:
    """Class of a failed acquisition, first matching rule."""
    c, t = F.upper(F.coalesce(code, F.lit(""))), F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(duplicate.isNotNull(), "SUPERSEDED_DUPLICATE").when(F.coalesce(existing, F.lit(False)), "DUPLICATE_ALREADY_REPRESENTED")
        .when(~candidate, F.when(t.rlike("html|landing") | ~t.contains("report"), "HTML_PAGE_NOT_REPORT").otherwise("NON_DOCUMENT_LINK"))
        .when((F.coalesce(status, F.lit("")) == "BLOCKED") | c.isin(*BLOCKED_CODES), "ACCESS_BLOCKED").when((c == "UNSUPPORTED_CONTENT_TYPE") | t.contains("unsupported content"), "UNSUPPORTED_CONTENT_TYPE")
        .when(c.isin("STALE_URL", "NOT_FOUND", "HTTP_404") | t.contains("404"), "STALE_URL").when(c.isin(*TRANSIENT_CODES) | http.isin(408, 425, 429) | (http >= 500), "TRANSIENT_HTTP_ERROR")
        .when(t.rlike("invalid pdf|encrypted or empty pdf|missing pdf signature"), "INVALID_DOCUMENT").when(t.contains("expected pdf, received") & t.contains("text/html"), "HTML_PAGE_NOT_REPORT")
        .when(c == "PDF_DOWNLOAD_FAILED", "REAL_DOWNLOAD_FAILURE").when(c != "", "EXPECTED_EXTERNAL_LIMITATION").otherwise("REAL_DOWNLOAD_FAILURE")
    )


def failure_stage(code: Column, message: Column, candidate: Column) -> Column:
    c, t = F.upper(F.coalesce(code, F.lit(""))), F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(t.rlike("invalid pdf structure|encrypted or empty pdf"), "pdf_validation").when(t.rlike("not a pdf|missing pdf signature"), "content_validation").when(c.isin(*BLOCKED_CODES), "access_check")
        .when(c.isin(*TRANSIENT_CODES), "pdf_fetch").when(~candidate, "candidate_validation").otherwise("pdf_fetch")
    )


def collection_metrics(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Discovered, saved, cached, blocked and failed records, and a status by precedence.

    ``records``: keys, status, cache_hit, duplicate_of.
    """
    s, hit, dup = F.col("status"), F.coalesce("cache_hit", F.lit(False)), F.col("duplicate_of").isNotNull()
    m = records.groupBy(*keys).agg(
        F.count("*").alias("discovered"), F.count_if((s == "DOWNLOADED") & ~hit & ~dup).alias("newly_saved"), F.count_if(hit | s.isin("CACHED", "REUSED") | ((s == "DOWNLOADED") & dup)).alias("cached"),
        F.count_if(s == "BLOCKED").alias("blocked"), F.count_if(s == "FAILED").alias("failed"),
    )
    got = (F.col("newly_saved") + F.col("cached")) > 0
    none = ~got & (F.col("failed") + F.col("blocked") >= F.col("discovered"))
    status = F.when((F.col("blocked") > 0) & ~got, "ACCESS_BLOCKED").when(F.col("discovered") == 0, "NO_DOCUMENTS_FOUND").when(none, "DISCOVERY_FAILED").otherwise("SUCCESS")
    return m.withColumns({"validated": F.col("newly_saved") + F.col("cached") + F.col("failed"), "category_status": status})


def company_status(categories: DataFrame) -> DataFrame:
    """Worst category status of a company by precedence."""
    # Precedence of statuses, worst first.
    order = ["DISCOVERY_FAILED", "ACCESS_BLOCKED", "NOT_SCANNED", "NO_DOCUMENTS_FOUND", "CACHE_HIT_EMPTY", "SUCCESS"]
    rank = F.array_position(F.array(*[F.lit(o) for o in order]), F.col("category_status"))
    some = F.max(F.col("category_status") == "SUCCESS")
    worst = F.min_by("category_status", rank)
    return categories.groupBy("ticker").agg(F.count("*").alias("categories"), F.when(some & (worst != "SUCCESS"), "PARTIAL").when(some, "SUCCESS").otherwise(worst).alias("company_status"))


# --- reports and events ------------------------------------------------------------------------------------

# Statuses of events and their groups, and the precedence of a company's outcome.
PROTECTED_MEDIA = ("DRM_PROTECTED", "HLS_ENCRYPTED", "EVENT_MEDIA_PROTECTED")
GATED_EVENTS = ("REGISTRATION_APPROVAL_REQUIRED", "REGISTRATION_REQUIRED", "AUTH_REQUIRED", "CAPTCHA_REQUIRED", "EMAIL_VERIFICATION_REQUIRED")
SKIPPED_EVENTS = ("SKIPPED_OFFICIAL_TRANSCRIPT", "SKIPPED_OFFICIAL_CAPTIONS", "SKIPPED_COMPLETED_GENERATED", "MEDIA_ATTEMPT_LIMIT", "CANDIDATE_SCANNED")
NO_REPLAY = ("NO_WEBCAST", "NO_REPLAY_AVAILABLE", "FUTURE_EVENT_NO_REPLAY")
EXPECTED_OUTCOMES = ("GENERATED_TRANSCRIPT_ALREADY_AVAILABLE", "CACHED_EVENT_MEDIA_PROTECTED", "CANDIDATE_CACHED", "EVENT_MEDIA_PROTECTED", "REGISTRATION_DESTINATION_DISCOVERED", "REGISTRATION_NOT_REQUIRED", *SKIPPED_EVENTS, *GATED_EVENTS, *NO_REPLAY)
OUTCOME_PRECEDENCE = (
    "GENERATED_TRANSCRIPT_ALREADY_AVAILABLE", "CACHED_EVENT_MEDIA_PROTECTED", "GENERATED_TRANSCRIPT_SUCCESS", "OFFICIAL_TRANSCRIPT_USED", "OFFICIAL_CAPTIONS_USED", "TRANSCRIPT_QA_WARNING", "EVENT_ALREADY_COMPLETE",
    "SKIPPED_OFFICIAL_TRANSCRIPT", "SKIPPED_OFFICIAL_CAPTIONS", "EVENT_MEDIA_PROTECTED", "IR_VERIFIED_ACCESS_BLOCKED", "MEDIA_NOT_FOUND", "REGISTRATION_APPROVAL_REQUIRED", "EMAIL_VERIFICATION_REQUIRED", "AUTH_REQUIRED", "CAPTCHA_REQUIRED",
    "REGISTRATION_FAILED", "REGISTRATION_REQUIRED", "PLAYER_HTTP_403", "PLAYER_BLOCKED", "EVENT_DISCOVERY_FAILED",
)


def report_metrics(records: DataFrame, keys: Sequence[str], discovered: DataFrame | None = None) -> DataFrame:
    """Reconciled report counts: found, validated, saved, reused, failed and blocked, and whether they add up.

    ``records``: keys, status, cache_hit, duplicate_of; ``discovered``: keys, discovered, raw_candidates where a scan counted more than it recorded.
    """
    s, hit, dup = F.col("status"), F.coalesce("cache_hit", F.lit(False)), F.col("duplicate_of").isNotNull()
    m = records.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.count_if((s == "DOWNLOADED") & ~hit & ~dup).alias("reports_saved"), F.count_if(hit | s.isin("CACHED", "REUSED") | ((s == "DOWNLOADED") & dup)).alias("reports_reused"),
        F.count_if(s == "FAILED").alias("reports_failed"), F.count_if(s == "BLOCKED").alias("reports_blocked"),
    )
    seen = m.withColumns({"discovered": F.col("_n"), "raw_candidates": F.col("_n")}) if discovered is None else m.join(discovered.select(*keys, "discovered", "raw_candidates"), list(keys), "left")
    found = F.coalesce("discovered", "_n")
    validated = F.col("reports_saved") + F.col("reports_reused") + F.col("reports_failed")
    out = seen.withColumns({"raw_report_candidates": F.coalesce("raw_candidates", found), "reports_discovered": found, "reports_validated": validated})
    return out.withColumn("reconciled", F.col("reports_validated") + F.col("reports_blocked") == F.col("_n")).drop("_n", "discovered", "raw_candidates")


def event_outcome() -> Column:
    """Outcome of an event from status, method, resumed, qa_status and protected_media_type."""
    status, method, resumed = F.col("status"), F.col("method"), F.coalesce("resumed", F.lit(False))
    made = F.when(method == "generated_transcript", "GENERATED_TRANSCRIPT_SUCCESS").when(method == "official_transcript", "OFFICIAL_TRANSCRIPT_USED").when(method == "official_captions", "OFFICIAL_CAPTIONS_USED").otherwise("TRANSCRIPT_READY")
    return (
        F.when(status == "CACHED_EVENT_MEDIA_PROTECTED", status).when(resumed & (method == "generated_transcript"), "GENERATED_TRANSCRIPT_ALREADY_AVAILABLE")
        .when(status == "TRANSCRIBED", F.when(F.col("qa_status") == "TRANSCRIPT_QA_WARNING", "TRANSCRIPT_QA_WARNING").when(resumed, "EVENT_ALREADY_COMPLETE").otherwise(made))
        .when(F.col("protected_media_type").isNotNull() | status.isin(*PROTECTED_MEDIA), "EVENT_MEDIA_PROTECTED").otherwise(status)
    )


def event_metrics(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of a company's events by what became of them, and the company's outcome by precedence.

    ``events``: keys, status, method, resumed, qa_status, protected_media_type, selected, webcast_url, transcript_found, captions_found,
    transcript_saved, captions_saved, generated_created, media_attempted. Discovery counts all events, the others the selected ones.
    """
    flag = lambda c: F.coalesce(c, F.lit(False))
    e = events.withColumns({"_o": event_outcome(), "_s": flag(F.col("selected")), "_r": flag(F.col("resumed"))})
    o, chosen, resumed, method, status = F.col("_o"), F.col("_s"), F.col("_r"), F.col("method"), F.col("status")
    n = lambda test: F.count_if(chosen & flag(test))
    official, captions, generated = method == "official_transcript", method == "official_captions", method == "generated_transcript"
    rank = F.array_position(F.array(*[F.lit(x) for x in OUTCOME_PRECEDENCE]), o)
    m = e.groupBy(*keys).agg(
        F.count("*").alias("events_discovered"), F.count_if(F.coalesce("webcast_url", F.lit("")) != "").alias("events_with_webcasts"), F.count_if(chosen).alias("events_processed"), n(resumed).alias("events_resumed"),
        n(flag(F.col("transcript_found")) | (status == "SKIPPED_OFFICIAL_TRANSCRIPT") | flag(official)).alias("official_transcript_discovered"), n(flag(F.col("captions_found")) | (status == "SKIPPED_OFFICIAL_CAPTIONS") | flag(captions)).alias("official_captions_discovered"),
        n(flag(F.col("transcript_saved")) | (o == "OFFICIAL_TRANSCRIPT_USED")).alias("official_transcript_saved"), n(flag(F.col("captions_saved")) | (o == "OFFICIAL_CAPTIONS_USED")).alias("official_captions_saved"),
        n(resumed & official).alias("official_transcript_reused"), n(resumed & captions).alias("official_captions_reused"), n(flag(F.col("generated_created")) & ~resumed).alias("generated_transcript_created"), n(resumed & generated).alias("generated_transcript_reused"),
        n(generated & (flag(F.col("generated_created")) | resumed)).alias("generated_transcript_available"), n(F.col("media_attempted")).alias("media_attempts_used"), F.count_if(flag(status.isin(*NO_REPLAY))).alias("events_no_replay"),
        n(o.isin(*GATED_EVENTS)).alias("registration_blocked"), n(o.isin("EVENT_MEDIA_PROTECTED", "CACHED_EVENT_MEDIA_PROTECTED")).alias("media_blocked"), n(o == "MEDIA_NOT_FOUND").alias("media_not_found"),
        n(o.isin("MEDIA_NOT_FOUND", "PLAYER_HTTP_403", "PLAYER_BLOCKED")).alias("media_failures"), n(o == "TRANSCRIPTION_FAILED").alias("transcription_failures"), n(~o.isin(*EXPECTED_OUTCOMES) & (status != "TRANSCRIBED")).alias("event_failures"),
        F.min_by(o, F.when(chosen & (rank > 0), rank)).alias("_best"), F.min(F.when(chosen & ~o.isin("DISCOVERED", "SITE_BLOCKED"), o)).alias("_other"),
    )
    late = lambda kind: F.greatest(F.lit(0), F.col(f"{kind}_saved") - F.col(f"{kind}_reused"))
    out = m.withColumns({"official_transcript_saved_new": late("official_transcript"), "official_captions_saved_new": late("official_captions"), "event_outcome": F.coalesce("_best", "_other", F.lit("EVENTS_FOUND"))})
    return out.drop("_best", "_other")
