"""Ownership trades, tenures, guidance, commitments and boards."""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gaugework.functions import text as tx
from gaugework.functions.numbers import joined_reasons, safe_div
from gaugework.plans.joins import asof_day, attach, latest_per_key, look_up
from gaugework.plans.ordered import running_maxima, with_previous
from gaugework.plans.settle import settle

# --- ownership forms ----------------------------------------------------------------------------------

_VALUE = "STRUCT<value: STRING, footnoteId: ARRAY<STRUCT<_id: STRING>>>"
_TRADE = (
    f"STRUCT<securityTitle: {_VALUE}, transactionDate: {_VALUE}, transactionCoding: STRUCT<transactionFormType: STRING, transactionCode: STRING, footnoteId: ARRAY<STRUCT<_id: STRING>>>, "
    f"transactionAmounts: STRUCT<transactionShares: {_VALUE}, transactionPricePerShare: {_VALUE}, transactionAcquiredDisposedCode: {_VALUE}>, "
    f"postTransactionAmounts: STRUCT<sharesOwnedFollowingTransaction: {_VALUE}>, ownershipNature: STRUCT<directOrIndirectOwnership: {_VALUE}, natureOfOwnership: {_VALUE}>>"
)
_HOLDING = (
    f"STRUCT<securityTitle: {_VALUE}, postTransactionAmounts: STRUCT<sharesOwnedFollowingTransaction: {_VALUE}>, ownershipNature: STRUCT<directOrIndirectOwnership: {_VALUE}, natureOfOwnership: {_VALUE}>>"
)
OWNERSHIP_SCHEMA = (
    "documentType STRING, periodOfReport STRING, issuer STRUCT<issuerCik: STRING, issuerName: STRING, issuerTradingSymbol: STRING>, "
    "reportingOwner ARRAY<STRUCT<reportingOwnerId: STRUCT<rptOwnerCik: STRING, rptOwnerName: STRING>, reportingOwnerRelationship: STRUCT<isDirector: STRING, isOfficer: STRING, isTenPercentOwner: STRING, officerTitle: STRING>>>, "
    f"nonDerivativeTable STRUCT<nonDerivativeTransaction: ARRAY<{_TRADE}>, nonDerivativeHolding: ARRAY<{_HOLDING}>>, "
    f"derivativeTable STRUCT<derivativeTransaction: ARRAY<{_TRADE}>, derivativeHolding: ARRAY<{_HOLDING}>>, "
    "footnotes STRUCT<footnote: ARRAY<STRUCT<_id: STRING, _VALUE: STRING>>>"
)


#: Forms whose elements a task holds at a time; bounds its memory, not the result.
_FORMS = 500
_DEFAULT_NAMESPACE = re.compile(r"""\sxmlns\s*=\s*(?:"[^"]*"|'[^']*')""")


def _root(text: str | None) -> ElementTree.Element | None:
    """Root element of a form, an empty one if the text is not well-formed. A default namespace does not rename elements."""
    if text is None:
        return None
    text = text.strip("\ufeff \t\r\n")
    try:
        return ElementTree.fromstring(_DEFAULT_NAMESPACE.sub("", text) if "xmlns" in text else text)
    except ElementTree.ParseError:
        return ElementTree.Element("form")


def _text(element: ElementTree.Element) -> str:
    inside = "".join(ElementTree.tostring(child, encoding="unicode") for child in element) if len(element) else ""
    return ((element.text or "") + inside).strip()


def _strings(values: list[str | None]) -> pa.Array:
    return pa.array(values, type=pa.string())


def _column(kind: T.DataType, elements: list[ElementTree.Element | None]) -> pa.Array:
    """Arrow array of ``kind`` with one value per element, field by field; ``_name`` fields are attributes, ``_VALUE`` is the text."""
    if not any(e is not None for e in elements):
        return pa.nulls(len(elements), to_arrow_type(kind))
    if not isinstance(kind, T.StructType):
        return _strings([None if e is None else _text(e) for e in elements])
    inner = [{} if e is None else {child.tag: child for child in e} for e in elements]  # of several the last
    children = []
    for field in kind.fields:
        name = field.name
        if isinstance(field.dataType, T.ArrayType):
            if not any(name in held for held in inner):
                children.append(pa.nulls(len(elements), to_arrow_type(field.dataType)))
                continue
            found = [e.findall(name) if name in held else None for e, held in zip(elements, inner)]
            ends, at = [0], 0
            for held in found:
                at += len(held or ())
                ends.append(at)
            starts = [start if held else None for start, held in zip(ends, found)] + ends[-1:]  # NULL where there is no such element
            children.append(pa.ListArray.from_arrays(pa.array(starts, type=pa.int32()), _column(field.dataType.elementType, [e for held in found if held for e in held])))
        elif name == "_VALUE":
            children.append(_strings([None if e is None else _text(e) or None for e in elements]))
        elif name.startswith("_"):
            children.append(_strings([None if e is None else e.get(name[1:]) for e in elements]))
        else:
            children.append(_column(field.dataType, [held.get(name) for held in inner]))
    return pa.StructArray.from_arrays(children, [f.name for f in kind.fields], mask=pa.array([e is None for e in elements], type=pa.bool_()))


#: Parts of a form that the readers below need.
PEOPLE_PARTS = ("issuer.issuerTradingSymbol", "reportingOwner")
TRADE_PARTS = ("documentType", "issuer.issuerTradingSymbol", "reportingOwner", "nonDerivativeTable.nonDerivativeTransaction", "derivativeTable.derivativeTransaction", "footnotes")
HOLDING_PARTS = ("periodOfReport", "issuer.issuerTradingSymbol", "reportingOwner", "nonDerivativeTable.nonDerivativeHolding", "derivativeTable.derivativeHolding")


def _only(kind: T.StructType, parts: Sequence[str], path: str = "") -> T.StructType:
    """Fields of ``kind`` that are named in ``parts`` or hold named ones."""
    kept = []
    for field in kind.fields:
        here = path + field.name
        if here in parts:
            kept.append(field)
        elif any(p.startswith(here + ".") for p in parts):
            kept.append(T.StructField(field.name, _only(field.dataType, parts, here + ".")))
    return T.StructType(kept)


def ownership_forms(filings: DataFrame, xml: str = "xml", parts: Sequence[str] | None = None) -> DataFrame:
    """Parse ownership-form XML text (accession, xml) into one struct column ``form`` per filing.

    Each text is parsed once, however many of its parts are read later; a text that is no XML gives a ``form`` of NULLs.
    ``parts`` limits the struct to the named parts (``PEOPLE_PARTS`` and the like); by default it holds all.
    """
    form = T.StructType.fromDDL(OWNERSHIP_SCHEMA)
    form = form if parts is None else _only(form, parts)
    others = [f for f in filings.schema.fields if f.name != xml]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(0, part.num_rows, _FORMS):
                some = part.slice(at, _FORMS)
                gc.disable()  # elements hold no cycles, and looking for some takes a third of the time
                try:
                    forms = _column(form, [_root(t) for t in some.column(len(others)).to_pylist()])
                finally:
                    gc.enable()
                yield pa.RecordBatch.from_arrays([*some.columns[: len(others)], forms], [*some.schema.names[: len(others)], "form"])

    rows = filings.select(*[F.col(f"`{f.name}`") for f in others], F.col(xml).cast("string").alias("_xml"))
    return rows.mapInArrow(run, T.StructType([*others, T.StructField("form", form)]))


def _flag(text: Column) -> Column:
    return F.lower(F.trim(text)).isin("1", "true")


def form_people(forms: DataFrame) -> DataFrame:
    """Reporting owners with their roles."""
    rows = forms.select("accession", F.upper(F.trim("form.issuer.issuerTradingSymbol")).alias("ticker"), F.explode("form.reportingOwner").alias("o"))
    rel = F.col("o.reportingOwnerRelationship")
    return rows.select(
        "accession", "ticker", F.col("o.reportingOwnerId.rptOwnerCik").alias("owner_cik"), F.col("o.reportingOwnerId.rptOwnerName").alias("name"),
        tx.person_id(F.col("o.reportingOwnerId.rptOwnerName"), F.col("o.reportingOwnerId.rptOwnerCik")).alias("person_id"),
        _flag(rel["isDirector"]).alias("is_director"), _flag(rel["isOfficer"]).alias("is_officer"), rel["officerTitle"].alias("title"),
    )


def _notes(ids: Column) -> Column:
    """Texts of the referenced footnotes of one filing."""
    notes = F.map_from_entries(F.transform(F.coalesce("form.footnotes.footnote", F.array()), lambda n: F.struct(n["_id"], n["_VALUE"])))
    return F.array_compact(F.transform(F.array_distinct(ids), lambda i: F.try_element_at(notes, i)))


def _ids(*fields: str) -> Column:
    empty = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(F.transform(F.col(f), lambda x: x["_id"]), empty) for f in fields])


def _table_rows(entry: str) -> Column:
    """Rows ``r`` (security_type, row_index, t) of the non-derivative, then the derivative table."""
    kinds = {"non_derivative": f"form.nonDerivativeTable.nonDerivative{entry}", "derivative": f"form.derivativeTable.derivative{entry}"}

    def rows(kind: str) -> Column:
        return F.transform(F.col(kinds[kind]), lambda t, i: F.struct(F.lit(kind).alias("security_type"), i.alias("row_index"), t.alias("t")))

    return F.explode(F.flatten(F.array_compact(F.array(*[rows(kind) for kind in kinds])))).alias("r")


def form_trades(forms: DataFrame) -> DataFrame:
    """Trades of both tables with resolved footnotes; the initial-report form yields none."""
    first = F.expr("form.reportingOwner[0].reportingOwnerId")

    rows = forms.where(F.substring("form.documentType", 1, 1) != "3").select("accession", "form", _table_rows("Transaction"))
    both = rows.select(
        "accession", F.upper(F.trim("form.issuer.issuerTradingSymbol")).alias("ticker"), tx.person_id(first["rptOwnerName"], first["rptOwnerCik"]).alias("person_id"), "r.row_index",
        "r.security_type", F.col("r.t.securityTitle.value").alias("security_title"), F.col("r.t.transactionDate.value").try_cast("date").alias("transaction_date"),
        F.col("r.t.transactionCoding.transactionCode").alias("code"), F.col("r.t.transactionAmounts.transactionAcquiredDisposedCode.value").alias("acquired_disposed"),
        F.col("r.t.transactionAmounts.transactionShares.value").try_cast("double").alias("shares"), F.col("r.t.transactionAmounts.transactionPricePerShare.value").try_cast("double").alias("price"),
        F.col("r.t.postTransactionAmounts.sharesOwnedFollowingTransaction.value").try_cast("double").alias("shares_after"), F.col("r.t.ownershipNature.directOrIndirectOwnership.value").alias("ownership_form"),
        F.col("r.t.ownershipNature.natureOfOwnership.value").alias("nature"),
        _notes(_ids("r.t.transactionCoding.footnoteId", "r.t.securityTitle.footnoteId", "r.t.transactionDate.footnoteId", "r.t.transactionAmounts.transactionShares.footnoteId", "r.t.transactionAmounts.transactionPricePerShare.footnoteId", "r.t.postTransactionAmounts.sharesOwnedFollowingTransaction.footnoteId")).alias("footnotes"),
    )
    return both.withColumn("transaction_id", tx.stable_id("trade:", accession=F.col("accession"), kind=F.col("security_type"), row=F.col("row_index")))


def form_holdings(forms: DataFrame) -> DataFrame:
    """Reported positions of both tables."""
    first = F.expr("form.reportingOwner[0].reportingOwnerId")

    rows = forms.select("accession", "form", _table_rows("Holding"))
    return rows.select(
        "accession", F.upper(F.trim("form.issuer.issuerTradingSymbol")).alias("ticker"), tx.person_id(first["rptOwnerName"], first["rptOwnerCik"]).alias("person_id"), "r.security_type", "r.row_index",
        F.col("r.t.securityTitle.value").alias("security_title"), F.col("form.periodOfReport").try_cast("date").alias("as_of_date"),
        F.col("r.t.postTransactionAmounts.sharesOwnedFollowingTransaction.value").try_cast("double").alias("shares"), F.col("r.t.ownershipNature.directOrIndirectOwnership.value").alias("direct_indirect"), F.col("r.t.ownershipNature.natureOfOwnership.value").alias("nature"),
    )


# --- trades ---------------------------------------------------------------------------------------------

# Trade codes.
TRADE_CODES = {
    "P": "open_market_purchase", "S": "open_market_sale", "M": "option_exercise", "A": "award_grant", "F": "tax_withholding", "G": "gift", "D": "transfer", "C": "conversion",
    "E": "other", "H": "other", "I": "other", "J": "other", "K": "derivative_transaction", "L": "other", "W": "other", "V": "other",
}


def classify_trades(trades: DataFrame) -> DataFrame:
    """Trade type, flags and confidence from code, direction, title and footnotes.

    ``trades``: code, acquired_disposed, security_title, footnotes ARRAY<STRING>, plan BOOLEAN (explicit, may be NULL).
    """
    code, direction = F.upper(F.trim("code")), F.upper(F.trim("acquired_disposed"))
    notes = F.lower(F.array_join(F.coalesce("footnotes", F.array().cast("array<string>")), " "))
    words = F.concat_ws(" ", F.lower(F.coalesce("security_title", F.lit(""))), notes)
    # Plan and award wording.
    denied = notes.rlike(r"not\s+(?:pursuant to|under)\s+(?:a\s+)?rule\s*10b5\s*[- ]?1")
    stated = notes.rlike(r"rule\s*10b5\s*[- ]?1|10b5\s*[- ]?1\s*(?:plan|trading)")
    plan = F.coalesce("plan", F.when(denied, False).when(stated, True))
    base = F.create_map(*[F.lit(x) for pair in TRADE_CODES.items() for x in pair])
    labelled = trades.withColumns({"is_plan": plan, "_base": F.coalesce(F.try_element_at(base, code), F.lit("unknown"))})
    planned = (code == "S") & F.col("is_plan").isNull() & words.rlike(r"automatic|pre[- ]?arranged|planned sale|scheduled sale")
    kind = (
        F.when((code == "S") & F.coalesce("is_plan", F.lit(False)), "automatic_sale").when(planned, "planned_sale")
        .when((code == "M") & (direction == "D"), "option_exercise_and_sale").when((code == "M") | words.rlike(r"option\s+(?:exercise|conversion)|exercise of option"), "option_exercise")
        .when((code == "A") & words.rlike(r"rsu|restricted stock|vesting|vested"), F.when(words.contains("rsu"), "rsu_vesting").otherwise("restricted_stock_vesting"))
        .when((code == "F") | words.rlike(r"tax(?:es| withholding)|withhold"), "tax_withholding")
        .when(code == "G", "gift").when(code == "C", "conversion").when(code == "D", "transfer").otherwise(F.col("_base"))
    )
    t = F.col("transaction_type")
    return labelled.withColumns({"transaction_type": kind, "confidence": F.when(planned, 0.86).when(code.isin(*TRADE_CODES), 0.98).otherwise(0.55)}).withColumns({
        "is_open_market": F.when(t.isin("open_market_purchase", "open_market_sale", "automatic_sale", "planned_sale"), True).when(t != "unknown", False),
        "is_option_exercise": t.isin("option_exercise", "option_exercise_and_sale"), "is_equity_award": t.isin("award_grant", "restricted_stock_vesting", "rsu_vesting"),
        "is_tax_withholding": t == "tax_withholding", "is_gift": t == "gift", "is_automatic_sale": t.isin("automatic_sale", "planned_sale"),
    }).drop("_base")


def holdings_before(trades: DataFrame) -> DataFrame:
    """Holdings before a trade from those after it; percent of both; NULL where direction or totals are unsafe."""
    after, n, side = F.col("shares_after"), F.col("shares"), F.col("acquired_disposed")
    pre = F.when(side == "A", after - n).when(side == "D", after + n)
    pre = F.when(pre >= 0, pre)
    return trades.withColumns({
        "shares_before": pre, "before_method": F.when(pre.isNotNull(), "derived").otherwise("unknown"),
        "percent_of_before": safe_div(n * 100, pre), "percent_of_after": safe_div(n * 100, after),
    })


def coherent_sequences(trades: DataFrame) -> DataFrame:
    """Same-day sequences whose totals do not chain lose their derived pre-holdings.

    ``trades`` needs shares_before, shares_after, row_index and the sequence key columns.
    """
    key = ["person_id", "transaction_date", "security_type", "security_title", "ownership_form"]
    safe = trades.withColumns({f"_{k}": F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key})
    hidden = [f"_{k}" for k in key]
    stepped = with_previous(safe, hidden, [F.coalesce("row_index", F.lit(-1)), "transaction_id"], ["shares_after"])
    broken = F.col("prev_shares_after").isNotNull() & F.coalesce(F.abs(F.col("prev_shares_after") - F.col("shares_before")) > 1e-9, F.lit(True))
    verdict = stepped.groupBy(*hidden).agg(F.count("*").alias("_n"), F.max(broken | F.col("row_index").isNull() | F.col("shares_after").isNull()).alias("_bad"))
    j = attach(safe, verdict, hidden)
    bad = (F.col("_n") > 1) & F.col("_bad")
    return j.withColumns({
        "shares_before": F.when(~bad, F.col("shares_before")), "before_method": F.when(bad, "unknown").otherwise(F.col("before_method")), "percent_of_before": F.when(~bad, F.col("percent_of_before")), "sequence_unresolved": bad,
    }).drop("_n", "_bad", *hidden)


def distinct_positions(positions: DataFrame) -> DataFrame:
    """Indirect trust, spouse, joint or footnoted rows that repeat an earlier beneficial count are marked dropped.

    ``positions``: ownership_id, person_id, security_title, shares, direct_indirect, nature, as_of_date.
    Only the first row of a (person, title, shares) group and plain rows survive.
    """
    nature = F.lower(F.coalesce("nature", F.lit("")))
    shared = (F.col("direct_indirect") == "I") & nature.rlike("trust|spouse|joint|see footnote|disclaim")
    order = F.struct(F.coalesce(F.col("as_of_date").cast("string"), F.lit("")), "ownership_id")
    key = ["person_id", "security_title", "shares"]
    first = positions.where(F.col("shares").isNotNull()).groupBy(*key).agg(F.min(order).alias("_first"))
    j = attach(positions.withColumn("_o", order), first, key)
    overlap = shared & F.col("_first").isNotNull() & (F.col("_o") > F.col("_first"))
    warning = F.when(overlap, "possible overlapping indirect ownership").when(shared & nature.rlike("see footnote|disclaim"), "ambiguous indirect ownership")
    return j.withColumns({"kept": ~F.coalesce(overlap, F.lit(False)), "warning": warning}).drop("_o", "_first")


def trade_counts(trades: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per trade class."""
    t = F.col("transaction_type")
    # Reporting classes of trade types.
    classes = {
        "open_market_purchases": ["open_market_purchase"], "open_market_sales": ["open_market_sale"], "automatic_sales": ["automatic_sale"], "planned_sales": ["planned_sale"],
        "option_exercises": ["option_exercise", "option_exercise_and_sale"], "awards_vesting": ["award_grant", "restricted_stock_vesting", "rsu_vesting"], "tax_withholding": ["tax_withholding"],
        "gifts_transfers": ["gift", "transfer"], "conversions": ["conversion"],
    }
    known = [x for v in classes.values() for x in v]
    return trades.groupBy(*keys).agg(*[F.count_if(t.isin(*v)).alias(n) for n, v in classes.items()], F.count_if(~t.isin(*known)).alias("other"))


def discretionary(side: str) -> Column:
    return F.col("is_open_market") & ~F.coalesce("is_automatic_sale", F.lit(False)) & (F.col("transaction_type") == f"open_market_{side}")


def trade_clusters(trades: DataFrame, window_days: int = 30) -> DataFrame:
    """Anchored clusters: from each unconsumed trade day, all trades within the window; two people make a cluster.

    ``trades``: transaction_id, ticker, side, person_id, transaction_date, value. The rule only looks at days: a
    day's window holds a second person exactly when its smallest and largest person differ. So trades collapse to
    (ticker, side, day) extremes first, the sequential jump runs on at most one row per calendar day, and the
    intervals found are joined back to the trades.
    """
    days = trades.where(F.col("transaction_date").isNotNull()).groupBy("ticker", "side", "transaction_date").agg(F.min("person_id").alias("lo"), F.max("person_id").alias("hi"))
    types = {f.name: f.dataType.simpleString() for f in days.schema.fields}

    def jump(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("transaction_date").reset_index(drop=True)
        at = pd.to_datetime(rows["transaction_date"])
        found, i = [], 0
        while i < len(rows):
            last = at.searchsorted(at[i] + pd.Timedelta(days=window_days), side="right")
            if rows["lo"][i:last].min() != rows["hi"][i:last].max():
                found.append((rows["ticker"][0], rows["side"][0], rows["transaction_date"][i], rows["transaction_date"][last - 1]))
                i = last
            else:
                i += 1
        return pd.DataFrame(found, columns=["ticker", "side", "start_date", "end_date"])

    spans = days.groupBy("ticker", "side").applyInPandas(jump, f"ticker {types['ticker']}, side {types['side']}, start_date date, end_date date")
    held = asof_day(trades.where(F.col("transaction_date").isNotNull()), spans, ["ticker", "side"], "transaction_date", "start_date", ["end_date"])
    inside = held.where(F.col("matched_day").isNotNull() & (F.col("transaction_date") <= F.col("end_date")))
    return inside.groupBy("ticker", "side", F.col("matched_day").alias("start_date")).agg(
        F.max("transaction_date").alias("end_date"), F.countDistinct("person_id").alias("people"), F.count("*").alias("trades"), F.sum(F.coalesce("value", F.lit(0.0))).alias("combined_value"),
    )


def alignment_snapshot(trades: DataFrame, as_of: Column, keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """30/90/365-day purchases and sales, values, distinct people, net and planned values as of a date."""
    seen = trades.where(F.col("transaction_date") <= as_of)
    age = F.datediff(as_of, F.col("transaction_date"))
    aggs = []
    for side in ("purchase", "sale"):
        own = discretionary(side)
        aggs += [F.count_if(own & (age <= d)).alias(f"{side}s_{d}d") for d in (30, 90, 365)]
        aggs += [F.sum(F.when(own & (age <= 365), F.coalesce("value", F.lit(0.0))).otherwise(0.0)).alias(f"{side}_value_365d"), F.countDistinct(F.when(own & (age <= 365), F.col("person_id"))).alias("buyers_365d" if side == "purchase" else "sellers_365d")]
    for kind in ("automatic_sale", "planned_sale"):
        aggs.append(F.sum(F.when((F.col("transaction_type") == kind) & (age <= 365), F.coalesce("value", F.lit(0.0))).otherwise(0.0)).alias(f"{kind}_value_365d"))
    return seen.groupBy(*keys).agg(*aggs).withColumn("net_value_365d", F.col("purchase_value_365d") - F.col("sale_value_365d"))


def role_holdings(positions: DataFrame, people: DataFrame) -> DataFrame:
    """Shares by role from kept non-derivative positions; a role without a known count stays NULL."""
    j = positions.where(F.col("kept") & (F.col("security_type") != "derivative")).join(people, ["ticker", "person_id"])
    roles = {"ceo": "is_ceo", "cfo": "is_cfo", "founder": "is_founder", "director": "is_director"}
    return j.groupBy("ticker").agg(*[F.sum(F.when(F.coalesce(c, F.lit(False)), F.col("shares"))).alias(f"{r}_shares") for r, c in roles.items()], F.sum("shares").alias("known_insider_shares"))


def current_holdings(positions: DataFrame) -> DataFrame:
    """Latest position per (ticker, person, security, direct or indirect)."""
    return latest_per_key(positions, ["ticker", "person_id", "security_title", "direct_indirect"], [F.coalesce("as_of_date", F.to_date(F.lit("0001-01-01"))), F.coalesce("filing_date", F.to_date(F.lit("0001-01-01"))), "ownership_id"])


def latest_baselines(baselines: DataFrame) -> DataFrame:
    """All rows of each ticker's newest baseline filing."""
    last = baselines.groupBy("ticker").agg(F.max("filing_date").alias("filing_date"))
    return baselines.join(last, ["ticker", "filing_date"], "left_semi")


def reconcile_baselines(baselines: DataFrame, trades: DataFrame, positions: DataFrame) -> DataFrame:
    """Proxy baseline plus later direct trades against the latest reported position.

    ``baselines``: baseline_id, ticker, person_id, beneficial_shares, as_of_date, is_group, security_class, notes.
    """
    direct = trades.where((F.col("security_type") != "derivative") & (F.upper("ownership_form") == "D") & (F.coalesce("nature", F.lit("")) == ""))
    change = F.when(F.col("acquired_disposed") == "A", F.col("shares")).when(F.col("acquired_disposed") == "D", -F.col("shares")).otherwise(0.0)
    later = attach(direct.select("ticker", "person_id", "transaction_date", change.alias("_d")), baselines.select("baseline_id", "ticker", "person_id", F.col("as_of_date").alias("_since")), ["ticker", "person_id"], how="inner").where(F.col("transaction_date") > F.coalesce("_since", F.to_date(F.lit("0001-01-01"))))
    moved = later.groupBy("baseline_id").agg(F.sum("_d").alias("_delta"), F.max("transaction_date").alias("_last"))
    latest = positions.groupBy("ticker", "person_id").agg(F.max_by("shares", F.struct("as_of_date", "ownership_id")).alias("reported_shares"))
    j = baselines.join(moved, "baseline_id", "left").join(latest, ["ticker", "person_id"], "left")
    shared = F.lower(F.coalesce("notes", F.lit(""))).rlike("trust|spouse|disclaim|shared beneficial")
    usable = ~F.col("is_group") & F.col("beneficial_shares").isNotNull() & (F.coalesce("security_class", F.lit("")) != "multiple") & ~shared
    rebuilt = F.when(usable & F.col("_delta").isNotNull(), F.col("beneficial_shares") + F.col("_delta"))
    differs = F.coalesce(F.abs(F.col("reported_shares") - rebuilt) > 0.01, F.lit(False))
    warning = (
        F.when(F.col("is_group"), "GROUP_OR_MAJOR_OWNER").when(F.col("beneficial_shares").isNull(), "NO_NUMERIC_SHARE_COUNT").when(F.coalesce("security_class", F.lit("")) == "multiple", "MULTIPLE_SECURITY_CLASSES")
        .when(shared, "SHARED_OR_INDIRECT_OWNERSHIP").when(rebuilt.isNotNull() & differs, "DIFFERS_FROM_REPORTED_POSITION").when(rebuilt.isNotNull(), None)
        .when(F.col("reported_shares").isNotNull(), "NO_LATER_TRADES").otherwise("NO_COMPARABLE_POSITION")
    )
    method = F.when(rebuilt.isNotNull() & ~differs, "proxy_plus_section16_reconciled").otherwise("proxy_only")
    return j.select("baseline_id", "ticker", "person_id", "beneficial_shares", "reported_shares", rebuilt.alias("reconstructed_shares"), method.alias("method"), warning.alias("warning"))


# --- people and roles -------------------------------------------------------------------------------------

# Role categories by title pattern, in order.
ROLE_PATTERNS = (
    ("chair", r"(?i)\b(?:chair(?:man|person)?|chair of the board)\b"), ("lead_independent_director", r"(?i)\blead independent director\b"), ("director", r"(?i)\bdirector\b|\bboard member\b"),
    ("CEO", r"(?i)\bchief executive officer\b|\bCEO\b|principal executive officer"), ("CFO", r"(?i)\bchief financial officer\b|\bCFO\b|principal financial officer"), ("COO", r"(?i)\bchief operating officer\b|\bCOO\b"),
    ("president", r"(?i)\bpresident\b"), ("CTO", r"(?i)\bchief technology officer\b|\bCTO\b"), ("chief_product_officer", r"(?i)\bchief product officer\b|\bCPO\b"), ("chief_commercial_officer", r"(?i)\bchief commercial officer\b|\bCCO\b"),
    ("general_counsel", r"(?i)\bgeneral counsel\b|\bchief legal officer\b"), ("founder", r"(?i)\bco[- ]?founder\b|\bfounder\b"), ("executive", r"(?i)\bchief\b|\bexecutive officer\b|\bsecretary\b|\btreasurer\b|\bvice president\b"),
)
SENTENCE_END = r"(?<=[.!?])(?<!\b(?:Mr|Ms|Mrs|Dr|Jr|Sr|Inc|Co)\.)\s+"
ROLE_WORDS = r"CEO|chief executive officer|CFO|chief financial officer|COO|chief operating officer|president|chair(?:man|person)?|director|general counsel|executive officer|chief legal officer"


def role_classes(title: Column) -> Column:
    """Every role category a title states, in fixed order."""
    return F.array_compact(F.array(*[F.when(title.rlike(p), F.lit(n)) for n, p in ROLE_PATTERNS]))


def canonical_role(category: Column, role: Column, title: Column) -> Column:
    t = F.lower(F.concat_ws(" ", role, title))
    return (
        F.when((category == "CEO") | t.contains("chief executive officer"), "CEO").when((category == "CFO") | t.contains("chief financial officer"), "CFO")
        .when((category == "COO") | t.contains("chief operating officer"), "COO").when((category == "CTO") | t.contains("chief technology officer"), "CTO")
        .when((category == "general_counsel") | t.contains("general counsel"), "general_counsel")
        .when((category == "president") & ~t.contains("executive vice president"), "president")
        .when((category == "executive") & ~t.rlike("director|chair|chief executive|chief financial|chief operating|chief technology"), "executive")
        .when((category == "founder") & t.rlike("president|chief|executive"), "founder")
    )


def date_precision(text: Column, explicit: Column) -> Column:
    n = F.length(text)
    return F.coalesce(explicit, F.when(n == 4, "year").when(n == 7, "month").when(n == 10, "day").when(n > 0, "reported"))


def full_date(text: Column) -> Column:
    """First day a year, month or day text can mean."""
    n = F.length(text)
    return F.when(n == 4, F.concat(text, F.lit("-01-01"))).when(n == 7, F.concat(text, F.lit("-01"))).otherwise(text).try_cast("date")


def merge_entities(rows: DataFrame, key: str, lists: Sequence[str], scalars: Sequence[str], flags: Sequence[str], order: str) -> DataFrame:
    """One row per id: union of list fields, first non-empty scalar in ``order``, OR of flags.

    Lists are exploded and deduplicated before they are gathered, so copies of one entity cost one element.
    """
    base = rows.groupBy(key).agg(
        *[F.min_by(s, F.when(F.coalesce(F.trim(F.col(s).cast("string")), F.lit("")) != "", F.col(order))).alias(s) for s in scalars],
        *[F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in flags],
    )
    for name in lists:
        items = rows.select(key, F.explode(name).alias("_i")).distinct()
        base = base.join(items.groupBy(key).agg(F.array_sort(F.collect_list("_i")).alias(name)), key, "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return base


def build_tenures(assertions: DataFrame, as_of: Column) -> DataFrame:
    """Merge assertions of one (ticker, person, role, start, end); a specific role beats the generic executive one.

    ``assertions``: ticker, person_id, role_category, role, title, start, end (year/month/day texts), precision, evidence.
    A departure after ``as_of`` keeps the tenure current with a scheduled end.
    """
    named = assertions.withColumn("canonical_role", canonical_role(F.col("role_category"), F.col("role"), F.col("title"))).where(F.col("canonical_role").isNotNull())
    key = ["ticker", "person_id", "canonical_role", "start", "end"]
    filled = named.withColumns({"start": F.coalesce("start", F.lit("")), "end": F.coalesce("end", F.lit(""))})
    merged = filled.groupBy(*key).agg(F.max_by("title", F.length("title")).alias("title"), F.max("precision").alias("precision"), F.countDistinct("evidence").alias("evidence_count"), F.count("*").alias("assertions"))
    specific = merged.where(F.col("canonical_role") != "executive").select("ticker", "person_id", "start").distinct().withColumn("_specific", F.lit(True))
    kept = merged.join(specific, ["ticker", "person_id", "start"], "left").where(~((F.col("canonical_role") == "executive") & F.coalesce("_specific", F.lit(False)))).drop("_specific")
    end = full_date(F.nullif("end", F.lit("")))
    return kept.select(
        "ticker", "person_id", "canonical_role", "title", full_date(F.nullif("start", F.lit(""))).alias("start_date"), end.alias("end_date"), date_precision(F.nullif("start", F.lit("")), F.col("precision")).alias("precision"),
        (end.isNull() | (end > as_of)).alias("is_current"), F.when(end > as_of, end).alias("scheduled_end"), "evidence_count", "assertions",
    )


def link_people(managers: DataFrame, insiders: DataFrame) -> DataFrame:
    """Every link of management people to ownership people of the same ticker.

    ``managers``: ticker, person_id, name; ``insiders``: ticker, person_id, name, owner_id. Equal name keys match;
    otherwise a shared surname of at least four letters and matching given-name prefixes. All matches are returned:
    ambiguous if the person has several, else high with an owner id and probable without.
    """
    def keyed(df: DataFrame, prefix: str, *more: str) -> DataFrame:
        k = tx.name_key(F.col("name"))
        return df.select(F.upper("ticker").alias("ticker"), F.col("person_id").alias(f"{prefix}_id"), k.alias(f"{prefix}_key"), F.split(k, " ").alias(f"{prefix}_tokens"), *more)

    m, i = keyed(managers, "m"), keyed(insiders, "i", "owner_id")
    exact = m.join(i, (m["ticker"] == i["ticker"]) & (m["m_key"] == i["i_key"])).select(m["ticker"], "m_id", "i_id", "owner_id", F.lit("issuer_exact_name").alias("method"))
    long = lambda df, p: df.select("*", F.explode(F.filter(f"{p}_tokens", lambda t: F.length(t) >= 4)).alias("token"))
    lm, li = long(m, "m").withColumnRenamed("ticker", "tm"), long(i, "i")
    near = lm.join(li, (lm["tm"] == li["ticker"]) & (lm["token"] == li["token"]) & (lm["m_key"] != li["i_key"]))
    near = near.select(li["ticker"], "m_id", "i_id", "owner_id", "m_tokens", "i_tokens")
    surname = F.array_max(F.transform(F.array_intersect("m_tokens", "i_tokens"), lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]
    given = near.withColumn("_s", surname)
    a, b = F.filter("m_tokens", lambda t: t != F.col("_s")), F.filter("i_tokens", lambda t: t != F.col("_s"))
    alike = F.forall(a, lambda x: F.exists(b, lambda y: x.startswith(F.substring(y, 1, 3)) | y.startswith(F.substring(x, 1, 3))))
    variant = given.where((F.size(a) > 0) & (F.size(b) > 0) & alike).select("ticker", "m_id", "i_id", "owner_id", F.lit("issuer_name_variant").alias("method")).distinct()
    found = exact.distinct().unionByName(variant)
    counted = found.groupBy("ticker", "m_id").agg(F.count("*").alias("candidates"))
    owned = F.col("owner_id").isNotNull()
    confidence = F.when(F.col("candidates") > 1, "ambiguous").when(owned, "high").otherwise("probable")
    method = F.concat("method", F.when(owned, "+owner_cik").otherwise(""))
    return found.join(counted, ["ticker", "m_id"]).select("ticker", F.col("m_id").alias("person_id"), F.col("i_id").alias("insider_id"), method.alias("method"), "candidates", confidence.alias("confidence"))


def resolve_identities(people: DataFrame) -> DataFrame:
    """Cross-company identity: a strong id or the same issuer resolves; one name at several issuers without one gets an issuer-bound id.

    ``people``: row_id, ticker, name, strong_id, biography.
    """
    k = people.withColumn("name_key", tx.name_key(F.col("name")))
    spread = k.groupBy("name_key").agg(F.countDistinct("ticker").alias("issuers"), F.countDistinct("strong_id").alias("strong_ids"))
    j = attach(k, spread, ["name_key"])
    other = F.coalesce(F.lower("biography").rlike(r"\b(?:also serves|serves on the board|previously|formerly)\b"), F.lit(False))
    status = F.when(F.col("strong_id").isNotNull(), "strong_identifier").when(F.col("issuers") == 1, "same_issuer").when(other & (F.col("strong_ids") <= 1), "biography_supported").otherwise("ambiguous")
    pid = F.when(status == "ambiguous", F.concat(F.lit("person:"), F.substring(F.sha2(F.concat_ws("|", "ticker", "name_key"), 256), 1, 20))).otherwise(tx.person_id(F.col("name"), F.col("strong_id")))
    return j.withColumns({"identity_status": status, "person_id": pid}).drop("name_key", "issuers", "strong_ids")


# Words of organisations that are no companies, and of private ones.
NON_COMPANY_WORDS = ("university", "college", "institute", "hospital", "foundation", "department", "school of")
PRIVATE_WORDS = ("venture", "capital", "fund", "private", "family office")


def resolve_organizations(names: DataFrame, companies: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Organisation names to listed companies by exact or word-prefix title; only a single matching title counts.

    ``names``: name; ``companies``: ticker, title; ``aliases``: alias, title (normalised names that stand for a title).
    They meet on equal beginnings of whole words, never on the first word alone, so a word that every title shares makes no
    pairs. Returns name, matched_title, ticker, status.
    """
    tidy = lambda c: F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))
    n = names.select("name").distinct().withColumn("own", tidy(F.col("name")))
    if aliases is not None:
        n = n.join(aliases.select(tidy(F.col("alias")).alias("own"), tidy(F.col("title")).alias("_title")).dropDuplicates(["own"]), "own", "left")
    else:
        n = n.withColumn("_title", F.lit(None).cast("string"))
    n = n.withColumn("n", F.coalesce("_title", "own"))
    titles = companies.select("ticker", "title", tidy(F.col("title")).alias("t")).where("t <> ''").groupBy("t").agg(F.min(F.struct("ticker", "title")).alias("listing"), F.count("*").alias("listed"))
    wanted = n.where("n <> ''").select("n").distinct()
    heads = lambda c: F.transform(F.sequence(F.lit(1), F.size(F.split(c, " "))), lambda i: F.array_join(F.slice(F.split(c, " "), F.lit(1), i), " "))
    # A title that a name equals or begins, counted per beginning; then the shorter titles that begin a name.
    begun = titles.select(F.explode(heads(F.col("t"))).alias("n"), "listing", "listed").groupBy("n").agg(F.sum("listed").alias("listed"), F.min("listing").alias("listing"))
    longer = look_up(wanted, begun, ["n"], how="inner").select("n", "listing", "listed")
    shorter = wanted.select("n", F.explode(heads(F.col("n"))).alias("t")).where("t <> n").join(titles, "t").select("n", "listing", "listed")
    one = longer.unionByName(shorter).groupBy("n").agg(F.sum("listed").alias("hits"), F.min("listing").alias("listing")).where("hits = 1")
    has = lambda words: reduce(Column.__or__, [F.col("own").contains(w) for w in words])
    status = F.when(F.col("hits") == 1, "PUBLIC_COMPANY_CONFIRMED").when(has(NON_COMPANY_WORDS), "NON_COMPANY_ORGANIZATION").when(has(PRIVATE_WORDS), "PRIVATE_COMPANY").otherwise("UNRESOLVED")
    return look_up(n, one, ["n"]).select("name", F.col("listing.title").alias("matched_title"), F.col("listing.ticker").alias("ticker"), status.alias("status"))


def issuer_metadata(sources: Sequence[DataFrame], fields: Sequence[str]) -> DataFrame:
    """One row per ticker: each field from the first source that states it."""
    tagged = [df.select("ticker", *fields, F.lit(i).alias("_p")) for i, df in enumerate(sources)]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df)
    return union.groupBy("ticker").agg(*[F.min_by(f, F.when(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) != "", F.col("_p"))).alias(f) for f in fields])


# --- guidance, commitments, capital -----------------------------------------------------------------------------

# Guidance metrics, units, statuses; commitment and capital vocabularies.
GUIDANCE_METRICS = (
    ("EPS", r"\beps\b|earnings per share"), ("revenue", r"revenue|top[- ]line"), ("gross_margin", r"gross margin"), ("operating_margin", r"operating margin|income from operations"),
    ("operating_income", r"operating income"), ("free_cash_flow", r"free cash flow"), ("capital_expenditure", r"capex|capital expenditure"), ("cash", r"cash(?: balance| position)?"),
)
GUIDANCE_STATUS = (("withdrawn", r"withdrawn|withdraw"), ("superseded", r"supersed|replaced"), ("raised", r"raise|raised|increase|increased|higher"), ("lowered", r"lower|lowered|cut|reduced"), ("reiterated", r"reiterate|maintain|unchanged|continue to expect"))
_UNIT = r"(billion|million|thousand|bn|mm|m|k|%)?"
GUIDANCE_RANGE = rf"(?i)(?:\$\s*)?(\d+(?:\.\d+)?)\s*{_UNIT}\s*(?:to|-)\s*(?:\$\s*)?(\d+(?:\.\d+)?)\s*{_UNIT}"
GUIDANCE_POINT = rf"(?i)(?:guidance|outlook|forecast|target|guide)\D{{0,50}}(?:\$\s*)?(\d+(?:\.\d+)?)\s*{_UNIT}"
COMMITMENT_CATEGORIES = (
    ("product_launch", r"launch|introduc|release"), ("capacity", r"capacity|manufactur|supply chain"), ("cost_reduction", r"cost|expense|efficien"), ("margin_target", r"margin"), ("revenue_target", r"revenue|growth target"),
    ("international_expansion", r"international|europe|asia|global expansion"), ("customer_target", r"customer|user|seat"), ("regulatory_milestone", r"regulatory|approval|fda|ind"), ("clinical_milestone", r"clinical|trial|phase [1-3]"),
    ("acquisition_integration", r"acquisition|integration|synerg"), ("debt_reduction", r"debt|leverage"), ("capital_return", r"buyback|repurchase|dividend|capital return"),
)
COMMITMENT_ACTION = r"\b(?:will|plan to|intend to|intended to|committed to|aim to|target(?:ed|ing)?|goal is to|objective is to)\b.{0,140}\b(?:launch|complete|expand|reduce|invest|integrat|achiev|reach|deliver|develop|build|enter|open|increase|decrease|add|create)\w*\b"
COMMITMENT_STOPWORDS = ("this", "that", "will", "plan", "expect", "intended", "intend", "company", "continue", "important", "measure", "terms", "think", "meaning", "putting", "additional", "cost", "bring", "interest", "customers", "drive", "future", "more", "also", "really", "some", "very", "their", "our", "into", "from", "with", "have", "been")


def guidance_from_claims(claims: DataFrame) -> DataFrame:
    """One row per stated metric: horizon, low, high or point in base units, unit, status.

    ``claims``: claim_id, ticker, evidence_text, period_label, issued_date. A single number is kept as ``point``.
    """
    t, low = F.col("evidence_text"), F.lower("evidence_text")
    metrics = F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(n)) for n, p in GUIDANCE_METRICS]))

    def scaled(number: Column, unit: Column) -> Column:
        u = F.lower(unit)
        factor = F.when(u.isin("billion", "bn"), 1e9).when(u.isin("million", "mm", "m"), 1e6).when(u.isin("thousand", "k"), 1e3).otherwise(1.0)
        return number.try_cast("double") * factor

    g = [F.regexp_extract(t, GUIDANCE_RANGE, i) for i in range(1, 5)]
    p = [F.regexp_extract(t, GUIDANCE_POINT, i) for i in (1, 2)]
    ranged = g[0] != ""
    unit = F.when(ranged, F.coalesce(F.nullif(g[1], F.lit("")), F.nullif(g[3], F.lit("")))).otherwise(F.nullif(p[1], F.lit("")))
    fy, q = F.regexp_extract(t, r"(?i)\bFY\s*['’]?\s*(20\d{2}|\d{2})\b", 1), F.regexp_extract(t, r"(?i)\bQ([1-4])\s*(20\d{2})?\b", 1)
    qy = F.coalesce(F.nullif(F.regexp_extract(t, r"(?i)\bQ([1-4])\s*(20\d{2})?\b", 2), F.lit("")), F.nullif(F.regexp_extract(F.coalesce("period_label", F.lit("")), r"(20\d{2})", 1), F.lit("")))
    labelled = F.regexp_extract(F.coalesce("period_label", F.lit("")), r"(?i)FY\s*(20\d{2})", 1)
    horizon = (
        F.when(fy != "", F.concat(F.lit("FY"), F.when(F.length(fy) == 2, F.concat(F.lit("20"), fy)).otherwise(fy)))
        .when(q != "", F.concat_ws(" ", F.concat(F.lit("Q"), q), qy)).when(labelled != "", F.concat(F.lit("FY"), labelled))
    )
    status = F.coalesce(*[F.when(low.rlike(x), F.lit(n)) for n, x in GUIDANCE_STATUS], F.lit("issued"))
    kind = F.when(unit == "%", "PERCENT").when(unit.isNotNull() | t.contains("$"), "USD")
    basis = F.when(low.rlike(r"non[- ]gaap"), "NON_GAAP").when(low.rlike(r"\bgaap\b"), "GAAP")
    out = claims.withColumns({
        "horizon": horizon, "low": F.when(ranged, scaled(g[0], F.coalesce(F.nullif(g[1], F.lit("")), unit))), "high": F.when(ranged, scaled(g[2], F.coalesce(F.nullif(g[3], F.lit("")), unit))),
        "point": F.when(~ranged & (p[0] != ""), scaled(p[0], p[1])), "unit": kind, "status": status, "basis": basis, "metric": F.explode(metrics),
    })
    return out.withColumn("guidance_id", tx.stable_id("guidance:", claim=F.col("claim_id"), metric=F.col("metric"), horizon=F.col("horizon")))


def guidance_revisions(guidance: DataFrame) -> DataFrame:
    """Revision number and type inside a (ticker, metric, horizon, unit) series."""
    from gaugework.plans.ordered import numbered

    key = ["ticker", "metric", "horizon", "unit"]
    safe = guidance.withColumns({f"_{k}": F.coalesce(k, F.lit("")) for k in key})
    placed = numbered(safe, [f"_{k}" for k in key], [F.coalesce("issued_date", F.to_date(F.lit("0001-01-01"))), "guidance_id"], "revision_number").drop("revision_number_all", *[f"_{k}" for k in key])
    return placed.withColumn("revision_type", F.when(F.col("revision_number") == 1, "initial").otherwise(F.col("status")))


def guidance_outcomes(guidance: DataFrame, facts: DataFrame, as_of: Column) -> DataFrame:
    """Guidance against the latest comparable actual: MET, BEAT, MISS, WITHDRAWN, NOT_COMPARABLE or UNRESOLVED.

    ``facts``: ticker, metric, fiscal_year, fiscal_period, unit, basis, value, period_end, filed; only those that ended and were
    filed by ``as_of`` are known. A horizon without a year ("Q2") takes the latest known fact of that quarter. Facts
    collapse to one per (ticker, metric, horizon, unit) before the join.
    """
    year, stated = F.col("fiscal_year").cast("string"), F.coalesce("fiscal_period", F.lit("FY"))
    # A quarter answers guidance for that quarter of its year, and guidance that names the quarter alone.
    period = F.when(stated == "FY", F.array(F.concat(F.lit("FY"), year))).otherwise(F.array(F.concat_ws(" ", stated, year), stated))
    unit = F.when(F.upper("unit").isin("PERCENT", "%"), "PERCENT").when(F.upper("unit").isin("USD", "USD/SHARES", "DOLLAR"), "USD").otherwise(F.upper("unit"))
    public = (F.col("period_end") <= as_of) & (F.col("filed").isNull() | (F.col("filed") <= as_of))
    known = facts.where(public).withColumns({"horizon": F.explode(period), "unit": unit})
    order = F.struct("period_end", F.coalesce("filed", F.to_date(F.lit("0001-01-01"))))
    actual = known.groupBy("ticker", "metric", "horizon", "unit").agg(F.max_by(F.struct("value", "basis", "period_end"), order).alias("a"))
    any_unit = actual.groupBy("ticker", "metric", "horizon").agg(F.max_by("a", F.struct("a.period_end", "unit")).alias("x"))
    g = look_up(look_up(guidance, actual, ["ticker", "metric", "horizon", "unit"]), any_unit, ["ticker", "metric", "horizon"])
    fact = F.when(F.col("unit").isNull(), F.col("x")).otherwise(F.col("a"))
    g = g.withColumn("f", fact)
    v, basis_matters = F.col("f.value"), F.col("metric").isin("EPS", "operating_income", "revenue")
    ranged = F.col("low").isNotNull() & F.col("high").isNotNull()
    target = F.coalesce("point", "low", "high")
    gap = F.abs(v - target)
    outcome = (
        F.when(F.col("status") == "withdrawn", "WITHDRAWN").when(F.col("f").isNull() & F.col("x").isNotNull(), "NOT_COMPARABLE").when(F.col("f").isNull(), "UNRESOLVED")
        .when(F.col("basis").isNotNull() & basis_matters & ~F.col("basis").eqNullSafe(F.col("f.basis")), "NOT_COMPARABLE").when(~ranged & target.isNull(), "UNRESOLVED")
        .when(ranged, F.when(v.between(F.col("low"), F.col("high")), "MET").when(v > F.col("high"), "BEAT").otherwise("MISS"))
        .otherwise(F.when(gap <= F.abs(target) * 0.01, "MET").when(v > target, "BEAT").otherwise("MISS"))
    )
    scored = outcome.isin("MET", "BEAT", "MISS")
    error = F.when(scored, v - F.when(ranged, (F.col("low") + F.col("high")) / 2).otherwise(target))
    return g.withColumns({"outcome": outcome, "actual": F.when(scored, v), "error": error, "percent_error": safe_div(error * 100, F.abs(v))}).drop("a", "x", "f")


def guidance_coverage(claims: DataFrame, documents: DataFrame, captured: DataFrame) -> DataFrame:
    """Why guidance is or is not available per ticker. Only an explicit statement confirms absence."""
    t = F.lower("evidence_text")
    spoken = t.rlike(r"\b(?:guidance|outlook|forecast|target|expect|raise|lower|reiterate)\b")
    numeric = spoken & t.rlike(r"\d+(?:\.\d+)?\s*(?:%|percent|million|billion|thousand|m|bn|mm|k)|\$\s*\d")
    absent = spoken & t.rlike(r"\b(?:we|the company|management)\s+(?:do not|does not|never)\s+(?:provide|issue|give)\s+guidance\b|\bno guidance is provided\b")
    c = claims.groupBy("ticker").agg(F.count("*").alias("claims"), F.count_if(spoken).alias("language"), F.count_if(numeric).alias("numeric"), F.count_if(absent).alias("absent"))
    d = documents.groupBy("ticker").agg(F.count("*").alias("documents"))
    g = captured.groupBy("ticker").agg(F.count("*").alias("captured"))
    j = c.join(d, "ticker", "full").join(g, "ticker", "full").fillna(0, ["claims", "language", "numeric", "absent", "documents", "captured"])
    n = F.col
    reason = (
        F.when(n("absent") > 0, "NO_GUIDANCE_GIVEN_CONFIRMED").when(n("captured") > 0, "GUIDANCE_AVAILABLE_AND_CAPTURED").when((n("language") > 0) & (n("numeric") > 0), "GUIDANCE_PRESENT_BUT_NOT_COMPARABLE")
        .when(n("language") > 0, "GUIDANCE_PRESENT_BUT_NOT_NUMERIC").when((n("documents") > 0) & (n("claims") == 0), "GUIDANCE_DOCUMENTS_PRESENT_BUT_NOT_EXTRACTED")
        .when((n("claims") == 0) & (n("documents") == 0), "GUIDANCE_NOT_IN_CURRENT_DOCUMENT_STORE").otherwise("GUIDANCE_EVIDENCE_NOT_FOUND")
    )
    return j.withColumn("reason", reason)


def capital_event(text: Column) -> Column:
    """Struct (type, status, amount, target) of a capital-allocation statement; NULL when none is stated."""
    t = F.lower(text)
    e = lambda kind, status: F.struct(F.lit(kind).alias("type"), (status if isinstance(status, Column) else F.lit(status)).alias("status"))
    kind = (
        F.when(t.rlike(r"closed (?:the )?acquisition|completed (?:the )?acquisition|was .*largest acquisition|largest acquisition .*at"), e("acquisition", "completed"))
        .when(t.rlike(r"acquisition of|acquired\b|entered into an agreement"), e("acquisition", "announced"))
        .when(t.rlike(r"divest|sale of (?:the )?(?:business|subsidiary|asset)"), e("divestiture", F.when(t.rlike("sold|completed"), "completed").otherwise("announced")))
        .when(t.rlike(r"authorized .*repurchase|repurchase authorization|authorized .*buyback"), e("buyback_authorization", "authorized"))
        .when(t.rlike(r"repurchased|buyback program|share repurchase program") & t.rlike(r"completed|repurchased|bought back"), e("buyback_execution", "executed"))
        .when(t.rlike(r"issued .*shares|equity issuance|offering"), e("share_issuance", "executed")).when(t.rlike(r"stock[- ]based compensation|equity compensation"), e("equity_compensation", "reported"))
        .when(t.rlike(r"issued .*debt|debt issuance|notes offering"), e("debt_issuance", "executed")).when(t.rlike(r"repaid .*debt|debt repayment|maturity"), e("debt_repayment", "executed"))
        .when(t.contains("dividend"), e("dividend", F.when(t.contains("declared"), "declared").otherwise("executed")))
        .when(t.rlike(r"capex|capital expenditure") & t.rlike(r"program|plan|spend"), e("capex_program", "planned")).when(t.rlike(r"invested|investment"), e("major_investment", "reported"))
    )
    amount = r"(?i)(?:\$\s*)?(\d+(?:\.\d+)?)\s*(million|billion|thousand|m|bn|k)\b"
    u = F.lower(F.regexp_extract(text, amount, 2))
    value = F.regexp_extract(text, amount, 1).try_cast("double") * F.when(u.isin("billion", "bn"), 1e9).when(u.isin("million", "m"), 1e6).otherwise(1e3)
    target = F.trim(F.regexp_extract(text, r"(?i)(?:acquisition of|acquired)\s+([A-Za-z0-9][A-Za-z0-9 .&'-]{1,70}?)(?=\s+(?:for|at|in|valued|worth)\b|[,.;]|$)", 1))
    return F.when(kind.isNotNull(), F.struct(kind["type"].alias("type"), kind["status"].alias("status"), value.alias("amount"), F.when((kind["type"] == "acquisition") & (target != ""), target).alias("target")))


def commitment_category(text: Column) -> Column:
    t = F.lower(text)
    return F.coalesce(*[F.when(t.rlike(p), F.lit(n)) for n, p in COMMITMENT_CATEGORIES], F.lit("other"))


def is_commitment(text: Column) -> Column:
    """Future, action-oriented statements; guidance and mere possibilities are excluded."""
    t = F.lower(text)
    guidance = t.rlike(r"\b(?:guidance|outlook|forecast|deferred revenue|eps|revenue|margin|cash flow)\b") & t.rlike(r"\b(?:expect|raise|lower|reiterate|up|down)\b")
    maybe = t.rlike(r"\b(?:could|may|might|risk|possibility|i think|opportunity)\b") & ~t.rlike(r"\b(?:target|goal|objective|committed|intend|intended|plan)\b")
    return ~guidance & ~maybe & t.rlike(COMMITMENT_ACTION)


def commitment_outcomes(commitments: DataFrame, claims: DataFrame, first_words: int | None = None) -> DataFrame:
    """Last later claim of the ticker that holds two long words of the commitment decides the outcome; silence is UNRESOLVED.

    ``commitments``: commitment_id, ticker, commitment_text, commitment_date, source_claim_id; ``claims``: claim_id, ticker,
    evidence_text, document_date. A word counts wherever it stands inside the evidence ("launch" in "launched"). A
    commitment without a date admits every claim; its own source claim never counts. All words take part unless
    ``first_words`` limits them.

    Words meet evidence words on their first four letters, once per ticker and distinct word. Claims are reduced to the
    latest two per (ticker, word pair) before they meet the commitments (two, as one of them may be the source), so a
    frequent word never pairs every claim with every commitment.
    """
    def found(text: str) -> Column:
        return F.filter(F.regexp_extract_all(F.lower(text), F.lit("([a-z]{4,})"), 1), lambda t: ~t.isin(*COMMITMENT_STOPWORDS))

    def word_pairs(column: str) -> Column:
        return F.explode(F.expr(f"flatten(transform({column}, (a, i) -> transform(slice({column}, i + 2, size({column})), b -> concat(a, ' ', b))))"))

    words = found("commitment_text") if first_words is None else F.slice(found("commitment_text"), 1, first_words)
    wanted = commitments.withColumn("_w", F.array_sort(F.array_distinct(words)))
    vocabulary = wanted.select("ticker", F.explode("_w").alias("word")).distinct().withColumn("gram", F.substring("word", 1, 4))
    parts = claims.select("ticker", "claim_id", "document_date", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("evidence_text"), F.lit("([a-z]{4,})"), 1))).alias("part"))
    grams = parts.select("ticker", "part").distinct().withColumn("gram", F.explode(F.expr("array_distinct(transform(sequence(1, length(part) - 3), i -> substring(part, i, 4)))")))
    inside = grams.join(vocabulary, ["ticker", "gram"]).where(F.col("part").contains(F.col("word"))).select("ticker", "part", "word").distinct()
    said = look_up(parts, inside, ["ticker", "part"], how="inner")
    known = said.groupBy("ticker", "claim_id", "document_date").agg(F.array_sort(F.collect_set("word")).alias("_w")).where(F.size("_w") >= 2)
    marked = known.select("ticker", word_pairs("_w").alias("pair"), F.struct("document_date", "claim_id").alias("m"))
    top = marked.groupBy("ticker", "pair").agg(F.max("m").alias("m1"))
    second = look_up(marked, top, ["ticker", "pair"], how="inner").where(F.col("m") < F.col("m1")).groupBy("ticker", "pair").agg(F.max("m").alias("m"))
    latest = top.withColumnRenamed("m1", "m").unionByName(second)
    met = attach(wanted.select("commitment_id", "ticker", "commitment_date", "source_claim_id", word_pairs("_w").alias("pair")), latest, ["ticker", "pair"], how="inner")
    later = F.col("commitment_date").isNull() | (F.col("m.document_date") > F.col("commitment_date"))
    other = F.coalesce(F.col("m.claim_id") != F.col("source_claim_id"), F.lit(True))
    last = met.where(later & other).groupBy("commitment_id").agg(F.max("m").alias("m")).select("commitment_id", F.col("m.claim_id").alias("claim_id"), F.col("m.document_date").alias("outcome_date"))
    e = F.lower("evidence_text")
    status = (
        F.when(e.rlike(r"\b(?:launched|completed|closed|achieved|delivered|approved|initiated|implemented)\b"), "ACHIEVED").when(e.rlike("delay|later|rescheduled"), "DELAYED")
        .when(e.rlike("revised|changed"), "REVISED").when(e.rlike("abandon|discontinued|cancelled"), "ABANDONED").otherwise("UNRESOLVED")
    )
    # Only commitments with a claim meet the claims, so no NULL key is joined.
    decided = last.join(claims.select("claim_id", "evidence_text"), "claim_id").select("commitment_id", status.alias("outcome"), "outcome_date", "claim_id")
    return commitments.select("commitment_id").join(decided, "commitment_id", "left").select("commitment_id", F.coalesce("outcome", F.lit("UNRESOLVED")).alias("outcome"), "outcome_date", "claim_id")


def name_in_text(name: Column, text: Column) -> Column:
    """The last two name words longer than two letters occur as whole words."""
    tokens = F.filter(F.regexp_extract_all(name, F.lit("([A-Za-z]+)"), 1), lambda t: F.length(t) > 2)
    pair = F.slice(tokens, F.greatest(F.size(tokens) - 1, F.lit(1)), 2)
    return (F.size(tokens) >= 2) & F.forall(pair, lambda t: F.regexp_like(text, F.concat(F.lit(r"(?i)\b"), t, F.lit(r"\b"))))


def attribution(text: Column, name: Column, role: Column) -> Column:
    """DIRECT, TEAM, ROLE_BASED, TENURE_OVERLAP or UNATTRIBUTED."""
    t = F.lower(text)
    return (
        F.when(name.isNotNull() & name_in_text(name, text) & t.rlike(r"(?:decided|directed|led|committed|announced|said|stated|approved|signed|initiated|delivered)"), "DIRECT")
        .when(t.rlike(r"\b(?:board|management|management team|executive team|company|we|our)\b"), "TEAM").when(role.isin("CEO", "CFO", "COO", "CTO", "president", "general_counsel", "executive"), "ROLE_BASED")
        .when(name.isNotNull(), "TENURE_OVERLAP").otherwise("UNATTRIBUTED")
    )


def attribution_errors(rows: DataFrame) -> DataFrame:
    """Unsupported levels, and DIRECT without the name in the evidence (``attribution``, ``evidence_text``, ``name``)."""
    a = F.col("attribution")
    error = F.when(~a.isin("DIRECT", "ROLE_BASED", "TEAM", "TENURE_OVERLAP", "UNATTRIBUTED"), "unsupported attribution level").when((a == "DIRECT") & F.col("name").isNotNull() & ~name_in_text(F.col("name"), F.col("evidence_text")), "DIRECT requires the named person in evidence")
    return rows.withColumn("error", error).where(F.col("error").isNotNull())


# --- boards -------------------------------------------------------------------------------------------------

# Expertise terms and committee names.
EXPERTISE = {
    "finance": ("finance", "financial", "cfo", "accounting", "audit", "treasurer", "investment banker"), "accounting": ("accounting", "auditor", "audit committee", "certified public accountant", "cpa"),
    "capital_markets": ("capital markets", "investment banking", "private equity", "venture capital", "investor"), "operations": ("operations", "operating officer", "chief operating", "supply chain", "manufacturing"),
    "technology": ("technology", "software", "information technology", "digital", "computer", "engineering", "artificial intelligence", " ai "), "cybersecurity": ("cybersecurity", "cyber security", "network security", "information security"),
    "biotechnology": ("biotech", "biotechnology", "life sciences"), "pharmaceuticals": ("pharmaceutical", "pharma", "drug development", "medicinal chemistry"), "clinical": ("clinical", "clinical-stage", "clinical trials"),
    "regulatory": ("regulatory", "government", "public policy", "federal", "compliance"), "legal": ("legal", "law", "attorney", "general counsel"), "sales": ("sales", "revenue", "commercial"), "marketing": ("marketing", "brand", "communications"),
    "international": ("international", "global", "europe", "asia"), "M&A": ("merger", "acquisition", "m&a", "corporate development"), "consumer": ("consumer", "retail", "e-commerce"), "government": ("government", "defense", "military", "public sector"),
}


# Phrases of independence statements.
EXECUTIVE_EVIDENCE = r"chief executive officer|president and chief executive|co-founder|founder and|executive chair"
DENIAL = r"not\s+(?:deemed\s+|considered\s+)?independent"
DETERMINATION = r"board(?:\s+of\s+directors)?\s+has\s+determined"
CHIEF_EXCEPTION = r"all\s+directors\s+independent,?\s+except\s+for\s+(?:our\s+)?(?:ceo|chief\s+executive\s+officer)"
CHIEF_ROLE = r"\b(?:ceo|chief executive officer|president\s+and\s+chief executive)\b"


def phrase_index(texts: DataFrame, key: str, phrases: Mapping[str, str], words: DataFrame, word: str) -> tuple[DataFrame, DataFrame]:
    """Positions of phrases and of words in each text: (key, sentence_no, at, kind) and (key, sentence_no, at, word).

    A sentence ends at a full stop; the items of a list belong to the sentence that introduces them. ``phrases`` are patterns
    by kind (lower-case letters), an earlier one takes its text from the later; ``words`` (key, word), lower case and of three
    letters or more, are looked up as whole words in the texts of their key only. ``at`` numbers phrases and words of a sentence
    together. Texts, sentences and words are rows of Spark, never lists of a task.
    """
    marked = F.col("sentence")
    for kind, pattern in phrases.items():
        marked = F.regexp_replace(marked, f"(?i){pattern}", f" \x01{kind}\x02 ")
    parts = texts.select(key, F.posexplode(F.split("text", SENTENCE_END)).alias("sentence_no", "sentence"))
    tokens = parts.select(key, "sentence_no", F.posexplode(F.regexp_extract_all(marked, F.lit("(\x01[a-z]+\x02|\\p{L}{3,})"), 1)).alias("at", "_token"))
    phrase = F.col("_token").startswith("\x01")
    marks = tokens.where(phrase).select(key, "sentence_no", "at", F.regexp_replace("_token", "[\x01\x02]", "").alias("kind"))
    said = tokens.where(~phrase).select(key, "sentence_no", "at", F.lower("_token").alias(word))
    return marks, said.join(words.select(key, word).distinct(), [key, word])


def independence(directors: DataFrame, proxies: DataFrame) -> DataFrame:
    """(ticker, person_id, independence, basis): INDEPENDENT, NOT_INDEPENDENT or UNKNOWN of every director.

    ``directors``: ticker, person_id, name, evidence_text, roles (array); ``proxies``: ticker, text. The director's own row
    speaks first. In the proxy each denial binds by position to its nearest surnames: those between the phrase before it and
    itself in its sentence, else those behind it up to the next phrase, else the last surname before it in the text. A
    denial beats everything else there; then "all directors independent except for our CEO" decides by role; then surnames in
    the sentence of a board determination that says independent. Distance in characters never matters, and surnames
    (the last word of three letters or more) are compared as words, not as patterns.
    """
    d = directors.select("ticker", "person_id", F.lower(F.coalesce("evidence_text", F.lit(""))).alias("_e"), "roles", F.lower(F.try_element_at(F.regexp_extract_all("name", F.lit(r"([\p{L}]{3,})"), 1), F.lit(-1))).alias("_last"))
    names = d.where(F.col("_last").isNotNull()).select("ticker", "_last")
    marks, said = phrase_index(proxies, "ticker", {"denial": DENIAL, "other": r"\bindependent\b", "determination": DETERMINATION}, names, "_last")
    marks, said = settle(marks), settle(said)
    sentence = Window.partitionBy("ticker", "sentence_no").orderBy("at")
    # Statements of one sentence in order; each reaches from the one before it to the one behind it.
    stated = marks.where("kind IN ('denial', 'other')")
    spans = stated.withColumns({"_from": F.coalesce(F.lag("at").over(sentence), F.lit(-1)), "_to": F.coalesce(F.lead("at").over(sentence), F.lit(1 << 30))}).where("kind = 'denial'")
    near = spans.join(said.withColumnRenamed("at", "_name_at"), ["ticker", "sentence_no"], "left").where(F.col("_name_at").isNull() | F.col("_name_at").between(F.col("_from"), F.col("_to")))
    before = near.groupBy("ticker", "sentence_no", "at").agg(F.count_if(F.col("_name_at") < F.col("at")).alias("_before"))
    bound = near.join(before, ["ticker", "sentence_no", "at"]).where((F.col("_before") == 0) | (F.col("_name_at") < F.col("at"))).where(F.col("_last").isNotNull())
    alone = spans.select("ticker", "sentence_no", "at").join(bound.select("ticker", "sentence_no", "at").distinct(), ["ticker", "sentence_no", "at"], "left_anti")
    # A denial without a surname in reach takes the last surname before it: one scan over names and denials in text order.
    order = F.struct("sentence_no", "at")
    line = said.select("ticker", order.alias("o"), F.lit(0).alias("side"), F.struct(order.alias("o"), F.col("_last").alias("w")).alias("seen")).unionByName(
        alone.select("ticker", order.alias("o"), F.lit(1).alias("side"), F.lit(None).cast("struct<o:struct<sentence_no:int,at:int>,w:string>").alias("seen")))
    reached = running_maxima(line, ["ticker"], [F.col("o"), F.col("side")], {"_seen": F.col("seen")}).where("side = 1 AND _seen IS NOT NULL").select("ticker", F.col("_seen.w").alias("_last"))
    denied = bound.select("ticker", "_last").union(reached).distinct().withColumn("_denied", F.lit(True))
    decided = marks.where("kind = 'determination'").select("ticker", "sentence_no").join(marks.where("kind = 'other'").select("ticker", "sentence_no"), ["ticker", "sentence_no"], "left_semi").distinct()
    granted = said.join(decided, ["ticker", "sentence_no"], "left_semi").select("ticker", "_last").distinct().withColumn("_granted", F.lit(True))
    except_chief = proxies.groupBy("ticker").agg(F.max(F.col("text").rlike(f"(?i){CHIEF_EXCEPTION}")).alias("_except"))
    j = look_up(look_up(look_up(d, denied, ["ticker", "_last"]), granted, ["ticker", "_last"]), except_chief, ["ticker"])
    chief = F.exists("roles", lambda r: F.lower(r).rlike(CHIEF_ROLE))
    said_so = lambda yes, why: F.struct(F.lit("INDEPENDENT" if yes else "NOT_INDEPENDENT").alias("independence"), F.lit(why).alias("basis"))
    verdict = (
        F.when(F.col("_e").rlike(EXECUTIVE_EVIDENCE), said_so(False, "executive or founder relationship")).when(F.col("_e").contains("not independent"), said_so(False, "own row states not independent"))
        .when(F.col("_e").rlike(r"\bindependent\b"), said_so(True, "own row states independent")).when(F.col("_denied"), said_so(False, "proxy denies independence"))
        .when(F.col("_except"), F.when(F.coalesce(chief, F.lit(False)), said_so(False, "exception for the chief executive")).otherwise(said_so(True, "summary of all directors")))
        .when(F.col("_granted"), said_so(True, "board determination")).otherwise(F.struct(F.lit("UNKNOWN").alias("independence"), F.lit("unknown").alias("basis")))
    )
    return j.select("ticker", "person_id", verdict.alias("v")).select("ticker", "person_id", "v.independence", "v.basis")


def committee_type(name: Column) -> Column:
    n = F.lower(name)
    return (
        F.when(n.contains("audit"), "audit").when(n.contains("compensation") & ~n.contains("nominating"), "compensation").when(n.rlike("nominating|governance"), "nominating_governance").when(n.contains("executive"), "executive")
        .when(n.contains("finance"), "finance").when(n.contains("risk"), "risk").when(n.contains("technology"), "technology").when(n.rlike("science|research"), "science").otherwise("other")
    )


def expertise(biography: Column) -> Column:
    """Expertise categories a biography states, sorted."""
    t = F.concat(F.lit(" "), F.regexp_replace(F.lower(biography), r"\s+", " "), F.lit(" "))
    return F.array_compact(F.array(*[F.when(F.exists(F.array(*[F.lit(x) for x in words]), lambda w: t.contains(w)), F.lit(n)) for n, words in sorted(EXPERTISE.items())]))


def shareholder_rights(filings: DataFrame) -> DataFrame:
    """YES, NO or UNKNOWN per right, election standard and board class from proxy text (``ticker``, ``text``)."""
    t = F.lower("text")

    def right(yes: str, no: str | None = None) -> Column:
        found = F.when(t.rlike(yes), "YES")
        return (found.when(t.rlike(no), "NO") if no else found).otherwise("UNKNOWN")

    standard = lambda q: F.coalesce(
        F.nullif(F.regexp_extract(t, rf"\b(majority|plurality)\b[^.]{{0,140}}\b{q}\b", 1), F.lit("")), F.nullif(F.regexp_extract(t, rf"\b{q}\b[^.]{{0,160}}?\b(majority|plurality)\b", 1), F.lit("")), F.lit("UNKNOWN")
    )
    contested, uncontested = standard("contested"), standard("uncontested")
    plain = F.when(t.contains("plurality"), "plurality").when(t.rlike("majority vote|majority of votes"), "majority").otherwise("UNKNOWN")
    election = F.when((contested != "UNKNOWN") & (uncontested != "UNKNOWN"), "CONDITIONAL").when(contested != "UNKNOWN", contested).when(uncontested != "UNKNOWN", uncontested).otherwise(plain)
    may = r"(?:may|can)\s+(?:call|request|demand)[^.]{0,80}special meeting"
    return filings.withColumns({
        "classified_board": F.when(t.rlike(r"classified board|staggered board|(?:two|three|\d+)\s+staggered classes? of directors|three classes of directors|each class of directors"), "CLASSIFIED")
        .when(t.rlike(r"each director.*?elected.*?annual meeting|each director.*?elected annually|annual election|one-year term"), "ANNUAL_ELECTION").otherwise("UNKNOWN"),
        "contested_standard": contested, "uncontested_standard": uncontested, "election_standard": election,
        "special_meeting": right(rf"stockholders? holding[^.]{{0,180}}{may}|holders? of [^.]{{0,120}}{may}", r"stockholders? may not[^.]{0,80}special meeting"),
        "written_consent": right(r"stockholders?[^.]{0,160}(?:may|can)\s+act by[^.]{0,80}written consent|action by written consent is permitted", r"stockholders?[^.]{0,120}may not[^.]{0,80}written consent|written consent is not permitted"),
        "proxy_access": right(r"proxy access|include director nominees in (?:the )?proxy", r"no proxy access"), "advance_notice": right(r"advance notice (?:requirement|provision|procedure|bylaw)|(?:bylaws?|charter)[^.]{0,120}advance notice|notice of nominations"),
        "cumulative_voting": right(r"cumulative voting is permitted|stockholders? may cumulate votes", r"not permitted to cumulate votes|may not cumulate votes|cumulative voting is not permitted"),
        "supermajority": right(r"supermajority|two-thirds vote|66 ?(?:1/3|%)", r"no supermajority|simple majority"), "poison_pill": right(r"shareholder rights plan|poison pill"),
    })


def voting_classes(filings: DataFrame) -> DataFrame:
    """(ticker, class_name, votes_per_share) from 'Each share of Class A common stock is entitled to one vote per share'."""
    pattern = r"(?i)Each share of (?:our )?((?:Class|Series)\s+[A-Z]\s+(?:common |ordinary )?stock|common stock)\s+is entitled to\s+([\w.]+)\s+votes?"
    names, votes = (F.regexp_extract_all("text", F.lit(pattern), i) for i in (1, 2))
    rows = filings.select("ticker", F.explode(F.arrays_zip(names.alias("n"), votes.alias("v"))).alias("c"))
    words = F.create_map(*[F.lit(x) for pair in {"one": 1.0, "two": 2.0, "three": 3.0, "four": 4.0, "five": 5.0, "ten": 10.0}.items() for x in pair])
    return rows.select("ticker", F.col("c.n").alias("class_name"), F.coalesce(F.try_element_at(words, F.lower("c.v")), F.col("c.v").try_cast("double")).alias("votes_per_share")).dropDuplicates(["ticker", "class_name"])


def related_party_sentences(filings: DataFrame) -> DataFrame:
    """Sentences on related-party deals, family ties and interlocks with their kind."""
    s = filings.select("ticker", F.explode(F.split("text", SENTENCE_END)).alias("sentence"))
    t = F.lower("sentence")
    kind = F.when(t.rlike(r"family relationship|brother|sister|spouse"), "family").when(t.rlike(r"interlock|compensation committee.*serve"), "interlock").when(t.rlike(r"related[- ](?:party|person)") & t.rlike("transaction|agreement|services|payments|relationship"), "related_party")
    status = F.when(t.rlike(r"there are no|no such transactions|none of|no other person|does not currently serve|no family"), "NO").otherwise("YES")
    return s.withColumn("kind", kind).where(F.col("kind").isNotNull()).withColumn("status", status)


def role_changes(filings: DataFrame) -> DataFrame:
    """Role-change events of the formal section: one row per sentence with a role and a verb of change.

    ``filings``: ticker, accession, text.
    """
    section = F.regexp_extract("text", r"(?is)\bitem\s+5\.02\b(.*?)(?:\bitem\s+\d+\.\d+\b|\bsignatures?\b|$)", 1)
    s = filings.select("ticker", "accession", F.posexplode(F.split(section, SENTENCE_END)).alias("sentence_no", "sentence"))
    t = F.col("sentence")
    role = F.regexp_extract(t, rf"(?i)\b({ROLE_WORDS})\b", 1)
    kind = F.when(t.rlike("(?i)resign|retir|depart|ceased"), "departure").when(t.rlike("(?i)interim"), "interim_appointment").when(t.rlike("(?i)appoint|appointment"), "appointment")
    when = F.coalesce(tx.first_date(F.regexp_extract(t, r"(?i)effective\s+(?:as of\s+|on\s+)?(.{0,40})", 1)), tx.first_date(t))
    found = s.select("*", kind.alias("event_type"), F.nullif(F.lower(role), F.lit("")).alias("role"), when.alias("effective_date"))
    named = found.withColumn("role", F.coalesce("role", F.when(t.rlike(r"(?i)\bboard(?: of directors)?\b"), F.lit("director"))))
    return named.where(F.col("event_type").isNotNull() & F.col("role").isNotNull())


def education(people: DataFrame) -> DataFrame:
    """Degree, institution and year statements of biographies (``person_id``, ``biography``)."""
    pattern = r"(?i)((?:holds?|earned|received|graduated with)\s+(?:an?\s+)?([A-Z][A-Za-z. &'/-]{1,80}?)\s+(?:from|at)\s+([A-Z][^.;,]{2,120}))"
    whole, degree, school = (F.regexp_extract_all("biography", F.lit(pattern), i) for i in (1, 2, 3))
    rows = people.select("person_id", F.explode(F.arrays_zip(whole.alias("w"), degree.alias("d"), school.alias("s"))).alias("e"))
    return rows.select(
        "person_id", F.trim("e.d").alias("degree"), F.trim(F.split("e.s", r"(?i)\s+and\s+(?:an?|is|was)\b")[0]).alias("institution"), F.nullif(F.regexp_extract("e.w", r"\b((?:19|20)\d{2})\b", 1), F.lit("")).alias("year")
    ).dropDuplicates(["person_id", "degree", "institution"])


def definitive_filing(filings: DataFrame, as_of: Column, forms: Sequence[str] = ("DEF 14A",)) -> DataFrame:
    """Latest definitive filing per ticker on or before a date; unknown filing dates are excluded."""
    return latest_per_key(filings.where(F.col("form").isin(*forms) & (F.col("filing_date") <= as_of)), ["ticker"], ["filing_date", "accession"])


def current_members(board: DataFrame, as_of: Column) -> DataFrame:
    """Members whose interval covers the date; NULL end is open, NULL start counts as begun."""
    return board.where((F.col("start_date").isNull() | (F.col("start_date") <= as_of)) & (F.col("end_date").isNull() | (F.col("end_date") > as_of)))


def board_tenure(board: DataFrame, as_of: Column) -> DataFrame:
    """Tenure in years with its precision and bucket."""
    days = F.datediff(as_of, F.col("start_date"))
    years = F.bround(days / 365.2425, 2)
    bucket = F.when(years.isNull(), "unknown").when(years < 3, "<3 years").when(years < 6, "3-6 years").when(years < 9, "6-9 years").otherwise(">9 years")
    p = F.lower(F.coalesce("precision", F.lit("unknown")))
    return board.withColumns({"tenure_days": days, "tenure_years": years, "tenure_bucket": bucket, "tenure_years_exact": F.when(p == "day", years), "tenure_precision": F.upper(F.when(p.isin("day", "month", "year"), p).otherwise("unknown"))})


def board_summary(tenure: DataFrame) -> DataFrame:
    """Average and median tenure with precision status, and bucket counts per ticker (a board is a short list)."""
    v, p = F.col("tenure_years"), F.col("tenure_precision")
    agg = tenure.groupBy("ticker").agg(
        F.bround(F.avg(v), 2).alias("average_tenure"), F.bround(F.median(v), 2).alias("median_tenure"), F.count(v).alias("value_count"),
        *[F.count_if(F.col("tenure_bucket") == b).alias(n) for b, n in (("<3 years", "under_3"), ("3-6 years", "from_3_to_6"), ("6-9 years", "from_6_to_9"), (">9 years", "over_9"), ("unknown", "unknown_tenure"))],
        F.count_if(v.isNotNull() & (p == "DAY")).alias("_d"), F.count_if(v.isNotNull() & p.isin("DAY", "MONTH", "YEAR")).alias("_k"),
    )
    status = F.when(F.col("value_count") == 0, "UNKNOWN").when(F.col("_d") == F.col("value_count"), "EXACT").when(F.col("_k") == F.col("value_count"), "ESTIMATED").otherwise("PARTIAL")
    return agg.withColumn("statistics_precision", status).drop("_d", "_k")


def board_refreshment(board: DataFrame, as_of: Column) -> DataFrame:
    """Directors added and departed within one and three years."""
    inside = lambda c, d: F.col(c).isNotNull() & (F.col(c) <= as_of) & (F.datediff(as_of, F.col(c)) <= d)
    return board.groupBy("ticker").agg(*[F.countDistinct(F.when(inside(c, d), F.col("person_id"))).alias(f"{n}_{y}y") for c, n in (("start_date", "added"), ("end_date", "departed")) for d, y in ((366, 1), (1096, 3))])


def board_counts(board: DataFrame, outside: DataFrame, expertise_rows: DataFrame) -> DataFrame:
    """Leadership structure, outside-board counts (unknown stays NULL) and expertise counts per ticker.

    ``board``: ticker, person_id, board_role, is_ceo; ``outside``: person_id, outside_boards; ``expertise_rows``: ticker, person_id, category.
    """
    r = F.lower("board_role")
    lead = board.groupBy("ticker").agg(F.count("*").alias("directors"), F.max(r.rlike(r"chair") & F.col("is_ceo")).alias("_combined"), F.max(r.contains("lead independent")).alias("has_lead_independent"), F.max(r.rlike(r"chair")).alias("_chair"))
    j = board.select("ticker", "person_id").join(outside, "person_id", "left")
    o = j.groupBy("ticker").agg(F.max("outside_boards").alias("max_outside_boards"), F.when(F.count("outside_boards") > 0, F.count_if(F.col("outside_boards") >= 4)).alias("overboarded"), F.count_if(F.col("outside_boards").isNull()).alias("outside_unknown"))
    e = expertise_rows.groupBy("ticker").agg(F.countDistinct("category").alias("expertise_categories"), F.countDistinct("person_id").alias("experts"))
    structure = F.when(F.col("_combined"), "COMBINED_CEO_CHAIR").when(F.col("_chair"), "SEPARATE_CHAIR").otherwise("UNKNOWN")
    return lead.withColumn("leadership", structure).drop("_combined", "_chair").join(o, "ticker", "left").join(e, "ticker", "left")


def store_audit(people: DataFrame, tenures: DataFrame) -> DataFrame:
    """Duplicate name keys, chronology errors and missing provenance as (check, subject, count) rows."""
    dup = people.groupBy(F.upper("ticker").alias("ticker"), tx.name_key(F.col("name")).alias("k")).agg(F.countDistinct("person_id").alias("n")).where("n > 1").select(F.lit("duplicate_name").alias("check"), F.concat_ws(":", "ticker", "k").alias("subject"), "n")
    late = tenures.where(F.col("end_date") < F.col("start_date")).select(F.lit("end_before_start"), F.col("person_id").cast("string"), F.lit(1).cast("long"))
    bare = people.where(F.coalesce(F.trim("source_id"), F.lit("")) == "").select(F.lit("missing_provenance"), F.col("person_id").cast("string"), F.lit(1).cast("long"))
    return dup.union(late).union(bare)


def director_audit(board: DataFrame, committees: DataFrame) -> DataFrame:
    """One row per current director with issue codes and the committees held (``committees``: ticker, person_id, committee_type)."""
    held = committees.select("ticker", "person_id", "committee_type").distinct().groupBy("ticker", "person_id").agg(F.array_join(F.array_sort(F.collect_list("committee_type")), ", ").alias("committees"))
    j = board.join(held, ["ticker", "person_id"], "left")
    issues = joined_reasons(
        (F.coalesce("independence", F.lit("UNKNOWN")) == "UNKNOWN", "INDEPENDENCE_UNKNOWN"), (F.col("start_date").isNull(), "START_DATE_UNKNOWN"), (F.coalesce("evidence_text", F.lit("")) == "", "EVIDENCE_MISSING"), (F.col("committees").isNull(), "NO_COMMITTEE_RECORDED"), sep="; ",
    )
    return j.withColumns({"issues": issues, "committees": F.coalesce("committees", F.lit(""))})


def membership_events(rows: DataFrame) -> DataFrame:
    """Appointment and departure events of committee or board intervals (``ticker``, ``person_id``, ``body``, start_date, end_date)."""
    e = F.array_compact(F.array(
        F.when(F.col("start_date").isNotNull(), F.struct(F.lit("appointment").alias("event_type"), F.col("start_date").alias("event_date"))),
        F.when(F.col("end_date").isNotNull(), F.struct(F.lit("departure").alias("event_type"), F.col("end_date").alias("event_date"))),
    ))
    return rows.select("ticker", "person_id", "body", F.explode(e).alias("e")).select("ticker", "person_id", "body", "e.*")


def track_record(tenures: DataFrame, guidance: DataFrame, commitments: DataFrame, operating: DataFrame) -> DataFrame:
    """Counts of outcomes per ticker with a coverage status."""
    t = tenures.groupBy("ticker").agg(F.count("*").alias("tenures"), F.count_if("is_current").alias("current_tenures"))
    g = guidance.groupBy("ticker").agg(*[F.count_if(F.col("outcome") == o).alias(f"guidance_{o.lower()}") for o in ("BEAT", "MET", "MISS", "UNRESOLVED")])
    c = commitments.groupBy("ticker").agg(F.count("*").alias("commitments"), F.count_if(F.col("outcome") == "ACHIEVED").alias("commitments_achieved"))
    o = operating.groupBy("ticker").agg(F.count("*").alias("operating_outcomes"))
    j = t.join(g, "ticker", "left").join(c, "ticker", "left").join(o, "ticker", "left").fillna(0)
    evidence = F.col("guidance_beat") + F.col("guidance_met") + F.col("guidance_miss") + F.col("commitments_achieved") + F.col("operating_outcomes")
    return j.withColumn("coverage", F.when(evidence == 0, "NO_COMPARABLE_EVIDENCE").when(F.col("guidance_unresolved") > 0, "PARTIAL").otherwise("COVERED"))
