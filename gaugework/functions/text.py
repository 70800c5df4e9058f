"""Text column rules: whitespace, hashes, addresses, names, claims. All but compatibility forms run inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions import rules as R


def normalise_whitespace(text: Column) -> Column:
    """NUL removed, one line-ending, single blanks, trimmed lines, at most one empty line in a row."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "\\x00", ""), "\r\n?", "\n")
    t = F.regexp_replace(t, "[ \t]+", " ")
    t = F.regexp_replace(t, "(?m)^[\\s&&[^\\n]]+|[\\s&&[^\\n]]+$", "")
    t = F.regexp_replace(t, "\n{3,}", "\n\n")
    return F.regexp_replace(t, "^\\s+|\\s+$", "")


def content_hash(text: Column) -> Column:
    return F.sha2(normalise_whitespace(text), 256)


def stable_id(prefix: str, **identity: Column) -> Column:
    """Hash of a canonical JSON object with sorted keys; NULL parts count as empty text."""
    parts = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in sorted(identity.items())]
    return F.concat(F.lit(prefix), F.sha2(F.to_json(F.struct(*parts)), 256))


_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _url(url: Column, part: int) -> Column:
    return F.regexp_extract(F.trim(url), _URL, part)


def host(url: Column) -> Column:
    """Host name in lower case without user info and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(_url(url, 2), r"^.*@", ""), r":\d+$", ""))


def _sorted_query(query: Column, drop_tracking: bool) -> Column:
    items = F.filter(F.split(query, "&"), lambda q: q != "")
    pairs = F.transform(items, lambda q: F.struct(F.substring_index(q, "=", 1).alias("k"), F.when(q.contains("="), F.regexp_replace(q, "^[^=]*=", "")).otherwise("").alias("v")))
    if drop_tracking:
        pairs = F.filter(pairs, lambda p: ~F.lower(p["k"]).startswith("utm_") & ~F.lower(p["k"]).isin(*R.TRACKING_KEYS))
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")


def canonical_url(url: Column) -> Column:
    """Lower scheme and host, no trailing slash, sorted query, no fragment; text that is no URL is kept."""
    query = _sorted_query(_url(url, 4), False)
    text = F.concat(F.lower(_url(url, 1)), F.lit("://"), F.lower(_url(url, 2)), F.regexp_replace(_url(url, 3), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.coalesce(url, F.lit("")) == "", "").when(_url(url, 1) == "", F.trim(url)).otherwise(text)


def navigation_url(url: Column) -> Column:
    """Web address identity without tracking keys, default ports or fragment; '' for anything not plain http(s)."""
    scheme, netloc = F.lower(_url(url, 1)), _url(url, 2)
    port = F.regexp_extract(netloc, r":(\d+)$", 1)
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    shown = F.when((port != "") & ~default, F.concat(F.lit(":"), port)).otherwise("")
    path = F.regexp_replace(_url(url, 3), "/+$", "")
    query = _sorted_query(_url(url, 4), True)
    text = F.concat(scheme, F.lit("://"), host(url), shown, F.when(path == "", "/").otherwise(path), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    usable = scheme.isin("http", "https") & (host(url) != "") & ~netloc.contains("@")
    return F.when(usable, text).otherwise("")


def is_public(url: Column) -> Column:
    """Global host: a dotted name, or an IPv4 address outside the private and reserved ranges."""
    h = host(navigation_url(url))
    v4 = h.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    private = h.rlike(r"^(0|10|127|169\.254|192\.168|172\.(1[6-9]|2\d|3[01])|100\.(6[4-9]|[7-9]\d|1[01]\d|12[0-7])|192\.0\.[02]|198\.1[89]|198\.51\.100|203\.0\.113|22[4-9]|23\d|24\d|25[0-5])\.")
    local = (h == "") | (h == "localhost") | h.endswith(".local") | h.endswith(".internal")
    return ~local & F.when(v4, ~private).otherwise(h.contains("."))


def is_blocked(url: Column, domains: Sequence[str] = R.BLOCKED_DOMAINS) -> Column:
    h = host(url)
    return h.rlike("(?:^|\\.)(?:" + "|".join(d.replace(".", "\\.") for d in domains) + ")$")


def redact(text: Column) -> Column:
    """Secret query values inside addresses and e-mail addresses are replaced."""
    secrets = R.SECRET_KEYS.replace("(?i)", "")
    keyed = F.regexp_replace(text, f"(?i)(https?://[^\\s<>\"'?]+\\?)", "$1&")
    hidden = F.regexp_replace(keyed, f"(?i)(?<=[?&])([^=&\\s#<>\"']*(?:{secrets})[^=&\\s#<>\"']*)=[^&\\s#<>\"']*", "$1=REDACTED")
    tidy = F.regexp_replace(hidden, "\\?&", "?")
    return F.regexp_replace(tidy, r"[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}", "[configured email]")


def redact_map(values: Column) -> Column:
    return F.transform_values(values, lambda _, v: redact(v))


def redact_array(values: Column) -> Column:
    return F.transform(values, redact)


# --- names ----------------------------------------------------------------------------------------------

# Accented letters and their plain forms.
_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿāăąćčďđēėęěğģīįķļłńņňōőŕřśşšţťūůűųźżžÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŠŽŁ"
_PLAIN = "aaaaaaceeeeiiiinoooooouuuuyyaaaccddeeeeggiikllnnnoorrsssttuuuuzzzAAAAAACEEEEIIIINOOOOOOUUUUYSZL"


def fold_accents(text: Column) -> Column:
    return F.translate(text, _ACCENTED, _PLAIN)


def person_name(text: Column) -> Column:
    """Lower case, no accents, no titles or degrees, letters and digits only, single blanks."""
    # Honorifics and degrees that are not part of a name.
    plain = F.lower(fold_accents(F.coalesce(text, F.lit(""))))
    bare = F.regexp_replace(F.regexp_replace(plain, r"\b(?:dr|mr|mrs|ms|miss|prof|phd|jd|md)\b\.?", " "), "[^a-z0-9]+", " ")
    return F.array_join(F.filter(F.split(F.trim(bare), " "), lambda t: (t != "") & ~t.isin("ph", "d", "md", "jd", "dvm", "frs")), " ")


def name_key(text: Column) -> Column:
    """Order-free key: the sorted tokens of the normalised name."""
    return F.array_join(F.array_sort(F.split(person_name(text), " ")), " ")


def person_id(name: Column, strong_identifier: Column | None = None) -> Column:
    """Global person id from a strong identifier, else from the order-free name."""
    seed = name_key(name) if strong_identifier is None else F.coalesce(strong_identifier, name_key(name))
    return F.concat(F.lit("person:"), F.substring(F.sha2(seed, 256), 1, 20))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


@F.pandas_udf(T.StringType())
def normal_form(texts: pd.Series) -> pd.Series:
    """Compatibility form (NFKC): full-width letters, ligatures and separate accents as one plain form."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def company_name(text: Column) -> Column:
    """Name without security words and legal suffixes, however many are stacked; not for use inside a lambda."""
    edge = r"^[ ,.-]+|[ ,.-]+$"

    def shorter(t: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(t, R.LEGAL_SUFFIX, ""), edge, "")
        return F.regexp_replace(bare, r"(?i)^([^.]*?)\s+Group$", "$1")  # a name with a point keeps its Group

    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(normal_form(text), R.SECURITY_WORDS, ""), r"\s+", " "), edge, "")
    # A pass takes a word at least, or nothing more.
    short = once(t, lambda name: F.aggregate(F.sequence(F.lit(1), F.size(F.split(name, " "))), name, lambda rest, _: shorter(rest)))
    return once(short, lambda name: F.when(name == "", F.trim(text)).otherwise(name))


def brand_aliases(text: Column) -> Column:
    def aliases(name: Column, base: Column) -> Column:
        first = F.when(F.size(F.split(base, " ")) > 1, F.split(base, " ")[0])
        joined = F.when(base.contains("-"), F.regexp_replace(base, "-", ""))
        return F.filter(F.array_distinct(F.array_compact(F.array(name, base, first, joined))), lambda a: F.length(a) >= 3)

    return once(company_name(text), lambda name: once(F.regexp_replace(name, r"(?i)\s+(?:group|online)$", ""), lambda base: aliases(name, base)))


def casefold(text: Column) -> Column:
    """Lower case; letters of a compatibility form that fold to plain ones in no other way are spelled out."""
    # The letters of Unicode whose case folding, not lower case, holds plain letters.
    return F.replace(F.translate(F.lower(text), "ǰẖẗẘẙ", "jhtwy"), F.lit("ß"), F.lit("ss"))


def fold(text: Column) -> Column:
    return F.regexp_replace(casefold(text), "[^a-z0-9]+", "")


def legal_match(name: Column, text: Column) -> Column:
    """The folded company name (without group/holding words) occurs in the folded text."""
    bare = F.regexp_replace(casefold(company_name(name)), "(?<![a-z0-9])(?:group|holdings?)(?![a-z0-9])|[^a-z0-9]+", "")
    both = F.struct(bare.alias("name"), fold(normal_form(text)).alias("text"))
    return once(both, lambda x: (x["name"] != "") & F.coalesce(x["text"].contains(x["name"]), F.lit(False)))


def brand_match(name: Column, text: Column) -> Column:
    """A folded alias of four letters or more occurs in the folded text."""
    both = F.struct(F.transform(brand_aliases(name), fold).alias("aliases"), fold(normal_form(text)).alias("text"))
    return once(both, lambda x: F.exists(x["aliases"], lambda a: (F.length(a) >= 4) & x["text"].contains(a)))


def blocking_key(name: Column) -> Column:
    """Company tokens without filler words, joined by blanks."""
    # Filler words of company names.
    filler = ["inc", "incorporated", "corporation", "corp", "plc", "ltd", "limited", "the", "company", "holdings", "group", "co"]
    tokens = F.regexp_extract_all(F.lower(company_name(name)), F.lit("([a-z0-9]+)"), 1)
    return F.array_join(F.filter(tokens, lambda t: ~t.isin(*filler)), " ")


# --- documents --------------------------------------------------------------------------------------------

# Filing forms in the order they are looked for.
FORMS = ["DEF 14A", "DEFA14A", "10-K", "10-Q", "8-K/A", "8-K"]


def filing_form(explicit: Column, title: Column, path: Column) -> Column:
    stated = F.upper(F.trim(F.coalesce(explicit, F.lit(""))))
    text = F.upper(F.concat_ws(" ", title, path))
    found = F.coalesce(*[F.when(text.contains(f) | text.contains(f.replace("-", "")), F.lit(f)) for f in FORMS])
    return F.when(stated.isin(*FORMS), stated).otherwise(found)


def document_type(title: Column, path: Column, category: Column, event_type: Column, form: Column, has_segments: Column) -> Column:
    """Document class by the first matching rule."""
    cat, ev = F.lower(F.coalesce(category, F.lit(""))), F.lower(F.coalesce(event_type, F.lit("")))
    text = F.lower(F.concat_ws(" ", title, path, cat, ev))
    spoken = F.coalesce(has_segments, F.lit(False)) | ev.contains("earnings_call")
    return (
        F.when(spoken & (text.contains("earning") | text.contains("quarter")), "earnings_transcript").when(spoken, "event_transcript")
        .when(form.isin("DEF 14A", "DEFA14A"), "proxy_statement")
        .when(cat.contains("news") | text.contains("news release") | text.contains("press release"), "news_release")
        .when(text.rlike("annual|10-k|10k"), "annual_report")
        .when(text.rlike("quarterly|10-q|10q") | (cat.isin("reports", "report") & title.rlike(r"(?i)\bQ[1-4]\b")), "quarterly_report")
        .when(text.rlike("presentation|investor deck|slides"), "investor_presentation")
        .otherwise("other_report")
    )


def availability_date(explicit: Column, filing: Column, publication: Column, source: Column) -> tuple[Column, Column]:
    status = F.when(explicit.isNotNull(), "EXPLICIT").when(filing.isNotNull(), "FILING_DATE").when(publication.isNotNull(), "PUBLICATION_DATE").when(source.isNotNull(), "SOURCE_DATE").otherwise("UNKNOWN")
    return F.coalesce(explicit, filing, publication, source), status


def fiscal_year_of(end: Column, fye_month: Column, fye_day: Column | None = None, start_label: Column | None = None) -> Column:
    """Fiscal year of a period end for a calendar ending in ``fye_month`` (label = ending year unless ``start_label``)."""
    later = F.month(end) > fye_month
    if fye_day is not None:
        later = later | ((F.month(end) == fye_month) & F.coalesce(F.dayofmonth(end) > fye_day, F.lit(False)))
    year = F.year(end) + later.cast("int")
    return year - F.coalesce(start_label, F.lit(False)).cast("int") if start_label is not None else year


def fiscal_quarter_of(end: Column, fye_month: Column) -> Column:
    return (F.floor(F.pmod(F.month(end) - fye_month - 1, F.lit(12)) / 3) + 1).cast("int")


def period_end(text: Column) -> Column:
    """Date of 'quarter/year ended Month d, yyyy' or d/m/yyyy; never an arbitrary date in the prose."""
    lead = r"(?i)\b(?:quarterly\s+period|three\s+months|quarter|fiscal\s+year|year)\s+ended\s+"
    month = "|".join(R.MONTHS)
    m, d, y = (F.regexp_extract(text, lead + rf"({month})\s+(\d{{1,2}}),?\s+(20\d{{2}})", i) for i in (1, 2, 3))
    n, a, b = (F.regexp_extract(text, lead + r"(\d{1,2})[/-](\d{1,2})[/-](20\d{2})", i) for i in (3, 2, 1))
    written = F.try_to_timestamp(F.concat_ws("-", y, F.array_position(F.array(*[F.lit(x) for x in R.MONTHS]), F.lower(m)).cast("string"), d), F.lit("yyyy-M-d"))
    numeric = F.try_to_timestamp(F.concat_ws("-", n, a, b), F.lit("yyyy-M-d"))
    return F.coalesce(F.when(m != "", written), F.when(n != "", numeric)).cast("date")


def stated_period(text: Column) -> tuple[Column, Column]:
    """(year, quarter) named in a text: 'Q2 FY2025', 'second quarter of fiscal 2025', 'FY 2024', 'fiscal year 2024'."""
    q_year = F.regexp_extract(text, r"(?i)\bQ([1-4])\s*(?:of\s+)?(?:FY|fiscal(?:\s+year)?)?\s*[-']?(20\d{2})\b", 2)
    q_no = F.regexp_extract(text, r"(?i)\bQ([1-4])\s*(?:of\s+)?(?:FY|fiscal(?:\s+year)?)?\s*[-']?(20\d{2})\b", 1)
    worded = r"(?i)\b(first|second|third|fourth)\s+quarter\s+(?:of\s+)?(?:fiscal\s+(?:year\s+)?)?(20\d{2})\b"
    w_no, w_year = F.lower(F.regexp_extract(text, worded, 1)), F.regexp_extract(text, worded, 2)
    annual = F.regexp_extract(text, r"(?i)\b(?:FY|fiscal\s+year|full[- ]year|annual report)\s*[-']?(20\d{2})\b", 1)
    word_no = F.nullif(F.array_position(F.array(*[F.lit(w) for w in ("first", "second", "third", "fourth")]), w_no), F.lit(0))
    year = F.coalesce(F.nullif(q_year, F.lit("")), F.nullif(w_year, F.lit("")), F.nullif(annual, F.lit(""))).cast("int")
    quarter = F.when(q_no != "", q_no.try_cast("int")).when(w_no != "", word_no.cast("int"))
    return year, quarter


def first_date(text: Column) -> Column:
    """First date written in a text, as DATE."""
    hit = F.regexp_replace(F.regexp_extract(text, f"({R.DATE_IN_TEXT})", 1), "[.,]", "")
    iso = F.regexp_replace(hit, "/", "-")
    short = F.initcap(F.regexp_replace(hit, r"([A-Za-z]{3})[a-z]*", "$1"))
    return F.coalesce(
        F.when(iso.rlike(r"^\d{4}-"), F.try_to_timestamp(iso, F.lit("yyyy-M-d"))),
        F.when(hit.rlike(r"^\d{1,2}/"), F.try_to_timestamp(hit, F.lit("M/d/yyyy"))),
        F.when(hit.rlike(r"^[A-Za-z]"), F.try_to_timestamp(F.regexp_replace(short, r"\s+", " "), F.lit("MMM d yyyy"))),
        F.when(hit.rlike(r"^\d{1,2}\s"), F.try_to_timestamp(F.regexp_replace(short, r"\s+", " "), F.lit("d MMM yyyy"))),
    ).cast("date")


def is_pdf(url: Column, text: Column) -> Column:
    return url.contains("/static-files/") | url.rlike(r"(?i)\.pdf(?:$|[?#])") | text.rlike(r"(?i)\bpdf\b")


def is_release_link(url: Column, text: Column, context: Column) -> Column:
    """A link to one news release: detail path or dated context, not a list page, event page or utility link."""
    low, path = F.lower(text), F.lower(_url(url, 3))
    noise = F.concat_ws(" ", low, path).rlike("|".join(R.LINK_NOISE))
    detail = path.rlike(r"news[-/]details|news-release-details|press-release-details|/releases?/\d|/news/\d{4}/|/news/[^/]{20,}|/press-releases/[^/]{15,}")
    event = ~detail & path.rlike(r"/(?:events?|presentations?|webcasts?)(?:/|$)")
    listing = F.trim(low).rlike(r"^(?:view all|all news|news archive|press release archive|news releases|press releases|archive)$")
    titled = path.rlike(r"/(?:news|news-releases|press-releases|press)/[^/]{6,}") & (F.length(text) >= 18) & ~path.contains("archive")
    dated = first_date(context).isNotNull() & (F.length(text) > 25)
    return ~noise & ~event & ~listing & (detail | titled | dated | (is_pdf(url, text) & (F.length(text) > 12)))


def event_type(title: Column) -> Column:
    found = F.coalesce(*[F.when(title.rlike(p), F.lit(n)) for p, n in R.EVENT_TYPES])
    return F.coalesce(found, F.lit("other"))


def event_priority(title: Column, date: Column, url: Column) -> Column:
    """Sortable struct: earnings calls first, then stated period, quarter, date and address."""
    year = F.regexp_extract(title, r"\b(20\d{2})\b", 1)
    q, w = F.regexp_extract(title, r"(?i)\bQ([1-4])\b", 1), F.lower(F.regexp_extract(title, r"(?i)\b(first|second|third|fourth)\s+quarter\b", 1))
    words = F.array(*[F.lit(x) for x in ("first", "second", "third", "fourth")])
    number = F.when(q != "", q.try_cast("int")).otherwise(F.array_position(words, w).cast("int"))
    period = F.when((year != "") & (number > 0), year.try_cast("int")).otherwise(F.coalesce(F.year(date), F.lit(0)))
    return F.struct((event_type(title) == "earnings_call").alias("earnings"), period.alias("period"), number.alias("quarter"), F.coalesce(date.cast("string"), F.lit("")).alias("date"), url.alias("url"))


# --- claims -------------------------------------------------------------------------------------------------


def unless(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Whether a pattern occurs without its exception, for any (pattern, exception)."""
    found = F.lit(False)
    for pattern, exception in pairs:
        found = found | (text.rlike(R.any_of([pattern])) & ~text.rlike(R.any_of([exception])))
    return found


def is_noise(sentence: Column, rules: R.ClaimRules = R.ClaimRules()) -> Column:
    """Boilerplate, logistics and questions."""
    t = F.trim(sentence)
    framed = unless(t, rules.framing)
    start = t.rlike(R.ascii_bounds("|".join(rules.noise_start))) if rules.noise_start else F.lit(False)
    listed = t.rlike(R.any_of(rules.noise)) if rules.noise else F.lit(False)
    return (t == "") | start | listed | framed


def is_material(sentence: Column, rules: R.ClaimRules = R.ClaimRules()) -> Column:
    """Not noise, long enough, and carrying a research-relevant proposition."""
    words = F.size(F.regexp_extract_all(sentence, F.lit(R.ascii_bounds(r"(\b[\w'-]+\b)")), 1))
    return ~is_noise(sentence, rules) & (words >= rules.minimum_words) & ~unless(sentence, rules.vague) & sentence.rlike(R.any_of(rules.material))


def matching_dimensions(sentence: Column, rules: R.ClaimRules = R.ClaimRules()) -> Column:
    """Dimensions whose patterns occur, in rule order."""
    return F.array_compact(F.array(*[F.when(sentence.rlike(R.any_of(r.patterns)), F.lit(r.dimension)) for r in rules.rules]))


def primary_dimension(sentence: Column, dimensions: Column, rules: R.ClaimRules = R.ClaimRules()) -> Column:
    """Struct (dimension, topic) of the one proposition a sentence stands for."""
    topics = {r.dimension: r.topic for r in rules.rules}
    metric = F.coalesce(*[F.when(F.array_contains(dimensions, r.dimension), F.lit(r.dimension)) for r in rules.rules if r.dimension in rules.guidance_metrics], F.lit(None).cast("string"))
    actual = sentence.rlike("(?i)" + R.ACTUAL_RESULT) & ~sentence.rlike("(?i)" + R.NEW_GUIDANCE)
    ordered = F.coalesce(*[F.when(F.array_contains(dimensions, d), F.lit(d)) for d in rules.primary_order if d in topics])
    guided = F.array_contains(dimensions, "guidance")
    dimension = F.when(guided & actual & metric.isNotNull(), metric).when(guided, "guidance").otherwise(F.coalesce(ordered, F.try_element_at(dimensions, F.lit(1))))
    names = F.create_map(*[F.lit(x) for pair in topics.items() for x in pair])
    topic = F.when(guided & ~(actual & metric.isNotNull()), F.coalesce(F.try_element_at(names, metric), F.lit("outlook"))).otherwise(F.try_element_at(names, dimension))
    return F.struct(dimension.alias("dimension"), topic.alias("topic"))


def direction(sentence: Column, rules: R.ClaimRules = R.ClaimRules()) -> Column:
    low = F.lower(sentence)
    versus = F.regexp_extract(low, R.ACTUAL_VS_GUIDANCE, 1)
    found = F.array_compact(F.array(*[F.when(low.rlike("(?:" + "|".join(p) + ")"), F.lit(n)) for n, p in rules.directions]))
    mixed = F.array_contains(found, "increasing") & F.array_contains(found, "decreasing")
    return F.when(versus == "above", "increasing").when(versus == "below", "decreasing").when(mixed, "mixed").otherwise(F.coalesce(F.try_element_at(found, F.lit(1)), F.lit("unknown")))


def certainty(sentence: Column, dimension: Column) -> Column:
    t = F.lower(sentence)
    risk = dimension == "risks"
    return (
        F.when(risk | t.rlike(R.CERTAINTY_RISKY), F.when(risk | t.rlike(R.CERTAINTY_RISK), "risk").otherwise("possibility"))
        .when(t.rlike(R.ACTUAL_RESULT) & ~t.rlike(R.NEW_GUIDANCE_CERTAINTY), "actual")
        .when(t.rlike(R.CERTAINTY_POSSIBLE), "possibility")
        .when(t.rlike(R.COMPLETED), "confirmed")
        .when(t.rlike(R.CERTAINTY_EXPECTED), F.when((dimension == "guidance") | t.contains("guidance") | t.contains("outlook"), "guidance").otherwise("expectation"))
        .when(t.rlike(R.CERTAINTY_ESTIMATE), "estimate")
        .when(t.rlike(R.CERTAINTY_TARGET), "target")
        .when(t.rlike(R.CERTAINTY_ACTUAL), "actual")
        .otherwise("unknown")
    )


# Numbers with a currency sign or a unit.
MAGNITUDE = r"(\$\d+(?:\.\d+)?|\d+(?:\.\d+)?)(\s*%|\s*(?:basis points|bps|million|billion|thousand|M|B|K)\b)?"


def magnitudes(sentence: Column, most: int | None = None) -> Column:
    """Explicit quantities, all unless ``most`` limits them: ARRAY<STRUCT<raw, value, unit>>."""
    raw = F.regexp_extract_all(sentence, F.lit(f"(?i)({MAGNITUDE})"), 1)
    marked = F.filter(raw, lambda m: m.startswith("$") | ~m.rlike(r"\d$"))
    if most is not None:
        marked = F.slice(marked, 1, most)

    def one(m: Column) -> Column:
        word = F.lower(F.trim(F.regexp_replace(m, r"^\$?\d+(?:\.\d+)?", "")))
        unit = F.when(m.startswith("$"), F.when(word == "", "USD").otherwise(F.concat(F.lit("USD_"), F.regexp_replace(word, " ", "_")))).when(word == "%", "percent").otherwise(word)
        return F.struct(F.trim(m).alias("raw"), F.regexp_extract(m, r"(\d+(?:\.\d+)?)", 1).cast("double").alias("value"), unit.alias("unit"))

    return F.transform(marked, one)


def metric_observation(magnitude: Column) -> Column:
    """Base-unit values and their one unit: STRUCT<values, unit>; NULL when units are mixed or absent."""
    def scaled(m: Column) -> Column:
        u = F.coalesce(m["unit"], F.lit(""))
        factor = F.when(u.contains("billion"), 1e9).when(u.contains("million"), 1e6).when(u.contains("thousand"), 1e3).otherwise(1.0)
        kind = F.when(u.startswith("USD"), "currency").when(u.contains("percent") | u.contains("bps"), "percent").otherwise("number")
        return F.struct((m["value"] * factor).alias("value"), kind.alias("unit"))

    items = F.transform(magnitude, scaled)
    units = F.array_distinct(F.transform(items, lambda i: i["unit"]))
    return F.when(F.size(units) == 1, F.struct(F.transform(items, lambda i: i["value"]).alias("values"), units[0].alias("unit")))


def cleaned(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9%$]+", " "))


def metric_unit(sentence: Column, magnitude: Column) -> Column:
    """percent, currency or number; NULL when a claim mixes percent and currency or states no quantity."""
    units = F.transform(magnitude, lambda m: F.lower(F.coalesce(m["unit"], F.lit(""))))
    percent = F.exists(units, lambda u: u.contains("percent") | u.isin("bps", "basis_points", "basis points"))
    currency = F.exists(units, lambda u: u.contains("usd") | u.isin("currency", "million", "billion", "thousand"))
    text = cleaned(sentence)
    spoken = F.when(text.contains("%") | text.rlike(r"\b(?:bps|basis points)\b"), "percent").when(text.contains("$") | text.rlike(r"\b(?:million|billion|thousand)\b"), "currency")
    stated = F.when(percent & currency, None).when(percent, "percent").when(currency, "currency").otherwise("number")
    return F.when(F.size(magnitude) > 0, stated).otherwise(spoken)


#: Fixed value: words of a claim that name its subject where no rule does. The name is a block in which statements meet; all words compare as tokens.
SUBJECT_WORDS = 5


def subject(sentence: Column, dimension: Column, topic: Column, most: int | None = SUBJECT_WORDS) -> Column:
    """Stable comparison subject of a claim: a named metric or theme, else its first ``most`` telling words."""
    text = cleaned(sentence)
    named = F.coalesce(*[F.when(text.rlike(p), F.lit(s)) for p, s in R.SUBJECTS])
    tokens = F.filter(F.split(text, " "), lambda t: (F.length(t) > 1) & ~t.isin(*R.SUBJECT_STOPWORDS))
    risky = F.filter(tokens, lambda t: ~t.isin(*R.RISK_WORDS))
    cuts = F.array_compact(F.array(*[F.nullif(F.array_position(risky, F.lit(m)), F.lit(0)) for m in R.RISK_MARKERS]))
    first_marker = F.try_element_at(cuts, F.lit(1))
    first = lambda words: words if most is None else F.slice(words, 1, most)
    risk_words = first(F.when(first_marker.isNotNull(), F.slice(risky, F.lit(1), (first_marker - 1).cast("int"))).otherwise(risky))
    alias = F.create_map(*[F.lit(x) for pair in R.SUBJECT_ALIASES.items() for x in pair])
    plain_topic = cleaned(F.coalesce(topic, F.lit("")))
    topic_name = F.coalesce(F.try_element_at(alias, plain_topic), plain_topic)
    useful = (topic_name != "") & ~topic_name.isin("outlook", "guidance", "revenue")
    general = F.when(dimension == "revenue", "general_revenue").otherwise("general_guidance")
    return (
        F.when(named.isNotNull(), named)
        .when(dimension == "risks", F.coalesce(F.nullif(F.array_join(risk_words, " "), F.lit("")), F.lit("risk")))
        .when(dimension == "demand", "general_demand")
        .when(dimension == "margins", "general_margin")
        .when(dimension.isin("guidance", "revenue"), F.when(useful, F.regexp_replace(topic_name, " ", "_")).otherwise(general))
        .otherwise(F.coalesce(F.nullif(F.array_join(first(tokens), " "), F.lit("")), F.regexp_replace(F.coalesce(F.nullif(plain_topic, F.lit("")), dimension), " ", "_")))
    )


def claim_tokens(text: Column) -> Column:
    """Distinct words longer than two letters."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1), lambda t: F.length(t) > 2))


def jaccard(left: Column, right: Column) -> Column:
    """Size of intersection over union of two token arrays; 0 when one is empty."""
    union = F.size(F.array_union(left, right))
    return F.when((F.size(left) > 0) & (F.size(right) > 0), F.size(F.array_intersect(left, right)) / union).otherwise(0.0)


def horizon(sentence: Column) -> Column:
    t = F.lower(sentence)
    fiscal, quarter = F.regexp_extract(t, r"\bfy\s*(20\d{2}|19\d{2})\b", 1), F.regexp_extract(t, r"\bq([1-4])\b", 1)
    return F.when(t.rlike(r"\b(?:full[- ]year|annual)\b") | (fiscal != ""), F.concat(F.lit("annual:"), fiscal)).when(quarter != "", F.concat(F.lit("quarter:"), quarter))


def reporting_basis(sentence: Column) -> Column:
    t = F.lower(sentence)
    return F.when(t.rlike(r"\bnon[- ]gaap\b"), "non_gaap").when(t.rlike(r"\bgaap\b"), "gaap")


def metric_terms(sentence: Column) -> Column:
    t = F.lower(sentence)
    # Explicit metric names.
    tests = [("eps", r"\b(?:eps|earnings per share)\b"), ("profitability", r"\bprofitability\b"), ("revenue", r"\b(?:revenue|sales|top[- ]line)\b"), ("margin", r"\b(?:gross margin|operating margin|free cash flow margin)\b")]
    return F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(n)) for n, p in tests]))


def completed(sentence: Column) -> Column:
    return F.lower(sentence).rlike(R.COMPLETED)


def claim_polarity(sentence: Column, direction_: Column, dimension: Column) -> Column:
    cost = dimension.isin("costs", "operating_expenses")
    return (
        F.when(cost & sentence.rlike(R.COST_REDUCTION), 1).when(cost & sentence.rlike(R.COST_INCREASE), -1)
        .when(direction_.isin(*R.POSITIVE_DIRECTIONS), 1).when(direction_.isin(*R.NEGATIVE_DIRECTIONS), -1)
        .when(sentence.rlike(R.TEXT_POSITIVE), 1).when(sentence.rlike(R.TEXT_NEGATIVE) | sentence.rlike(R.RETENTION_NEGATIVE), -1).otherwise(0)
    )


def absolute_signal(sentence: Column, dimension: Column) -> Column:
    return (
        F.when(dimension == "risks", F.when(sentence.rlike(R.RISK_IMPACT), -1).otherwise(0))
        .when(sentence.rlike(R.RETENTION_NEGATIVE) | sentence.rlike(R.ABSOLUTE_NEGATIVE), -1).when(sentence.rlike(R.ABSOLUTE_POSITIVE), 1).otherwise(0)
    )


def evidence_quality(certainty_: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in R.QUALITY.items() for x in pair])
    return F.coalesce(F.try_element_at(table, certainty_), F.lit(R.QUALITY["unknown"]))


def change_polarity(change_type: Column, direction_: Column) -> Column:
    return (
        F.when(change_type.isin("new_risk", "risk_intensified"), -1).when(change_type.isin("risk_removed", "risk_eased"), 1)
        .when(direction_.isin(*R.POSITIVE_DIRECTIONS), 1).when(direction_.isin(*R.NEGATIVE_DIRECTIONS), -1).otherwise(0)
    )


def is_comparative(sentence: Column) -> Column:
    return sentence.rlike(R.COMPARATIVE)
