"""Document jobs: normalisation, sentences, claims, captions, pages, link scores and document merging."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions import rules as R
from gaugework.functions import text as tx
from gaugework.functions.numbers import joined_reasons
from gaugework.plans.components import connected
from gaugework.plans.joins import attach, look_up
from gaugework.plans.matching import first_independent, one_to_one, similar_sets
from gaugework.plans.ordered import following, medians, numbered, running_maxima, running_totals, value_positions, with_previous
from gaugework.plans.settle import settle

# A sentence ends at . ! ? before a blank or the end of the text; section headings.
# The look-behind starts a match only at the head of a run, so a line without an end costs one pass.
SENTENCE = re.compile(r"(?<![^.!?\n])[^.!?\n]++(?:[.!?]+(?=\s|$)|$)")
#: Characters of text after which a Python task hands on its rows, whatever the length of the Arrow batch.
SLICE = 2_000_000
HEADINGS = r"(?im)^(prepared remarks|question and answer|q&a|financial outlook)\s*:?[ \t]*$"


def normalise_documents(documents: DataFrame) -> DataFrame:
    """Clean text, hash, id, form, type, sections, availability and fiscal period in one projection.

    ``documents``: ticker, title, path, source_url, category, event_type, explicit_form, text, has_segments,
    explicit_date, filing_date, publication_date, source_date, fye_month.
    """
    c = F.col
    clean = documents.withColumn("text", tx.normalise_whitespace(c("text")))
    form = tx.filing_form(c("explicit_form"), c("title"), c("path"))
    available, status = tx.availability_date(c("explicit_date"), c("filing_date"), c("publication_date"), c("source_date"))
    typed = clean.withColumns({
        "content_hash": F.sha2("text", 256), "canonical_url": tx.canonical_url(c("source_url")), "sec_form": form,
        "available_date": available, "availability_status": status, "period_end": tx.period_end(c("text")),
    }).withColumn("document_type", tx.document_type(c("title"), c("path"), c("category"), c("event_type"), c("sec_form"), c("has_segments")))
    year, quarter = fiscal_period(c("document_type"), c("title"), c("path"), c("text"), c("period_end"), c("fye_month"))
    return typed.withColumns({
        "document_id": tx.stable_id("doc_", ticker=F.upper(F.trim("ticker")), source_url=c("canonical_url"), document_type=c("document_type"), content_hash=c("content_hash")),
        "fiscal_year": year, "fiscal_quarter": quarter, "section_count": F.size(F.regexp_extract_all("text", F.lit(f"({HEADINGS})"), 1)),
    }).withColumn("period_label", F.when(c("fiscal_year").isNull(), None).when(c("fiscal_quarter").isNull(), F.concat(F.lit("FY "), c("fiscal_year").cast("string"))).otherwise(F.concat(F.lit("Q"), c("fiscal_quarter").cast("string"), F.lit(" FY"), c("fiscal_year").cast("string"))))


def fiscal_period(kind: Column, title: Column, path: Column, body: Column, end: Column, fye_month: Column) -> tuple[Column, Column]:
    """Reporting period: filing header, annual title, file name, title, then body; proxies have none."""
    quarterly = kind.isin("quarterly_report", "other_report")
    (ty, tq), (py, pq), (by, bq) = (tx.stated_period(t) for t in (title, path, body))
    annual = F.regexp_extract(title, r"\b(20\d{2})\b", 1).try_cast("int")
    year = (
        F.when(kind == "proxy_statement", None)
        .when(quarterly & end.isNotNull(), tx.fiscal_year_of(end, fye_month))
        .when((kind == "annual_report") & annual.isNotNull(), annual)
        .otherwise(F.coalesce(F.when(kind == "quarterly_report", py), ty, by))
    )
    quarter = (
        F.when(kind.isin("proxy_statement", "annual_report"), None)
        .when(quarterly & end.isNotNull(), tx.fiscal_quarter_of(end, fye_month))
        .otherwise(F.when((kind == "quarterly_report") & py.isNotNull(), pq).when(ty.isNotNull(), tq).otherwise(bq))
    )
    return year, quarter.cast("int")


def sections(documents: DataFrame, key: str) -> DataFrame:
    """Sections under recognised heading lines: (key, position, heading, text)."""
    parts = F.split("text", HEADINGS)
    heads = F.regexp_extract_all("text", F.lit(HEADINGS), 1)
    zipped = F.arrays_zip(heads.alias("heading"), F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))).alias("body"))
    return documents.select(key, F.posexplode(zipped).alias("position", "s")).select(key, "position", F.col("s.heading").alias("heading"), F.trim(F.regexp_replace("s.body", r"^\s+|\s+$", "")).alias("text"))


def sentences(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, sentence_no, start_char, end_char, sentence) with exact character offsets."""
    kind = documents.schema[key].dataType.simpleString()
    columns = [key, "sentence_no", "start_char", "end_char", "sentence"]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, size = [], 0
            for k, body in zip(batch[key], batch[text]):
                number = 0
                size += len(body or "")
                for m in SENTENCE.finditer(body or ""):
                    value = m.group(0).strip()
                    if value:
                        start = m.start() + len(m.group(0)) - len(m.group(0).lstrip())
                        rows.append((k, number, start, start + len(value), value))
                        number += 1
                if size >= SLICE:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=columns)

    return documents.select(key, text).mapInPandas(split, f"{key} {kind}, sentence_no int, start_char int, end_char int, sentence string")


def chunks(documents: DataFrame, key: str, max_chars: int = 1800, overlap: int = 240) -> DataFrame:
    """Greedy sentence windows of at most ``max_chars`` with ``overlap``: (key, chunk_no, start_char, end_char, text).

    Sequential inside one document, independent between documents. A longer sentence stays whole.
    """
    kind = documents.schema[key].dataType.simpleString()
    columns = [key, "chunk_no", "start_char", "end_char", "text"]
    width, lap = max(200, max_chars), max(0, min(overlap, max(200, max_chars) // 2))

    def windows(body: str) -> Iterator[tuple[int, int]]:
        units = []
        for m in SENTENCE.finditer(body):
            value = m.group(0).strip()
            if value:
                start = m.start() + len(m.group(0)) - len(m.group(0).lstrip())
                units.append((start, start + len(value)))
        units = units or [(0, len(body))]
        first = 0
        while first < len(units):
            begin, stop, nxt = units[first][0], units[first][1], first + 1
            while nxt < len(units) and units[nxt][1] - begin <= width:
                stop, nxt = units[nxt][1], nxt + 1
            yield begin, stop
            if stop >= len(body):
                return
            back = nxt
            while back > first and units[back - 1][0] >= max(begin, stop - lap):
                back -= 1
            first = max(first + 1, back)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, size = [], 0
            for k, body in zip(batch[key], batch["text"]):
                if body:
                    rows += [(k, i, a, b, body[a:b]) for i, (a, b) in enumerate(windows(body))]
                    size += len(body)
                if size >= SLICE:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=columns)

    return documents.select(key, "text").mapInPandas(pack, f"{key} {kind}, chunk_no int, start_char int, end_char int, text string")


Step = Callable[[DataFrame], DataFrame]


def sentence_claims(rows: DataFrame, rules: R.ClaimRules = R.ClaimRules()) -> DataFrame:
    """Material sentences with their primary proposition, direction, certainty and magnitudes."""
    s = F.col("sentence")
    held = rows.where(tx.is_material(s, rules)).withColumn("dimensions", tx.matching_dimensions(s, rules)).where(F.size("dimensions") > 0)
    primary = held.withColumn("_p", tx.primary_dimension(s, F.col("dimensions"), rules))
    named = primary.select("*", F.col("_p.dimension").alias("dimension"), F.col("_p.topic").alias("topic")).drop("_p")
    return named.withColumns({"direction": tx.direction(s, rules), "certainty": tx.certainty(s, F.col("dimension")), "magnitude": tx.magnitudes(s)}).withColumn(
        "extraction_confidence", F.when(F.col("direction") != "unknown", 0.84).otherwise(0.72)
    )


def extract_claims(documents: DataFrame, key: str, rules: R.ClaimRules = R.ClaimRules(), steps: Sequence[Step] = ()) -> DataFrame:
    """Documents to deduplicated claims with ids and exact locations; ``steps`` may transform the candidates."""
    found = sentence_claims(sentences(documents, key), rules)
    for step in steps:
        found = step(found)
    kept = drop_near_duplicates(settle(drop_exact_duplicates(found, key)), key)  # read four times below
    return kept.withColumn("claim_id", tx.stable_id("clm_", document=F.col(key), start=F.col("start_char"), dimension=F.col("dimension"), text=F.col("sentence")))


def drop_exact_duplicates(claims: DataFrame, key: str) -> DataFrame:
    """First occurrence per (document, dimension, normalised wording)."""
    wording = F.regexp_replace(F.lower(F.trim(F.regexp_replace("sentence", r"\s+", " "))), r"[.!?]+$", "")
    others = [c for c in claims.columns if c not in (key, "dimension")]
    first = claims.withColumn("_w", wording).groupBy(key, "dimension", "_w").agg(F.min_by(F.struct(*others), "start_char").alias("_r"))
    return first.select(key, "dimension", "_r.*").select(*claims.columns)


def drop_near_duplicates(claims: DataFrame, key: str, share: float = 0.70) -> DataFrame:
    """Inside one document, drop a claim whose dimension and magnitudes equal an earlier kept one and whose
    tokens overlap it by ``share`` of the smaller set.

    Claims of equal tokens collapse to the first: whatever keeps or drops it drops the others. Similar pairs of the
    rest come from a prefix-filtered set join, and the visiting order is settled by rounds over those pairs, so no task
    holds the kept claims of a document. Claims without a token are never similar to another.
    """
    words = F.filter(F.array_distinct(F.regexp_extract_all(F.lower("sentence"), F.lit("([a-z0-9]+)"), 1)), lambda t: ~t.isin(*R.OVERLAP_STOPWORDS) & (F.length(t) > 2))
    numbered = claims.where(F.size("magnitude") > 0).select(key, "dimension", F.to_json("magnitude").alias("_m"), "start_char", F.array_sort(words).alias("_t"))
    place = F.struct(key, "dimension", "_m", "start_char")
    some = numbered.where(F.size("_t") > 0)
    first = settle(some.groupBy(key, "dimension", "_m", "_t").agg(F.min("start_char").alias("start_char")).withColumn("_id", place))
    pairs = similar_sets(first, [key, "dimension", "_m"], "_id", "_t", share)
    kept = first_independent(first, pairs.toDF("earlier", "later"), "_id").select(f"_id.{key}", "_id.dimension", "_id.start_char")
    survivors = kept.unionByName(numbered.where(F.size("_t") == 0).select(key, "dimension", "start_char"))
    plain = claims.where(F.size("magnitude") == 0)
    return plain.unionByName(claims.where(F.size("magnitude") > 0).join(survivors, [key, "dimension", "start_char"], "left_semi"))


def evidence_errors(claims: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Add ``errors`` to each claim: unknown document, invalid offsets, text that is not what the document says."""
    j = look_up(claims, documents.select(key, F.col("text").alias("_text")), [key])
    start, end = F.col("start_char"), F.col("end_char")
    valid = (start >= 0) & (end > start) & (end <= F.length("_text"))
    said = F.substring(F.col("_text"), start + 1, end - start)
    errors = joined_reasons(
        (F.col("_text").isNull(), "unknown document"), (F.col("_text").isNotNull() & ~valid, "invalid offsets"), (valid & (said != F.col("sentence")), "evidence differs from document"), sep="; ",
    )
    return j.withColumn("errors", errors).drop("_text")


def overlapping_spans(left: DataFrame, right: DataFrame, key: str, payload: Sequence[Column], width: int = 4096) -> DataFrame:
    """Aggregate ``payload`` over the right spans that overlap each left span of the same document.

    Spans meet only inside shared offset buckets, so a long document joins bucket by bucket. ``left`` has a
    unique ``span_id``; both sides carry start_char and end_char.
    """
    def bucketed(df: DataFrame) -> DataFrame:
        return df.withColumn("_b", F.explode(F.sequence(F.floor(F.col("start_char") / width), F.floor((F.greatest(F.col("end_char") - 1, F.col("start_char"))) / width))))

    r = bucketed(right.withColumnsRenamed({"start_char": "_rs", "end_char": "_re"}).withColumns({"start_char": F.col("_rs"), "end_char": F.col("_re")})).drop("start_char", "end_char")
    met = bucketed(left).join(r, [key, "_b"]).where((F.col("start_char") < F.col("_re")) & (F.col("end_char") > F.col("_rs")))
    # A pair sharing several buckets counts in the first shared one only.
    once = met.where(F.col("_b") == F.floor(F.greatest(F.col("start_char"), F.col("_rs")) / width))
    return once.groupBy(key, "span_id").agg(*payload)


# --- pages ------------------------------------------------------------------------------------------

# Elements that never hold visible prose.
HIDDEN_TAGS = {"nav", "footer", "header", "script", "style", "noscript", "template"}
HIDDEN_WORDS = ("cookie", "consent", "navigation", "breadcrumb")
VOID_TAGS = {"br", "img", "hr", "meta", "link", "input", "source", "wbr", "area", "base", "col", "embed", "param", "track"}


class _Visible(HTMLParser):
    """Collects text outside hidden elements and the cells of table rows."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.rows: list[list[str]] = []
        self.hidden: list[str] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            if tag == "br":
                self.parts.append("\n")
            return
        marks = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower()
        if self.hidden or tag in HIDDEN_TAGS or any(w in marks for w in HIDDEN_WORDS):
            self.hidden.append(tag)
            return
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self.cell = []
        if tag in ("p", "div", "li", "h1", "h2", "h3", "h4", "tr", "article", "section", "table", "ul"):
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if self.hidden:
            if tag in self.hidden:
                while self.hidden and self.hidden.pop() != tag:
                    pass
            return
        if tag in ("td", "th") and self.cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None
        if tag in ("p", "div", "li", "h1", "h2", "h3", "h4", "tr", "article", "section", "table", "ul"):
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if self.cell is not None:
                self.cell.append(data)


def _parsed(html: str) -> _Visible:
    parser = _Visible()
    parser.feed(html or "")
    parser.close()
    return parser


def visible_text(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, text): prose of each page without navigation, scripts, styles and cookie notices."""
    kind = pages.schema[key].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for body in batch[html]:
                lines = (" ".join(line.split()) for line in "".join(_parsed(body).parts).split("\n"))
                texts.append("\n".join(line for line in lines if line))
            yield pd.DataFrame({key: batch[key], "text": texts})

    return pages.select(key, html).mapInPandas(read, f"{key} {kind}, text string")


def table_row_numbers(pages: DataFrame, key: str, label: str, html: str = "html") -> DataFrame:
    """(key, row_no, label, numbers) of table rows whose first cell equals or starts with ``label``."""
    kind = pages.schema[key].dataType.simpleString()
    wanted = label.lower()

    def number(cell: str) -> float | None:
        text = re.sub(r"[,%$]", "", cell).strip()
        try:
            return float(text)
        except ValueError:
            return None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, body in zip(batch[key], batch[html]):
                for i, cells in enumerate(_parsed(body).rows):
                    if cells and cells[0].lower().startswith(wanted):
                        out.append((k, i, cells[0], [n for n in map(number, cells[1:]) if n is not None]))
            yield pd.DataFrame(out, columns=[key, "row_no", "label", "numbers"])

    return pages.select(key, html).mapInPandas(read, f"{key} {kind}, row_no int, label string, numbers array<double>")


# --- captions and transcripts -------------------------------------------------------------------------

# WebVTT / SRT timing line.
TIMING = r"(?:(\d{1,3}):)?(\d{2}):(\d{2})[.,](\d{3})\s*-->\s*(?:(\d{1,3}):)?(\d{2}):(\d{2})[.,](\d{3})"


def cues(captions: DataFrame, key: str, body: str = "body") -> DataFrame:
    """Caption text to (key, cue_no, start, end, speaker, text, chapter)."""
    text = F.regexp_replace(F.col(body), "\r\n?", "\n")
    blocks = captions.select(key, F.posexplode(F.split(text, r"\n\s*\n")).alias("cue_no", "block")).where(F.col("block").rlike(TIMING) & ~F.col("block").rlike(r"^\s*(NOTE|STYLE|REGION)(\s|$)"))

    def seconds(first: int) -> Column:
        part = [F.coalesce(F.regexp_extract("block", TIMING, first + i).try_cast("double"), F.lit(0.0)) for i in range(4)]
        return part[0] * 3600 + part[1] * 60 + part[2] + part[3] / 1000

    said = F.regexp_replace("block", rf"(?s)^.*?{TIMING}[^\n]*\n?", "")
    plain = F.trim(F.regexp_replace(said, "<[^>]*>", ""))
    for mark, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(mark), F.lit(char))
    speaker = F.nullif(F.regexp_extract(said, r"<v(?:\.[^ >]+)?\s+([^>]+)>", 1), F.lit(""))
    chapter = F.col("block").rlike(r"(?i)^\s*chapter[-_]\d+\s*\n")
    return blocks.select(key, "cue_no", seconds(1).alias("start"), seconds(5).alias("end"), speaker.alias("speaker"), plain.alias("text"), chapter.alias("chapter")).where(F.col("text") != "")


def cue_errors(rows: DataFrame, key: str) -> DataFrame:
    """Cues that end before they start or start before their predecessor."""
    stepped = with_previous(rows, [key], ["cue_no"], ["start"])
    error = F.when(F.col("end") <= F.col("start"), "not positive").when(F.col("start") < F.col("prev_start"), "not monotonic")
    return stepped.withColumn("error", error).where(F.col("error").isNotNull()).select(key, "cue_no", "error")


def rolling_captions(rows: DataFrame, key: str) -> DataFrame:
    """Trim the words a cue repeats from its predecessor; a full repeat only extends the segment before it.

    Returns segments (key, segment_no, start, end, speaker, text) with ``removed_words`` per segment.
    """
    stepped = with_previous(rows, [key], ["cue_no"], ["start", "end", "speaker", "text"])
    words, before = F.split(F.trim("text"), r"\s+"), F.split(F.trim("prev_text"), r"\s+")
    near = F.col("prev_text").isNotNull() & F.col("speaker").eqNullSafe(F.col("prev_speaker")) & (F.col("start") <= F.col("prev_end") + 0.05)
    line = F.col("text").contains("\n") & (F.substring_index("text", "\n", 1) == F.substring_index("prev_text", "\n", -1))
    partial = (F.col("start") < F.col("prev_end")) | line
    longest = F.expr("filter(sequence(least(size(_w), size(_b)), 2, -1), n -> slice(_b, size(_b) - n + 1, n) = slice(_w, 1, n))")
    tested = stepped.withColumns({"_w": words, "_b": before}).withColumn(
        "_o", F.when(near & (F.col("_w") == F.col("_b")), F.size("_w")).when(
            near & partial & (F.least(F.size("_w"), F.size("_b")) >= 2),
            F.coalesce(F.try_element_at(longest, F.lit(1)), F.lit(0)),
        ).otherwise(0),
    )
    first = F.col("prev_text").isNull()
    marked = tested.withColumn("_kept", ((F.col("_o") < F.size("_w")) | first).cast("int"))
    grouped = running_totals(marked.drop("_b"), [key], [F.col("cue_no")], {"segment_no": F.col("_kept")}).drop("segment_no_all")
    return grouped.groupBy(key, "segment_no").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.first("speaker").alias("speaker"),
        F.max(F.when(F.col("_kept") == 1, F.array_join(F.slice("_w", F.col("_o") + 1, F.size("_w")), " "))).alias("text"),
        F.sum("_o").alias("removed_words"),
    )


def caption_diagnostics(rows: DataFrame, key: str) -> DataFrame:
    """Track kind, cue count, span and the share of it covered by the union of cue intervals, for tracks of any size.

    A cue adds what lies behind the furthest end of all earlier cues; that end is a running maximum carried across ranges.
    """
    reach = running_maxima(rows, [key], [F.col("start"), F.col("cue_no")], {"_reach": F.col("end")})
    part = F.greatest(F.lit(0.0), F.col("end") - F.greatest(F.col("start"), F.coalesce("_reach", F.col("start"))))
    s = reach.groupBy(key).agg(F.count("*").alias("raw_cues"), F.min("start").alias("first_timestamp"), F.max("end").alias("last_timestamp"), F.sum(part).alias("covered_seconds"), F.bool_and("chapter").alias("_c"))
    span = F.col("last_timestamp") - F.col("first_timestamp")
    return s.select(key, "raw_cues", "first_timestamp", "last_timestamp", span.alias("span_seconds"), (F.col("covered_seconds") / F.greatest(span, F.lit(1.0))).alias("time_coverage"), F.when(F.col("_c"), "chapters").otherwise("captions").alias("track_kind"))


def transcript_documents(segments: DataFrame, key: str, position: str, speaker: str, text: str) -> DataFrame:
    """One text per transcript: ``speaker: text`` paragraphs in order (the result is one document value)."""
    said = F.when(F.coalesce(F.trim(speaker), F.lit("")) != "", F.concat(F.col(speaker), F.lit(": "), F.col(text))).otherwise(F.col(text))
    return segments.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), said.alias("t")))), lambda s: s["t"]), "\n\n").alias("text"))


#: A word that follows itself nine times or more.
LOCAL_LOOP = r"(?U)\b(\w+)(?:\s+\1\b){9,}"


def transcript_quality(segments: DataFrame, key: str, durations: DataFrame | None = None) -> DataFrame:
    """Speech plausibility of a transcript: rates, duplicates, repeated 5-grams, overlaps, warnings.

    ``segments``: key, segment_no, start, end, text; ``durations``: key, duration of the audio in seconds (rates use it, and
    stamps over two seconds behind it are reported; without one a minute rate uses the last stamp). All neighbour steps are
    numbered by range and the median is read off range ranks, so one transcript may hold any share of the rows.
    Near-duplicate neighbours use edit distance.
    """
    tidy = F.array_join(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\w+)"), 1), " ")
    base = segments.withColumn("tidy", tidy).withColumn("length", F.greatest(F.lit(0.0), F.col("end") - F.col("start")))
    stepped = with_previous(base, [key], ["segment_no"], ["tidy", "start", "end"])
    ratio = 1 - F.levenshtein("tidy", "prev_tidy") / F.greatest(F.length("tidy"), F.length("prev_tidy"), F.lit(1))
    words_n = F.when(F.col("tidy") == "", 0).otherwise(F.size(F.split("tidy", " ")))
    facts = stepped.groupBy(key).agg(
        F.count("*").alias("segment_count"), F.sum(words_n).alias("word_count"), F.sum(F.length("text")).alias("character_count"), F.avg("length").alias("average_segment_duration"),
        F.count_if(F.col("tidy") == F.col("prev_tidy")).alias("_same"), F.count_if((F.col("tidy") != F.col("prev_tidy")) & (ratio > 0.9)).alias("near_duplicate_adjacent_count"),
        F.count_if(F.col("start") < F.col("prev_end") - 0.001).alias("overlapping_timestamp_count"), F.count_if(F.col("start") < F.col("prev_start")).alias("non_monotonic_timestamp_count"),
        F.max("end").alias("last_timestamp"), F.min_by("start", "segment_no").alias("first_timestamp"), F.count_if(F.col("tidy").rlike(LOCAL_LOOP)).alias("local_repetition_segments"),
    )
    middle = medians(value_positions(base, [key], "length"), [key], "length", "median_segment_duration")
    facts = facts.join(middle, key, "left")
    facts = facts.join(durations.select(key, F.col("duration").cast("double").alias("duration")), key, "left") if durations is not None else facts.withColumn("duration", F.lit(None).cast("double"))
    distinct = base.groupBy(key, "tidy").agg(F.count("*").alias("n")).groupBy(key).agg(F.sum(F.col("n") - 1).alias("_repeats"))
    words = base.where(F.col("tidy") != "").select(key, "segment_no", F.posexplode(F.split("tidy", " ")).alias("word_no", "word"))
    grams = following(words, [key], ["segment_no", "word_no"], "word", 4).where(F.size("ahead") == 4)
    counted = grams.groupBy(key, F.xxhash64("word", "ahead").alias("g"), F.concat_ws(" ", F.col("word"), F.array_join("ahead", " ")).alias("gram")).agg(F.count("*").alias("n"))
    ngram = counted.groupBy(key).agg((F.sum(F.col("n") - 1) / F.sum("n")).alias("repeated_ngram_ratio"))
    j = facts.join(distinct, key).join(ngram, key, "left")
    minutes = F.greatest(F.coalesce("duration", "last_timestamp") / 60, F.lit(1 / 60))
    rated = j.withColumns({
        "duration_minutes": minutes,
        "words_per_minute": F.col("word_count") / minutes, "characters_per_minute": F.col("character_count") / minutes, "segments_per_minute": F.col("segment_count") / minutes,
        "duplicate_text_ratio": F.col("_repeats") / F.greatest(F.col("segment_count"), F.lit(1)), "repeated_ngram_ratio": F.coalesce("repeated_ngram_ratio", F.lit(0.0)),
        "consecutive_duplicate_ratio": F.col("_same") / F.greatest(F.col("segment_count") - 1, F.lit(1)),
    })
    enough = F.col("word_count") >= 100
    warnings = joined_reasons(
        (F.col("local_repetition_segments") > 0, "local_word_repetition_review_required"), (enough & (F.col("words_per_minute") > 300), "speech_rate_above_300_wpm"),
        (enough & (F.col("characters_per_minute") > 2000), "character_rate_above_2000_per_minute"), (enough & (F.col("duplicate_text_ratio") > 0.30), "repeated_segment_text"),
        (enough & (F.col("repeated_ngram_ratio") > 0.60), "repeated_phrase_loop"),
        ((F.col("segment_count") >= 300) & (F.col("segments_per_minute") > 45) & (F.col("median_segment_duration") <= 1.2), "dense_short_segments"), (F.col("overlapping_timestamp_count") > 0, "overlapping_timestamps"),
        (F.col("non_monotonic_timestamp_count") > 0, "non_monotonic_timestamps"),
        (F.col("last_timestamp") > F.col("duration") + 2, "timestamps_beyond_audio"), sep="; ",
    )
    return rated.withColumn("warnings", warnings).withColumn("status", F.when(F.col("warnings") == "", "PASS").otherwise("TRANSCRIPT_QA_WARNING")).drop("_same", "_repeats")


def repeated_words(segments: DataFrame, key: str) -> DataFrame:
    """(key, segment_no) of segments in which one word follows itself nine times or more."""
    tidy = F.array_join(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\w+)"), 1), " ")
    return segments.where(tidy.rlike(LOCAL_LOOP)).select(key, "segment_no")


# --- merging and discovery ------------------------------------------------------------------------------


def merge_documents(documents: DataFrame, row: str, keys: Sequence[Column], fields: Sequence[str], order: str) -> DataFrame:
    """Rows sharing any key become one: first non-empty field in ``order``, count and first provenance kept.

    Returns the merged rows; their ``root`` is the smallest row id of the group. Use :func:`merge_members`
    for the full provenance list, which stays a table because a group may be large.
    """
    labels = merge_members(documents, row, keys)
    j = documents.join(labels, row, "left").withColumn("root", F.coalesce("root", row))
    picked = [F.min_by(f, F.when(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) != "", F.struct(order, row))).alias(f) for f in fields]
    return j.groupBy("root").agg(F.count("*").alias("merged_rows"), *picked)


def merge_members(documents: DataFrame, row: str, keys: Sequence[Column]) -> DataFrame:
    """(row, root) of every row that states at least one key."""
    tagged = F.array_compact(F.array(*[F.when(F.coalesce(k, F.lit("")) != "", F.concat(F.lit(f"{i}:"), k)) for i, k in enumerate(keys)]))
    return connected(documents.select(row, F.explode(tagged).alias("_key")), row, "_key")


def _without_query(url: Column) -> Column:
    return F.regexp_extract(tx.canonical_url(F.coalesce(url, F.lit(""))), r"^[^?#]*", 0)


def reconcile_events(fresh: DataFrame, stored: DataFrame, sticky: Sequence[str]) -> DataFrame:
    """Match fresh events to stored ones one to one; sticky fields keep the stored value, unmatched stored rows stay.

    Both sides: ticker, event_id (unique), event_url, date, webcast_url, media_url, provider_event_id, title; missing columns count as NULL.
    A pair of one event address (without query; only addresses with an ``#event-`` part name an event) matches unless both
    sides state different dates, webcast paths or media paths, and then nothing else can match it. Other pairs match by equal
    provider id, or by equal date and normalised title. Fresh events are visited in id order and each takes the first stored
    event, in id order, that is still free. Candidates come from equal keys only, so rows that state none never meet and
    no task gathers them; the order is settled by rounds. Adds ``stored_id``, ``match_method`` and ``reconciliation``.
    """
    names = ["event_url", "date", "webcast_url", "media_url", "provider_event_id", "title"]

    def described(df: DataFrame, p: str) -> DataFrame:
        has = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
        url, date, webcast, media, pid, title = (has(c) for c in names)
        blank = lambda c: F.nullif(c, F.lit(""))
        return df.select(
            "ticker", F.col("event_id").alias(f"{p}id"), F.when(url.contains("#event-"), blank(_without_query(url))).alias(f"{p}url"), blank(date).alias(f"{p}date"), blank(_without_query(webcast)).alias(f"{p}webcast"),
            blank(_without_query(media)).alias(f"{p}media"), blank(pid).alias(f"{p}pid"), F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"(?U)\W+", "").alias(f"{p}title"),
        )

    def keyed(df: DataFrame, p: str) -> DataFrame:
        """One row per key a pair may share. Dated events meet the same date; undated ones meet every date of their address."""
        url, date, pid, title = (F.col(f"{p}{c}") for c in ("url", "date", "pid", "title"))
        any_date, dated, undated = F.struct(F.lit("u*").alias("k"), url.alias("v")), F.struct(F.lit("ud").alias("k"), F.concat_ws("|", url, date).alias("v")), F.struct(F.lit("un").alias("k"), url.alias("v"))
        options = [F.when(url.isNotNull() & date.isNotNull(), dated), F.when(pid.isNotNull(), F.struct(F.lit("p").alias("k"), pid.alias("v"))), F.when(date.isNotNull(), F.struct(F.lit("t").alias("k"), F.concat_ws("|", date, title).alias("v")))]
        # An undated fresh event looks for all stored ones of its address, an undated stored one is found by the dated.
        options += [F.when(url.isNotNull() & date.isNull(), any_date), F.when(url.isNotNull() & date.isNotNull(), undated)] if p == "f_" else [F.when(url.isNotNull(), any_date), F.when(url.isNotNull() & date.isNull(), undated)]
        return df.select("*", F.explode(F.array_compact(F.array(*options))).alias("_k"))

    c = F.col
    same_url = F.coalesce(c("f_url") == c("s_url"), F.lit(False))
    differ = lambda n: F.coalesce(c(f"f_{n}") != c(f"s_{n}"), F.lit(False))
    method = (
        F.when(same_url, F.when(~differ("date") & ~differ("webcast") & ~differ("media"), "canonical_url")).when(c("f_pid") == c("s_pid"), "provider_event_id")
        .when((c("f_date") == c("s_date")) & (c("f_title") == c("s_title")), "date_title")
    )
    met = keyed(described(fresh, "f_"), "f_").join(keyed(described(stored, "s_"), "s_"), ["ticker", "_k"]).withColumn("match_method", method).where(c("match_method").isNotNull())
    links = met.select("ticker", "f_id", "s_id", "match_method").distinct()
    matches = settle(one_to_one(links, "f_id", "s_id", []).select(c("f_id").alias("event_id"), c("s_id").alias("stored_id"), "match_method"))
    kept = stored.select(c("event_id").alias("stored_id"), *[c(x).alias(f"_s_{x}") for x in sticky]).join(matches, "stored_id")
    joined = fresh.join(kept, "event_id", "left")
    cols = [F.coalesce(F.nullif(c(f"_s_{x}"), F.lit("")) if dict(fresh.dtypes)[x] == "string" else c(f"_s_{x}"), c(x)).alias(x) if x in sticky else c(x) for x in fresh.columns]
    out = joined.select(*cols, "stored_id", "match_method", F.when(c("stored_id").isNotNull(), "matched").otherwise("new").alias("reconciliation"))
    rest = stored.join(matches.select(c("stored_id").alias("event_id")), "event_id", "left_anti")
    return out.unionByName(rest.select(*[c(x) if x in stored.columns else F.lit(None).cast(dict(fresh.dtypes)[x]).alias(x) for x in fresh.columns], c("event_id").alias("stored_id"), F.lit(None).cast("string").alias("match_method"), F.lit("kept").alias("reconciliation")))


def _weighted(tests: Sequence[tuple[Column, int, str]]) -> tuple[Column, Column]:
    score = sum((F.when(F.coalesce(t, F.lit(False)), w).otherwise(0) for t, w, _ in tests), F.lit(0))
    return score, joined_reasons(*[(t, f"{w:+d} {why}") for t, w, why in tests], sep="; ")


def entry_page_scores(links: DataFrame) -> DataFrame:
    """Score pages as an investor entry page of a company, with reasons and caps.

    ``links``: company, ticker, url, title, body, endorsed BOOLEAN.
    """
    name, title, body, url = F.col("company"), F.lower("title"), F.lower("body"), F.col("url")
    key = tx.blocking_key(name)
    tokens = F.split(key, " ")
    domain = F.regexp_replace(F.regexp_extract(tx.host(url), r"([^.]+)\.[^.]+$", 1), "-", "")
    present = (key != "") & F.forall(tokens, lambda t: body.contains(t))
    branded = (key != "") & (F.array_contains(tokens, domain) | (domain == F.array_join(tokens, "")))
    signals = F.size(F.filter(F.array(*[F.lit(s) for s in R.IR_SIGNALS]), lambda s: body.contains(s)))
    path = F.regexp_extract(url, r"^[a-z]+://[^/]+(/[^?#]*)", 1)
    tests = [
        (present, 25, "company identity in content"), (F.forall(tokens, lambda t: title.contains(t)), 20, "company in title"),
        (title.contains("investor relations") | title.contains("investors"), 20, "investor page title"),
        (tx.host(url).rlike(r"^ir\.|investor") | path.contains("investor"), 10, "IR URL pattern"), (branded, 15, "company-branded hostname"),
        (F.regexp_like(body, F.concat(F.lit(r"\b\Q"), F.lower("ticker"), F.lit(r"\E\b"))), 5, "ticker in content"),
        (F.coalesce("endorsed", F.lit(False)), 25, "linked by company-branded corporate page"),
    ]
    base, reasons = _weighted(tests)
    score = base + F.least(F.lit(15), signals * 3)
    score = F.when(~branded & ~F.coalesce("endorsed", F.lit(False)), F.least(score, F.lit(64))).otherwise(score)
    score = F.when(url.rlike("(?i)news-release-details|news/details|stock-quote|investor-faq"), F.least(score, F.lit(64))).otherwise(score)
    score = F.when(signals < 2, F.least(score, F.lit(50))).otherwise(score)
    final = F.when(tx.is_blocked(url), -100).when(~present, 0).otherwise(score)
    why = F.when(tx.is_blocked(url), "rejected third-party information domain").when(~present, "company identity not confirmed in content").otherwise(reasons)
    return links.withColumns({"score": final, "reasons": why})


def section_link_scores(links: DataFrame, category: str) -> DataFrame:
    """Score links as the way to a news, reports or events section (``links``: url, text, context)."""
    words = {"news": R.NEWS_KEYWORDS, "events": R.EVENT_KEYWORDS, "reports": R.REPORT_KEYWORDS}[category]
    strong = ["press releases", "news releases", "all news"] if category == "news" else ["featured reports", "view all reports", "annual reports"]
    text, context = F.lower("text"), F.lower("context")
    path = F.regexp_replace(F.lower(F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)), "[-_]", " ")
    pattern = "|".join(words)
    both = F.concat(text, path)
    tests = [
        (text.rlike(pattern), 12, "anchor"), (path.rlike(pattern), 7, "path"), (context.rlike(pattern), 2, "context"),
        (F.trim(text).isin(*strong), 15, "explicit archive navigation"), (both.contains("archive"), 5, "archive"),
    ]
    if category == "reports":
        tests.append((both.contains("sec filing") & ~both.contains("report"), -30, "filing list"))
    score, reasons = _weighted(tests)
    unrelated = F.lit(category == "events") & F.concat_ws(" ", "text", "url").rlike("(?i)career|community|charity|job fair|employee|training|volunteer")
    noise = F.concat_ws(" ", text, path).rlike("|".join(R.LINK_NOISE))
    return links.withColumns({
        "score": F.when(unrelated | noise, -50).otherwise(score),
        "reasons": F.when(unrelated, "unrelated corporate event").when(noise, "utility link").otherwise(reasons),
    })


def search_result_scores(rows: DataFrame) -> DataFrame:
    """Relevance and ownership of (company, ticker, url, title, snippet, body) search results."""
    name, url = F.col("company"), F.col("url")
    domain = tx.fold(F.regexp_extract(tx.host(url), r"([^.]+)\.[^.]+$", 1))
    sub = F.regexp_extract(tx.host(url), r"^([^.]+)\.[^.]+\.[^.]+$", 1)
    aliases = F.filter(F.transform(tx.brand_aliases(name), tx.fold), lambda a: F.length(a) >= 4)
    # Brand extensions and investor words.
    tail = ["semi", "semiconductor", "tech", "technology", "networks", "medicines", "holdings"]
    brand = F.when(F.array_contains(aliases, domain), 2).when(F.exists(aliases, lambda a: domain.startswith(a) & F.substring(domain, F.length(a) + 1, F.length(domain)).isin(*tail)), 1).otherwise(0)
    words = F.concat_ws(" ", "title", "snippet")
    company, ir_title = tx.legal_match(name, words), F.col("title").rlike("(?i)investor")
    ir = F.concat_ws(" ", F.col("title"), url).rlike("(?i)investor") | sub.isin("ir", "investor", "investors")
    ticker = (F.coalesce("ticker", F.lit("")) != "") & F.regexp_like(words, F.concat(F.lit(r"(?i)\b\Q"), F.col("ticker"), F.lit(r"\E\b")))
    relevance = 25 * brand + 35 * company.cast("int") + 15 * ticker.cast("int") + 20 * ir.cast("int") + 10 * ir_title.cast("int")
    rejected = tx.is_blocked(url)
    legal_page = (tx.legal_match(name, F.col("title")) | tx.brand_match(name, F.col("title"))) & tx.legal_match(name, F.col("body"))
    ticker_page = F.regexp_like("body", F.concat(F.lit(r"(?i)\b\Q"), F.col("ticker"), F.lit(r"\E\b")))
    ir_page = ir_title & F.col("body").rlike("(?i)financial|sec filings|annual report|stock|earnings")
    owned = F.when(brand == 2, 20).when(brand == 1, 10).otherwise(0) + 40 * legal_page.cast("int") + 20 * ticker_page.cast("int") + 20 * ir_page.cast("int") + 10 * sub.isin("ir", "investor", "investors").cast("int") + 10 * tx.legal_match(name, F.col("snippet")).cast("int")
    proven = legal_page & ir_page & (ticker_page | (brand > 0))
    return rows.withColumns({
        "relevance": F.when(rejected, -1000).when((brand == 0) & ~(company & ir), -100).otherwise(relevance),
        "ownership": F.when(rejected, 0).when(proven, F.least(owned, F.lit(100))).otherwise(F.least(owned, F.lit(74))),
    })
