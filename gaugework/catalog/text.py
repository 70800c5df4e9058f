"""Document, page and transcript jobs over the supplied texts. Invented prose gets a vocabulary of words that occur in it."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugework.catalog.registry import query, table
from gaugework.functions import rules as R
from gaugework.functions import text as tx
from gaugework.operators import text as ops
from gaugework.plans.settle import settle

C = F.col

# A vocabulary for the supplied prose: the finance rules themselves are tested on hand-written fixtures.
PROSE = R.ClaimRules(
    rules=(R.Rule("article", "the", (r"\bthe\b",)), R.Rule("link", "and", (r"\band\b",)), R.Rule("owner", "of", (r"\bof\b",)), R.Rule("place", "in", (r"\bin\b", r"\bon\b"))),
    primary_order=("owner", "link", "article", "place"), noise_start=(r"^[a-z,;:]", r"\?"), noise=(r"\bwith\b",), material=(r"\bthat\b", r"\bfor\b", r"\bto\b"),
    directions=(("increasing", ("ing",)), ("decreasing", ("tion",)), ("stable", ("ble",))), minimum_words=4, guidance_metrics=(), framing=(), vague=(),
)


@query("whitespace_normalisation", r"""SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n\n\n+', chr(10) || chr(10), 'g'), ' ' || chr(10))) AS hash FROM documents""")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(tx.normalise_whitespace(C("text")), 256).alias("hash"))


@query("content_hash_groups", r"""WITH h AS (SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n\n\n+', chr(10) || chr(10), 'g'), ' ' || chr(10))) AS h FROM documents) SELECT h AS hash, count(*) AS copies, min(doc_id) AS first_doc FROM h GROUP BY 1""")
def _(spark, folder):
    return table(spark, folder, "documents").groupBy(tx.content_hash(C("text")).alias("hash")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"))


@query("stable_document_ids", """SELECT doc_id, 'doc_' || sha256('{"lang":"' || lang || '","number":"' || doc_id || '","source":"' || source || '"}') AS document_id FROM documents""")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", tx.stable_id("doc_", source=C("source"), lang=C("lang"), number=C("doc_id")).alias("document_id"))


URLS = r"""u AS (SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS s, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) AS h, regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS p, regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages)"""


@query("canonical_urls", f"""WITH {URLS} SELECT page_id, s || '://' || h || p || CASE WHEN q <> '' THEN '?' || array_to_string(list_sort(string_split(q, '&')), '&') ELSE '' END AS canonical FROM u""")
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.canonical_url(C("url")).alias("canonical"))


@query("navigation_urls", f"""WITH {URLS}, t AS (SELECT *, array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_') AND NOT starts_with(x, 'gclid='))), '&') AS qq FROM u)
    SELECT page_id, s || '://' || h || CASE WHEN p = '' THEN '/' ELSE p END || CASE WHEN qq <> '' THEN '?' || qq ELSE '' END AS address FROM t""")
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.navigation_url(C("url")).alias("address"))


@query("host_predicates", f"""WITH {URLS} SELECT page_id, contains(h, '.') AS public, ends_with(h, '.example.org') OR h = 'example.org' AS blocked FROM u""")
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.is_public(C("url")).alias("public"), tx.is_blocked(C("url"), ["example.org", "bloomberg.com"]).alias("blocked"))


@query("redacted_texts", r"""SELECT doc_id, len(regexp_extract_all(text, '[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}')) AS emails FROM documents""")
def _(spark, folder):
    clean = tx.redact(C("text"))
    return table(spark, folder, "documents").select("doc_id", ((F.length(clean) - F.length(F.replace(clean, F.lit("[configured email]"), F.lit("")))) / 18).cast("long").alias("emails"))


@query("redacted_maps", "SELECT event_id, 'http://a.b/c?token=REDACTED&k=' || json_extract_string(props, '$.k') AS url, '[configured email]' AS mail FROM events")
def _(spark, folder):
    k = F.get_json_object("props", "$.k")
    m = tx.redact_map(F.create_map(F.lit("url"), F.concat(F.lit("http://a.b/c?token="), C("user_id").cast("string"), F.lit("&k="), k), F.lit("mail"), F.concat(F.lit("u"), C("user_id").cast("string"), F.lit("@example.com"))))
    return table(spark, folder, "events").select("event_id", m["url"].alias("url"), m["mail"].alias("mail"))


SENT = r"""sn AS (SELECT doc_id, text, trim(s, ' ' || chr(9) || chr(10) || chr(13)) AS sentence FROM (SELECT doc_id, text, unnest(regexp_extract_all(text, '[^.!?\n]+(?:[.!?]+(?:\s|$)|$)')) AS s FROM documents) WHERE trim(s, ' ' || chr(9) || chr(10) || chr(13)) <> '')"""


@query("sentence_split", f"WITH {SENT} SELECT doc_id, count(*) AS sentences, CAST(sum(length(sentence)) AS BIGINT) AS characters, true AS offsets_exact FROM sn GROUP BY 1")
def _(spark, folder):
    d = table(spark, folder, "documents")
    s = ops.sentences(d, "doc_id").join(d.select("doc_id", "text"), "doc_id")
    exact = F.substring(C("text"), C("start_char") + 1, C("end_char") - C("start_char")) == C("sentence")
    return s.groupBy("doc_id").agg(F.count("*").alias("sentences"), F.sum(F.length("sentence")).alias("characters"), F.bool_and(exact).alias("offsets_exact"))


CLAIMS = rf"""{SENT},
c0 AS (SELECT doc_id, sentence, [CASE WHEN regexp_matches(sentence, '(?i)\bthe\b') THEN 'article' END, CASE WHEN regexp_matches(sentence, '(?i)\band\b') THEN 'link' END, CASE WHEN regexp_matches(sentence, '(?i)\bof\b') THEN 'owner' END, CASE WHEN regexp_matches(sentence, '(?i)\b(in|on)\b') THEN 'place' END] AS dims FROM sn
  WHERE NOT regexp_matches(sentence, '^[a-z,;:]|\?') AND NOT regexp_matches(sentence, '(?i)\bwith\b') AND regexp_matches(sentence, '(?i)\b(that|for|to)\b') AND len(regexp_extract_all(sentence, '\b[\w''-]+\b')) >= 4),
c1 AS (SELECT doc_id, sentence, coalesce(dims[3], dims[2], dims[1], dims[4]) AS dimension, CASE WHEN contains(lower(sentence), 'ing') AND contains(lower(sentence), 'tion') THEN 'mixed' WHEN contains(lower(sentence), 'ing') THEN 'increasing' WHEN contains(lower(sentence), 'tion') THEN 'decreasing' WHEN contains(lower(sentence), 'ble') THEN 'stable' ELSE 'unknown' END AS direction
  FROM c0 WHERE coalesce(dims[1], dims[2], dims[3], dims[4]) IS NOT NULL)"""


def english(spark, folder):
    return table(spark, folder, "documents")


@query("sentence_claims", f"WITH {CLAIMS} SELECT dimension, direction, count(*) AS claims, count(DISTINCT doc_id) AS documents FROM c1 GROUP BY 1, 2")
def _(spark, folder):
    c = ops.sentence_claims(ops.sentences(english(spark, folder), "doc_id"), PROSE)
    return c.groupBy("dimension", "direction").agg(F.count("*").alias("claims"), F.countDistinct("doc_id").alias("documents"))


@query("claims_without_exact_copies", rf"""WITH {CLAIMS} SELECT dimension, count(DISTINCT doc_id || '|' || rtrim(lower(trim(regexp_replace(sentence, '\s+', ' ', 'g'))), '.!?')) AS claims FROM c1 GROUP BY 1""")
def _(spark, folder):
    c = ops.drop_exact_duplicates(ops.sentence_claims(ops.sentences(english(spark, folder), "doc_id"), PROSE), "doc_id")
    return c.groupBy("dimension").agg(F.count("*").alias("claims"))


def claims(spark, folder):
    return ops.extract_claims(english(spark, folder), "doc_id", PROSE)


@query("extracted_claims")
def _(spark, folder):
    return claims(spark, folder).select("claim_id", "doc_id", "dimension", "topic", "direction", "certainty", F.size("magnitude").alias("magnitudes"), "start_char", "end_char")


@query("claims_after_user_step", rf"""WITH {CLAIMS} SELECT dimension, count(DISTINCT doc_id || '|' || rtrim(lower(trim(regexp_replace(sentence, '\s+', ' ', 'g'))), '.!?')) AS claims FROM c1 WHERE dimension <> 'place' AND length(sentence) % 2 = 0 GROUP BY 1""")
def _(spark, folder):
    # A caller's own step between the rules and the removal of copies: it drops a dimension and every sentence of odd length.
    def step(found):
        return found.where((C("dimension") != "place") & (F.length("sentence") % 2 == 0))

    c = ops.sentence_claims(ops.sentences(english(spark, folder), "doc_id"), PROSE)
    return ops.drop_exact_duplicates(step(c), "doc_id").groupBy("dimension").agg(F.count("*").alias("claims"))


@query("claim_evidence_check", rf"""WITH {CLAIMS} SELECT 'evidence differs from document' AS errors, count(DISTINCT c1.doc_id || '|' || dimension || '|' || rtrim(lower(trim(regexp_replace(sentence, '\s+', ' ', 'g'))), '.!?')) AS claims
    FROM c1 JOIN documents USING (doc_id) WHERE lang = 'de' GROUP BY 1""")
def _(spark, folder):
    # Offsets of the claims in German documents are shifted by one; exactly those must be reported.
    docs = english(spark, folder)
    c = ops.drop_exact_duplicates(ops.sentence_claims(ops.sentences(docs, "doc_id"), PROSE), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    shifted = c.withColumn("_by", F.when(C("lang") == "de", 1).otherwise(0)).withColumns({"start_char": C("start_char") - C("_by"), "end_char": C("end_char") - C("_by")})
    shifted = shifted.withColumns({"start_char": F.greatest("start_char", F.lit(0)), "end_char": F.greatest("end_char", F.lit(1))})
    return ops.evidence_errors(shifted, docs, "doc_id").where("errors <> ''").groupBy("errors").agg(F.count("*").alias("claims"))


# Units with their offsets from pieces that cover the whole text, then greedy windows by recursion over the first unit of each.
CHUNKS = r"""pc AS (SELECT doc_id, text, regexp_extract_all(text, '(?s)[^.!?\n]+(?:[.!?]+(?:\s|$)|$)|.') AS ps FROM documents WHERE text IS NOT NULL AND text <> ''),
px AS (SELECT doc_id, text, len(ps) AS n, unnest(ps) AS piece, unnest(range(1, len(ps) + 1)) AS i FROM pc),
py AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off, trim(piece, ' ' || chr(9) || chr(10) || chr(13)) AS v, length(piece) - length(ltrim(piece, ' ' || chr(9) || chr(10) || chr(13))) AS lead
  FROM px),
un AS (SELECT doc_id, off + lead AS a, off + lead + length(v) AS b FROM py WHERE v <> '' AND (regexp_matches(piece, '^[^.!?\n]+[.!?]+\s?$') OR (i = n AND regexp_matches(piece, '^[^.!?\n]+$')))),
ar AS (SELECT pc.doc_id, length(text) AS size, coalesce(any_value(aa), [0]) AS aa, coalesce(any_value(bb), [length(text)]) AS bb FROM pc LEFT JOIN (SELECT doc_id, list(CAST(a AS BIGINT) ORDER BY a) AS aa, list(CAST(b AS BIGINT) ORDER BY a) AS bb FROM un GROUP BY 1) l USING (doc_id) GROUP BY pc.doc_id, text),
ch AS (
  SELECT doc_id, 0 AS chunk_no, 1 AS first, greatest(2, len(list_filter(bb, lambda e: e - aa[1] <= 1800)) + 1) AS nxt FROM ar
  UNION ALL
  SELECT doc_id, chunk_no, first, greatest(first + 1, len(list_filter(bb, lambda e: e - aa[first] <= 1800)) + 1) AS nxt FROM (
    SELECT ar.doc_id, chunk_no + 1 AS chunk_no, aa, bb, greatest(first + 1, least(nxt, len(list_filter(aa, lambda x: x < greatest(aa[first], bb[nxt - 1] - 240))) + 1)) AS first FROM ch JOIN ar USING (doc_id) WHERE bb[nxt - 1] < size
  ) WHERE first <= len(aa)
)"""


@query("document_chunks", f"WITH RECURSIVE {CHUNKS} SELECT ch.doc_id, chunk_no, aa[first] AS start_char, bb[nxt - 1] AS end_char FROM ch JOIN ar USING (doc_id)")
def _(spark, folder):
    return ops.chunks(english(spark, folder), "doc_id").select("doc_id", "chunk_no", "start_char", "end_char")


@query("chunk_sentence_overlap", f"WITH {SENT} SELECT doc_id, count(*) AS sentences FROM sn GROUP BY 1")
def _(spark, folder):
    # Each sentence overlaps the document's one whole-text span exactly once.
    docs = english(spark, folder)
    whole = docs.select("doc_id", C("doc_id").alias("span_id"), F.lit(0).alias("start_char"), F.length("text").alias("end_char"))
    return ops.overlapping_spans(whole, ops.sentences(docs, "doc_id"), "doc_id", [F.count("*").alias("sentences")]).select("doc_id", "sentences")


# Hidden elements go with their content (to the end of a page that is cut off inside one), block tags and breaks become line feeds, other tags vanish.
_HIDDEN = "regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
for _tag in ("script", "style", "nav", "footer", "header", "noscript", "template"):
    _HIDDEN = f"regexp_replace({_HIDDEN}, '(?s)<{_tag}\\b.*?(?:</{_tag}>|$)', '', 'g')"
VISIBLE = rf"""vb AS (SELECT page_id, regexp_replace(regexp_replace({_HIDDEN}, '<(?:br|/?(?:p|div|li|h1|h2|h3|h4|tr|article|section|table|ul))(?:\s[^>]*)?>', chr(10), 'g'), '<[^>]*(?:>|$)', '', 'g') AS t FROM pages),
vd AS (SELECT page_id, replace(replace(replace(replace(regexp_replace(t, '&amp$', '&'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS t FROM vb),
vt AS (SELECT page_id, trim(regexp_replace(regexp_replace(t, '[ \t\r\f\v]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS t FROM vd)"""


@query("visible_page_text", f"WITH {VISIBLE} SELECT page_id, length(t) AS characters, sha256(t) AS hash FROM vt")
def _(spark, folder):
    return ops.visible_text(table(spark, folder, "pages"), "page_id").select("page_id", F.length("text").alias("characters"), F.sha2("text", 256).alias("hash"))


@query("page_table_rows", """SELECT page_id, 'Total of page' AS label, CAST(CAST(page_id * 1000 + 250 AS DOUBLE) AS VARCHAR) || ',' || CAST((page_id % 100) / 2.0 AS VARCHAR) || CASE WHEN page_id % 3 = 0 THEN ',-4.0' ELSE '' END AS numbers FROM pages
    UNION ALL SELECT page_id, 'TOTAL &', '1.0' FROM pages WHERE page_id % 2 = 0""")
def _(spark, folder):
    # Every page gets a table of its own numbers: the labelled row, one with an entity in its label on even pages, and rows that do not count.
    i = C("page_id")
    cell = lambda *parts: F.concat(F.lit("<td>"), *parts, F.lit("</td>"))
    last = F.when(i % 3 == 0, F.lit("-4")).otherwise(F.lit("n/a"))
    own = F.concat(F.lit("<table><tr><th>Name</th><th>n</th></tr><tr>"), cell(F.lit("Total <b>of</b>\n page")), cell(F.format_number(i * 1000 + 250, 0)), cell((i % 100 / 2).cast("string"), F.lit("%")), cell(last), F.lit("</tr><tr>"), cell(F.lit("Subtotal")), cell(F.lit("5")), F.lit("</tr>"),
                   F.when(i % 2 == 0, "<tr><td>TOTAL &amp;</td><td>$1</td></tr>").otherwise(""), F.lit("</table>"))
    rows = table(spark, folder, "pages").withColumn("html", F.concat(C("html"), own))
    return ops.table_row_numbers(rows, "page_id", "total").select("page_id", "label", F.array_join(F.transform("numbers", lambda n: n.cast("string")), ",").alias("numbers"))


@query("written_sections", "SELECT conv_id, CAST(turn AS BIGINT) AS turn, CASE WHEN role = 'user' THEN 'Prepared Remarks' ELSE 'Q&A' END AS heading, role || ' says' AS text FROM conversations")
def _(spark, folder):
    t = table(spark, folder, "conversations").select("conv_id", C("turn").cast("long").alias("turn"), F.concat(F.when(C("role") == "user", "Intro\nPrepared Remarks:\n").otherwise("x\nQ&A\n"), C("role"), F.lit(" says\n")).alias("text"), F.concat_ws(":", "conv_id", "turn").alias("k"))
    return ops.sections(t, "k").join(t.select("k", "conv_id", "turn"), "k").select("conv_id", "turn", "heading", "text")


# --- transcripts ---------------------------------------------------------------------------------------


@query("transcript_documents", "SELECT conv_id, sha256(string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn)) AS hash FROM conversations GROUP BY 1")
def _(spark, folder):
    t = ops.transcript_documents(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    return t.select("conv_id", F.sha2("text", 256).alias("hash"))


def segments(spark, folder):
    turn = C("turn").cast("double")
    return table(spark, folder, "conversations").select("conv_id", C("turn").alias("segment_no"), (turn * 10).alias("start"), (turn * 10 + F.when(C("role") == "assistant", 12).otherwise(9)).alias("end"), C("role").alias("speaker"), "text")


@query(
    "transcript_quality",
    r"""WITH s AS (SELECT conv_id, turn, role, text, array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), ' ') AS t FROM conversations), p AS (SELECT *, lag(t) OVER (PARTITION BY conv_id ORDER BY turn) AS pt, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS pr FROM s),
    w AS (SELECT conv_id, turn, unnest(string_split(t, ' ')) AS word, unnest(range(len(string_split(t, ' ')))) AS i FROM s WHERE t <> ''), g AS (SELECT conv_id, word || ' ' || lead(word, 1) OVER x || ' ' || lead(word, 2) OVER x || ' ' || lead(word, 3) OVER x || ' ' || lead(word, 4) OVER x AS gram FROM w WINDOW x AS (PARTITION BY conv_id ORDER BY turn, i)),
    r AS (SELECT conv_id, (count(*) - count(DISTINCT gram)) / CAST(count(*) AS DOUBLE) AS rr FROM g WHERE gram IS NOT NULL GROUP BY 1), d AS (SELECT conv_id, count(*) - count(DISTINCT t) AS dup FROM s GROUP BY 1)
    SELECT p.conv_id, count(*) AS segment_count, CAST(sum(CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END) AS BIGINT) AS word_count, max(dup) / CAST(count(*) AS DOUBLE) AS duplicate_text_ratio, round(coalesce(max(rr), 0), 6) AS repeated_ngram_ratio,
      count(CASE WHEN pr = 'assistant' THEN 1 END) AS overlapping_timestamp_count, count(CASE WHEN t = pt THEN 1 END) / CAST(greatest(count(*) - 1, 1) AS DOUBLE) AS consecutive_duplicate_ratio,
      round(median(CASE WHEN role = 'assistant' THEN 12.0 ELSE 9.0 END), 6) AS median_segment_duration, round(greatest(count(*) * 9.0 / 60, 1 / 60.0), 6) AS duration_minutes, max(turn * 10 + CASE WHEN role = 'assistant' THEN 12.0 ELSE 9.0 END) > count(*) * 9.0 + 2 AS beyond_audio,
      round(sum(CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END) / greatest(count(*) * 9.0 / 60, 1 / 60.0), 6) AS words_per_minute FROM p LEFT JOIN r USING (conv_id) LEFT JOIN d USING (conv_id) GROUP BY 1""",
)
def _(spark, folder):
    # The audio of a conversation lasts nine seconds a turn.
    durations = segments(spark, folder).groupBy("conv_id").agg((F.count("*") * 9.0).alias("duration"))
    q = ops.transcript_quality(segments(spark, folder), "conv_id", durations)
    return q.select("conv_id", "segment_count", "word_count", "duplicate_text_ratio", F.round("repeated_ngram_ratio", 6).alias("repeated_ngram_ratio"), "overlapping_timestamp_count", "consecutive_duplicate_ratio",
                    F.round("median_segment_duration", 6).alias("median_segment_duration"), F.round("duration_minutes", 6).alias("duration_minutes"), C("warnings").contains("timestamps_beyond_audio").alias("beyond_audio"), F.round("words_per_minute", 6).alias("words_per_minute"))


def caption_bodies(spark, folder):
    c = segments(spark, folder)
    stamp = lambda x: F.format_string("%02d:%02d:%02d.%03d", (x / 3600).cast("int"), (x / 60).cast("int") % 60, x.cast("int") % 60, F.lit(0))
    words = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    cue = F.concat(stamp(C("start")), F.lit(" --> "), stamp(C("end")), F.lit("\n<v "), "speaker", F.lit(">"), F.array_join(words, " "))
    return c.groupBy("conv_id").agg(F.concat(F.lit("WEBVTT\n\nNOTE made\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_no", cue.alias("c")))), lambda s: s["c"]), "\n\n")).alias("body"))


@query("caption_cues", r"""SELECT conv_id, CAST(turn * 10 AS DOUBLE) AS start, turn * 10 + CASE WHEN role = 'assistant' THEN 12.0 ELSE 9.0 END AS end, role AS speaker, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM conversations""")
def _(spark, folder):
    return ops.cues(caption_bodies(spark, folder), "conv_id").select("conv_id", "start", "end", "speaker", "text")


@query("caption_cue_errors", "SELECT conv_id, turn AS cue_no, 'not positive' AS error FROM conversations WHERE role = 'assistant'")
def _(spark, folder):
    s = segments(spark, folder).select("conv_id", C("segment_no").alias("cue_no"), "start", F.when(C("speaker") == "assistant", C("start")).otherwise(C("end")).alias("end"))
    return ops.cue_errors(s, "conv_id")


@query("caption_time_coverage", """WITH c AS (SELECT conv_id, turn * 10.0 AS s, turn * 10 + CASE WHEN role = 'assistant' THEN 12.0 ELSE 9.0 END AS e FROM conversations), r AS (SELECT *, max(e) OVER (PARTITION BY conv_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM c)
    SELECT conv_id, count(*) AS raw_cues, round(sum(greatest(0, e - greatest(s, coalesce(m, s)))) / greatest(max(e) - min(s), 1), 6) AS time_coverage, 'captions' AS track_kind FROM r GROUP BY 1""")
def _(spark, folder):
    d = ops.caption_diagnostics(ops.cues(caption_bodies(spark, folder), "conv_id"), "conv_id")
    return d.select("conv_id", "raw_cues", F.round("time_coverage", 6).alias("time_coverage"), "track_kind")


@query("rolling_caption_overlap", """SELECT conv_id, count(*) AS segments, CAST(3 * (count(*) - 1) AS BIGINT) AS removed_words FROM conversations GROUP BY 1""")
def _(spark, folder):
    # Every cue starts inside its predecessor and repeats three words of it.
    t = C("segment_no").cast("string")
    tail = lambda n: F.concat(F.lit("a"), n, F.lit(" b"), n, F.lit(" c"), n)
    before = (C("segment_no") - 1).cast("string")
    s = segments(spark, folder).select("conv_id", C("segment_no").alias("cue_no"), (C("segment_no") * 24).cast("double").alias("start"), (C("segment_no") * 24 + 25).cast("double").alias("end"), F.lit("s").alias("speaker"),
                                      F.concat(F.when(C("segment_no") > 0, F.concat(tail(before), F.lit(" "))).otherwise(""), F.lit("x"), t, F.lit(" "), tail(t)).alias("text"))
    return ops.rolling_captions(s, "conv_id").groupBy("conv_id").agg(F.count("*").alias("segments"), F.sum("removed_words").alias("removed_words"))


@query("neighbour_text_similarity", r"""WITH t AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: length(x) > 2)) AS w FROM conversations), p AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS q FROM t)
    SELECT conv_id, turn, round(CASE WHEN len(w) > 0 AND len(q) > 0 THEN len(list_intersect(w, q)) / CAST(len(list_distinct(list_concat(w, q))) AS DOUBLE) ELSE 0 END, 6) AS similarity FROM p WHERE q IS NOT NULL""")
def _(spark, folder):
    from gaugework.plans.ordered import with_previous

    t = with_previous(table(spark, folder, "conversations").select("conv_id", "turn", tx.claim_tokens(C("text")).alias("w")), ["conv_id"], ["turn"], ["w"]).where("prev_w IS NOT NULL")
    return t.select("conv_id", "turn", F.round(tx.jaccard(C("w"), C("prev_w")), 6).alias("similarity"))


# --- merging and scoring -----------------------------------------------------------------------------------


@query("merged_documents", rf"""WITH {URLS}, k AS (SELECT page_id, s || '://' || h || '/' AS a, md5(html) AS b FROM pages JOIN u USING (page_id)),
    e AS (SELECT page_id, 'a' || a AS k FROM k UNION ALL SELECT page_id, 'b' || b FROM k),
    r1 AS (SELECT e.page_id, min(m.r) AS r FROM e JOIN (SELECT k, min(page_id) AS r FROM e GROUP BY 1) m USING (k) GROUP BY 1), r2 AS (SELECT e.page_id, min(m.r) AS r FROM e JOIN (SELECT k, min(r1.r) AS r FROM e JOIN r1 USING (page_id) GROUP BY 1) m USING (k) GROUP BY 1),
    r3 AS (SELECT e.page_id, min(m.r) AS r FROM e JOIN (SELECT k, min(r2.r) AS r FROM e JOIN r2 USING (page_id) GROUP BY 1) m USING (k) GROUP BY 1), r4 AS (SELECT e.page_id, min(m.r) AS r FROM e JOIN (SELECT k, min(r3.r) AS r FROM e JOIN r3 USING (page_id) GROUP BY 1) m USING (k) GROUP BY 1),
    r5 AS (SELECT e.page_id, min(m.r) AS r FROM e JOIN (SELECT k, min(r4.r) AS r FROM e JOIN r4 USING (page_id) GROUP BY 1) m USING (k) GROUP BY 1)
    SELECT r AS root, count(*) AS merged_rows, arg_min(url, page_id) AS url FROM r5 JOIN pages USING (page_id) GROUP BY 1""")
def _(spark, folder):
    p = table(spark, folder, "pages")
    site = F.concat(F.lower(F.regexp_extract("url", r"^([A-Za-z]+://[^/?#]*)", 1)), F.lit("/"))
    return ops.merge_documents(p, "page_id", [site, F.md5("html")], ["url"], "page_id").select("root", "merged_rows", "url")


# Fresh and stored events of the pages: kind k = page_id % 8 decides what the two sides share.
EVENTS = """ev AS (SELECT page_id AS i, page_id % 8 AS k, 'T' || page_id % 5 AS t FROM pages),
em AS (SELECT *, CASE k WHEN 0 THEN 'canonical_url' WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN 'provider_event_id' WHEN 4 THEN 'date_title' WHEN 5 THEN NULL WHEN 6 THEN 'canonical_url' END AS m FROM ev)"""


@query("event_reconciliation", f"""WITH {EVENTS} SELECT t AS ticker, 'e' || i AS event_id, CASE WHEN m IS NOT NULL THEN 's' || i END AS stored_id, m AS match_method, CASE WHEN m IS NULL THEN 'new' ELSE 'matched' END AS reconciliation, CASE WHEN m IS NOT NULL THEN 'transcript ' || i END AS transcript FROM em
    UNION ALL SELECT t, 'e' || i || 'b', NULL, NULL, 'new', NULL FROM em WHERE k = 6 UNION ALL SELECT t, 's' || i, 's' || i, NULL, 'kept', 'transcript ' || i FROM em WHERE m IS NULL""")
def _(spark, folder):
    i, k = C("page_id").cast("string"), C("page_id") % 8
    p = table(spark, folder, "pages").withColumn("ticker", F.concat(F.lit("T"), (C("page_id") % 5).cast("string")))
    none = F.lit(None).cast("string")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (C("page_id") % 300).cast("int"))
    path = F.concat(F.lit("https://ir.x.com/events/"), i)
    # 0: one address, other query; 1: one address, other date; 2: one address, other webcast, equal provider id; 3: provider id; 4: date and title; 5, 7: nothing in common (5 without an event part); 6: two fresh events for one stored.
    fresh = p.select(
        "ticker", F.concat(F.lit("e"), i).alias("event_id"), F.concat(path, F.when(k == 5, "").otherwise(F.concat(F.lit("?s=1#event-"), i))).alias("event_url"), F.when(k == 6, None).otherwise(day).alias("date"),
        F.when(k == 2, F.concat(F.lit("https://cast.x.com/new/"), i)).alias("webcast_url"), none.alias("media_url"), F.when(k.isin(2, 3), i).alias("provider_event_id"), F.concat(F.lit("Results Call, no. "), i).alias("title"), none.alias("transcript"),
    )
    again = fresh.where(C("event_url").contains("#event-") & C("date").isNull()).withColumn("event_id", F.concat("event_id", F.lit("b")))
    stored = p.select(
        "ticker", F.concat(F.lit("s"), i).alias("event_id"), F.when(k.isin(0, 1, 2, 6), F.concat(path, F.lit("?s=2#event-old"))).when(k == 5, path).otherwise(F.concat(F.lit("https://old.x.com/"), i, F.lit("#event-1"))).alias("event_url"), F.when(k == 1, F.date_add(day, 7)).when(k.isin(0, 4), day).when(k == 2, day).when(k == 3, F.date_add(day, 1)).alias("date"),
        F.when(k == 2, F.concat(F.lit("https://cast.x.com/old/"), i)).alias("webcast_url"), none.alias("media_url"), F.when(k.isin(2, 3), i).alias("provider_event_id"), F.when(k == 4, F.concat(F.lit("RESULTS CALL - No "), i)).otherwise(F.concat(F.lit("Old "), i)).alias("title"), F.concat(F.lit("transcript "), i).alias("transcript"),
    )
    return ops.reconcile_events(fresh.unionByName(again), stored, ["transcript"]).select("ticker", "event_id", "stored_id", "match_method", "reconciliation", "transcript")


@query("section_link_scores", r"""SELECT page_id, CASE WHEN contains(lower(url), 'contact') THEN -50 ELSE CASE WHEN regexp_matches(lower(t), 'news|press|releases') THEN 12 ELSE 0 END + CASE WHEN regexp_matches(lower(p), 'news|press|releases') THEN 7 ELSE 0 END + CASE WHEN contains(lower(t) || lower(p), 'archive') THEN 5 ELSE 0 END END AS score
    FROM (SELECT page_id, url, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS p, CASE WHEN page_id % 2 = 0 THEN 'News archive' ELSE 'Home' END AS t FROM pages)""")
def _(spark, folder):
    p = table(spark, folder, "pages").select("page_id", "url", F.when(C("page_id") % 2 == 0, "News archive").otherwise("Home").alias("text"), F.lit("").alias("context"))
    return ops.section_link_scores(p, "news").select("page_id", "score")


ENTRY = rf"""{URLS}, ep AS (SELECT page_id, u.url, h, p AS path, lower(html) AS body, lower(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, replace(regexp_extract(h, '([^.]+)\.[^.]+$', 1), '-', '') AS domain,
    list_filter(regexp_extract_all(lower(regexp_extract(u.url, '//(?:[a-z]+\.)?([a-z-]+)\.example', 1)), '[a-z0-9]+'), lambda t: t NOT IN ('inc', 'incorporated', 'corporation', 'corp', 'plc', 'ltd', 'limited', 'the', 'company', 'holdings', 'group', 'co')) AS tok FROM u JOIN pages USING (page_id)),
  et AS (SELECT *, len(tok) > 0 AND len(list_filter(tok, lambda t: contains(body, t))) = len(tok) AS present, CASE WHEN len(tok) = 0 THEN contains(title, '') ELSE len(list_filter(tok, lambda t: contains(title, t))) = len(tok) END AS titled, contains(title, 'investors') OR contains(title, 'investor relations') AS invest,
    regexp_matches(h, '^ir\.|investor') OR contains(path, 'investor') AS irurl, len(tok) > 0 AND (list_contains(tok, domain) OR domain = array_to_string(tok, '')) AS branded, regexp_matches(body, '\bex\b') AS tick,
    regexp_matches(h, '(?:^|\.)(?:{"|".join(d.replace(".", chr(92) + ".") for d in R.BLOCKED_DOMAINS)})$') AS blocked, len(list_filter([{", ".join(f"'{x}'" for x in R.IR_SIGNALS)}], lambda x: contains(body, x))) AS sig FROM ep),
  es AS (SELECT *, 25 * present::INT + 20 * titled::INT + 20 * invest::INT + 10 * irurl::INT + 15 * branded::INT + 5 * tick::INT + least(15, 3 * sig) AS base FROM et)"""


@query("entry_page_scores", f"""WITH {ENTRY} SELECT page_id, CASE WHEN blocked THEN -100 WHEN NOT present THEN 0 ELSE least(base, CASE WHEN sig < 2 THEN 50 ELSE 999 END, CASE WHEN branded THEN 999 ELSE 64 END, CASE WHEN regexp_matches(url, '(?i)news-release-details|news/details|stock-quote|investor-faq') THEN 64 ELSE 999 END) END AS score,
    CASE WHEN blocked THEN 'rejected third-party information domain' WHEN NOT present THEN 'company identity not confirmed in content' ELSE array_to_string(list_filter(['+25 company identity in content', CASE WHEN titled THEN '+20 company in title' END, CASE WHEN invest THEN '+20 investor page title' END, CASE WHEN irurl THEN '+10 IR URL pattern' END,
      CASE WHEN branded THEN '+15 company-branded hostname' END, CASE WHEN tick THEN '+5 ticker in content' END], lambda x: x IS NOT NULL), '; ') END AS reasons FROM es""")
def _(spark, folder):
    p = table(spark, folder, "pages").select("page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), C("html").alias("body"), F.initcap(F.regexp_extract("url", r"//(?:[a-z]+\.)?([a-z-]+)\.example", 1)).alias("company"), F.lit("EX").alias("ticker"), F.lit(False).alias("endorsed"))
    return ops.entry_page_scores(p).select("page_id", "score", "reasons")


FOLDED = "regexp_replace(lower({}), '[^a-z0-9]+', '', 'g')"
RESULTS = rf"""{URLS}, sp AS (SELECT page_id, u.url, html AS body, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, h, {FOLDED.format("regexp_extract(h, '([^.]+)[.][^.]+$', 1)")} AS domain, regexp_extract(h, '^([^.]+)\.[^.]+\.[^.]+$', 1) AS sub FROM u JOIN pages USING (page_id)),
sq AS (SELECT *, CASE WHEN domain = 'example' THEN 2 WHEN starts_with(domain, 'example') AND substr(domain, 8) IN ('semi', 'semiconductor', 'tech', 'technology', 'networks', 'medicines', 'holdings') THEN 1 ELSE 0 END AS brand, contains({FOLDED.format("title || ' Investor relations'")}, 'example') AS company,
  regexp_matches(title, '(?i)investor') AS irt, regexp_matches(title || ' ' || url, '(?i)investor') OR sub IN ('ir', 'investor', 'investors') AS ir, regexp_matches(title || ' Investor relations', '(?i)\bEX\b') AS tk, contains({FOLDED.format("title")}, 'example') AND contains({FOLDED.format("body")}, 'example') AS lp,
  regexp_matches(body, '(?i)\bEX\b') AS tp, regexp_matches(title, '(?i)investor') AND regexp_matches(body, '(?i)financial|sec filings|annual report|stock|earnings') AS ip, regexp_matches(h, '(?:^|\.)(?:{"|".join(d.replace(".", chr(92) + ".") for d in R.BLOCKED_DOMAINS)})$') AS blocked FROM sp),
sr AS (SELECT *, CASE brand WHEN 2 THEN 20 WHEN 1 THEN 10 ELSE 0 END + 40 * lp::INT + 20 * tp::INT + 20 * ip::INT + 10 * (sub IN ('ir', 'investor', 'investors'))::INT AS owned FROM sq)"""


@query("search_result_scores", f"""WITH {RESULTS} SELECT page_id, CASE WHEN blocked THEN -1000 WHEN brand = 0 AND NOT (company AND ir) THEN -100 ELSE 25 * brand + 35 * company::INT + 15 * tk::INT + 20 * ir::INT + 10 * irt::INT END AS relevance,
    CASE WHEN blocked THEN 0 WHEN lp AND ip AND (tp OR brand > 0) THEN least(owned, 100) ELSE least(owned, 74) END AS ownership FROM sr""")
def _(spark, folder):
    p = table(spark, folder, "pages").select("page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.lit("Investor relations").alias("snippet"), C("html").alias("body"), F.lit("Example Inc.").alias("company"), F.lit("EX").alias("ticker"))
    return ops.search_result_scores(p).select("page_id", "relevance", "ownership")


# --- scalar text rules on composed texts ----------------------------------------------------------------------


@query("company_names", "SELECT p_partkey AS partkey, p_name AS normalised, lower(p_name) AS blocking FROM part")
def _(spark, folder):
    raw = F.concat(C("p_name"), F.when(C("p_type") == "PROMO", ", Inc.").when(C("p_type") == "LARGE", " Holdings Ltd").when(C("p_type") == "SMALL", " Corp. Class A Shares").otherwise(""))
    return table(spark, folder, "part").select(C("p_partkey").alias("partkey"), tx.company_name(raw).alias("normalised"), tx.blocking_key(raw).alias("blocking"))


# Where the text holds only the first word of the name, that word is a brand from four letters on.
@query("company_text_match", "SELECT p_partkey AS partkey, p_brand NOT LIKE '%2' AS legal, p_brand NOT LIKE '%2' OR length(split_part(p_name, ' ', 1)) >= 4 AS brand FROM part")
def _(spark, folder):
    name = F.concat(C("p_name"), F.lit(" Group plc"))
    text = F.when(C("p_brand").endswith("2"), F.concat(F.lit("About "), F.split("p_name", " ")[0], F.lit(" x "))).otherwise(F.concat(F.lit("About "), F.upper("p_name"), F.lit(".")))
    p = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand").repartition("p_partkey")  # a small file is one task, but its names take long
    return p.select(C("p_partkey").alias("partkey"), tx.legal_match(name, text).alias("legal"), tx.brand_match(name, text).alias("brand"))


@query("fiscal_periods", """WITH f AS (SELECT o_orderkey AS orderkey, CAST(o_orderdate AS DATE) AS d, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 2 AS m FROM orders) SELECT orderkey, CAST(year(d) + (month(d) > m)::INT AS BIGINT) AS fiscal_year, CAST(((month(d) - m - 1 + 12) % 12) // 3 + 1 AS BIGINT) AS fiscal_quarter FROM f""")
def _(spark, folder):
    d, m = F.to_date("o_orderdate"), F.substring("o_orderpriority", 1, 1).cast("int") * 2
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), tx.fiscal_year_of(d, m).cast("long").alias("fiscal_year"), tx.fiscal_quarter_of(d, m).cast("long").alias("fiscal_quarter"))


@query("period_end_dates", "SELECT o_orderkey AS orderkey, CASE WHEN year(o_orderdate) >= 2000 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS period_end FROM orders")
def _(spark, folder):
    d = F.to_date("o_orderdate")
    text = F.when(F.dayofmonth(d) > 15, F.concat(F.lit("Results for the quarter ended "), F.date_format(d, "MMMM d, yyyy"), F.lit(" were"))).otherwise(F.concat(F.lit("FISCAL YEAR ENDED "), F.date_format(d, "dd/MM/yyyy")))
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), tx.period_end(text).cast("string").alias("period_end"))


@query("stated_periods", "SELECT o_orderkey AS orderkey, CASE WHEN year(o_orderdate) >= 2000 THEN CAST(year(o_orderdate) AS DOUBLE) END AS year, CASE WHEN o_orderpriority LIKE '3%' OR year(o_orderdate) < 2000 THEN NULL ELSE CAST(quarter(o_orderdate) AS DOUBLE) END AS quarter FROM orders")
def _(spark, folder):
    d, p = F.to_date("o_orderdate"), C("o_orderpriority")
    words = F.array(*[F.lit(w) for w in ("first", "second", "third", "fourth")])
    text = F.when(p.startswith("1"), F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" FY"), F.year(d).cast("string"))).when(p.startswith("3"), F.concat(F.lit("fiscal year "), F.year(d).cast("string"))).otherwise(F.concat(F.element_at(words, F.quarter(d)), F.lit(" quarter of fiscal "), F.year(d).cast("string")))
    y, q = tx.stated_period(text)
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), y.cast("double").alias("year"), q.cast("double").alias("quarter"))


@query("first_dates_in_text", "SELECT o_orderkey AS orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def _(spark, folder):
    d, p = F.to_date("o_orderdate"), C("o_orderpriority")
    form = F.when(p.startswith("1"), d.cast("string")).when(p.startswith("2"), F.date_format(d, "MMMM d, yyyy")).when(p.startswith("3"), F.date_format(d, "d MMMM yyyy")).otherwise(F.date_format(d, "M/d/yyyy"))
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), tx.first_date(F.concat(F.lit("Posted on "), form, F.lit(", then 2031-01-01"))).cast("string").alias("day"))


@query("document_types", "SELECT p_partkey AS partkey, CASE p_type WHEN 'PROMO' THEN 'annual_report' WHEN 'LARGE' THEN 'quarterly_report' WHEN 'SMALL' THEN 'proxy_statement' WHEN 'ECONOMY' THEN 'news_release' WHEN 'MEDIUM' THEN 'earnings_transcript' ELSE 'investor_presentation' END AS document_type, CASE p_type WHEN 'PROMO' THEN '10-K' WHEN 'SMALL' THEN 'DEF 14A' END AS sec_form FROM part")
def _(spark, folder):
    t = C("p_type")
    p = table(spark, folder, "part").select(
        C("p_partkey").alias("partkey"), F.when(t == "PROMO", "Form 10-K filing").when(t == "LARGE", "Q2 figures").when(t == "ECONOMY", "Press release").when(t == "MEDIUM", "Quarter call").when(t == "STANDARD", "Slides").otherwise("Proxy").alias("title"),
        F.when(t == "LARGE", "reports").alias("category"), F.when(t == "SMALL", "def 14a").alias("form"), (t == "MEDIUM").alias("spoken"), F.lit("x").alias("path"),
    )
    f = tx.filing_form(C("form"), C("title"), C("path"))
    return p.select("partkey", tx.document_type(C("title"), C("path"), C("category"), F.lit(""), f, C("spoken")).alias("document_type"), f.alias("sec_form"))


@query("availability_dates", "SELECT o_orderkey AS orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'EXPLICIT' WHEN o_orderpriority LIKE '2%' THEN 'FILING_DATE' WHEN o_orderpriority LIKE '3%' THEN 'PUBLICATION_DATE' ELSE 'UNKNOWN' END AS status FROM orders")
def _(spark, folder):
    d, p = F.to_date("o_orderdate"), C("o_orderpriority")
    _, status = tx.availability_date(F.when(p.startswith("1"), d), F.when(p.rlike("^[12]"), d), F.when(p.rlike("^[123]"), d), F.lit(None).cast("date"))
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), status.alias("status"))


@query("normalised_documents", "SELECT doc_id, 'other_report' AS document_type, 'PUBLICATION_DATE' AS availability_status, CAST(0 AS BIGINT) AS sections FROM documents")
def _(spark, folder):
    n = F.lit(None).cast("string")
    d = table(spark, folder, "documents").select(
        "doc_id", C("source").alias("ticker"), F.lit("Letter").alias("title"), F.lit("p").alias("path"), F.concat(F.lit("https://x.example.com/"), C("doc_id").cast("string")).alias("source_url"), n.alias("category"), n.alias("event_type"), n.alias("explicit_form"), "text",
        F.lit(False).alias("has_segments"), n.cast("date").alias("explicit_date"), n.cast("date").alias("filing_date"), F.lit("2024-01-01").cast("date").alias("publication_date"), n.cast("date").alias("source_date"), F.lit(12).alias("fye_month"),
    )
    return ops.normalise_documents(d).select("doc_id", "document_type", "availability_status", C("section_count").cast("long").alias("sections"))


@query("link_predicates", "SELECT page_id, CASE WHEN page_id % 4 = 0 THEN true ELSE false END AS pdf, CASE WHEN page_id % 4 IN (0, 1) THEN true ELSE false END AS release FROM pages")
def _(spark, folder):
    k = C("page_id") % 4
    url = F.when(k == 0, "https://x.com/a.pdf?x=1").when(k == 1, "https://x.com/news/2024/item").when(k == 2, "https://x.com/events/spring").otherwise("https://x.com/about")
    text = F.when(k == 0, "Annual letter to holders").when(k == 3, "view all").otherwise("Company reports a result")
    return table(spark, folder, "pages").select("page_id", tx.is_pdf(url, text).alias("pdf"), tx.is_release_link(url, text, F.lit("")).alias("release"))


@query("event_types", "SELECT o_orderkey AS orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'earnings_call' WHEN '2-HIGH' THEN 'investor_day' WHEN '3-MEDIUM' THEN 'annual_meeting' WHEN '5-LOW' THEN 'conference' ELSE 'other' END AS type, CAST(CASE WHEN o_orderpriority LIKE '1%' THEN quarter(o_orderdate) ELSE 0 END AS BIGINT) AS quarter FROM orders")
def _(spark, folder):
    p, d = C("o_orderpriority"), F.to_date("o_orderdate")
    title = F.when(p.startswith("1"), F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string"), F.lit(" Earnings"))).when(p.startswith("2"), "Capital Markets Day").when(p.startswith("3"), "Annual General Meeting").when(p.startswith("5"), "Tech Summit").otherwise("Update")
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), tx.event_type(title).alias("type"), tx.event_priority(title, d, F.lit("u"))["quarter"].cast("long").alias("quarter"))


def metric_sentences(spark, folder):
    q, p = C("l_quantity").cast("int").cast("string"), C("l_linenumber").cast("string")
    s = F.when(C("l_returnflag") == "A", F.concat(F.lit("Revenue of $"), q, F.lit(" million beat the plan"))).when(C("l_returnflag") == "R", F.concat(F.lit("Gross margin was "), q, F.lit("% and then "), p, F.lit("%"))).otherwise(F.concat(F.lit("Capex of $"), q, F.lit(" billion was "), p, F.lit("% of sales")))
    return table(spark, folder, "lineitem").select("l_returnflag", "l_quantity", "l_linenumber", s.alias("sentence"))


@query("claim_magnitudes", """SELECT CAST(l_quantity AS BIGINT) AS quantity, CAST(l_linenumber AS BIGINT) AS line, l_returnflag AS flag, CASE l_returnflag WHEN 'A' THEN 'USD_million' WHEN 'R' THEN 'percent,percent' ELSE 'USD_billion,percent' END AS units,
    CASE l_returnflag WHEN 'A' THEN l_quantity * 1e6 WHEN 'R' THEN l_quantity END AS base_value, count(*) AS rows FROM lineitem GROUP BY 1, 2, 3, 4, 5""")
def _(spark, folder):
    s = metric_sentences(spark, folder).withColumn("m", tx.magnitudes(C("sentence")))
    obs = tx.metric_observation(C("m"))
    return s.groupBy(C("l_quantity").cast("long").alias("quantity"), C("l_linenumber").cast("long").alias("line"), C("l_returnflag").alias("flag"), F.array_join(F.transform("m", lambda x: x["unit"]), ",").alias("units"), obs["values"][0].alias("base_value")).agg(F.count("*").alias("rows"))


@query("claim_subjects", "SELECT l_returnflag AS flag, CASE l_returnflag WHEN 'A' THEN 'revenue' WHEN 'R' THEN 'gross_margin' ELSE 'revenue' END AS subject, CASE l_returnflag WHEN 'A' THEN 'currency' WHEN 'R' THEN 'percent' END AS unit, count(*) AS rows FROM lineitem GROUP BY 1, 2, 3")
def _(spark, folder):
    s = metric_sentences(spark, folder)
    m = tx.magnitudes(C("sentence"))
    return s.groupBy(C("l_returnflag").alias("flag"), tx.subject(C("sentence"), F.lit("revenue"), F.lit("revenue")).alias("subject"), tx.metric_unit(C("sentence"), m).alias("unit")).agg(F.count("*").alias("rows"))


@query("claim_horizon_and_basis", "SELECT o_orderkey AS orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'annual:' WHEN o_orderpriority LIKE '2%' THEN 'quarter:' || quarter(o_orderdate) END AS horizon, CASE WHEN o_orderstatus = 'F' THEN 'non_gaap' WHEN o_orderstatus = 'O' THEN 'gaap' END AS basis, o_orderpriority LIKE '3%' AS done FROM orders")
def _(spark, folder):
    p, s = C("o_orderpriority"), C("o_orderstatus")
    text = F.concat(F.when(p.startswith("1"), "Full-year sales").when(p.startswith("2"), F.concat(F.lit("In Q"), F.quarter("o_orderdate").cast("string"))).when(p.startswith("3"), "We launched it").otherwise("Margin"), F.when(s == "F", " on a non-GAAP basis").when(s == "O", " under GAAP").otherwise(""))
    return table(spark, folder, "orders").select(C("o_orderkey").alias("orderkey"), tx.horizon(text).alias("horizon"), tx.reporting_basis(text).alias("basis"), tx.completed(text).alias("done"))


@query("person_names", "SELECT s_suppkey AS suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'jose q smith' ELSE 'smith jose' END AS plain, CASE WHEN s_suppkey % 2 = 0 THEN 'jose q smith' ELSE 'jose smith' END AS name_key FROM supplier")
def _(spark, folder):
    raw = F.when(C("s_suppkey") % 2 == 0, "Dr. José Q. Smith, Ph.D").otherwise("SMITH, JOSE")
    return table(spark, folder, "supplier").select(C("s_suppkey").alias("suppkey"), tx.person_name(raw).alias("plain"), tx.name_key(raw).alias("name_key"))
