"""DuckDB statements of the pipeline operators that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         len(string_split(t, '!!')) - 1 AS n_bangs, coalesce(list_sum(list_transform(lines, lambda x: strlen(x))), 0) AS line_chars,
         coalesce(list_sum(list_transform(list_distinct(lines), lambda x: strlen(x))), 0) AS first_line_chars
  FROM d LEFT JOIN covered USING (doc_id)
), f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars > 12 * n_words THEN 16 ELSE 0 END) + (CASE WHEN 10 * (line_chars - first_line_chars) > 3 * line_chars THEN 32 ELSE 0 END)
    + (CASE WHEN 2 * n_upper > word_chars THEN 64 ELSE 0 END) + (CASE WHEN 10 * n_bangs > n_words THEN 128 ELSE 0 END) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, CAST(fail_bits AS BIGINT) AS fail_bits FROM f
"""

MIX = rf"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size FROM documents),
s AS (
  SELECT source, source_size, CASE ((row_number() OVER (ORDER BY source IS NULL, source)) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)
), r AS (SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source) AS k FROM s),
levels AS (
  SELECT n.k, (1.5 * CAST((SELECT sum(source_size) FROM s) AS BIGINT) - CAST(coalesce(sum(CASE WHEN r.k <= n.k THEN 2 * source_size END), 0) AS BIGINT))
         / CAST(nullif(sum(CASE WHEN r.k > n.k THEN weight END), 0) AS BIGINT) AS level
  FROM (SELECT unnest(range(0, (SELECT count(*) FROM r))) AS k) n, r GROUP BY n.k
), chosen AS (SELECT k, level FROM levels l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.k > l.k AND l.level * r.weight >= 2 * r.source_size) ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN r.k <= c.k THEN CAST(2 * source_size AS DOUBLE) ELSE c.level * weight END AS target FROM r, chosen c),
rated AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 16777216 + 0.5) AS BIGINT) ELSE 0 END AS rate,
         CAST('0x' || substr(md5('7:' || coalesce(d.source, '')), 1, 6) AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), summed AS (SELECT *, CAST(sum(rate) OVER (PARTITION BY source ORDER BY size, md5('7:' || doc_id) ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM rated)
SELECT doc_id, size, source_size, target, (((upto + start) >> 24) - ((upto - rate + start) >> 24)) * size AS taken FROM summed
"""

VECTORS = """
WITH RECURSIVE links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.9
), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(l.b, vec_id)) AS component_id, vec_id <= coalesce(l.b, vec_id) AS kept
FROM embeddings e LEFT JOIN least l ON l.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""


def crc_table() -> list[int]:
    """The 256 steps of CRC-32, from its polynomial."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


def shards(dimensions: tuple[str, ...], bits: int = 5, count: int = 40) -> str:
    """The Hilbert shards, one common table expression per step of the curve's transform."""
    n = len(dimensions)
    ctes = []
    for i, d in enumerate(dimensions):
        ctes.append(f"q{i} AS (SELECT {d}, CAST(floor((sum(m) OVER (ORDER BY {d}) - m) * {1 << bits} / (sum(m) OVER ())) AS BIGINT) AS cell FROM (SELECT {d}, count(*) AS m FROM documents WHERE {d} IS NOT NULL GROUP BY {d}))")
    joins = " ".join(f"LEFT JOIN q{i} ON d.{d} = q{i}.{d}" for i, d in enumerate(dimensions))
    cells = ", ".join(f"coalesce(q{i}.cell, 0) AS x{i}" for i in range(n))
    ctes.append(f"s0 AS (SELECT d.doc_id, d.text, {', '.join(f'd.{d}' for d in dimensions)}, {cells} FROM documents d {joins})")
    step = 0
    for level in range(bits - 1, 0, -1):
        q, p = 1 << level, (1 << level) - 1
        for i in range(n):
            flip = f"CASE WHEN x{i} & {q} <> 0 THEN xor(x0, {p}) ELSE " + ("x0" if i == 0 else f"xor(x0, xor(x0, x{i}) & {p})") + " END AS x0"
            swap = f", CASE WHEN x{i} & {q} <> 0 THEN x{i} ELSE xor(x{i}, xor(x0, x{i}) & {p}) END AS x{i}" if i else ""
            ctes.append(f"s{step + 1} AS (SELECT * REPLACE ({flip}{swap}) FROM s{step})")
            step += 1
    for i in range(1, n):
        ctes.append(f"s{step + 1} AS (SELECT * REPLACE (xor(x{i}, x{i - 1}) AS x{i}) FROM s{step})")
        step += 1
    turn = "0"
    for level in range(bits - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN x{n - 1} & {1 << level} <> 0 THEN {(1 << level) - 1} ELSE 0 END)"
    ctes.append(f"turned AS (SELECT *, {turn} AS t FROM s{step})")
    places = [(level, i) for level in range(bits - 1, -1, -1) for i in range(n)]
    index = " + ".join(f"(((xor(x{i}, t) >> {level}) & 1) << {len(places) - 1 - k})" for k, (level, i) in enumerate(places))
    steps = ", ".join(map(str, crc_table()))
    ctes.append(f"indexed AS (SELECT *, {index} AS curve, hex(encode(coalesce(text, ''))) AS h FROM turned)")
    ctes.append(f"steps AS (SELECT CAST([{steps}] AS BIGINT[]) AS crc)")
    ctes.append(
        "sums AS (SELECT *, strlen(coalesce(text, '')) + 16 AS size, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), "
        "list_transform(range(0, CAST(length(h) / 2 AS BIGINT)), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS text_crc32 FROM indexed, steps)"
    )
    order = ", ".join(f"{d} NULLS FIRST" for d in dimensions)
    ctes.append(f"placed AS (SELECT *, row_number() OVER (ORDER BY curve, {order}, doc_id NULLS FIRST, text_crc32, size) - 1 AS place, count(*) OVER () AS n FROM sums)")
    ctes.append(f"cut AS (SELECT *, place * {count} // n AS shard FROM placed)")
    return f"WITH {', '.join(ctes)} SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, place - (shard * n + {count - 1}) // {count} AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM cut"

_ESCAPE = r"'([<\[])(\\*)(s>|/s>|INST\]|/INST\]|\|endoftext\|>)', '\1\2\\\3', 'g'"

CHAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS x FROM conversations
  UNION ALL SELECT -1, i, role, '</s>[INST] ok [/INST]', role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, role)
), k AS (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, r NULLS LAST, x NULLS LAST)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, r NULLS LAST, x NULLS LAST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(17 + length(regexp_replace(role, {_ESCAPE})) + length(regexp_replace(text, {_ESCAPE}))) AS BIGINT) AS formatted_chars
FROM k GROUP BY conv_id, alone
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
q AS (SELECT row_number() OVER () AS k, item_id, list_distinct({_TERMS}) AS w FROM benchmark),
c AS (SELECT count(*) AS docs, sum(len(w)) AS total FROM d WHERE len(w) > 0),
wanted AS (SELECT DISTINCT unnest(w) AS term FROM q),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) SEMI JOIN wanted USING (term) GROUP BY ALL),
v AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term),
s AS (
  SELECT k, item_id, d.r, d.doc_id, CAST(sum(v.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + CAST((90 * len(d.w) * docs) // total AS BIGINT))))) AS BIGINT) AS score
  FROM (SELECT k, item_id, unnest(w) AS term FROM q) JOIN p USING (term) JOIN v USING (term) JOIN d ON d.r = p.r, c GROUP BY ALL
), o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST, r) AS n FROM s WHERE score > 0)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM o WHERE n <= 10
"""
