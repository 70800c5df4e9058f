"""Quality rules as a bitmask ledger: measure once, decide by versioned policies, study by bit counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_bangs long, line_chars long, dup_line_chars long"
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() cuts at ASCII white space only
    n = len(words)
    # Code points in words: bytes that do not continue a character, without the white space.
    blanks = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
    chars = len(text) - blanks
    symbols = sum(raw.count(_SYMBOLS[i : i + 1]) for i in range(len(_SYMBOLS)))
    seen: set[bytes] = set()
    dup = lines = line_chars = dup_chars = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            line_chars += len(line)
            if line in seen:
                dup += 1
                dup_chars += len(line)
            seen.add(line)
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            counts = Counter(windows)
            marked = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=n - 2)
            cover = np.zeros(n, dtype=bool)
            for j in range(3):
                cover[j : j + n - 2] |= marked
            repeated = int(cover.sum())
    upper = len(raw) - len(raw.translate(None, _CAPITALS))
    return n, chars, symbols, dup, repeated, lines, upper, raw.count(b"!!"), line_chars, dup_chars


def rules() -> dict[str, Column]:
    """Name to failure condition over the measurements, in bit order; new rules are only ever appended."""
    words = F.col("n_words")
    return {
        "few_words": words < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * words,
        "symbols": 10 * F.col("n_symbols") > words,
        "word_length_low": F.col("word_chars") < 2 * words,
        "word_length_high": F.col("word_chars") > 12 * words,
        "repeated_lines": 10 * F.col("dup_line_chars") > 3 * F.col("line_chars"),
        "shouting": 2 * F.col("n_upper") > F.col("word_chars"),
        "exclamations": 10 * F.col("n_bangs") > words,
    }


BASE = ("few_words", "repeated_words")
#: Version to the rules that decide. Measurements and bits never change with a version.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "word_length_low", "word_length_high", "repeated_lines"),
    "v2": (*BASE, "symbols", "word_length_low", "word_length_high", "repeated_lines", "shouting", "exclamations"),
}


def policy_mask(names: tuple[str, ...]) -> int:
    order = list(rules())
    return reduce(int.__or__, (1 << order.index(n) for n in names), 0)


def _measure_pass(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [f.split()[0] for f in MEASURES.split(", ")]
    for part in parts:
        found = [measure(t) if t is not None else (0,) * len(fields) for t in part.column(1).to_pylist()]
        columns = [pa.array([r[i] for r in found], type=pa.int64()) for i in range(len(fields))]
        yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *fields])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, every measurement and ``fail_bits`` (bit i set: rule i fails), one row per row of ``docs``.

    One pass over whole texts evaluates every rule once; nothing is shuffled. A NULL text has no words, so it
    measures 0 and fails ``few_words``; an empty table gives no row; repeated rows are repeated; other columns
    are ignored. Words and lines are those of ``measure``: runs of characters other than ASCII white space, and
    pieces between line feeds that hold a word.
    """
    measured = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_measure_pass, f"doc_id long, {MEASURES}")
    bits = reduce(Column.bitwiseOR, (F.when(c, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(rules().values())))
    return measured.withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, version: str, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """The ledger with ``policy``, ``base_failed`` and ``kept``: no text is read again to change the policy."""
    return book.select(
        "*",
        F.lit(version).alias("policy"),
        (F.col("fail_bits").bitwiseAND(F.lit(policy_mask(BASE))) != 0).alias("base_failed"),
        (F.col("fail_bits").bitwiseAND(F.lit(policy_mask((*BASE, *policies[version])))) == 0).alias("kept"),
    )


def ablations(book: DataFrame, version: str, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (kept without it), and that fail it with each other rule.

    The ledger is reduced to its distinct bit patterns first (at most 2^rules rows, combined before the
    shuffle); every figure is then a bitwise aggregate of those.
    """
    order = list(rules())
    mask = policy_mask((*BASE, *policies[version]))
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("docs"))
    names = [n for n in order if policy_mask((n,)) & mask]
    per_rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(policy_mask((n,))).cast("long").alias("bit")) for n in names])).alias("r")
    rows = patterns.select("bits", "docs", per_rule).select("bits", "docs", "r.rule", "r.bit")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return rows.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(fails, F.col("docs"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("docs"))), F.lit(0)).alias("failed_alone"),
        F.coalesce(F.sum(F.when(F.col("bits") != 0, F.col("docs"))), F.lit(0)).alias("rejected_with"),
        F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) != 0, F.col("docs"))), F.lit(0)).alias("rejected_without"),
    )
