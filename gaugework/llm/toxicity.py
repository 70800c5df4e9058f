"""Toxicity classifier whose scores may not depend on which group a text mentions."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import settle
from gaugework.llm.tokens import Memory

#: At most so many labelled documents are used for fitting, those with the smallest hash of their id.
SAMPLE = 20_000
#: So many word and word-start features with the strongest evidence enter the model.
FEATURES = 3_000
STARTS = (3, 4, 5, 6)
PENALTY = 1.0
#: Terms that name groups; a mention alone is neutral, and one may stand for another of its row.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("gay", "lesbian", "straight", "transgender", "queer", "schwule", "lesben", "homosexuels", "homosexuales"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "muslime", "christen", "juden", "musulmans", "chrétiens", "juifs", "musulmanes", "cristianos", "judíos"),
    ("black", "white", "asian", "african", "latino", "european", "arab", "indigenous", "schwarze", "weiße", "noirs", "blancs", "negros", "blancos"),
    ("immigrants", "refugees", "foreigners", "natives", "flüchtlinge", "ausländer", "immigrés", "réfugiés", "inmigrantes", "refugiados"),
    ("elderly", "young", "disabled", "deaf", "blind", "poor", "rich"),
)
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…¡¿–—"


def word_features(piece: str) -> list[str]:
    """Features of one white-space-separated piece: the word without marks at its ends, and its starts."""
    word = piece.strip(_EDGES)
    return [word, *[f"{word[:k]}-" for k in STARTS if len(word) > k]] if word else []


def pieces(text: str | None) -> list[str]:
    return (text or "").lower().split()


@dataclass(frozen=True)
class Model:
    """Weights by feature; the score is the logistic function of bias + sum of weight * log2(1 + count)."""

    weights: dict[str, float]
    bias: float

    def scorer(self):
        index = {f: i for i, f in enumerate(self.weights)}
        value = list(self.weights.values())
        known = Memory(lambda piece: tuple(index[f] for f in word_features(piece) if f in index))

        def score(text: str | None) -> float:
            counts = Counter(i for hit in map(known.__getitem__, pieces(text)) if hit for i in hit)
            z = self.bias + sum(value[i] * math.log2(1 + n) for i, n in counts.items())
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

        return score


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text leaves remainder 0 by 5; a NULL id is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _evidence_pass(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        seen: dict[str, list[int]] = {}
        for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            for f in {f for p in set(pieces(text)) for f in word_features(p)}:
                seen.setdefault(f, [0, 0])[toxic] += 1
        if seen:
            n = np.array(list(seen.values()), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), type=pa.string()), pa.array(n[:, 1]), pa.array(n[:, 0])], ["feature", "toxic", "clean"])


def swapped(words: list[str], seed: int) -> tuple[list[str], list[str]]:
    """A text's pieces, and its counterfactual: every identity term replaced by another of its row.

    Where the text names no group, a term is added and the addition is the counterfactual, so the mere mention of
    any group is learned to be neutral too.
    """
    other = {t: row for row in IDENTITY_TERMS for t in row}
    if any(w in other for w in words):
        return words, [other[w][(other[w].index(w) + 1 + seed % (len(other[w]) - 1)) % len(other[w])] if w in other else w for w in words]
    row = IDENTITY_TERMS[seed % len(IDENTITY_TERMS)]
    return words, [*words, row[seed // 7 % len(row)]]


def _example_pass(features: list[str]):
    def values(index: dict[str, int], words: list[str]) -> dict[int, float]:
        counts = Counter(i for w in words for f in word_features(w) if (i := index.get(f)) is not None)
        return {i: math.log2(1 + n) for i, n in counts.items()}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {f: i for i, f in enumerate(features)}
        for part in parts:
            rows: list[list] = [[], [], [], [], []]
            for text, toxic, doc in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                words, changed = swapped([p.strip(_EDGES) for p in pieces(text)], zlib.crc32(str(doc).encode()))
                here, there = values(index, words), values(index, changed)
                moved = {i: d for i in here.keys() | there.keys() if (d := there.get(i, 0.0) - here.get(i, 0.0))}
                for column, value in zip(rows, (toxic, list(here), list(here.values()), list(moved), list(moved.values())), strict=True):
                    column.append(value)
            kinds = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(rows, kinds, strict=True)], ["toxic", "at", "value", "moved_at", "moved_value"])

    return run


def _sparse(examples: pa.Table, at: str, value: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = examples.column(at).combine_chunks()
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    return rows, lists.flatten().to_numpy(), examples.column(value).combine_chunks().flatten().to_numpy()


def fit_weights(examples: pa.Table, features: int, penalty: float = PENALTY, ridge: float = 2e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise log loss + penalty * mean squared change of the logit under the swaps + ridge.

    Accelerated full-batch descent on sparse rows with a step from the power-iterated curvature; no randomness.
    """
    n = examples.num_rows
    y = examples.column("toxic").to_numpy().astype(np.float64)
    r, c, v = _sparse(examples, "at", "value")
    mr, mc, mv = _sparse(examples, "moved_at", "moved_value")

    def forward(w: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(r, weights=v * w[c], minlength=n)

    def backward(g: np.ndarray) -> np.ndarray:
        return np.bincount(c, weights=v * g[r], minlength=features)

    def moved(w: np.ndarray) -> np.ndarray:
        change = np.bincount(mr, weights=mv * w[mc], minlength=n)
        return np.bincount(mc, weights=mv * change[mr], minlength=features)

    probe = np.full(features + 1, 1 / math.sqrt(features + 1))
    top = 1.0
    for _ in range(30):
        f = forward(probe[:-1], probe[-1])
        probe = np.append(0.25 * backward(f) / n + 2 * penalty * moved(probe[:-1]) / n + ridge * probe[:-1], 0.25 * f.sum() / n)
        top = float(np.linalg.norm(probe)) or 1.0
        probe /= top
    w, bias = np.zeros(features), math.log((y.sum() + 0.5) / (n - y.sum() + 1.5))
    ahead_w, ahead_b, t = w, bias, 1.0
    for _ in range(steps):
        g = 1 / (1 + np.exp(-np.clip(forward(ahead_w, ahead_b), -500, 500))) - y
        new_w = ahead_w - (backward(g) / n + 2 * penalty * moved(ahead_w) / n + ridge * ahead_w) / (1.1 * top)
        new_b = ahead_b - g.mean() / (1.1 * top)
        later = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead_w, ahead_b = new_w + (t - 1) / later * (new_w - w), new_b + (t - 1) / later * (new_b - bias)
        w, bias, t = new_w, new_b, later
    return w, bias


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, penalty: float = PENALTY) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out (smallest hashes of doc_id first).

    Only ids and whole texts are read, never lang, source or other columns. Evidence for every word and word start is
    counted over the sample in parallel; the ``features`` strongest and the identity terms enter. The driver
    receives those names and the sample's sparse rows, both bounded by the parameters. A label is the largest of
    repeated ones, and of rows that share a doc_id the text with the smallest digest is read; NULL labels and ids are ignored. Without any labelled document the model has only a bias below 0.5.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` ids, each with any number of rows
    rows = settle(found.groupBy("doc_id", "toxic").agg(F.min_by("text", F.coalesce(F.md5("text"), F.lit("~"))).alias("text")).select("text", "toxic", "doc_id"))
    counted = rows.mapInArrow(_evidence_pass, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sizes = rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()
    n = {r["toxic"]: r["n"] for r in sizes}
    if not n.get(0) or not n.get(1):
        return Model({}, math.log((n.get(1, 0) + 0.5) / (n.get(0, 0) + 1.5)))
    # Chi-squared of presence against label: words as frequent in clean as in toxic texts rank last.
    with_t, with_c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    gap = with_t * (n[0] - with_c) - with_c * (n[1] - with_t)
    gain = gap * gap / ((with_t + with_c) * (n[0] + n[1] - with_t - with_c + 0.5))
    names = [r["feature"] for r in counted.where("toxic + clean >= 4").select("feature", gain.alias("gain")).orderBy(F.desc("gain"), "feature").limit(features).collect()]
    named = list(dict.fromkeys([*names, *[t for row in IDENTITY_TERMS for t in row]]))
    examples = rows.mapInArrow(_example_pass(named), "toxic int, at array<int>, value array<double>, moved_at array<int>, moved_value array<double>").toArrow()
    weights, bias = fit_weights(examples, len(named), penalty)
    return Model({f: float(w) for f, w in zip(named, weights, strict=True) if abs(w) > 1e-9}, float(bias))


def score_column(model: Model) -> Column:
    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model.scorer()
        for texts in parts:
            yield pd.Series([score(t) for t in texts], dtype="float64")

    return scored(F.col("text").cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text; other columns are ignored).

    Whole texts are scored in one pass. NULL and empty texts get the score of a text without any known word; repeated
    rows get equal scores; an empty table gives no row.
    """
    model = train(docs, labels, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), score_column(model).alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose score is at least 0.5; columns as they are."""
    model = train(docs, labels, **options)
    return docs.where(score_column(model) < 0.5)
