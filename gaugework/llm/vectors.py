"""Embedding near-dedup: int8 tile products with rigorous error bounds, full precision only where needed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.common import numbered, settle
from gaugework.llm.linking import components, spanning

SIMILARITY = 0.9
TILE = 4096
STRIP = 1024


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale, error) of unit rows: |row - scale * code| <= error in Euclidean length, rounding included."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, error * (1 + 1e-9) + 1e-12


def near_pairs(left: np.ndarray, right: np.ndarray, similarity: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine >= ``similarity`` between two tiles of vectors (i < j if they are the ``same`` tile).

    For unit x = s p + e and y = t q + f with codes p, q: x.y = s t (p.q) + s p.f + e.y, so it differs from s t (p.q)
    by at most |s p| |f| + |e| <= (1 + |e|) |f| + |e|. Code products are whole numbers below 2^24 in float32, so they
    are exact; only pairs whose product plus bound reaches the threshold are computed in double precision.
    """
    def prepared(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        unit = rows / np.linalg.norm(rows, axis=1)[:, None]
        return unit, *quantise(unit)

    unit_a, code_a, scale_a, error_a = prepared(left)
    unit_b, code_b, scale_b, error_b = (unit_a, code_a, scale_a, error_a) if same else prepared(right)
    columns = np.ascontiguousarray(code_b.astype(np.float32).T)
    exact = left.shape[1] * 127 * 127 < 1 << 24
    most_error = float(error_b.max(initial=0.0))
    for at in range(0, len(left), STRIP):
        strip = slice(at, min(at + STRIP, len(left)))
        first = at if same else 0
        codes = code_a[strip].astype(np.float32 if exact else np.float64)
        product = codes @ (columns[:, first:] if exact else columns[:, first:].astype(np.float64))
        # One comparison per cell: the row's loosest threshold over all columns, in code units of the column.
        slack = (1 + error_a[strip]) * most_error + error_a[strip] + 1e-6
        least = ((similarity - slack) / scale_a[strip])[:, None] / scale_b[first:][None, :]
        i, j = np.nonzero(product >= least.astype(np.float32))
        i, j = i + at, j + first
        if same:
            later = i < j
            i, j = i[later], j[later]
        bound = (1 + error_a[i]) * error_b[j] + error_a[i]
        code_product = np.einsum("ij,ij->i", code_a[i].astype(np.int64), code_b[j].astype(np.int64))
        possible = scale_a[i] * scale_b[j] * code_product + bound >= similarity - 1e-12
        i, j = i[possible], j[possible]
        close = np.einsum("ij,ij->i", unit_a[i], unit_b[j]) >= similarity
        yield i[close], j[close]


def _pack_pass(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (dim, tile, item, weight, vector) of one tile after the other, packed into one row per tile."""
    held: list[tuple] = []

    def packed() -> pa.RecordBatch:
        dim, tile = held[0][0], held[0][1]
        items = np.array([h[2] for h in held], dtype=np.int64)
        weights = np.array([h[3] for h in held], dtype=np.int64)
        body = np.array([h[4] for h in held], dtype=np.float32)
        return pa.RecordBatch.from_arrays([pa.array([dim], type=pa.int32()), pa.array([tile], type=pa.int32()), pa.array([items.tobytes()]), pa.array([weights.tobytes()]), pa.array([body.tobytes()])], ["dim", "tile", "items", "weights", "body"])

    for part in parts:
        for row in zip(*[c.to_pylist() if not pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False) for c in part.columns], strict=True):
            if held and held[0][:2] != row[:2]:
                yield packed()
                held = []
            held.append(row)
    if held:
        yield packed()


def _tile_pass(similarity: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                same = row["tile"] == row["tile_b"]
                a, b = (np.frombuffer(row[k], dtype=np.float32).reshape(-1, row["dim"]).astype(np.float64) for k in ("body", "body_b"))
                ids_a, ids_b, w_a, w_b = (np.frombuffer(row[k], dtype=np.int64) for k in ("items", "items_b", "weights", "weights_b"))
                links_a, links_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
                roots: list[tuple[np.ndarray, np.ndarray]] = []
                for i, j in near_pairs(a, b, similarity, same):
                    np.add.at(links_a, i, w_b[j])
                    np.add.at(links_b, j, w_a[i])
                    keep = np.array(spanning(ids_a[i].tolist(), ids_b[j].tolist()), dtype=bool)
                    roots.append((ids_a[i][keep], ids_b[j][keep]))
                x = np.concatenate([r[0] for r in roots]) if roots else np.zeros(0, dtype=np.int64)
                y = np.concatenate([r[1] for r in roots]) if roots else np.zeros(0, dtype=np.int64)
                keep = np.array(spanning(x.tolist(), y.tolist()), dtype=bool)
                x, y = x[keep], y[keep]
                hit_a, hit_b = np.flatnonzero(links_a), np.flatnonzero(links_b)
                items = np.concatenate([ids_a[hit_a], ids_b[hit_b], x])
                links = np.concatenate([links_a[hit_a], links_b[hit_b], np.zeros(len(x), dtype=np.int64)])
                other = pa.array(np.concatenate([np.zeros(len(hit_a) + len(hit_b), dtype=np.int64), y]), mask=np.arange(len(items)) < len(hit_a) + len(hit_b))
                yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(links), other], ["item", "links", "other"])

    return run


def near_vectors(vectors: DataFrame, similarity: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding array<float>; other columns are ignored).

    Two vectors are linked if their cosine in double precision is at least ``similarity``; n_links counts the other
    rows linked directly, component_id is the smallest vec_id reachable, kept marks it. Equal vectors are one
    item with a weight, so a vector shared by a third of the rows is compared once. Items are numbered and
    cut into tiles of ``tile`` rows; every pair of tiles is one product of int8 codes, and only pairs that the
    quantisation bound cannot exclude are recomputed. Tile pairs return counts and spanning links, never the
    pairs of a group. All pairs of tiles are compared, so the work is quadratic in distinct vectors.

    Vectors that are NULL, empty, zero or hold a NULL or non-finite component link with nothing: 0 links, a component
    of their own. Vectors of different length never link. Rows with a NULL vec_id count as linked rows but get a
    component only through equal vectors with an id. Repeated rows count as other vectors. An empty table gives no row.
    """
    body = F.col("embedding").cast("array<float>")
    usable = F.coalesce(F.exists(body, lambda x: x != 0) & F.forall(body, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))), F.lit(False))
    rows = settle(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, F.transform(body, lambda x: F.when(x == 0, F.lit(0.0).cast("float")).otherwise(x))).alias("vector")).withColumn("digest", F.when(F.col("vector").isNotNull(), F.md5(F.to_json("vector")))))
    items = settle(rows.where("digest is not null").groupBy("digest").agg(F.min("vec_id").alias("item"), F.count("*").alias("weight"), F.min_by("vector", "vec_id").alias("vector")).where("item is not null"))
    placed = numbered(items.select("item", "weight", "vector", F.size("vector").alias("dim")), ["dim", "item"], "place")
    sizes = placed.groupBy("dim").agg(F.min("place").alias("start"))
    tiled = placed.join(sizes, "dim").withColumn("tile", F.floor((F.col("place") - F.col("start")) / tile).cast("int"))
    packed = settle(tiled.repartition("dim", "tile").sortWithinPartitions("dim", "tile", "place").select("dim", "tile", "item", "weight", "vector").mapInArrow(_pack_pass, "dim int, tile int, items binary, weights binary, body binary"))
    last = Window.partitionBy("dim")
    heads = packed.select("dim", "tile").withColumn("last", F.max("tile").over(last))  # one row per ``tile`` vectors
    pairs = heads.select("dim", "tile", F.explode(F.sequence("tile", "last")).alias("tile_b"))
    other = packed.toDF("dim", "tile_b", "items_b", "weights_b", "body_b")
    met = pairs.repartition("dim", "tile", "tile_b").join(packed, ["dim", "tile"]).join(other, ["dim", "tile_b"])
    found = settle(met.repartition(F.xxhash64("dim", "tile", "tile_b")).mapInArrow(_tile_pass(similarity), "item long, links long, other long"))
    counts = found.where("other is null").groupBy("item").agg(F.sum("links").alias("links"))
    groups = components(found.where("other is not null").select(F.col("item").alias("a"), F.col("other").alias("b")))
    known = items.join(counts, "item", "left").join(groups, "item", "left").select("digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "item").alias("component_id"))
    out = rows.select("vec_id", "digest").join(known, "digest", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
