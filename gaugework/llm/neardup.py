"""Near-duplicate documents by ProbMinHash: weighted word shingles, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import id_bitmap, in_bitmap, packed, settle, unpacked
from gaugework.llm.linking import link, spanning
from gaugework.llm.words import mix, shingles, text_ranges, word_hashes

WIDTH = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 4
BLOCK = 512


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, texts: int, places: int) -> np.ndarray:
    """ProbMinHash signature of each text: the winning element of every place (0 where a text has no element).

    Each element's arrivals form a Poisson process whose rate is its weight; every arrival falls on a random
    place, and a place keeps the element that arrived first. The processes of all elements of a batch advance
    together, one arrival a round; an element stops as soon as its clock passes the latest arrival kept by its
    text, since none of its later arrivals can win. Two texts agree in a place with probability equal to their
    probability Jaccard similarity.
    """
    first = np.full(texts * places, np.inf)
    winner = np.zeros(texts * places, dtype=np.uint64)
    clock = np.zeros(len(owner))
    state = mix(elements + np.uint64(0x9E3779B97F4A7C15))
    rate = weights.astype(np.float64)
    while len(owner):
        state = mix(state + np.uint64(0xD1B54A32D192ED03))
        uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        clock = clock - np.log(uniform) / rate
        slot = owner * places + (mix(state ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(places)).astype(np.int64)
        np.minimum.at(first, slot, clock)
        won = clock == first[slot]
        winner[slot[won]] = elements[won]
        latest = first.reshape(texts, places).max(axis=1)
        going = clock < latest[owner]
        owner, elements, rate, clock, state = owner[going], elements[going], rate[going], clock[going], state[going]
    return winner.reshape(texts, places)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per text and band."""
    out = np.zeros((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, dtype=np.uint64)
        for r in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * rows + r])
        out[:, b] = key
    return out


def _band_pass(width: int, bands: int, rows: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for lo, hi, texts in text_ranges(part.column(1)):
                hashes, counts = word_hashes(texts)
                owner, shingle, weight = shingles(hashes, counts, width)
                keys = band_keys(signatures(owner, shingle, 1 + np.log2(weight), hi - lo, bands * rows), bands, rows)
                flat = pa.array(keys.view(np.int64).ravel())
                # Texts without a word carry no keys.
                lengths = np.where(counts > 0, bands, 0)
                flat = flat.filter(pa.array(np.repeat(counts > 0, bands)))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays([part.column(0).slice(lo, hi - lo), part.column(2).slice(lo, hi - lo), lists], ["doc_id", "digest", "keys"])

    return run


def _shingle_pass(width: int, bits: bytes):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bits, dtype=np.uint8)
        for part in parts:
            part = part.filter(pa.array(in_bitmap(wanted, part.column(0).to_numpy(zero_copy_only=False))))
            for lo, hi, texts in text_ranges(part.column(1)):
                owner, shingle, _ = shingles(*word_hashes(texts), width)
                ends = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(shingle.view(np.int64)))], ["item", "shingles"])

    return run


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(ends)[:-1])


def _compare_pass(similarity: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep = []
            for x, y in zip(_lists(part.column(2)), _lists(part.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and both >= similarity * (len(x) + len(y) - both))
            part = part.filter(pa.array(keep, type=pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"])

    return run


def similar_between(items: list[int], roots: list[int], blocks: list[int], sets: list[np.ndarray], similarity: float) -> tuple[list[int], list[int]]:
    """Spanning links between different roots of one tile: members of one block, or of two blocks against each other.

    Intersections of all pairs at once: shingles that two members share become columns of a 0/1 matrix,
    8,192 at a time, whose product with itself counts them exactly.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.float32)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = count[column] > 1
    row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for at in range(0, int((count > 1).sum()), 8192):
        here = (column >= at) & (column < at + 8192)
        matrix = np.zeros((len(sets), 8192), dtype=np.float32)
        matrix[row[here], column[here] - at] = 1
        both += matrix @ matrix.T
    close = (both > 0) & (both >= similarity * (sizes[:, None] + sizes[None, :] - both))
    root, block = np.array(roots), np.array(blocks)
    close &= root[:, None] != root[None, :]
    if block.min() != block.max():
        close &= block[:, None] != block[None, :]
    i, j = np.nonzero(np.triu(close, 1))
    a, b = np.array(items)[i], np.array(items)[j]
    keep = spanning(a.tolist(), b.tolist())
    return a[keep].tolist(), b[keep].tolist()


def _tile_pass(similarity: float):
    """Rows (bucket, p, q, block, item, root, shingles) sorted by tile; one tile is held at a time."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, ([], [], [], [])

        def links() -> pa.RecordBatch:
            a, b = similar_between(*held, similarity) if len(set(held[1])) > 1 else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], ["a", "b"])

        for part in parts:
            columns = [part.column(i).to_pylist() for i in range(6)]
            for *key, block, item, root, shingle in zip(*columns, _lists(part.column(6)), strict=True):
                if key != tile:
                    if len(held[0]) > 1:
                        yield links()
                    tile, held = key, ([], [], [], [])
                for kept, value in zip(held, (item, root, block, shingle), strict=True):
                    kept.append(value)
        if len(held[0]) > 1:
            yield links()

    return run


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Class of every row of ``docs`` (doc_id, text, any further columns): (doc_id, class_id, kept).

    Words are runs of characters other than ASCII white space; shingles are ``width`` words, weighted by
    1 + log2 of their count in the whole text. Texts are linked when they share a band of the ProbMinHash
    signature, which estimates the probability Jaccard similarity of the weights, and the exact Jaccard similarity of
    their shingle sets (the same measure where no shingle repeats) is at least ``similarity``; a class is a
    connected group of links, ``class_id`` its smallest doc_id, and ``kept`` marks that document. At the default
    24 bands of 4 rows a pair of similarity 0.8 misses every band with a probability of 3 in a million.
    Members of one bucket in different groups are compared in tiles of two blocks of at most about ``BLOCK``
    texts, which return spanning links only, so a large family of near copies never becomes a table of pairs.

    Equal texts form one class before anything else, so copies take part once. Texts of fewer words than
    ``width`` are one shingle; texts without a word are linked only with equal texts. NULL texts are linked
    with nothing. Rows with a NULL doc_id get the class of their text (NULL if no equal text has an id) and
    are not kept. Rows that share a doc_id are one document. An empty table gives no row.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("digest", F.when(F.col("text").isNotNull(), F.md5("text")))
    spark = docs.sparkSession
    rowset = ids.select("doc_id", "text", "digest")
    narrow = settle(rowset.mapInArrow(_band_pass(width, bands, rows), "doc_id long, digest string, keys array<long>"))
    texts = narrow.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("item"), F.min_by("keys", "doc_id").alias("keys"))
    texts = settle(texts)
    buckets = texts.where(F.col("item").isNotNull()).select(F.explode("keys").alias("bucket"), "item")

    def sets_of(items: DataFrame) -> DataFrame:
        named = rowset.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
        found = named.mapInArrow(_shingle_pass(width, id_bitmap(items, "item")), "item long, shingles array<long>")
        return found.join(items, "item", "left_semi")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = settle(pairs)
        sets = sets_of(pairs.select(F.col("a").alias("item")).union(pairs.select(F.col("b").alias("item"))).distinct())
        both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
        return both.mapInArrow(_compare_pass(similarity), "a long, b long").distinct()

    def between(members: DataFrame) -> DataFrame:
        # Bands of one group often hold the same members; such buckets are compared once.
        mixed = members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.xxhash64("item").cast("decimal(20,0)")).alias("mark"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
        once = mixed.groupBy("n", "mark").agg(F.min("bucket").alias("bucket"))
        rows = settle(members.join(once.select("bucket", "n"), "bucket"))
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        placed = rows.withColumn("block", F.pmod(F.xxhash64("item"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        tiles = placed.select("bucket", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "item", "root")
        filled = tiles.join(sets_of(rows.select("item").distinct()), "item").select("bucket", "p", "q", "block", "item", "root", "shingles")
        dealt = filled.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "item")
        return dealt.mapInArrow(_tile_pass(similarity), "a long, b long").distinct()

    groups = link(buckets, verify, between=between)
    classes = texts.join(groups, "item", "left").select("digest", F.coalesce("root", "item").alias("class_id"))
    # Rows that share a doc_id but not a text are one document: they take the smallest class of their texts.
    out = narrow.select("doc_id", "digest").join(classes, "digest", "left")
    return out.select("doc_id", F.when(F.col("digest").isNotNull(), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class of texts; columns and their order stay.

    Classes are those of the texts alone, so rows that share a doc_id but no text class all stay. The row with the
    smallest doc_id stays, one without an id only where its class has none; of exact repeats any one. A NULL text is
    never a duplicate.
    """
    mark = F.when(F.col("text").isNotNull(), F.xxhash64(F.col("text").cast("string")))
    texts = docs.where(F.col("text").isNotNull()).select(mark.alias("doc_id"), "text")
    classes = near_duplicates(texts, **options).select(F.col("doc_id").alias("_mark"), "class_id").distinct()
    pairs = settle(docs.select("doc_id", mark.alias("_mark")).where("_mark is not null").groupBy("_mark", "doc_id").agg(F.count("*").alias("n")))
    least = pairs.groupBy("_mark").agg(F.min("doc_id").alias("doc_id")).join(classes, "_mark")
    keep = settle(least.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_mark")).alias("keep")).select(F.col("keep._mark").alias("_kept"), F.col("keep.doc_id").alias("_id")))
    own = packed(docs, ["doc_id", "text"]).withColumn("_mark", mark)

    def same(left: DataFrame):
        return (left["_mark"] == keep["_kept"]) & left["doc_id"].eqNullSafe(keep["_id"])

    gone = pairs.join(keep, same(pairs), "left_anti").select(F.col("_mark").alias("_gone"), F.col("doc_id").alias("_id"))
    kept = own.join(gone, (own["_mark"] == gone["_gone"]) & own["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
    if not pairs.where("n > 1").join(keep, same(pairs), "left_semi").isEmpty():
        one = kept.where("_mark is not null").groupBy("_mark", "doc_id").agg(F.any_value(F.struct("text", "_rest")).alias("_row"))
        kept = one.select("doc_id", "_row.text", "_row._rest").unionByName(kept.where("_mark is null").drop("_mark"))
    return kept.select(*unpacked(docs.columns, ["doc_id", "text"]))
