"""Ranked lexical search: an item's documents grouped by the mask of terms they hold, masks visited by descending bound."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.llm.common import settle
from gaugework.llm.words import text_ranges

TOP = 10
#: Terms of the items that are looked up in one pass over the documents; more items make more passes.
BLOCK_TERMS = 200_000
#: Documents whose bitmaps a task holds at a time.
CHUNK = 1 << 16
_LETTERS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_LETTERS).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the text), terms and tfs (of the vocabulary) for every document with a term; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for part in parts:
            for start, end, texts in text_ranges(part.column(1)):
                rows, lengths, terms, tfs, sizes = [], [], [], [], [0]
                for row, text in enumerate(texts, start):
                    words = terms_of(text)
                    if words:
                        found = Counter(map(number, words))
                        found.pop(None, None)
                        rows.append(row)
                        lengths.append(len(words))
                        terms.extend(found)
                        tfs.extend(found.values())
                        sizes.append(len(terms))
                at = pa.array(sizes, type=pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, type=pa.int64())), pa.array(lengths, type=pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, type=pa.int32())), pa.ListArray.from_arrays(at, pa.array(tfs, type=pa.int64()))],
                    ["doc_id", "n", "terms", "tfs"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Chunk:
    """Some documents with the postings of every term, and each term's share of each document's score."""

    def __init__(self, doc_ids: list, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, documents: int, total: int):
        self.doc_ids = doc_ids
        if len(n) and 90 * int(n.max()) * documents >= 1 << 63:  # beyond 64 bits numpy would wrap
            self.m = np.array([10 + 90 * int(x) * documents // total for x in n], dtype=np.int64)
        else:
            self.m = 10 + 90 * n * documents // total
        owner = np.repeat(np.arange(len(n)), sizes)
        order = np.argsort(terms, kind="stable")
        self.weights = weights
        self.starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.owner, self.tfs = owner[order], tfs[order]
        self.shares = weights[terms[order]] * share(self.tfs, self.m[self.owner])

    def postings(self, term: int) -> slice:
        return slice(int(self.starts[term]), int(self.starts[term + 1]))

    def key(self, row: int, score: int) -> tuple[int, bool, int]:
        found = self.doc_ids[row]
        return -score, found is None, found or 0


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The part of a term's weight that a document gets; it grows with tf and falls with the length in m."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def mask_groups(chunk: Chunk, places: list[slice]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents sorted by mask, start of each mask's documents, masks as a 0/1 matrix): bit j says that the document holds term j."""
    words = -(-len(places) // 64)
    masks = np.zeros((len(chunk.doc_ids), words), dtype=np.uint64)
    for j, place in enumerate(places):
        masks[chunk.owner[place], j >> 6] |= np.uint64(1 << (j & 63))
    some = np.flatnonzero(masks.any(axis=1))
    held = masks[some]
    order = np.lexsort(held.T)
    rows, held = some[order], held[order]
    starts = np.flatnonzero(np.concatenate(([True], (held[1:] != held[:-1]).any(axis=1)))) if len(rows) else np.zeros(0, dtype=np.int64)
    bits = np.unpackbits(held[starts].view(np.uint8).reshape(len(starts), words * 8), axis=1, bitorder="little")[:, : len(places)]
    return rows, starts, bits.astype(np.int64)


def best_documents(chunk: Chunk, terms: list[int], best: list[tuple[int, bool, int]], top: int) -> list[tuple[int, bool, int]]:
    """``best`` (sorted (-score, id is NULL, id), at most ``top``) joined by the documents of ``chunk`` that beat it.

    Documents are grouped by the mask of terms they hold, with one bit operation per term and posting list. The most a mask can
    score sums the largest share of each of its terms; masks are visited by descending maximum, some at a time, those of a
    visit are bounded again by the length of their own shortest document, and only then scored. The search ends once the next
    maximum is below the last score kept; at an equal one it goes on, for a smaller id may still win the tie.
    """
    places = [place for t in terms if (place := chunk.postings(t)).start < place.stop]
    if not places:
        return best
    rows, starts, bits = mask_groups(chunk, places)
    ends = np.append(starts[1:], len(rows))
    most = bits @ np.array([chunk.shares[p].max() for p in places], dtype=np.int64)
    most_tf = np.array([chunk.tfs[p].max() for p in places], dtype=np.int64)
    worth = np.array([chunk.weights[t] for t in terms if chunk.postings(t).start < chunk.postings(t).stop], dtype=np.int64)
    shortest = np.minimum.reduceat(chunk.m[rows], starts)
    order = np.argsort(-most, kind="stable")
    at, size = 0, 16
    scores = np.zeros(len(chunk.doc_ids), dtype=np.int64)
    while at < len(order):
        last = -best[-1][0] if len(best) == top else 1
        visit = order[at : at + size]
        visit = visit[most[visit] >= last]
        if not len(visit):
            break
        closer = (bits[visit] * worth * share(most_tf, shortest[visit, None])).sum(axis=1)
        chosen = visit[closer >= last]
        if len(chosen):
            members = np.concatenate([rows[a:b] for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist(), strict=True)])
            wanted = np.zeros(len(chunk.doc_ids), dtype=bool)
            wanted[members] = True
            scores[members] = 0
            for place in (places[j] for j in np.flatnonzero(bits[chosen].any(axis=0)).tolist()):
                holders = chunk.owner[place]
                here = wanted[holders]
                scores[holders[here]] += chunk.shares[place][here]
            found = scores[members]
            if len(members) > top:  # those at or above the last place among themselves, ties included
                least = np.partition(found, -top)[-top]
                members, found = members[found >= least], found[found >= least]
            keep = found >= last
            best = heapq.nsmallest(top, best + [chunk.key(r, s) for r, s in zip(members[keep].tolist(), found[keep].tolist(), strict=True) if s > 0])
        at += size
        size *= 2
    return best


def _ranked(found: DataFrame, items: list[tuple[int, list[int]]], weights: np.ndarray, documents: int, total: int, top: int) -> DataFrame:
    """item_no, doc_id, score: the best documents of each item within every task's share of the postings."""
    shared = found.sparkSession.sparkContext.broadcast((items, weights))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        best: dict[int, list] = {}

        def settle_chunk(held: list[pa.RecordBatch]) -> None:
            ids = [i for p in held for i in p.column(0).to_pylist()]
            n = np.concatenate([p.column(1).to_numpy() for p in held])
            sizes = np.concatenate([np.diff(p.column(2).offsets.to_numpy()) for p in held])
            terms = np.concatenate([p.column(2).flatten().to_numpy() for p in held])
            tfs = np.concatenate([p.column(3).flatten().to_numpy() for p in held])
            chunk = Chunk(ids, n, sizes, terms, tfs, weights, documents, total)
            for item, words in items:
                best[item] = best_documents(chunk, words, best.get(item, []), top)

        held, rows = [], 0
        for part in parts:
            for start in range(0, part.num_rows, CHUNK):
                piece = part.slice(start, CHUNK)
                if rows + piece.num_rows > CHUNK:
                    settle_chunk(held)
                    held, rows = [], 0
                held.append(piece)
                rows += piece.num_rows
        if held:
            settle_chunk(held)
        out = [(item, None if none else doc, -score) for item, rows in best.items() for score, none, doc in rows]
        kinds = (pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], type=k) for i, k in enumerate(kinds)], ["item_no", "doc_id", "score"])

    return found.mapInArrow(run, "item_no long, doc_id long, score long")


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Items (number, id, terms) in blocks of at most ``most`` terms; the driver holds one block and the rows of one partition."""
    held, size = [], 0
    for number, row in enumerate(items.select(F.col("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator()):
        words = list(dict.fromkeys(terms_of((row["text"] or "").encode("utf-8", "surrogatepass"))))
        if held and size + len(words) > most:
            yield held
            held, size = [], 0
        if words:
            held.append((number, row["item_id"], words))
            size += len(words)
    if held:
        yield held


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every item, by score and then by smaller doc_id.

    ``docs`` (doc_id, text), ``items`` (item_id, text). All documents count in N, L and df. The items are a query set, taken in
    blocks of at most ``block_terms`` terms (an item with more is a block of its own); only their terms and document
    frequencies pass the driver. Each block reads the documents once, keeps the counts of its terms in the shared
    checkpoint folder, and every task searches its documents with ``best_documents``; ``top`` rows an item and task meet in the end.

    Edge cases: a NULL or empty text has no term and never ranks, nor is it counted; an item without a term, or whose terms no
    document weighs, has no row; items that share an id are ranked one by one; repeated documents each rank; a NULL doc_id
    ranks after others of its score; empty tables give no row; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    parts = []
    for block in _blocks(items, block_terms):
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for _, _, words in block for w in words))}
        found = settle(postings(docs, vocabulary))
        counts = found.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not counts["docs"]:
            break
        weights = np.full(len(vocabulary), weight(counts["docs"], 0), dtype=np.int64)
        for row in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most the block's terms
            weights[row["t"]] = weight(counts["docs"], row["count"])
        asked = [(number, [vocabulary[w] for w in words]) for number, _, words in block]
        names = spark.createDataFrame([(number, item) for number, item, _ in block], T.StructType([T.StructField("item_no", T.LongType()), T.StructField("item_id", kind)]))
        local = _ranked(found, asked, weights, counts["docs"], counts["terms"], top)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        # First within salts, so that no task sees an item's rows from all tasks.
        salted = local.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(64)))
        near = salted.withColumn("_r", F.row_number().over(Window.partitionBy("item_no", "_salt").orderBy(*order))).where(F.col("_r") <= top)
        last = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_no").orderBy(*order))).where(F.col("rank") <= top)
        parts.append(settle(last.join(names, "item_no").select("item_id", "rank", "doc_id", "score")))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
