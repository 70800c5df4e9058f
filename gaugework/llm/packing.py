"""Best-fit packing of token pieces into sequences, with certified bin counts and exchange between partitions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import settle
from gaugework.llm.tokens import LIMIT, Encoder, vocabulary_path, worker

END = 0
#: Pieces that one task packs at a time; fixes the memory of a task, never what is packed.
PART = 50_000
#: Texts that a Python task encodes at a time; bounds its memory, not the result.
TEXTS = 256
ROUNDS = 6


def token_pieces(docs: DataFrame, capacity: int = LIMIT, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): a document's ids and the end id, cut at ``capacity`` only if longer.

    NULL and empty texts are the end id alone; repeated rows give repeated pieces.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_piece_pass(path or vocabulary_path(), capacity, keep_ids), "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else ""))


def _piece_pass(path: str, capacity: int, keep_ids: bool):
    end = np.asarray([END], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker(path, Encoder)
        for part in (whole.slice(at, TEXTS) for whole in parts for at in range(0, whole.num_rows, TEXTS)):
            columns: list[list] = [[] for _ in names]
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                packed = encode(text or "") + end
                for piece, at in enumerate(range(0, len(packed), 4 * capacity)):
                    body = packed[at : at + 4 * capacity]
                    for column, value in zip(columns, (doc, piece, at // 4, len(body) // 4, zlib.crc32(body), body)):  # ids only if kept
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], names)

    return run


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that these lengths need at least: the best of the volume bound and two families of dual-feasible functions.

    A dual-feasible function f keeps every set of lengths that fits one sequence within one sequence, so the
    rounded-up sum of f over all lengths bounds every packing from below. Used are the rounding family
    u_k(x) = floor((k + 1) x) / k (x itself where (k + 1) x is whole) and the threshold family that counts
    lengths above capacity - t as whole, drops those below t and keeps the others.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    best = -(-int((counts * sizes).sum()) // capacity)
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    below_n = np.cumsum(counts)
    below_v = np.cumsum(counts * sizes)
    t = np.arange(1, capacity // 2 + 1)
    whole = below_n[capacity] - below_n[capacity - t]
    middle = below_v[capacity - t] - below_v[t - 1]
    return max(best, int((whole + -(-middle // capacity)).max()))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence of each length, place in it): longest first, each into the fullest open sequence that still holds it."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set when some open sequence has room r
    count = 0
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, count
            count += 1
        bins[i], offsets[i] = b, capacity - room
        if room > length:
            open_bins[room - length].append(b)
            rooms |= 1 << (room - length)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = LIMIT, part: int = PART, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (with length from 1 to ``capacity``) plus sequence_id, offset and certified.

    Pieces are dealt by hash to parts of about ``part`` and each part is packed best-fit decreasing. A part is
    certified when its sequences equal the dual-feasible lower bound of its lengths. Full sequences are final.
    As long as the sequences that are not full outnumber the bound of their volume, the pieces in them are
    exchanged: dealt anew to as few parts as hold them, packed and certified again. A round that saves no
    sequence is thrown away and ends the exchange, as do ``rounds`` rounds. No task ever holds more than one part.
    ``certified`` tells whether the part that made the sequence met its bound. Repeated rows are packed
    one by one; an empty table gives no row.
    """
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    schema += ", _row long, _part long, _bin long, offset long, _room long, certified boolean"

    def pack_part(frame: pa.Table) -> pa.Table:
        frame = frame.sort_by([("length", "descending"), ("_row", "ascending")])
        lengths = frame.column("length").to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        used = np.bincount(bins, weights=lengths).astype(np.int64)
        met = len(used) == lower_bound(lengths, capacity)
        for name, values in (("_bin", bins), ("offset", offsets), ("_room", capacity - used[bins]), ("certified", np.full(len(bins), met))):
            frame = frame.append_column(name, pa.array(values))
        return frame

    def packed(todo: DataFrame, turn: int) -> DataFrame:
        parts = max(1, -(-todo.count() // part))
        dealt = todo.withColumn("_part", F.pmod(F.xxhash64("_row", F.lit(turn)), F.lit(parts)).cast("long"))
        return settle(dealt.groupBy("_part").applyInArrow(pack_part, schema))

    def named(done: DataFrame, turn: int) -> DataFrame:
        number = F.shiftleft(F.lit(turn).cast("long"), 56).bitwiseOR(F.shiftleft("_part", 24)).bitwiseOR(F.col("_bin"))
        return done.select(*columns, number.alias("sequence_id"), "offset", "certified")

    def sequences(of: DataFrame) -> int:
        return of.agg(F.count_distinct("_part", "_bin")).first()[0]

    now, turn, final = packed(settle(pieces.withColumn("_row", F.monotonically_increasing_id())), 0), 0, []
    while turn < rounds:
        open_ = now.where("_room > 0")
        volume = open_.agg(F.sum("length")).first()[0] or 0
        held = sequences(open_)
        if held <= -(-volume // capacity):
            break
        again = packed(open_.select(*columns, "_row"), turn + 1)
        if sequences(again) >= held:
            break
        final.append(named(now.where("_room = 0"), turn))
        now, turn = again, turn + 1
    return reduce(DataFrame.unionByName, [*final, named(now, turn)])
