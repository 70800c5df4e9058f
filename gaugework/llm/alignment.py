"""Cross-tokenizer alignment: token groups between common byte ends, pair counts in dense vectors behind minimal perfect hashes."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import scratch_folder, settle
from gaugework.llm.words import mix, text_ranges

#: Entries a worker remembers before it starts again; bounds its memory, not the result.
MEMORY = 400_000
#: Pairs whose hash, keys and counts are broadcast together (at most 13 bytes each); more pairs are looked up block by block.
BLOCK_PAIRS = 8 << 20
#: Pairs of one perfect hash, built by one task.
SHARD_PAIRS = 1 << 18
#: Entries of one slice of a count vector, and vectors that one task of the tree adds.
SLICE, FAN = 1 << 16, 16
#: Distinct pairs a task holds before it passes its counts on.
HELD_PAIRS = 1 << 22
#: Links written out at a time inside a group.
EXPANDED = 1 << 22
B_BITS = 15


class TwoTokenizers:
    """Both public vocabularies with the bytes of every token, and their ids for the pieces of a text.

    A text is cut before single spaces between two visible characters. Vocabulary A's published pattern starts a new
    pre-token at such a space, and no entry of vocabulary B holds a space mark behind another character (checked when the
    worker starts), so neither ever merges across a cut: the ids of a text are those of its pieces, each with a space before it.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in set(shown)]
        letters = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
        self.bytes_a: list[bytes] = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for entry, number in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[number] = bytes(letters[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(self.bytes_a) >= 1 << 31 - B_BITS or len(pieces) > 1 << B_BITS or any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("the vocabularies do not fit the pair keys, or pieces of B cross words")
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.cut = re.compile(r"(?<=[!-~À-ÿ]) (?=[!-~À-ÿ])").split
        self.uneven = re.compile(r" [^!-~À-ÿ]|[^!-~À-ÿ] ").search
        # Vocabulary A's pre-token pattern, its classes written out for ASCII and Latin-1 letters, for a piece without other white space than single line feeds inside.
        word = "A-Za-zÀ-ÖØ-öø-ÿ"
        self.pre_tokens = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\n| ?[{word}]+| ?[0-9]+| ?[^ \n{word}0-9]+").findall
        self.plain = re.compile(r"[!-~À-ÿ]+(?:\n[!-~À-ÿ]+)*").fullmatch
        back = {x: c for c, x in letters.items()}
        self.spelled = {c: "".join(back[x] for x in chr(c).encode()) for c in (0x20, 0x0A, *range(0xC0, 0x100))}
        # Two flat tables: tuples in one would be walked by every garbage collection.
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        #: Pieces whose tokens do not spell them; only a text with one of them can fail to spell its text.
        self.odd: set[str] = set()

    def learn(self, pieces: list[str]) -> None:
        merge, spelled = self.a.model.tokenize, self.spelled
        rare = [p for p in pieces if not self.plain(p)]
        ids = dict(zip(rare, (e.ids for e in self.a.encode_batch([f" {p}" for p in rare], add_special_tokens=False)), strict=True)) if rare else {}
        for piece, b in zip(pieces, self.b.encode(pieces, num_threads=1), strict=True):
            if piece in ids:
                a = ids[piece]
                whole = b" " + piece.encode("utf-8", "surrogatepass")
                if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
                    self.odd.add(piece)
            else:  # both vocabularies spell every character of a plain piece
                a = [t.id for part in self.pre_tokens(f" {piece}") for t in merge(part.translate(spelled))]
            self.known_a[piece], self.known_b[piece] = array("H", a).tobytes(), array("H", b).tobytes()

    def ids(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of A for space + text and of B for text, as 16-bit words; None where the tokens do not spell space + text."""
        cuts = [self.cut(t) if t[:1] == " " or t[-1:] == " " or self.uneven(t) else t.split(" ") for t in texts]
        if len(self.known_a) > MEMORY:
            self.known_a, self.known_b, self.odd = {}, {}, set()
        get_a, get_b = self.known_a.__getitem__, self.known_b.__getitem__
        distinct = set().union(*cuts)
        new = [p for p in distinct if p not in self.known_a]
        if new:
            self.learn(new)
        odd = self.odd & distinct
        out: list[tuple[bytes, bytes] | None] = []
        for text, pieces in zip(texts, cuts, strict=True):
            found = b"".join(map(get_a, pieces)), b"".join(map(get_b, pieces))
            out.append(found if not odd or odd.isdisjoint(pieces) or self.valid(text, *found) else None)
        return out

    def valid(self, text: str, a: bytes, b: bytes) -> bool:
        whole = b" " + text.encode("utf-8", "surrogatepass")
        return all(b"".join(map(table.__getitem__, np.frombuffer(ids, dtype=np.uint16).tolist())) == whole for ids, table in ((a, self.bytes_a), (b, self.bytes_b)))


_held: dict[tuple[str, str], TwoTokenizers] = {}


def worker(path_a: str, path_b: str) -> TwoTokenizers:
    if (path_a, path_b) not in _held:
        _held[path_a, path_b] = TwoTokenizers(path_a, path_b)
    return _held[path_a, path_b]


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Aligned:
    """Tokens of several documents laid end to end; groups are numbered through."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    #: Of each document: tokens of A, tokens of B, groups.
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray

    @property
    def document_of_group(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_groups)), self.n_groups)


def align(parts_a: list[bytes], parts_b: list[bytes], length_a: np.ndarray, length_b: np.ndarray) -> Aligned:
    """Groups between the byte offsets where tokens of both vocabularies end."""
    a, b = (np.frombuffer(b"".join(p), dtype=np.uint16).astype(np.int64) for p in (parts_a, parts_b))
    n_a, n_b = (np.array([len(x) // 2 for x in p], dtype=np.int64) for p in (parts_a, parts_b))
    end_a, end_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
    last = np.cumsum(n_a)
    upto = np.where(last > 0, group_a[np.maximum(last, 1) - 1] + 1, 0) if len(a) else np.zeros(len(n_a), dtype=np.int64)
    return Aligned(a, b, group_a, group_b, n_a, n_b, np.diff(upto, prepend=0))


def links(found: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, pair key, occurrences) of the linked id pairs, at most about ``EXPANDED`` a time; a pair may come again."""
    groups = int(found.n_groups.sum())
    p, q = np.bincount(found.group_a, minlength=groups), np.bincount(found.group_b, minlength=groups)
    start_a, start_b = np.cumsum(p) - p, np.cumsum(q) - q
    document = found.document_of_group
    size = p * q
    small = np.flatnonzero(size <= EXPANDED)
    upto = np.cumsum(size[small])
    at = 0
    while at < len(small):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + EXPANDED, side="right")))
        g = small[at:end]
        n = size[g]
        owner = np.repeat(np.arange(len(g)), n)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        wide = q[g][owner]
        a, b = found.a[start_a[g][owner] + place // wide], found.b[start_b[g][owner] + place % wide]
        yield document[g][owner], a << B_BITS | b, np.ones(len(owner), dtype=np.int64)
        at = end
    for g in np.flatnonzero(size > EXPANDED):  # distinct ids with their occurrences, a few of A at a time
        ids_a, times_a = np.unique(found.a[start_a[g] : start_a[g] + p[g]], return_counts=True)
        ids_b, times_b = np.unique(found.b[start_b[g] : start_b[g] + q[g]], return_counts=True)
        step = max(1, EXPANDED // len(ids_b))
        for i in range(0, len(ids_a), step):
            keys = (ids_a[i : i + step, None] << B_BITS | ids_b).ravel()
            yield np.full(len(keys), document[g]), keys, (times_a[i : i + step, None] * times_b).ravel()


def group_texts(found: Aligned) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every document."""
    groups = int(found.n_groups.sum())
    group = np.concatenate((found.group_a, found.group_b))
    side = np.concatenate((np.zeros(len(found.a), dtype=np.int8), np.ones(len(found.b), dtype=np.int8)))
    order = np.argsort(group * 2 + side, kind="stable")
    ids, group, side = np.concatenate((found.a, found.b))[order], group[order], side[order]
    last = np.ones(len(ids), dtype=bool)
    last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
    mark = np.where(~last, 0, 1 + side)
    words = _words()
    tokens = list(map(words.__getitem__, (ids * 3 + mark).tolist()))
    upto = np.cumsum(found.n_a + found.n_b).tolist()
    assert groups == int(last.sum()) // 2
    return [b"".join(tokens[s:e])[:-1] for s, e in zip([0, *upto[:-1]], upto, strict=True)]


_decimal: list[bytes] = []


def _words() -> list[bytes]:
    """Decimal ids of 16 bits with the mark behind them: comma, bar, semicolon."""
    if not _decimal:
        _decimal.extend(b"%d%c" % (i, m) for i in range(1 << 16) for m in b",|;")
    return _decimal


class PerfectHash:
    """Minimal perfect hash of distinct keys, by levels of bit fields.

    On a level every key left takes a slot; keys alone in theirs set its bit and are done, the others go on to the next.
    The number of set bits before a key's bit is its index, so n keys fill 0 to n - 1. ``keys`` verifies a look-up.
    """

    def __init__(self, keys: np.ndarray, room: float = 2.0):
        keys = np.unique(keys.astype(np.uint64))
        self.levels: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        left, total = keys, 0
        while len(left):
            size = max(64, int(len(left) * room))
            slot = self._slot(left, len(self.levels), size)
            bits = np.bincount(slot, minlength=size) == 1
            self.levels.append(bits)
            self.before.append(total + np.cumsum(bits) - bits)
            total += int(bits.sum())
            left = left[~bits[slot]]
        self.n = total
        self.keys = np.zeros(total, dtype=np.uint64)
        self.keys[self._place(keys)] = keys

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.levels, self.before, strict=True)):
            slot = self._slot(keys[open_], level, len(bits))
            hit = bits[slot]
            out[open_[hit]] = before[slot[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for one that is not of the set."""
        place = self._place(keys.astype(np.uint64))
        known = place >= 0
        known[known] = self.keys[place[known]] == keys[known].astype(np.uint64)
        return np.where(known, place, -1)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(shards)).astype(np.int64)


@dataclass
class Block:
    """Perfect hashes of some shards, one after the other, and a count vector over all of their keys."""

    shards: int
    first: int
    hashes: list[PerfectHash]
    starts: np.ndarray

    @classmethod
    def of(cls, shards: int, first: int, keys: list[np.ndarray]) -> Block:
        hashes = [PerfectHash(k) for k in keys]
        return cls(shards, first, hashes, np.cumsum([0] + [h.n for h in hashes]))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the block's vectors, -1 for keys of other blocks and unknown keys."""
        out = np.full(len(keys), -1, dtype=np.int64)
        shard = shard_of(keys, self.shards) - self.first
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(len(self.hashes) + 1))
        for i, one in enumerate(self.hashes):
            rows = order[bounds[i] : bounds[i + 1]]
            if len(rows):
                place = one.index(keys[rows])
                out[rows] = np.where(place >= 0, place + self.starts[i], -1)
        return out


def _batches(parts: Iterator[pa.RecordBatch], names: list[str], size: int) -> Iterator[tuple]:
    for part in parts:
        lengths = sum(pc.fill_null(pc.binary_length(part.column(n)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for n in names)
        at = 0
        upto = np.cumsum(lengths)
        while at < part.num_rows:
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, side="right")))
            yield part.slice(at, end - at)
            at = end


def token_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and the ids of both vocabularies (16-bit words) of every row; both empty where a text has no tokens."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = worker(path_a, path_b)
        for part in parts:
            for start, end, raw in text_ranges(part.column(1)):
                texts = [t.decode("utf-8", "surrogatepass") for t in raw]
                rows = [i for i, t in enumerate(texts) if t]
                a, b = [b""] * len(texts), [b""] * len(texts)
                for i, found in zip(rows, both.ids([texts[i] for i in rows]), strict=True):
                    if found is not None:
                        a[i], b[i] = found
                yield pa.RecordBatch.from_arrays([part.column(0).slice(start, end - start), pa.array(a, type=pa.binary()), pa.array(b, type=pa.binary())], ["doc_id", "a", "b"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, a binary, b binary")


def pair_counts(tokens: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """part, pair, n: documents of a task's share that hold a linked pair, counted before anything is shuffled."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both, number = worker(path_a, path_b), TaskContext.get().partitionId()
        keys, counts, loose, held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), [], 0

        def combined() -> tuple[np.ndarray, np.ndarray]:
            found, place = np.unique(np.concatenate([keys, *[k for k, _ in loose]]), return_inverse=True)
            return found, np.bincount(place, weights=np.concatenate([counts, *[c for _, c in loose]]), minlength=len(found)).astype(np.int64)

        def rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(keys), 1 << 16):
                k = keys[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), number, dtype=np.int32)), pa.array(k), pa.array(counts[i : i + (1 << 16)])], ["part", "pair", "n"])

        for part in _batches(parts, ["a", "b"], 1 << 20):
            found = align(part.column(1).to_pylist(), part.column(2).to_pylist(), both.length_a, both.length_b)
            held_pairs = [np.unique(document << 31 | pair) for document, pair, _ in links(found)]
            once = np.unique(np.concatenate(held_pairs)) if held_pairs else np.zeros(0, dtype=np.int64)
            loose.append(np.unique(once & ((1 << 31) - 1), return_counts=True))
            held += len(loose[-1][0])
            if held > HELD_PAIRS:
                keys, counts = combined()
                loose, held = [], 0
                if len(keys) > HELD_PAIRS:
                    yield from rows(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        keys, counts = combined()
        yield from rows(keys, counts)

    return tokens.mapInArrow(run, "part int, pair long, n long")


def hashed_shards(pairs: DataFrame, shards: int, first: int, last: int) -> list[np.ndarray]:
    """Distinct pairs of the shards first to last - 1, each gathered and deduplicated by one task."""

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys = part.column(0).to_numpy()
            shard = shard_of(keys, shards)
            rows = (shard >= first) & (shard < last)
            yield pa.RecordBatch.from_arrays([pa.array(shard[rows]), pa.array(keys[rows])], ["shard", "pair"])

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def one() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], type=pa.int64()), pa.array([np.concatenate(held).astype(np.uint32).tobytes()], type=pa.binary())], ["shard", "pairs"])

        for part in parts:
            shard, keys = part.column(0).to_numpy(), part.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for s, k in zip(shard[np.concatenate(([0], cuts))] if len(shard) else [], np.split(keys, cuts), strict=False):
                if now is not None and s != now:
                    yield one()
                    held = []
                now = int(s)
                held.append(k)
        if held:
            yield one()

    placed = pairs.mapInArrow(assign, "shard long, pair long").repartition("shard").sortWithinPartitions("shard", "pair")
    out = [np.zeros(0, dtype=np.int64)] * (last - first)
    for row in placed.mapInArrow(gather, "shard long, pairs binary").collect():  # at most BLOCK_PAIRS pairs of 4 bytes
        out[row["shard"] - first] = np.frombuffer(row["pairs"], dtype=np.uint32).astype(np.int64)
    return out


def tree_sum(vectors: DataFrame) -> DataFrame:
    """(slice, counts): dense vectors (part, slice, counts) added up, ``FAN`` parts to one at each step of the tree."""

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def one() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]], type=pa.int32()), pa.array([now[1]], type=pa.int32()), pa.array([total.tobytes()], type=pa.binary())], ["part", "slice", "counts"])

        for part in parts:
            for i in range(part.num_rows):
                key = (part.column(0)[i].as_py(), part.column(1)[i].as_py())
                counts = np.frombuffer(part.column(2)[i].as_py(), dtype=np.int64)
                if key != now:
                    if now is not None:
                        yield one()
                    now, total = key, np.zeros(len(counts), dtype=np.int64)
                total += counts
        if now is not None:
            yield one()

    parts = (vectors.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        parts = -(-parts // FAN)
        vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).repartition("part", "slice").sortWithinPartitions("part", "slice").mapInArrow(add, "part int, slice int, counts binary")
        if parts <= 1:
            return vectors.select("slice", "counts")
        vectors = settle(vectors)


def dense_vectors(counts: DataFrame, block) -> DataFrame:
    """(part, slice, counts) of the pair counts (part, pair, n): slices of a vector indexed by the block's perfect hash; slices of zeros stay out."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = block.value
        total, numbers = {}, 0
        for part in parts:
            at = known.index(part.column(1).to_numpy())
            rows = at >= 0
            at, n = at[rows], part.column(2).to_numpy()[rows]
            if part.num_rows:
                numbers = part.column(0)[0].as_py()
            for s in np.unique(at // SLICE).tolist():
                inside = at // SLICE == s
                if s not in total:
                    total[s] = np.zeros(SLICE, dtype=np.int64)
                np.add.at(total[s], at[inside] - s * SLICE, n[inside])
        for s, vector in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([numbers], type=pa.int32()), pa.array([s], type=pa.int32()), pa.array([vector.tobytes()], type=pa.binary())], ["part", "slice", "counts"])

    return counts.mapInArrow(run, "part int, slice int, counts binary")


def look_up(tokens: DataFrame, block, best, path_a: str, path_b: str, whole: bool) -> DataFrame:
    """The second pass: documents aligned again, each link's count read through the perfect hash.

    With ``whole`` all columns, else only what later blocks add to those of the first.
    """
    names = ["doc_id", "digest", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, (known, counts), highest = worker(path_a, path_b), block.value, best.value
        for part in _batches(parts, ["a", "b"], 1 << 20):
            a, b = part.column(1).to_pylist(), part.column(2).to_pylist()
            found = align(a, b, both.length_a, both.length_b)
            n_links, n_best, sums = (np.zeros(part.num_rows, dtype=np.int64) for _ in range(3))
            for document, pair, times in links(found):
                at = known.index(pair)
                n = np.where(at >= 0, counts[at], 0)
                np.add.at(n_links, document, times)
                np.add.at(sums, document, n * times)
                np.add.at(n_best, document, times * ((at >= 0) & (n == highest[pair >> B_BITS])))
            digests = [hashlib.sha256(x + b"/" + y).digest() for x, y in zip(a, b, strict=True)]
            texts = [hashlib.sha256(t).hexdigest() if n else "" for t, n in zip(group_texts(found), found.n_a.tolist(), strict=True)] if whole else [None] * part.num_rows
            columns = [part.column(0), pa.array(digests, type=pa.binary()), *[pa.array(x) for x in (found.n_a, found.n_b, found.n_groups, n_links, n_best, sums)], pa.array(texts, type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return tokens.mapInArrow(run, "doc_id long, digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align_documents(docs: DataFrame, paths: tuple[str, str] | None = None, block_pairs: int = BLOCK_PAIRS, shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs`` (doc_id, text).

    First pass: both token sequences of each text are written to the shared folder; every task aligns its documents and
    counts the documents of each linked id pair. The distinct pairs fall into shards by hash, each shard into a minimal
    perfect hash; the tasks' counts become dense vectors indexed by it and are added in a tree. Second pass: the documents
    are aligned again and every link reads its pair's count, verified by the key at its index. Hashes, keys and counts of at
    most ``block_pairs`` pairs are broadcast at a time (8 million: about 110 MB); where there are more, each block makes a
    pass over the distinct token sequences and adds its part. An id's highest count is one number per entry of vocabulary A.

    Edge cases: a NULL or empty text, and one whose joined token bytes differ from space + text (U+2581 in the text), has zeros
    and an empty ``groups_sha256``; repeated rows each count as a document; an empty table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    path_a, path_b = paths or default_paths()
    home = scratch_folder(spark, "tokens")
    token_table(docs, path_a, path_b).write.option("compression", "zstd").parquet(home)
    tokens = spark.read.parquet(home)
    counts = settle(pair_counts(tokens, path_a, path_b))
    pairs = settle(counts.select("pair").distinct())
    total = pairs.count()
    shards = max(1, -(-total // shard_pairs))
    step = max(1, block_pairs // shard_pairs)
    blocks, highest = [], np.zeros(1 << 16, dtype=np.int64)
    context = spark.sparkContext
    for first in range(0, shards, step):
        last = min(shards, first + step)
        known = Block.of(shards, first, hashed_shards(pairs, shards, first, last))
        vector = np.zeros(-(-max(1, int(known.starts[-1])) // SLICE) * SLICE, dtype=np.int64)
        shared = context.broadcast(known)
        for row in tree_sum(settle(dense_vectors(counts, shared))).collect():  # one vector of the block
            vector[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["counts"], dtype=np.int64)
        for one, start in zip(known.hashes, known.starts.tolist(), strict=False):
            np.maximum.at(highest, (one.keys >> np.uint64(B_BITS)).astype(np.int64), vector[start : start + one.n])
        blocks.append(context.broadcast((known, vector)))
    best = context.broadcast(highest)
    out = look_up(tokens, blocks[0], best, path_a, path_b, True)
    if len(blocks) > 1:
        texts = tokens.groupBy(F.sha2(F.concat("a", F.lit("/").cast("binary"), "b"), 256).alias("_text")).agg(F.first("a").alias("a"), F.first("b").alias("b"))
        texts = settle(texts.select(F.lit(0).cast("long").alias("doc_id"), "a", "b"))
        more = None
        for block in blocks[1:]:
            one = look_up(texts, block, best, path_a, path_b, False).select("digest", F.col("n_best").alias("_best"), F.col("count_sum").alias("_sum"))
            more = one if more is None else more.unionByName(one)
        added = settle(more.groupBy("digest").agg(F.sum("_best").alias("_best"), F.sum("_sum").alias("_sum")))
        out = out.join(added, "digest", "left").withColumn("n_best", F.col("n_best") + F.coalesce("_best", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("_sum", F.lit(0)))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
