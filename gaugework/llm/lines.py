"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity, one occurrence per connected group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import id_bitmap, in_bitmap, packed, settle, unpacked
from gaugework.llm.linking import components, merged
from gaugework.llm.words import mix, text_ranges, word_hashes

SIMILARITY = 0.8
#: 64-bit words of a SimHash, and its blocks: block j starts at bit 16 * j and is as wide as its kind says, so neighbours may overlap.
WORDS64, BLOCKS = 4, 16
#: Lines of at least FROM words are hashed by their words, lines of at most UPTO words by their character pairs, those between by both.
FROM, UPTO = 11, 14
WORD_BLOCK, PAIR_BLOCK = 20, 16
#: Bits of the first 128 in which a candidate pair may differ. Lines whose features have a cosine of 0.7 or more differ in about 32, give or take 5; unrelated ones in about 64.
FAR = 40
#: Of the 64 bits that travel with a block, and that it has no part in.
FAR_64 = 20
#: Bytes of a word that tells lines apart.
TELLING = 5
#: Features that are counted in bit planes; longer lines are counted one by one.
PLANES = 255
#: Rows of a bucket that are compared each with each at once.
SMALL = 64
#: Lines whose bucket rows are packed at once, bucket rows of a part on average, and those that are held before large buckets are relieved.
SLICE, PART, HELD = 1 << 14, 1 << 19, 1 << 22
#: Pairs whose edit distances are worked out at once, and characters of the shorter line up to which they are.
BATCH, SHORT = 4096, 256
#: Lines of one side of a tile.
TILE = 256
_PLAIN = bytes(0x0A if b == 0x0A else 0x30 if 0x30 <= b <= 0x39 else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_SEEDS = mix(np.arange(1, WORDS64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def normalised(text: bytes) -> bytes:
    """Lower case, digits as 0, other ASCII punctuation and blanks as spaces; line feeds stay."""
    return text.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass").translate(_PLAIN)


def line_keys(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit key of each line from its words and their order, as two 64-bit halves; lines all have a word."""
    starts = np.cumsum(counts) - counts
    place = (np.arange(len(hashes)) - np.repeat(starts, counts)).astype(np.uint64)
    return tuple(mix(np.add.reduceat(mix(hashes ^ (place * np.uint64(odd) + np.uint64(more))), starts)) for odd, more in ((0x9E3779B97F4A7C15, 0), (0xD1B54A32D192ED03, 0x5851F42D4C957F2D)))


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """SimHash of each line, ``WORDS64`` words of 64 bits: every bit is the majority of that bit over the line's feature hashes.

    Counters of all lines and bits advance together, one feature a round: plane k of a counter holds bit k of the count, and adding
    a feature is a carry through the planes. Lines are ordered by their number of features, so a round touches only those not done.
    """
    out = np.zeros((len(counts), WORDS64), dtype=np.uint64)
    starts = np.cumsum(counts) - counts
    for i in np.flatnonzero(counts > PLANES).tolist():
        mine = hashes[starts[i] : starts[i] + counts[i]]
        for w in range(WORDS64):
            votes = sum(np.unpackbits(mix(mine[a : a + (1 << 14)] ^ _SEEDS[w]).view(np.uint8)).reshape(-1, 64).sum(axis=0) for a in range(0, len(mine), 1 << 14))
            out[i, w] = np.packbits(votes > counts[i] // 2).view(np.uint64)[0]
    some = np.flatnonzero(counts <= PLANES)
    order = some[np.argsort(-counts[some], kind="stable")]
    sizes, starts = counts[order], starts[order]
    planes: list[np.ndarray] = []
    for step in range(int(sizes[0]) if len(sizes) else 0):
        active = int(np.searchsorted(-sizes, -step, side="left"))
        carry = mix(hashes[starts[:active] + step][:, None] ^ _SEEDS)
        for k in range(64):
            if k == len(planes):
                planes.append(np.zeros((len(order), WORDS64), dtype=np.uint64))
            plane = planes[k][:active]
            carry, planes[k][:active] = plane & carry, plane ^ carry
            if not carry.any():
                break
    above, equal = np.zeros((len(order), WORDS64), dtype=np.uint64), np.full((len(order), WORDS64), ~np.uint64(0))
    half = (sizes // 2).astype(np.uint64)
    for k in range(len(planes) - 1, -1, -1):
        bit = (np.uint64(0) - (half >> np.uint64(k) & np.uint64(1)))[:, None]
        above |= equal & planes[k] & ~bit
        equal &= ~(planes[k] ^ bit)
    out[order] = above
    return out


def pair_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the pairs of neighbouring bytes of each line between two blanks, told apart by the number of the word they are in.

    The number keeps lines of one language apart, which share most of their pairs.
    """
    joined = np.frombuffer(b"".join(b" " + line + b" " for line in lines), dtype=np.uint8).astype(np.uint64)
    lengths = np.array([len(line) + 2 for line in lines], dtype=np.int64)
    owner = np.repeat(np.arange(len(lines)), lengths)
    blanks = np.cumsum(joined == 0x20)
    word = (blanks - blanks[np.cumsum(lengths) - lengths][owner]).astype(np.uint64)
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    return mix(word[inside] << np.uint64(16) | joined[inside] << np.uint64(8) | joined[inside + 1]), lengths - 1


def sim_hashes(lines: list[bytes], hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(words, pairs) SimHashes of normalised lines that all have a word: 2 * WORDS64 columns, zeros for a kind that the line has not.

    Short words stand in every line of a language, so only those of ``TELLING`` bytes count where a line has six of them.
    """
    out = np.zeros((len(lines), 2 * WORDS64), dtype=np.uint64)
    long = np.flatnonzero(counts >= FROM)
    if len(long):
        blanks = np.flatnonzero(np.frombuffer(b" ".join(lines) + b" ", dtype=np.uint8) == 0x20)
        owner = np.repeat(np.arange(len(lines)), counts)
        telling = np.diff(blanks, prepend=-1) > TELLING
        few = np.bincount(owner[telling], minlength=len(lines)) < 6
        picked = (telling | few[owner]) & (counts >= FROM)[owner]
        out[long, :WORDS64] = majority(hashes[picked], np.bincount(owner[picked], minlength=len(lines))[long])
    short = np.flatnonzero(counts <= UPTO)
    if len(short):
        out[short, WORDS64:] = majority(*pair_features([lines[i] for i in short.tolist()]))
    return out


def _places(counts: list[int]) -> np.ndarray:
    """0, 1, ... inside each run of the given lengths."""
    n = np.array(counts, dtype=np.int64)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


_SIMS = [f"s{i}" for i in range(2 * WORDS64)]


def _line_pass(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and key of every line with a word; length, words and SimHashes where the key comes first in a range of texts, else NULL."""
    for part in parts:
        for lo, hi, texts in text_ranges(part.column(2), 1 << 21):
            split = [normalised(t).split(b"\n") for t in texts]
            flat = [line for s in split for line in s]
            hashes, words = word_hashes(flat)
            keep = np.flatnonzero(words > 0)
            counts = words[keep]
            owner = pa.array(np.repeat(np.arange(lo, hi), [len(s) for s in split])[keep])
            columns = [part.column(0).take(owner), part.column(1).take(owner), pa.array(_places([len(s) for s in split])[keep].astype(np.int32))]
            if not len(keep):
                continue
            k1, k2 = line_keys(hashes, counts)
            first = np.sort(np.unique(k1, return_index=True)[1])
            starts = np.cumsum(counts) - counts
            tidy = [b" ".join(flat[i].split()) for i in keep[first].tolist()]
            some = np.concatenate([hashes[a : a + n] for a, n in zip(starts[first].tolist(), counts[first].tolist(), strict=True)])
            sims = sim_hashes(tidy, some, counts[first])
            told = np.ones(len(keep), dtype=bool)
            told[first] = False

            def spread(values: np.ndarray, kind: pa.DataType, told=told, first=first) -> pa.Array:
                whole = np.zeros(len(told), dtype=values.dtype)
                whole[first] = values
                return pa.array(whole, type=kind, mask=told)

            lengths = np.array([len(t.decode("utf-8", "replace")) for t in tidy], dtype=np.int32)
            columns += [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), spread(lengths, pa.int32()), spread(counts[first].astype(np.int32), pa.int32())]
            columns += [spread(sims[:, i].view(np.int64), pa.int64()) for i in range(2 * WORDS64)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "line_no", "k1", "k2", "length", "words", *_SIMS])


def bucket_rows(sims: np.ndarray, lengths: np.ndarray, words: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row, mark) of the pigeonhole keys of lines: kind, block, the block's bits and a class of the length; the mark is 64 bits of the SimHash that the block has no part in.

    Classes are as wide as two steps of ``similarity`` and shifted from block to block, so lines of similar length share most of them.
    Keys are mixed, not hashed, so two of them never meet by chance. Rows of a bucket come in their order.
    """
    span = np.log(np.maximum(lengths, 1)) / (-2 * np.log(similarity)) if 0 < similarity < 1 else lengths.astype(np.float64)
    out = []
    for kind, width, has in ((0, WORD_BLOCK, words >= FROM), (1, PAIR_BLOCK, words <= UPTO)):
        rows = np.flatnonzero(has)
        mine = sims[rows, kind * WORDS64 : (kind + 1) * WORDS64]
        for j in range(BLOCKS):
            shift = 16 * (j % 4)
            bits = mine[:, j // 4] >> np.uint64(shift)
            if shift + width > 64:
                bits = bits | mine[:, (j // 4 + 1) % WORDS64] << np.uint64(64 - shift)
            size = np.floor(span[rows] + j / BLOCKS).astype(np.uint64)
            key = (size << np.uint64(5) | np.uint64(kind * BLOCKS + j)) << np.uint64(width) | bits & np.uint64((1 << width) - 1)
            out.append((mix(key * np.uint64(2) + np.uint64(kind)), rows, mine[:, (j // 4 + 2) % WORDS64]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _deal_pass(similarity: float, n: int):
    """The bucket rows of each ``SLICE`` of lines, dealt to ``n`` ranges of buckets: one row of packed arrays a slice and range, so few rows are shuffled."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, SLICE):
                items, lengths, words, *sims = (c.slice(at, SLICE).to_numpy() for c in part.columns)
                bucket, row, mark = bucket_rows(np.stack([s.view(np.uint64) for s in sims], axis=1), lengths, words, similarity)
                place = (bucket >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)
                order = np.argsort(place.astype(np.uint16) if n < 1 << 16 else place, kind="stable")
                ends = np.searchsorted(place[order], np.arange(n, dtype=np.uint64), side="right")
                bucket, mark, offset = bucket[order], mark[order], (items[row[order]] - items[0]).astype(np.int64)
                spans = [(i, slice(a, b)) for i, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)) if a < b]
                columns = [pa.array([i for i, _ in spans], type=pa.int32()), pa.array([int(items[0])] * len(spans), type=pa.int64())]
                columns += [pa.array([c[s].tobytes() for _, s in spans], type=pa.binary()) for c in (bucket, offset.astype(np.uint32), mark)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "lo", "buckets", "offsets", "marks"])

    return run


class _Meeting:
    """Members of one bucket as they come: each joins the first leader whose mark is near, or leads on its own.

    Nothing leaves before two members are near; until then every member is a leader, so all pairs have been compared and only their
    marks are held. From then on all members leave, each with its leader.
    """

    def __init__(self, bucket: int):
        self.bucket, self.near = bucket, False
        self.items, self.marks = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)

    def add(self, items: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hubs, items) that leave now."""
        hubs = np.full(len(items), -1, dtype=np.int64)
        known, new = len(self.items), []
        for at in range(0, len(items), 4096):
            part = slice(at, at + 4096)
            for leader, mark in zip(self.items.tolist(), self.marks, strict=True):
                if not (open_ := np.flatnonzero(hubs[part] < 0)).size:
                    break
                hit = open_[np.bitwise_count(marks[part][open_] ^ mark) <= FAR_64]
                hubs[at + hit] = leader
            for i in np.flatnonzero(hubs[part] < 0).tolist():
                i += at
                if hubs[i] >= 0:
                    continue
                rest = i + 1 + np.flatnonzero(hubs[i + 1 : at + 4096] < 0)
                hubs[rest[np.bitwise_count(marks[rest] ^ marks[i]) <= FAR_64]] = items[i]
                hubs[i] = items[i]
                new.append(i)
            self.items, self.marks = np.append(self.items, items[new]), np.append(self.marks, marks[new])
            new = []
        if not self.near and len(self.items) - known < len(items):
            self.near = True
            return np.concatenate((self.items[:known], hubs)), np.concatenate((self.items[:known], items))
        return (hubs, items) if self.near else (hubs[:0], items[:0])


def met_in_small(b: np.ndarray, i: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, hub, item) of the members with a near one in their bucket; the hub is the first near one, or the member itself.

    Rows are sorted by bucket. All buckets are compared at once, rows one apart first, then two and so on to the longest bucket.
    """
    first = np.full(len(b), -1, dtype=np.int64)
    step, alike = 1, np.flatnonzero(b[1:] == b[:-1])
    while len(alike):
        near = alike[np.bitwise_count(m[alike] ^ m[alike + step]) <= FAR_64]
        # Steps grow, so a later step finds an earlier partner.
        first[near + step] = near
        first[near] = np.where(first[near] < 0, near, first[near])
        step += 1
        alike = alike[alike + step < len(b)]
        alike = alike[b[alike] == b[alike + step]]
    rows = np.flatnonzero(first >= 0)
    return b[rows], i[first[rows]], i[rows]


def _meet_pass(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, hub, item) of members near to another of their bucket, from rows (bucket, item, mark) sorted by bucket and item.

    The last bucket of a batch waits for the next; one of more than ``SMALL`` rows goes on as a ``_Meeting``.
    """
    names = ["bucket", "hub", "item"]
    wait = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))
    large: _Meeting | None = None

    def batch(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    for part in parts:
        b, i, m = part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2).to_numpy().view(np.uint64)
        if large is not None:
            same = int(np.searchsorted(b, large.bucket, side="right"))
            hubs, items = large.add(i[:same], m[:same])
            yield batch(np.full(len(items), large.bucket), hubs, items)
            b, i, m = b[same:], i[same:], m[same:]
            large = large if not len(b) else None
        if not len(b):
            continue
        b, i, m = (np.concatenate(c) for c in zip(wait, (b, i, m), strict=True))
        heads = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        ends = np.append(heads[1:], len(b))
        small = np.repeat(ends - heads <= SMALL, ends - heads)
        small[heads[-1] :] = False
        yield batch(*met_in_small(b[small], i[small], m[small]))
        for start, end in ((heads[k], ends[k]) for k in np.flatnonzero(ends - heads > SMALL).tolist()):
            large = _Meeting(int(b[start]))
            hubs, items = large.add(i[start:end], m[start:end])
            yield batch(np.full(len(items), b[start]), hubs, items)
        last = slice(int(heads[-1]), None)
        large, wait = (large, tuple(c[:0] for c in (b, i, m))) if ends[-1] - heads[-1] > SMALL else (None, (b[last], i[last], m[last]))
    yield batch(*met_in_small(*wait))


def _gather_pass(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_meet_pass`` finds in the rows of ``_deal_pass``, sorted by part and lo.

    The rows of one part are held, sorted and compared at once. Beyond ``HELD`` rows, which only buckets with very many members
    cause, those members go on as a ``_Meeting`` and are held no longer.
    """
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size, most, now = 0, HELD, None
    large: dict[int, _Meeting] = {}

    def batch(bucket: np.ndarray | int, hubs: np.ndarray, items: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (np.full(len(items), bucket, dtype=np.int64) if np.isscalar(bucket) else bucket, hubs, items)], ["bucket", "hub", "item"])

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bucket, item, mark = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(bucket, kind="stable")
        return bucket[order], item[order], mark[order]

    def relieved() -> Iterator[pa.RecordBatch]:
        nonlocal size, most
        bucket, item, mark = joined()
        heads = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        ends = np.append(heads[1:], len(bucket))
        stay = np.ones(len(bucket), dtype=bool)
        for start, end in zip(heads.tolist(), ends.tolist(), strict=True):
            key = int(bucket[start])
            if end - start > SMALL or key in large:
                stay[start:end] = False
                yield batch(key, *large.setdefault(key, _Meeting(key)).add(item[start:end], mark[start:end]))
        held[:] = [(bucket[stay], item[stay], mark[stay])]
        size = int(stay.sum())
        most = max(HELD, 2 * size)

    def finished() -> Iterator[pa.RecordBatch]:
        nonlocal size, most
        if large:
            yield from relieved()
        bucket, item, mark = joined()
        yield from _meet_pass(iter([pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(item), pa.array(mark.view(np.int64))], ["bucket", "item", "mark"])]))
        held.clear()
        large.clear()
        size, most = 0, HELD

    for rows in parts:
        for part, lo, *packs in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if part != now and held:
                yield from finished()
            now = part
            bucket, offset, mark = (np.frombuffer(p, dtype=k) for p, k in zip(packs, (np.int64, np.uint32, np.uint64), strict=True))
            held.append((bucket, offset.astype(np.int64) + lo, mark))
            size += len(bucket)
            if size > most:
                yield from relieved()
    if held:
        yield from finished()


def _text_pass(row_bits: bytes, line_bits: bytes):
    """Normalised lines whose row and place may be wanted; only those are normalised."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, places = np.frombuffer(row_bits, dtype=np.uint8), np.frombuffer(line_bits, dtype=np.uint8)
        for part in parts:
            part = part.filter(pa.array(in_bitmap(wanted, part.column(1).to_numpy(zero_copy_only=False))))
            marks = part.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, texts in text_ranges(part.column(2)):
                split = [t.split(b"\n") for t in texts]
                counts = [len(s) for s in split]
                owner, place = np.repeat(np.arange(lo, hi), counts), _places(counts)
                found = np.flatnonzero(in_bitmap(places, (marks[owner] << 20) ^ place))
                bodies = [b" ".join(normalised(split[owner[i] - lo][place[i]]).split()).decode("utf-8", "replace") for i in found]
                at = pa.array(owner[found])
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(place[found].astype(np.int32)), pa.array(bodies, type=pa.string())], ["id", "mark", "line_no", "line"])

    return run


def common_ends(a: str, b: str) -> tuple[int, int]:
    """Lengths of the common start and of the common end of what is left, by bisection."""
    def shared(same) -> int:
        low, high = 0, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if same(middle) else (low, middle - 1)
        return low

    start = shared(lambda n: a[:n] == b[:n])
    room = min(len(a), len(b)) - start
    end = min(room, shared(lambda n: a[len(a) - n :] == b[len(b) - n :]))
    return start, end


def edits_at_most(a: str, b: str) -> int:
    """A quick upper bound of the edit distance: the cost of one walk over both lines that replaces, drops or adds whole words."""
    left, right = a.split(" "), b.split(" ")
    i = j = cost = 0
    while i < len(left) and j < len(right):
        if left[i] == right[j]:
            i, j = i + 1, j + 1
            continue
        x, y = left[i + 1 : i + 2], right[j + 1 : j + 2]
        if x != y and x == right[j : j + 1]:
            cost, i = cost + len(left[i]) + 1, i + 1
        elif x != y and y == left[i : i + 1]:
            cost, j = cost + len(right[j]) + 1, j + 1
        else:
            cost, i, j = cost + max(len(left[i]), len(right[j])), i + 1, j + 1
    return cost + sum(len(w) + 1 for w in left[i:] + right[j:])


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance, or some number above ``most``: a column of the table is two bit strings (Myers, 1999), one step a character."""
    if len(a) > len(b):
        a, b = b, a
    if not a or len(b) - len(a) > most:
        return len(b) - len(a) if a else len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    whole, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, cost = whole, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b, strict=True):
        same = where.get(c, 0)
        across = ((same & up) + up ^ up) | same
        rise, fall = down | whole & ~(across | up), up & across
        cost += (rise & top > 0) - (fall & top > 0)
        if cost - left > most:
            return cost - left
        rise = rise << 1 | 1
        keep = same | down
        up, down = (fall << 1 | ~(keep | rise)) & whole, rise & keep & whole
    return cost


def similar(a: str, b: str, similarity: float) -> bool:
    """Whether 1 - edit distance / longer length is at least ``similarity``: cheap bounds first, then the distance of what differs."""
    most = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    if edits_at_most(a, b) <= most:
        return True
    start, end = common_ends(a, b)
    return edit_distance(a[start : len(a) - end], b[start : len(b) - end], most) <= most


def edit_distances(left: list[str], right: list[str]) -> np.ndarray:
    """Edit distances of pairs of lines, ``left`` of 1 to any number of characters: Myers' columns of all pairs advance together, in blocks of 64 bits."""
    out = np.zeros(len(left), dtype=np.int64)
    sizes, texts = (np.array([len(x) for x in side], dtype=np.int64) for side in (left, right))
    blocks = (sizes + 63) // 64
    codes = np.unique(np.frombuffer("".join(left + right).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), return_inverse=True)
    ids, kinds = codes[1].astype(np.int32), len(codes[0])
    starts = np.cumsum(np.concatenate((sizes, texts))) - np.concatenate((sizes, texts))
    one, top = np.uint64(1), np.uint64(63)
    for w in np.unique(blocks).tolist():
        group = np.flatnonzero(blocks == w)
        group = group[np.argsort(-texts[group], kind="stable")]
        most = max(1, (1 << 22) // (kinds * w))
        for rows in (group[i : i + most] for i in range(0, len(group), most)):
            m, n = sizes[rows], texts[rows]
            owner, place = np.repeat(np.arange(len(rows)), m), _places(m.tolist())
            same = np.zeros((len(rows), kinds, w), dtype=np.uint64)
            np.bitwise_or.at(same, (owner, ids[np.repeat(starts[rows], m) + place], place >> 6), one << (place & 63).astype(np.uint64))
            up, down, cost = np.full((w, len(rows)), ~np.uint64(0)), np.zeros((w, len(rows)), dtype=np.uint64), m.copy()
            last = ((m - 1) & 63).astype(np.uint64)
            for step in range(int(n[0]) if len(n) else 0):
                k = int(np.searchsorted(-n, -step, side="left"))
                found = same[np.arange(k), ids[starts[len(left) + rows[:k]] + step]]
                plus, minus = np.ones(k, dtype=np.uint64), np.zeros(k, dtype=np.uint64)
                for b in range(w):
                    eq, vp, vn = found[:, b], up[b, :k], down[b, :k]
                    xv = eq | vn
                    eq = eq | minus
                    xh = (((eq & vp) + vp) ^ vp) | eq
                    rise, fall = vn | ~(xh | vp), vp & xh
                    if b == w - 1:
                        cost[:k] += (rise >> last[:k] & one).astype(np.int64) - (fall >> last[:k] & one).astype(np.int64)
                    more, less = rise >> top, fall >> top
                    rise, fall = rise << one | plus, fall << one | minus
                    up[b, :k], down[b, :k] = fall | ~(xv | rise), rise & xv
                    plus, minus = more, less
            out[rows] = cost
    return out


def similar_short(left: list[str], right: list[str], similarity: float) -> np.ndarray:
    """1 or 0 for pairs as ``similar`` says, for all of them at once; -1 where the shorter line is empty or has more than ``SHORT`` characters."""
    out = np.full(len(left), -1, dtype=np.int8)
    sizes = np.array([(len(x), len(y)) for x, y in zip(left, right, strict=True)], dtype=np.int64).reshape(-1, 2)
    low, high = sizes.min(axis=1), sizes.max(axis=1)
    most = ((1 - similarity) * high + 1e-9).astype(np.int64)
    out[high - low > most] = 0
    some = np.flatnonzero((out < 0) & (low > 0) & (low <= SHORT))
    if len(some):
        a, b = zip(*(sorted((left[i], right[i]), key=len) for i in some.tolist()), strict=True)
        out[some] = edit_distances(list(a), list(b)) <= most[some]
    return out


def _similar_pass(similarity: float):
    """The similar pairs (a, b) of rows (a, b, la, lb). Spark's own levenshtein walks a band of cells one by one, which costs several times more on long lines."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, BATCH):
                rows = part.slice(at, BATCH)
                left, right = rows.column(2).to_pylist(), rows.column(3).to_pylist()
                same = [known > 0 or known < 0 and similar(x, y, similarity) for known, x, y in zip(similar_short(left, right, similarity).tolist(), left, right, strict=True)]
                yield rows.select(["a", "b"]).filter(pa.array(same, type=pa.bool_()))

    return run


_MARKS = [_SIMS[k * WORDS64 + w] for k in (0, 1) for w in (0, 1)]


def close_pairs(roots: np.ndarray, blocks: np.ndarray, lengths: np.ndarray, words: np.ndarray, marks: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of one tile in different groups, and different blocks if it has two, whose lengths and marks are near."""
    close = np.abs(lengths[:, None] - lengths[None, :]) <= np.maximum(lengths[:, None], lengths[None, :]) * (1 - similarity) + 1e-9
    close &= roots[:, None] != roots[None, :]
    if blocks.min() != blocks.max():
        close &= blocks[:, None] != blocks[None, :]
    near = np.zeros_like(close)
    for kind, has in ((0, words >= FROM), (1, words <= UPTO)):
        apart = np.bitwise_count(marks[:, None, 2 * kind : 2 * kind + 2] ^ marks[None, :, 2 * kind : 2 * kind + 2]).sum(axis=2, dtype=np.int64)
        near |= (apart <= FAR) & has[:, None] & has[None, :]
    return np.nonzero(np.triu(close & near, 1))


def links_between(items: list[int], roots: list[int], pairs: tuple[np.ndarray, np.ndarray], lines: list[str], similarity: float) -> tuple[list[int], list[int]]:
    """Spanning links between different groups of tiles; pairs of groups already joined by an earlier batch never reach the edit distance."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            x = y
        return x

    a, b = [], []
    for at in range(0, len(pairs[0]), BATCH):
        met = [(i, j) for i, j in zip(*(x[at : at + BATCH].tolist() for x in pairs), strict=True) if top(roots[i]) != top(roots[j])]
        known = similar_short([lines[i] for i, _ in met], [lines[j] for _, j in met], similarity).tolist()
        for (i, j), same in zip(met, known, strict=True):
            x, y = top(roots[i]), top(roots[j])
            if x != y and (same > 0 or same < 0 and similar(lines[i], lines[j], similarity)):
                up[max(x, y)] = min(x, y)
                a.append(items[i])
                b.append(items[j])
    return a, b


def _tile_pass(similarity: float):
    """Links (a, b) between groups from rows (bucket, p, q, block, item, root, length, words, marks, line) sorted by tile.

    One tile is held at a time, and of earlier ones the lines of up to ``BATCH`` pairs, which are compared at once.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        items, roots, lines, pairs = [], [], [], [np.zeros((2, 0), dtype=np.int64)]

        def met() -> int:
            """Pairs that wait, with those of the tile that is held."""
            if len(held) > 1:
                numbers = np.array([row[:5] for row in held], dtype=np.int64)
                block, item, root, length, words = numbers.T
                if root.min() != root.max():
                    marks = np.array([row[5:9] for row in held], dtype=np.int64).view(np.uint64)
                    new = np.stack(close_pairs(root, block, length, words, marks, similarity))
                    used, again = np.unique(new, return_inverse=True)
                    pairs.append(again.reshape(new.shape) + len(items))
                    items.extend(item[used].tolist())
                    roots.extend(root[used].tolist())
                    lines.extend(held[i][9] for i in used.tolist())
            return sum(p.shape[1] for p in pairs) if len(pairs) > 1 else 0

        def found() -> pa.RecordBatch:
            a, b = links_between(items, roots, tuple(np.concatenate(pairs, axis=1)), lines, similarity)
            for kept in (items, roots, lines):
                kept.clear()
            pairs[1:] = []
            return pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], ["a", "b"])

        for part in parts:
            for start in range(0, part.num_rows, 8192):
                for bucket, p, q, *row in zip(*(c.slice(start, 8192).to_pylist() for c in part.columns), strict=True):
                    if (bucket, p, q) != tile:
                        if met() >= BATCH or len(pairs) > BATCH:
                            yield found()
                        tile, held = (bucket, p, q), []
                    held.append(row)
        met()
        yield found()

    return run


def _near(similarity: float) -> Column:
    """Whether two lines (columns of ``a`` and ``b``) may be similar by length and by the first 128 bits of a SimHash that both have."""
    longer = F.greatest("a.length", "b.length")
    apart = lambda kind: sum((F.bit_count(F.col(f"a.{_SIMS[kind * WORDS64 + w]}").bitwiseXOR(F.col(f"b.{_SIMS[kind * WORDS64 + w]}"))) for w in (0, 1)), F.lit(0)) <= FAR
    words, pairs = (F.col("a.words") >= FROM) & (F.col("b.words") >= FROM), (F.col("a.words") <= UPTO) & (F.col("b.words") <= UPTO)
    return (F.abs(F.col("a.length") - F.col("b.length")) <= longer * (1 - similarity) + 1e-9) & ((words & apart(0)) | (pairs & apart(1)))


def dropped_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(id, mark, line_no) of every line that is not the first occurrence of its group; see ``dedup_lines`` and ``_rows``."""
    rows = _rows(docs).where("text is not null").select("id", "mark", "text")
    kinds = ", ".join(f"{s} long" for s in _SIMS)
    found = settle(rows.mapInArrow(_line_pass, f"id long, mark long, line_no int, k1 long, k2 long, length int, words int, {kinds}"))
    place = F.struct("id", "mark", "line_no")
    lines = found.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count("*").alias("n"), *[F.max(c).alias(c) for c in ("length", "words", *_SIMS)])
    # The number is fixed by the written table.
    lines = settle(lines.withColumn("item", F.monotonically_increasing_id()))
    rows_of = lambda kind: F.sum(F.when(kind, BLOCKS).otherwise(0))
    n = lines.agg(F.coalesce(rows_of(F.col("words") >= FROM) + rows_of(F.col("words") <= UPTO), F.lit(0))).first()[0] // PART + 1
    dealt = lines.select("item", "length", "words", *_SIMS).mapInArrow(_deal_pass(similarity, n), "part int, lo long, buckets binary, offsets binary, marks binary")
    members = settle(dealt.repartition("part").sortWithinPartitions("part", "lo").mapInArrow(_gather_pass, "bucket long, hub long, item long"))
    marks = lines.select("item", "length", "words", *_MARKS)

    def bodies(items: DataFrame) -> DataFrame:
        where = settle(lines.join(items, "item", "left_semi").select("item", "first.*"))
        places = where.select(F.shiftleft("mark", 20).bitwiseXOR(F.col("line_no").cast("long")).alias("place"))
        passed = rows.mapInArrow(_text_pass(id_bitmap(where, "mark"), id_bitmap(places, "place")), "id long, mark long, line_no int, line string")
        return passed.join(where, ["id", "mark", "line_no"]).groupBy("item").agg(F.min("line").alias("line"))

    star = members.where("item <> hub").select(F.col("hub").alias("x"), F.col("item").alias("y")).distinct()
    pairs = settle(star.join(marks.alias("a"), F.col("x") == F.col("a.item")).join(marks.alias("b"), F.col("y") == F.col("b.item")).where(_near(similarity)).select(F.col("x").alias("a"), F.col("y").alias("b")))
    said = bodies(pairs.select(F.col("a").alias("item")).union(pairs.select(F.col("b").alias("item"))).distinct())
    both = pairs.join(said.toDF("a", "la"), "a").join(said.toDF("b", "lb"), "b").select("a", "b", "la", "lb")
    first = settle(both.mapInArrow(_similar_pass(similarity), "a long, b long"))
    groups = components(first)
    # Where members of a bucket still lie in different groups, they meet in tiles; a bucket of two has met.
    rooted = settle(members.join(groups, "item", "left").select("bucket", "item", F.coalesce("root", "item").alias("root")))
    mixed = rooted.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.xxhash64("item").cast("decimal(20,0)")).alias("same"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi and n > 2")
    once = mixed.groupBy("n", "same").agg(F.min("bucket").alias("bucket"))
    apart = settle(rooted.join(once.select("bucket", "n"), "bucket"))
    blocks = F.ceil(F.col("n") / TILE).cast("int")

    dealt = apart.withColumn("block", F.pmod(F.xxhash64("item"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    tiles = dealt.select("bucket", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "item", "root")
    told = marks.join(bodies(apart.select("item").distinct()), "item")
    filled = tiles.join(told, "item").select("bucket", "p", "q", "block", "item", "root", "length", "words", *_MARKS, "line")
    sorted_ = filled.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "item")
    second = settle(sorted_.mapInArrow(_tile_pass(similarity), "a long, b long").distinct())
    if not second.isEmpty():
        groups = merged(groups, second)
    decided = lines.select("k1", "k2", "n", "first", "item").join(groups, "item", "left").where("n > 1 or root is not null").select("k1", "k2", "first", F.coalesce("root", "item").alias("root"))
    decided = settle(decided)
    keep = decided.groupBy("root").agg(F.min("first").alias("keep"))
    return found.select("id", "mark", "line_no", "k1", "k2").join(decided.join(keep, "root").select("k1", "k2", "keep"), ["k1", "k2"]).where(place != F.col("keep")).select("id", "mark", "line_no")


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of a row: its id (rows without one come after all others) and a hash of its text."""
    return docs.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))).withColumn("text", F.col("text").cast("string")).withColumn("mark", F.xxhash64("text"))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, plus n_lines and n_removed.

    Lines are the pieces between line feeds; they are compared in lower case, with digits as 0 and punctuation as
    blanks, word by word. Equal lines are one; different lines are linked if their SimHashes share a pigeonhole block and their
    edit similarity (1 - edit distance / longer length) is at least ``similarity``. Of each connected group the occurrence
    with the smallest (doc_id, text hash, line number) stays in the whole table and every other one goes, whatever the number of
    copies. Documents always stay, at worst with an empty text.

    A SimHash has 256 bits: the majority over the words of a line, and for short lines over its pairs of neighbouring
    characters. Blocks only propose pairs; the README gives their recall by kind of line.

    Lines without a letter or digit and NULL texts are left as they are. A row is known by (doc_id, text): rows that share an id
    but not a text are cut one by one, a repeated row keeps what its twin keeps, and rows without an id come last. Columns
    of ``docs`` keep their names and order, but n_lines and n_removed are replaced; an empty table gives no row.
    """
    gone = dropped_lines(docs.select("doc_id", "text"), similarity).groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_set("line_no").alias("_gone"))
    held = packed(docs, ["doc_id", "text"])
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_mark")]
    joined = held.select("*", *key).join(gone, ["_id", "_mark"], "left")
    pieces = F.split("text", "\n", -1)
    cut = F.array_join(F.filter(pieces, lambda _line, i: ~F.array_contains("_gone", i)), "\n")
    lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(pieces)).cast("long")
    removed = F.when(F.col("_gone").isNull() | F.col("text").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("long")
    done = joined.select("doc_id", F.when(F.col("_gone").isNotNull(), cut).otherwise(F.col("text")).alias("text"), "_rest", lines.alias("_lines"), removed.alias("_removed"))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return done.select(*unpacked(columns, ["doc_id", "text"]), F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"))
