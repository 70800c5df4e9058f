"""Main text of web pages: page structure, and repeated runs of a host found by suffix order."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens that a run must have to count as repeated.
RUN = 8
#: Characters of html in a part of the pages, and parts whose runs meet in one range of the suffix order.
CHARACTERS, PARTS = 8_000_000, 4

#: Fixed values of HTML: elements without content, elements that start a new block, and elements that never hold main text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody tfoot thead title tr ul".split())
_NEVER = frozenset("script style noscript template head title nav header footer button select option textarea iframe object svg canvas audio video dialog menu".split())
#: Elements and names that hold no main text, but may be an outer frame around the article (a form around the page, an aside never closed).
_FRAMES = frozenset("form aside".split())
_NAMES = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination popup promo promos promotion recommended related replies share sharing sidebar social sponsor sponsored sponsors subscribe toolbar widget".split())
#: Parts of a class or id that make it a state or a slug instead of a name.
_STATES = frozenset("has no not with without is js show hide open closed enabled disabled active of the to for and in on a".split())
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert".split())
#: Elements that a class or id never takes out.
_KEPT = frozenset("html body main article".split())

MAIN, OPEN, NEVER, FRAME, HELD = 0, 1, 2, 3, 4


def named_boilerplate(value: str | None) -> bool:
    """Whether a class or id names boilerplate: ``related-links`` and ``top ad`` do; ``has-sidebar`` and ``notice-of-change`` do not."""
    for name in (value or "").lower().split():
        parts = [p for p in re.split(r"[-_]+", name) if p]
        if any(p in _NAMES for p in parts) and not any(p in _STATES for p in parts):
            return True
    return False


def zone_of(tag: str, attributes: dict[str, str | None], outer: int) -> int:
    """Zone of an element from its own tag and attributes and the zone around it."""
    role = attributes.get("role") or ""
    article = tag in ("article", "main") or role == "main"
    if outer == NEVER:
        return NEVER
    if tag in _NEVER or role in _ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return NEVER
    framed = tag in _FRAMES or role == "form" or (tag not in _KEPT and not article and any(named_boilerplate(attributes.get(k)) for k in ("class", "id")))
    if framed:
        return NEVER if outer in (MAIN, HELD) else FRAME
    if outer == FRAME:
        return HELD if article else FRAME
    return MAIN if article and outer == OPEN else outer


class _Blocks(HTMLParser):
    """Blocks of visible text in page order with their zone: inside the article, undecided, or never main text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int]] = []
        self.blocks: list[tuple[int, str]] = []
        self.parts: list[str] = []
        self.zone = OPEN

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((self.zone, text))
        self.parts = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCK:
            self._flush()
            if tag != "br" and any(t == "p" for t, _ in self.stack):  # a block ends an open paragraph
                at = max(i for i, (t, _) in enumerate(self.stack) if t == "p")
                if not any(t in _BLOCK for t, _ in self.stack[at + 1 :]):
                    del self.stack[at:]
        elif tag in ("td", "th"):
            self.parts.append(" ")
        if tag not in _VOID:
            zone = zone_of(tag, dict(attrs), self.stack[-1][1] if self.stack else OPEN)
            self.stack.append((tag, zone))
        self._enter()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCK:
            self._flush()

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        if at is None:
            return
        if any(t in _BLOCK for t, _ in self.stack[at:]):
            self._flush()
        del self.stack[at:]
        self._enter()

    def _enter(self) -> None:
        zone = self.stack[-1][1] if self.stack else OPEN
        if zone != self.zone:
            self._flush()
            self.zone = zone

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def page_blocks(html: str | None) -> list[tuple[int, str]]:
    """(zone, text) blocks of a whole page: MAIN, OPEN or NEVER.

    Where an article or main element exists, text outside it is never main text. Articles inside a frame (a form, an aside or an
    element named like boilerplate) count only where no other article exists, so a form around the page or an aside that is
    never closed does not hide the article, and teasers in a sidebar do not join it.
    """
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser._flush()
    zones = {zone for zone, _ in parser.blocks}
    best = MAIN if MAIN in zones else HELD if HELD in zones else OPEN
    return [(NEVER if zone != best else MAIN if best == HELD else zone, text) for zone, text in parser.blocks]


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit names of pairs of names; equal pairs have equal names on every task."""
    name = left * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F)
    name ^= name >> np.uint64(29)
    name *= np.uint64(0xBF58476D1CE4E5B9)
    name ^= name >> np.uint64(32)
    return name


#: Keys under which a word has its two independent 64-bit names.
_KEYS = ("suffix order one", "suffix order two")


def _marks(words: pa.Array, key: str) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), hash_key=key, categorize=False)


def suffix_names(words: pa.Array, lengths: np.ndarray, run: int = RUN, keys: tuple[str, ...] = _KEYS) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(first token, tokens, names by each key) of every run of blocks of ``lengths`` tokens.

    A run is ``run`` tokens inside a block, or a whole shorter block. The suffixes of the joined tokens are named by
    prefix doubling, cut off at ``run`` tokens: the name of twice the tokens joins the names of its halves, so equal
    prefixes of suffixes have equal names in every task, and ordering the names brings equal runs together.
    """
    n = len(words)
    coded = words.dictionary_encode()
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)
    starts = np.flatnonzero((left >= run) | (left == np.repeat(lengths, lengths)))
    names = []
    for key in keys:
        name = _marks(coded.dictionary, key)[coded.indices.to_numpy()]
        known = 1
        while known < run:
            step = min(known, run - known)
            ahead = np.zeros_like(name)  # 0 stands for the end of the block
            np.multiply(name[step:], left[: max(0, n - step)] > step, out=ahead[: max(0, n - step)])
            name = _joined(name, ahead)
            known += step
        names.append(name[starts])
    return starts, np.minimum(run, left[starts]), names


def _heads(*ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins in ordered arrays."""
    new = np.zeros(max(0, len(ordered[0]) - 1), dtype=bool)
    for values in ordered:
        new |= values[1:] != values[:-1]
    return np.flatnonzero(np.append(True, new)[: len(ordered[0])])


def _on_several(names: list[np.ndarray], page: np.ndarray) -> np.ndarray:
    """Which runs stand on more than one page, from their order by name."""
    out = np.zeros(len(page), dtype=bool)
    if len(page):
        order = np.argsort(names[0])
        head = _heads(*[name[order] for name in names])
        several = np.maximum.reduceat(page[order], head) != np.minimum.reduceat(page[order], head)
        out[order] = np.repeat(several, np.diff(np.append(head, len(order))))
    return out


def _shared(*ordered: np.ndarray) -> np.ndarray:
    """Which values of ordered arrays stand there more than once."""
    head = _heads(*ordered)
    times = np.diff(np.append(head, len(ordered[0])))
    return np.repeat(times > 1, times)


def _covered(n: int, starts: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which of ``n`` tokens lie in a run of ``spans`` tokens from ``starts``."""
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(starts + spans, minlength=n + 1)
    return np.cumsum(edges)[:n] > 0


def repeated_tokens(pages: list[list[list[str]]], run: int = RUN) -> list[np.ndarray]:
    """Per page (a list of blocks of tokens), which tokens lie in a run that stands on another page too. Runs never cross the end of a block."""
    lengths = np.array([len(block) for page in pages for block in page], dtype=np.int64)
    per_page = np.array([sum(map(len, page)) for page in pages], dtype=np.int64)
    starts, spans, names = suffix_names(pa.array([t for page in pages for block in page for t in block], type=pa.string()), lengths, run)
    several = _on_several(names, np.repeat(np.arange(len(pages)), per_page)[starts])
    return np.split(_covered(int(lengths.sum()), starts[several], spans[several]), np.cumsum(per_page)[:-1])


def _packed(values: np.ndarray) -> tuple[int, int, bytes]:
    """Ordered whole numbers as their count, bytes a number, and compressed bytes of their differences."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return len(values), width, pa.compress(steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(n: int, width: int, data: bytes) -> np.ndarray:
    steps = np.zeros((n, 8), dtype=np.uint8)
    steps[:, :width] = np.frombuffer(pa.decompress(data, decompressed_size=n * width, codec="zstd"), dtype=np.uint8).reshape(width, n).T
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def _groups(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each key of an ordered array and where it stands."""
    heads = _heads(keys).tolist()
    for start, end in zip(heads, [*heads[1:], len(keys)], strict=False):
        yield int(keys[start]), slice(start, end)


_RUNS = "part int, range int, n int, width int, runs binary, checks binary"
_TEXTS = "page_id long, url string, text string, n_chars long, n_repeated_tokens long"


def _run_rows(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], ["part", "range", "n", "width", "runs", "checks"])


def _run_columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, run, check) of all rows; checks are empty where only runs are sent."""
    rows = table.to_pylist()
    runs = [_unpacked(r["n"], r["width"], r["runs"]) for r in rows]
    checks = [np.frombuffer(r["checks"], dtype="<u8") for r in rows]
    return np.repeat([r["part"] for r in rows], [r["n"] for r in rows]).astype(np.int64), np.concatenate([np.zeros(0, np.uint64), *runs]), np.concatenate([np.zeros(0, np.uint64), *checks])


class _Part:
    """Pages of one part, each of its different pages once, with the names of their runs."""

    def __init__(self, table: pa.Table, run: int, bits: int, keys: tuple[str, ...] = _KEYS) -> None:
        place: dict[tuple, int] = {}
        self.rows: list[tuple] = []
        for size, data in zip(table["size"].to_pylist(), table["pages"].to_pylist(), strict=True):
            for host, texts, copies in pickle.loads(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)):
                at = place.setdefault((host, texts), len(place))
                self.rows += [(at, *copy) for copy in copies]
        self.texts = [texts for _, texts in place]
        split = pc.split_pattern(pa.array([t for texts in self.texts for t in texts], type=pa.string()), " ")
        self.lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        blocks = np.array([len(texts) for texts in self.texts], dtype=np.int64)
        self.first = np.cumsum(blocks) - blocks
        self.starts, self.spans, names = suffix_names(split.flatten(), self.lengths, run, keys)
        self.page = np.repeat(np.repeat(np.arange(len(blocks)), blocks), self.lengths)[self.starts]
        hosts = pa.array([host for host, _ in place], type=pa.string())
        self.names = [_joined(name, _marks(hosts, key)[self.page]) for name, key in zip(names, keys, strict=True)]
        self.runs = self.names[0] >> np.uint64(64 - bits)

    def finished(self, repeated: np.ndarray) -> pa.Table:
        """Main text and repeated tokens of every row, given which runs are repeated."""
        ends = np.cumsum(self.lengths)
        covered = _covered(int(self.lengths.sum()), self.starts[repeated], self.spans[repeated])
        upto = np.append(0, np.cumsum(covered))
        out: list[tuple] = []
        for at, page_id, url, zones in self.rows:
            texts, first = self.texts[at], self.first[at]
            kept = []
            for i, (zone, text) in enumerate(zip(zones, texts, strict=True), first):
                if zone == MAIN:
                    kept.append(text)
                elif zone == OPEN:
                    gone = covered[ends[i] - self.lengths[i] : ends[i]].tolist()
                    rest = " ".join(w for w, g in zip(text.split(" "), gone, strict=True) if not g) if any(gone) else text
                    if rest:
                        kept.append(rest)
            body = "\n".join(kept)
            count = int(upto[ends[first + len(texts) - 1]] - upto[ends[first] - self.lengths[first]]) if texts else 0
            out.append((page_id, url, body, len(body), count))
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        columns = zip(*out, strict=True) if out else [[]] * len(kinds)
        return pa.Table.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "url", "text", "n_chars", "n_repeated_tokens"])


def _deal_pass(parts: int):
    """Parses pages and packs them by part; pages of one host and equal blocks share a part."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dealt: dict[int, dict[tuple, list]] = {}
            for host, page_id, url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                blocks = page_blocks(html)
                texts = tuple(text for _, text in blocks)
                part = int.from_bytes(blake2b("\n".join((host, *texts)).encode(), digest_size=8).digest()) % parts
                dealt.setdefault(part, {}).setdefault((host, texts), []).append((page_id, url, bytes(zone for zone, _ in blocks)))
            data = [pickle.dumps([(*page, copies) for page, copies in pages.items()]) for pages in dealt.values()]
            packs = [pa.compress(d, codec="zstd", asbytes=True) for d in data]
            yield pa.RecordBatch.from_arrays([pa.array(list(dealt), type=pa.int32()), pa.array([len(d) for d in data], type=pa.int64()), pa.array(packs, type=pa.binary())], ["part", "size", "pages"])

    return deal


def _run_passes(run: int, bits: int, ranges: int):
    """The passes over parts and ranges of the suffix order: offer, meet, prove, settle and finish."""

    def dealt(part: int, runs: np.ndarray, checks: np.ndarray | None = None) -> list[tuple]:
        """Ordered runs by range."""
        at = (runs * np.uint64(ranges)) >> np.uint64(bits)
        return [(part, r, *_packed(runs[w]), b"" if checks is None else checks[w].tobytes()) for r, w in _groups(at)]

    def offer(key: tuple, pages: pa.Table) -> pa.Table:
        runs = np.sort(_Part(pages, run, bits, _KEYS[:1]).runs)
        return _run_rows(dealt(key[0].as_py(), runs[_heads(runs)]))

    def meet(key: tuple, offers: pa.Table) -> pa.Table:
        """For each part, its runs whose first bits another part has too."""
        part, runs, _ = _run_columns(offers)
        order = np.argsort(runs)
        order = order[_shared(runs[order])]
        order = order[np.argsort(part[order], kind="stable")]
        part, runs = part[order], runs[order]
        return _run_rows([(p, key[0].as_py(), *_packed(runs[w]), b"") for p, w in _groups(part)])

    def prove(key: tuple, pages: pa.Table, asked: pa.Table) -> pa.Table:
        """Both names of the runs asked for."""
        if not asked.num_rows:
            return _run_rows([])
        held = _Part(pages, run, bits)
        wanted = np.isin(held.runs, _run_columns(asked)[1])
        runs, checks = held.runs[wanted], held.names[1][wanted]
        order = np.lexsort((checks, runs))
        order = order[_heads(runs[order], checks[order])]
        return _run_rows(dealt(key[0].as_py(), runs[order], checks[order]))

    def agree(key: tuple, proofs: pa.Table) -> pa.Table:
        """For each part, the second names of its runs that another part has too."""
        part, runs, checks = _run_columns(proofs)
        order = np.lexsort((checks, runs))
        order = order[_shared(runs[order], checks[order])]
        order = order[np.argsort(part[order], kind="stable")]
        part, checks = part[order], checks[order]
        return _run_rows([(p, key[0].as_py(), 0, 1, _packed(np.zeros(1, np.uint64))[2], checks[w].tobytes()) for p, w in _groups(part)])

    def finish(key: tuple, pages: pa.Table, found: pa.Table) -> pa.Table:
        held = _Part(pages, run, bits)
        checks = np.frombuffer(b"".join(found["checks"].to_pylist()), dtype="<u8")
        return held.finished(_on_several(held.names, held.page) | np.isin(held.names[1], checks))

    return offer, meet, prove, agree, finish


def extract_main_text(pages: DataFrame, run: int = RUN) -> DataFrame:
    """page_id, url, text, n_chars and n_repeated_tokens for every row of ``pages`` (page_id, url, html; other columns are ignored).

    A run counts as repeated if two pages of different text of one host hold it, however large the host. Pages are parsed
    where they are read and dealt by hash into parts that one task holds. Each part orders the names of its runs; the order
    of all parts is compared in ranges: first by the leading bits of the names, then, for runs that two parts seem to share,
    by the whole second name. What is found goes back to the parts. The article's blocks (or, without an article or main
    element, undecided blocks outside repeated runs) are the text: character references decoded, white space of a block one
    space, blocks joined by line feeds; nothing is cut. A NULL or empty html gives an empty text, a NULL url counts as one
    host, repeated rows are extracted again, an empty table gives no row.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(host.alias("host"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    size = rows.agg(F.sum(F.length("html"))).first()[0] or 0
    least = pages.sparkSession.sparkContext.defaultParallelism
    parts = max(least, -(-size // CHARACTERS))
    ranges = max(least, -(-parts // PARTS))
    bits = min(44, max(24, size.bit_length() + 3))  # few runs share these bits by chance
    offer, meet, prove, agree, finish = _run_passes(run, bits, ranges)
    held = rows.mapInArrow(_deal_pass(parts), "part int, size long, pages binary").repartitionById(parts, "part")
    offers = held.groupBy("part").applyInArrow(offer, _RUNS)
    asked = offers.repartitionById(ranges, "range").groupBy("range").applyInArrow(meet, _RUNS).repartitionById(parts, "part")
    proofs = held.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(prove, _RUNS)
    found = proofs.repartitionById(ranges, "range").groupBy("range").applyInArrow(agree, _RUNS).repartitionById(parts, "part")
    return held.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(finish, _TEXTS)
