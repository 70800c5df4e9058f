"""Token counts with the whole-token shortcut, and token ids, of the public word-level BPE vocabulary."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2048
#: Entries a worker remembers before it starts again; bounds its memory, not the result.
MEMORY = 300_000


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Encodes white-space-separated pieces of a text exactly as the library encodes the text.

    A text of the vocabulary's library is split at white space by its own rules before anything merges, so the
    tokens of a text are those of its pieces in order. A piece of printable ASCII and Latin-1 characters is
    lower-cased and cut here by the vocabulary's published pattern, and only its pre-tokens meet the library's merge
    model; any other piece, one that may hold a special token, and any text with control characters that
    Python and the library split differently, goes to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        # Fixed values of the vocabulary file: its pre-token pattern, with its classes written out for lower-case Latin-1.
        letters, numbers = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
        self.pre_tokens = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{letters}{numbers}]+").findall
        self.plain = re.compile(r"[!-~¡-¬®-ÿ]+").fullmatch
        self.odd = re.compile(r"[\x1c-\x1f]").search
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.latin = {c: "".join(self.letter[b] for b in chr(c).encode()) for c in range(256)}

    def merge(self, pre_token: str) -> list[int]:
        return [t.id for t in self.model.tokenize(pre_token if pre_token.isascii() else pre_token.translate(self.latin))]

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def pieces(self, text: str) -> list[str] | None:
        """White-space-separated pieces, or None if the text must be encoded whole."""
        return None if self.odd(text) else text.split()

    def cut(self, piece: str) -> list[str] | None:
        """Pre-tokens of a piece, or None if the library must encode it."""
        return self.pre_tokens(piece.lower()) if self.plain(piece) and "<|" not in piece else None


def whole_tokens(tokenizer: WordTokenizer) -> frozenset[str]:
    """The proof of the shortcut, made once per process from the vocabulary: pre-tokens that encode alone as one token.

    Each vocabulary entry that ends a word is turned back into text, cut like any piece, and merged; it enters
    the set only if it stays one pre-token and merges into exactly its own id.
    """
    back = {v: k for k, v in tokenizer.letter.items()}
    proven = []
    for entry, number in tokenizer.library.get_vocab(with_added_tokens=False).items():
        if not entry.endswith("</w>"):
            continue
        try:
            text = bytes(back[c] for c in entry[:-4]).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if tokenizer.cut(text) == [text] and tokenizer.merge(text) == [number]:
            proven.append(text)
    return frozenset(proven)


class Memory(dict):
    """Values worked out lately: two generations of at most ``MEMORY`` entries; a lost one is worked out again."""

    def __init__(self, work: Callable[[str], object]):
        super().__init__()
        self.work = work
        self.older: dict = {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= MEMORY:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Counter:
    """Number of tokens of a text: proven whole tokens count one, only the other pre-tokens merge."""

    def __init__(self, tokenizer: WordTokenizer):
        self.tokenizer = tokenizer
        proven = whole_tokens(tokenizer)
        parts = Memory(lambda p: 1 if p in proven else len(tokenizer.merge(p)))

        def piece(text: str) -> int:
            cut = tokenizer.cut(text)
            return len(tokenizer.whole(text)) if cut is None else sum(map(parts.__getitem__, cut))

        self.pieces = Memory(piece)

    def __call__(self, text: str) -> int:
        pieces = self.tokenizer.pieces(text)
        return len(self.tokenizer.whole(text)) if pieces is None else sum(map(self.pieces.__getitem__, pieces))


class Encoder:
    """Token ids of a text as little-endian 32-bit words."""

    def __init__(self, tokenizer: WordTokenizer):
        self.tokenizer = tokenizer
        parts = Memory(lambda p: _packed(tokenizer.merge(p)))

        def piece(text: str) -> bytes:
            cut = tokenizer.cut(text)
            return _packed(tokenizer.whole(text)) if cut is None else b"".join(map(parts.__getitem__, cut))

        self.pieces = Memory(piece)

    def __call__(self, text: str) -> bytes:
        pieces = self.tokenizer.pieces(text)
        return _packed(self.tokenizer.whole(text)) if pieces is None else b"".join(map(self.pieces.__getitem__, pieces))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_held: dict[tuple[str, type], object] = {}


def worker(path: str, kind: type):
    """One ``Counter`` or ``Encoder`` per Python worker process."""
    if (path, kind) not in _held:
        _held[path, kind] = kind(WordTokenizer(path))
    return _held[path, kind]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), one row per row of ``docs`` (doc_id, text).

    One pass without a shuffle. A NULL text counts as empty (0 bytes, 0 tokens); repeated rows are counted again;
    an empty table gives no row; other columns are ignored. ``path`` must be readable on every executor.
    """
    path = path or vocabulary_path()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = worker(path, Counter)
        for part in parts:
            size = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
            n = [0 if t is None else count(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array(n, type=pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
