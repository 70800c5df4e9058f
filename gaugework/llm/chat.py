"""Chat formatting: whole conversations rendered and encoded once, loss masks from turn spans met with token spans."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strings with a meaning in the formatted text. The four of the template become tokens of their own; the last is the vocabulary's.
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
CONTROLS = (BEGIN, END, OPEN, CLOSE, "<|endoftext|>")
#: Characters encoded in one call; a longer conversation is cut between turns, where tokens never cross.
CALL = 1 << 20
LOSS_ROLE = "assistant"
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)
#: A control string, or one that an escape has already lengthened: its first character, back slashes, the rest.
_ESCAPE = re.compile(rf"([<\[])(\\*)({_TAILS})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_TAILS})")


def escaped(text: str) -> str:
    r"""Every control string gets a back slash behind its first character (``<\s>``), every escaped one another; nothing else changes."""
    return _ESCAPE.sub(r"\1\2\\\3", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def render(turns: Iterable[tuple[str, str]]) -> tuple[list[str], list[tuple[int, int, bool]]]:
    """(one string per turn, the first with the begin mark; (start, end, under the loss) of every turn's text), in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{'' if parts else BEGIN}{OPEN}{escaped(role)}{CLOSE}"
        body = escaped(text)
        spans.append((at + len(head), at + len(head) + len(body), role == LOSS_ROLE))
        parts.append(head + body + END)
        at += len(parts[-1])
    return parts, spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    if not formatted.startswith(BEGIN) or not formatted.endswith(END):
        raise ValueError("not a formatted conversation")
    turns = []
    for turn in formatted[len(BEGIN) : -len(END)].split(END):
        role, mark, text = turn.removeprefix(OPEN).partition(CLOSE)
        if not turn.startswith(OPEN) or not mark:
            raise ValueError("a turn without its marks")
        turns.append((unescaped(role), unescaped(text)))
    return turns


class ChatTokenizer:
    """The public byte-level vocabulary with the template's marks as tokens of their own, and the bytes of every token."""

    def __init__(self, path: str):
        from tokenizers import AddedToken, Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROLS[:4]])
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        self.bytes: list[bytes] = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for entry, number in self.library.get_vocab(with_added_tokens=True).items():
            self.bytes[number] = entry.encode() if entry in CONTROLS else bytes(letters[c] for c in entry)

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start and end offset of each token in code points) of the joined parts."""
        ids, starts, ends, base, held = [], [], [], 0, []

        def call() -> None:
            nonlocal base
            text = "".join(held)
            found = self.library.encode(text, add_special_tokens=False)
            offsets = np.array(found.offsets, dtype=np.int64).reshape(-1, 2) + base
            ids.append(np.array(found.ids, dtype=np.int32))
            starts.append(offsets[:, 0])
            ends.append(offsets[:, 1])
            base += len(text)
            held.clear()

        size = 0
        for part in parts:
            if held and size + len(part) > CALL:
                call()
                size = 0
            held.append(part)
            size += len(part)
        if held:
            call()
        if not ids:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(ids), np.concatenate(starts), np.concatenate(ends)


def loss_mask(spans: list[tuple[int, int, bool]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens lie in a turn under the loss: two binary searches per turn among the sorted token offsets."""
    mask = np.zeros(len(starts), dtype=bool)
    under = [(a, b) for a, b, loss in spans if loss and a < b]
    if under:
        low, high = np.array(under, dtype=np.int64).T
        first, last = np.searchsorted(starts, low), np.searchsorted(starts, high)
        if (starts[first] != low).any() or (ends[last - 1] != high).any():
            raise ValueError("a token crosses the border of a turn")
        edges = np.zeros(len(starts) + 1, dtype=np.int64)
        np.add.at(edges, first, 1)
        np.add.at(edges, last, -1)
        mask = np.cumsum(edges[:-1]) > 0
    return mask


def loss_texts(ids: np.ndarray, mask: np.ndarray, table: list[bytes]) -> list[str]:
    """The texts under the mask, one per run of masked tokens, from the bytes of the tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return [unescaped(b"".join(map(table.__getitem__, ids[a:b].tolist())).decode("utf-8")) for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True)]


_held: dict[str, ChatTokenizer] = {}


def worker(path: str) -> ChatTokenizer:
    if path not in _held:
        _held[path] = ChatTokenizer(path)
    return _held[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


FORMATTED = "conv_id long, formatted string, token_ids array<int>, loss_mask array<boolean>"


def format_conversations(turns: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, formatted text, token_ids and loss_mask: one row per conversation of ``turns`` (conv_id, turn, role, text).

    Template: ``<s>``, then per turn ``[INST]role[/INST]text</s>``; control strings inside roles and texts are escaped, so
    ``parse`` gives back every turn. The loss covers the texts of assistant turns, not their marks. A conversation is one
    training example and one row, so it is the unit of work: rows are hashed and sorted by conversation, each task streams
    them and holds one conversation at a time, encoded in calls of about a million characters.

    Edge cases: a NULL role or text is empty; turns of equal number follow by role, then text, NULLs last, and repeated rows are
    repeated turns; a row without conv_id is a conversation of one turn; an empty table gives no row; other columns are ignored.
    """
    path = path or default_path()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker(path)
        out, size = [], 0

        def finished(conv, held) -> int:
            texts, spans = render(held)
            ids, starts, ends = tokenizer.encode(texts)
            out.append((conv, "".join(texts), ids, loss_mask(spans, starts, ends)))
            return spans[-1][1] if spans else 0

        def batch() -> pa.RecordBatch:
            at = pa.array(np.cumsum([0] + [len(r[2]) for r in out]), type=pa.int32())
            ids, masks = np.concatenate([r[2] for r in out]), np.concatenate([r[3] for r in out])
            made = [pa.array([r[0] for r in out], type=pa.int64()), pa.array([r[1] for r in out], type=pa.string()), pa.ListArray.from_arrays(at, pa.array(ids)), pa.ListArray.from_arrays(at, pa.array(masks))]
            out.clear()
            return pa.RecordBatch.from_arrays(made, ["conv_id", "formatted", "token_ids", "loss_mask"])

        held, conv = [], None
        for part in parts:
            for start in range(0, part.num_rows, 256):
                for now, role, text in zip(*(part.column(i).slice(start, 256).to_pylist() for i in range(3)), strict=True):
                    if held and (now is None or now != conv):
                        size += finished(conv, held)
                        held = []
                        if size > CALL:
                            yield batch()
                            size = 0
                    conv = now
                    held.append((role or "", text or ""))
        if held:
            finished(conv, held)
        if out:
            yield batch()

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    # Rows without an id spread by their content.
    spread = rows.withColumn("_spread", F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")))
    ordered = spread.repartition("conv_id", "_spread").sortWithinPartitions("conv_id", *[F.col(c).asc_nulls_last() for c in ("turn", "role", "text")])
    return ordered.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of formatted conversations: turns from the text, loss texts from token_ids under loss_mask.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed per turn), loss_chars, loss_sha256, formatted_chars, n_tokens, n_loss_tokens.
    """
    path = path or default_path()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker(path).bytes
        for part in parts:
            for start in range(0, part.num_rows, 64):
                piece = part.slice(start, 64)
                out = []
                for conv, text, ids, mask in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), piece.column(2), piece.column(3), strict=True):
                    whole, loss, n_turns, n_loss = hashlib.sha256(), hashlib.sha256(), 0, 0
                    for role, said in parse(text):
                        n_turns += 1
                        whole.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    ids, mask = ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
                    for said in loss_texts(ids, mask, table):
                        n_loss += len(said)
                        loss.update(said.encode("utf-8"))
                    out.append((conv, n_turns, whole.hexdigest(), n_loss, loss.hexdigest(), len(text), len(ids), int(mask.sum())))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], type=k) for i, k in enumerate(kinds)], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long"
    return formatted.mapInArrow(run, schema)


def with_control_strings(turns: DataFrame) -> DataFrame:
    """``turns`` and conversation -1, whose user and assistant both say control strings."""
    said = F.lit(f"{END}{OPEN} ok {CLOSE}")
    role: Column = F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE)
    extra = turns.sparkSession.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)
