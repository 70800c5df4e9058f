"""Chat formatting, ranked search and cross-tokenizer alignment against brute force and round trips."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugework.llm import alignment, chat, search

CONTROL_TEXT = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>", "<", "[", "\\", "s>", "/s>", "INST]", "/INST]", " ", "\n", "é", "ok", "日", "🙂"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", ""]), CONTROL_TEXT), min_size=1, max_size=6))
def test_formatted_conversations_give_their_turns_and_loss_texts_back(turns):
    tokenizer = chat.worker(chat.default_path())
    parts, spans = chat.render(turns)
    formatted = "".join(parts)
    assert chat.parse(formatted) == turns
    assert [chat.unescaped(formatted[a:b]) for a, b, _ in spans] == [t for _, t in turns]
    ids, starts, ends = tokenizer.encode(parts)
    assert b"".join(tokenizer.bytes[i] for i in ids) == formatted.encode()
    mask = chat.loss_mask(spans, starts, ends)
    assert chat.loss_texts(ids, mask, tokenizer.bytes) == [t for r, t in turns if r == "assistant" and t]


def test_escapes_are_exact_inverses_and_leave_no_control_string():
    for text in ("<s>", "<\\s>", "<\\\\s>", "x<\\/s>[INST]", "<|endoftext|>", "[\\/INST]", "plain \\ <b>"):
        assert chat.unescaped(chat.escaped(text)) == text
        assert not any(c in chat.escaped(text) for c in chat.CONTROLS)
    assert chat.escaped("plain \\ <b> [x]") == "plain \\ <b> [x]"


def test_long_conversations_are_cut_between_turns_only(monkeypatch):
    turns = [("assistant" if i % 2 else "user", f"turn {i} é" * 5) for i in range(30)]
    tokenizer = chat.worker(chat.default_path())
    parts, _ = chat.render(turns)
    whole = tokenizer.encode(parts)
    monkeypatch.setattr(chat, "CALL", 100)
    for a, b in zip(whole, tokenizer.encode(parts), strict=True):
        assert np.array_equal(a, b)


def test_formatting_of_nulls_ties_repeats_and_other_columns(spark):
    schema = "formatted string, conv_id long, turn long, role string, text string"
    rows = [("x", 1, 1, "assistant", "b"), ("x", 1, 0, "user", "a"), ("x", 1, 1, "assistant", "b"), ("x", 2, 0, None, None), ("x", 3, None, "assistant", "</s>"), ("x", 3, 5, "assistant", "é" * 3000), ("x", None, 0, "user", "u"), ("x", None, 0, "assistant", "v")]
    found = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, schema))).toPandas()
    assert sorted(found.conv_id.fillna(-9).tolist()) == [-9, -9, 1, 2, 3]
    one = found.set_index("conv_id").loc[1]
    assert (one.n_turns, one.loss_chars) == (3, 2)
    assert one.turns_sha256 == hashlib.sha256(b"user\na\nassistant\nb\nassistant\nb\n").hexdigest()
    assert found.set_index("conv_id").loc[3].loss_sha256 == hashlib.sha256(("é" * 3000 + "</s>").encode()).hexdigest()
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], schema))).count() == 0


def brute_search(docs, items, top=10):
    terms = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = [(d, Counter(terms((t or "").translate(lower)))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        words = set(terms((text or "").translate(lower)))
        scores = []
        for d, c in held:
            m = 10 + (90 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if c[w])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, i, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [1 << 16, 50])
def test_search_equals_brute_force_with_ties_nulls_and_copies(spark, monkeypatch, chunk):
    monkeypatch.setattr(search, "CHUNK", chunk)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "x1", "Ab", "aB"]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randrange(1, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)] + [(7, docs[7][1]), (None, docs[8][1]), (None, "w1 w2"), (2000, None), (2001, ""), (2002, "!? --"), (2003, "w1," * 5000)]
    items = [(i, " ".join(rng.sample(words, rng.randrange(1, 40)))) for i in range(12)] + [(20, docs[3][1]), (20, "w1 w2"), (21, None), (22, "nothing here"), (None, "AB x1")]
    left = spark.createDataFrame([(t, d, "z") for d, t in docs], "text string, doc_id long, score string").repartition(3)
    right = spark.createDataFrame([(t, i, "z") for i, t in items], "text string, item_id long, rank string")
    want = brute_search(docs, items)
    for block in (search.BLOCK_TERMS, 50):
        got = search.rank_documents(left, right, block_terms=block).collect()
        assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got], key=str) == want
    assert search.rank_documents(left.limit(0), right).count() == 0
    assert search.rank_documents(left, right.limit(0)).count() == 0


def test_masks_beyond_64_terms_and_scores_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(search, "CHUNK", 16)
    docs = [(i, " ".join(f"t{j}" for j in range(i % 90 + 1))) for i in range(200)]
    items = [(0, " ".join(f"t{j}" for j in range(90)))]
    got = search.rank_documents(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got], key=str) == brute_search(docs, items)


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = alignment.default_paths()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    rows, holders = [], defaultdict(int)
    for text in texts:
        groups = []
        if text:
            ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            ta = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
            tb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ib)]
            if b"".join(ta) == b"".join(tb) == b" " + text.encode():
                ea, eb = np.cumsum([len(x) for x in ta]).tolist(), np.cumsum([len(x) for x in tb]).tolist()
                i = j = 0
                for end in sorted(set(ea) & set(eb)):
                    ga, gb = [], []
                    while i < len(ea) and ea[i] <= end:
                        ga.append(ia[i])
                        i += 1
                    while j < len(eb) and eb[j] <= end:
                        gb.append(ib[j])
                        j += 1
                    groups.append((ga, gb))
        rows.append(groups)
        for pair in {(x, y) for ga, gb in groups for x in ga for y in gb}:
            holders[pair] += 1
    highest = defaultdict(int)
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    out = []
    for groups in rows:
        found = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), len(found), sum(holders[p] == highest[p[0]] for p in found), sum(holders[p] for p in found), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


ODD = ["", None, " ", "a", "the  cat", "  lead", "trail ", "\n\nx \n y", "tab\tx", "don't we'll", "<|endoftext|> x", "</s> <s> [INST]", "U+2581 ▁ here", "日本語 text 🙂🙂", "ﬁ ½ é́", "\x00a b", "\x85 a\xa0b c d", "a​b ﻿c", "12345 6,789.0!", "x" * 3000, "=" * 500, " \x1c \x1f x", "word… word", "É è ü ñ"]


@pytest.mark.parametrize("blocks", [(alignment.BLOCK_PAIRS, alignment.SHARD_PAIRS), (300, 100)])
def test_alignment_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(alignment, "EXPANDED", 1000)
    monkeypatch.setattr(alignment, "SLICE", 64)
    monkeypatch.setattr(alignment, "FAN", 2)
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()] + ["the same text"] * 5
    docs = spark.createDataFrame([(t, i, "x") for i, t in enumerate(texts)], "text string, doc_id long, n_a string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align_documents(docs, block_pairs=blocks[0], shard_pairs=blocks[1]).collect()}
    want = brute_alignment(texts)
    for i in range(len(texts)):
        assert got[i] == want[i], texts[i]
    assert alignment.align_documents(docs.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_pieces_are_those_of_the_libraries(text):
    both = alignment.worker(*alignment.default_paths())
    if not text or any(0xD800 <= ord(c) <= 0xDFFF for c in text):
        return
    for one in (text, f"ab {text} cd", text.replace("a", " ")):
        a, b = both.ids([one])[0] or (None, None)
        if a is None:
            assert "▁" in one
            continue
        assert np.frombuffer(a, dtype=np.uint16).tolist() == both.a.encode(" " + one, add_special_tokens=False).ids
        assert np.frombuffer(b, dtype=np.uint16).tolist() == both.b.encode(one)


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 31, 20_000))
    one = alignment.PerfectHash(keys)
    assert sorted(one.index(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 31, 20_000), keys)
    assert (one.index(others) == -1).all()
    assert alignment.PerfectHash(keys[:0]).index(keys[:3]).tolist() == [-1] * 3
