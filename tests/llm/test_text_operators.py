"""Documents, lines, rules, tokens, packing and mixing on small tables with every awkward case."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugework.llm import lines, mixing, neardup, packing, rules, sharding, tokens
from gaugework.llm.words import shingles, text_ranges, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, item string, key int, _gone int, n_lines int"
BASE = " ".join(f"word{i}" for i in range(120))
OTHER = " ".join(f"term{i}" for i in range(90))
NEAR = BASE.replace("word60", "changed")
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, NEAR, "en", "b"), (4, OTHER, "de", None), (5, "", "en", "a"), (6, None, None, "b"), (7, "", "en", "a"),
    (8, " \t\n", "en", "c"), (9, "one two", "en", "c"), (10, "one two", "en", "c"), (11, "one three", "en", "c"), (1, BASE, "en", "a"), (None, BASE, "en", "a"), (12, "x " * 30_000, "fr", "a"),
    (13, f"{OTHER}\nshared line of several words here\n{'y ' * 50}", "en", "b"), (14, f"Shared line, of several words HERE!\nfresh words only in this text {BASE[:40]}", "en", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, None, "clash", 1, 2, 3) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_classes(rows, similarity=0.8, width=5):
    """Smallest id of each connected group under plain Jaccard of word n-grams (rows with an id and a text)."""
    sets = {}
    for doc_id, text in rows:
        words = text.encode().split()
        sets[doc_id] = ({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}) if words else {("empty", text)}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_near_duplicate_classes(docs, empty):
    found = neardup.near_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    classes = {r.doc_id: r.class_id for r in found}
    assert {d: c for d, c in classes.items() if d not in (None, 6)} == brute_classes([(r[0], r[1]) for r in ROWS if r[0] and r[1] is not None])
    assert classes[6] == 6 and classes[None] == 1
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.class_id) for r in found)
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({1: 1, 4: 1, 5: 1, 6: 1, 8: 1, 9: 1, 11: 1, 12: 1, 14: 1})
    assert neardup.near_duplicates(empty).count() == 0


def test_drop_near_duplicates_decides_by_row(spark):
    rows = [(None, BASE), (None, BASE), (None, NEAR), (None, OTHER), (7, OTHER), (7, "one id with another text"), (7, "one id with another text"), (8, None), (8, None), (None, None), (None, "only without id")]
    kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = Counter((r.doc_id, r.text) for r in kept)
    base = [text for text in (BASE, NEAR) if got.pop((None, text), 0)]
    assert len(base) == 1 and len(kept) == 7
    assert got == Counter({(7, OTHER): 1, (7, "one id with another text"): 1, (8, None): 2, (None, None): 1, (None, "only without id"): 1})


def test_near_duplicates_equal_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    extra = []
    for k, (doc_id, text) in enumerate(rows[:40]):  # near copies with one word in thirty changed
        words = text.split(" ")
        words[k % 30 :: 60] = ["edited"] * len(words[k % 30 :: 60])
        extra.append((10_000 + doc_id, " ".join(words)))
    more = spark.createDataFrame(rows + extra, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(more).collect()}
    want = brute_classes(rows + extra)
    groups = lambda classes: {frozenset(d for d in classes if classes[d] == c) for c in set(classes.values())}
    assert groups(got) == groups(want)


def test_tiles_link_like_brute_force():
    random = np.random.default_rng(6)
    base = random.integers(1, 1 << 60, 400)
    sets = [np.unique(np.concatenate([base[random.random(400) < 0.9], random.integers(1, 1 << 60, 20)])) for _ in range(40)]
    roots, blocks = list(range(40)), [i % 2 for i in range(40)]
    for tile in (list(range(40)), list(range(0, 40, 2))):
        a, b = neardup.similar_between([100 + i for i in tile], [roots[i] for i in tile], [blocks[i] for i in tile], [sets[i] for i in tile], 0.78)
        same = len({blocks[i] for i in tile}) == 1
        want = {(x, y) for x in tile for y in tile if x < y and (same or blocks[x] != blocks[y]) and len(set(sets[x]) & set(sets[y])) >= 0.78 * len(set(sets[x]) | set(sets[y]))}
        assert {(x - 100, y - 100) for x, y in zip(a, b, strict=True)} <= want and want

        def groups(pairs):
            label = {i: i for i in tile}
            for _ in tile:
                for x, y in pairs:
                    label[x] = label[y] = min(label[x], label[y])
            return label

        assert groups(want) == groups([(x - 100, y - 100) for x, y in zip(a, b, strict=True)])


def test_signatures_estimate_probability_jaccard():
    random = np.random.default_rng(5)
    elements = np.sort(random.integers(1, 1 << 62, 300, dtype=np.uint64))
    weights = np.zeros((2, 300))
    weights[0, :200], weights[1, 100:] = random.integers(1, 4, 200), random.integers(1, 4, 200)
    x, y = weights
    exact = sum(1 / np.maximum(x / x[d], y / y[d]).sum() for d in range(100, 200))
    row, column = np.nonzero(weights)
    got = neardup.signatures(row, elements[column], weights[row, column], 2, 20_000)
    assert abs((got[0] == got[1]).mean() - exact) < 0.02


@given(st.lists(st.text(alphabet="ab \t\n\x0b\x0c\r\x1c\x85é", max_size=30), max_size=6))
@settings(max_examples=100, deadline=None)
def test_word_hashes_follow_the_words(texts):
    raw = [t.encode() for t in texts]
    if not raw:
        return
    hashes, counts = word_hashes(raw)
    words = [w for t in raw for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in raw]
    by_word = defaultdict(set)
    for w, h in zip(words, hashes.tolist(), strict=True):
        by_word[w].add(h)
    assert all(len(v) == 1 for v in by_word.values()) and len({v for s in by_word.values() for v in s}) == len(by_word)
    owner, _, weight = shingles(hashes, counts, 3)
    want = [Counter(tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))) if (w := t.split()) else Counter() for t in raw]
    assert [sorted(weight[owner == i].tolist()) for i in range(len(raw))] == [sorted(c.values()) for c in want]


def test_batches_cover_everything():
    import pyarrow as pa

    texts = ["", "é" * 5, "x" * 3_000_000, None, "y", ""]
    ranges = list(text_ranges(pa.array(texts), size=8))
    assert [i for lo, hi, _ in ranges for i in range(lo, hi)] == list(range(6))
    assert [t for _, _, part in ranges for t in part] == [(t or "").encode() for t in texts]


def similar(a: str, b: str) -> float:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return 1 - row[-1] / max(len(a), len(b), 1)


def test_line_dedup_against_brute_force(spark):
    random = np.random.default_rng(3)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)]
    base = [" ".join(random.choice(vocabulary, 60)) for _ in range(12)]
    rows = []
    for d in range(60):
        line = base[d % 12].split(" ")
        if d >= 12:
            line[int(random.integers(60))] = vocabulary[int(random.integers(300))]
        rows.append((d, " ".join(line).title() + "!\n" + " ".join(random.choice(vocabulary, 9)) + "\n\n12/05\nsame line everywhere"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    normal, first = {}, {}
    for d, text in rows:
        for n, line in enumerate(lines.normalised(text.encode()).split(b"\n")):
            words = b" ".join(line.split())
            if words:
                normal[d, n] = words
                first.setdefault(words, (d, n))
    distinct = list(first)
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(distinct)):
        for j in range(i):
            if similar(distinct[i].decode(), distinct[j].decode()) >= lines.SIMILARITY:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    keep = {}
    for i, words in enumerate(distinct):
        keep[find(i)] = min(keep.get(find(i), (1 << 60, 0)), first[words])
    place = {w: i for i, w in enumerate(distinct)}
    want = {at for at, words in normal.items() if keep[find(place[words])] != at}
    got = {(r.id, r.line_no) for r in lines.dropped_lines(docs).collect()}
    assert got == want and len({find(i) for i in range(len(distinct))}) < len(distinct)


LETTERS = list("abcdefghijklmnop")


def changed_pairs(kind, words, random, count=150):
    """Pairs of a random line of so many words and a copy changed as ``kind`` says, similar enough to be linked."""
    vocabulary = ["".join(random.choice(LETTERS, int(random.integers(3, 9)))) for _ in range(3000)]
    out = []
    while len(out) < count:
        line = list(random.choice(vocabulary, words))
        if kind == "word":
            other = list(line)
            other[int(random.integers(words))] = vocabulary[int(random.integers(3000))]
            a, b = " ".join(line), " ".join(other)
        else:
            a = " ".join(line)
            b = list(a)
            for at in random.choice(len(a), max(1, round(len(a) * kind)), replace=False):
                b[int(at)] = str(random.choice(LETTERS))
            b = " ".join("".join(b).split())
        if a != b and similar(a, b) >= lines.SIMILARITY:
            out.append((a, b))
    return out


# Least share of similar pairs that must be linked, by kind of change (share of characters, or one word) and words of the line. They lie a little
# under what was measured, so they only catch a loss; the README gives the measured figures and says which kinds stay below 0.9.
RECALL = [(0.001, 3, 0.60), (0.001, 5, 0.70), (0.001, 8, 0.80), (0.001, 12, 0.90), (0.001, 30, 0.80), (0.001, 60, 0.93), (0.05, 8, 0.50), (0.05, 12, 0.45), (0.02, 30, 0.25), ("word", 12, 0.80), ("word", 30, 0.85), ("word", 60, 0.93), ("word", 90, 0.95)]


def test_recall_of_the_blocks_by_kind_of_line(spark):
    random = np.random.default_rng(12)
    rows, found = [], {}
    for k, (kind, words, _) in enumerate(RECALL):
        for i, (a, b) in enumerate(changed_pairs(kind, words, random)):
            n = 2 * (1000 * k + i)
            rows += [(n, a), (n + 1, b)]
    got = {(r.id, r.line_no) for r in lines.dropped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (kind, words, least) in enumerate(RECALL):
        pairs = [n for n, _ in rows if n // 2000 == k and n % 2 == 0]
        found[kind, words] = sum((n + 1, 0) in got for n in pairs) / len(pairs)
    assert all(found[kind, words] >= least for kind, words, least in RECALL), found
    assert not any(n % 2 == 0 for n, _ in got)


def test_recall_where_up_to_a_tenth_of_the_words_change(spark):
    # Min-hash bands over word pairs, the method of the round before, linked 0.98 of these; SimHash blocks link about 0.8.
    random = np.random.default_rng(12)
    vocabulary = ["".join(random.choice(LETTERS, int(random.integers(3, 9)))) for _ in range(4000)]
    rows = []
    for k in range(150):
        words = list(random.choice(vocabulary, int(random.integers(15, 96))))
        other = list(words)
        for at in random.choice(len(words), int(random.integers(1, max(2, len(words) // 10 + 1))), replace=False):
            other[int(at)] = vocabulary[int(random.integers(4000))]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    want = {(b[0], 0) for a, b in zip(rows[::2], rows[1::2], strict=True) if similar(a[1], b[1]) >= lines.SIMILARITY}
    got = {(r.id, r.line_no) for r in lines.dropped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= want and len(got) >= 0.70 * len(want)


def test_rows_that_share_an_id_are_cut_one_by_one(spark):
    rows = [(1, "alone in the first text\nseen again elsewhere"), (1, "seen again elsewhere\nonly in the second text"), (None, "seen again elsewhere\nno id here"), (None, "no id here"), (2, None)]
    out = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = sorted(str(r.text) for r in out)
    assert len(out) == 5 and sum("seen again elsewhere" in t for t in texts) == 1 and sum("no id here" in t for t in texts) == 1
    assert any("alone in the first text" in t for t in texts) and any("only in the second text" in t for t in texts)


@pytest.mark.parametrize("small", [64, 2])
def test_members_of_a_bucket_meet_across_batches(monkeypatch, small):
    import pyarrow as pa

    monkeypatch.setattr(lines, "SMALL", small)
    random = np.random.default_rng(4)
    centres = random.integers(0, 1 << 62, 5)
    rows = sorted({(int(random.integers(14)), k): int(centres[random.integers(5)]) ^ (1 << int(random.integers(60))) for k in range(80)}.items())
    near = lambda x, y: bin(x ^ y).count("1") <= lines.FAR_64
    marks = {item: mark for (_, item), mark in rows}
    buckets = defaultdict(list)
    for (bucket, item), _ in rows:
        buckets[bucket].append(item)
    need = {(b, i) for b, held in buckets.items() for i in held if any(near(marks[i], marks[j]) for j in held if j != i)}
    for size in (1, 2, 3, 7, 100):
        chunks = [rows[k : k + size] for k in range(0, len(rows), size)]
        parts = [pa.RecordBatch.from_arrays([pa.array([x[0][0] for x in c], type=pa.int64()), pa.array([x[0][1] for x in c], type=pa.int64()), pa.array([x[1] for x in c], type=pa.int64())], ["bucket", "item", "mark"]) for c in chunks]
        got = [tuple(x.values()) for p in lines._meet_pass(iter(parts)) for x in p.to_pylist()]
        assert len({(b, i) for b, _, i in got}) == len(got) and need <= {(b, i) for b, _, i in got}
        assert all(hub == item or near(marks[hub], marks[item]) for _, hub, item in got)
        # Every member but the first of its near ones comes with another hub.
        assert all(any(h != i for c, h, i in got if c == b) for b, _ in need)


def test_majority_and_edit_distance_equal_plain_counts():
    random = np.random.default_rng(6)
    counts = np.array([1, 2, 5, 40, 129])
    hashes = random.integers(0, 1 << 63, counts.sum()).astype(np.uint64)
    at = 0
    for got, n in zip(lines.majority(hashes, counts), counts.tolist(), strict=True):
        bits = np.unpackbits(lines.mix(hashes[at : at + n][:, None] ^ lines._SEEDS).view(np.uint8).reshape(n, -1), axis=1).sum(axis=0)
        assert (np.packbits(bits > n // 2).view(np.uint64) == got).all()
        at += n
    for _ in range(200):
        a, b = ("".join(random.choice(list("ab c"), int(random.integers(0, 20)))) for _ in range(2))
        exact = round((1 - similar(a, b)) * max(len(a), len(b), 1))
        assert lines.edit_distance(a, b, 99) == exact and (lines.edit_distance(a, b, 3) > 3) == (exact > 3)
        assert lines.similar(a, b, 0.8) == (exact <= int(0.2 * max(len(a), len(b)) + 1e-9))


def test_line_dedup_cases(docs, empty):
    out = lines.dedup_lines(docs)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == len(ROWS)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert [r.text for r in by_id[1]] == [BASE, BASE] and by_id[2][0].text == "" and by_id[None][0].text == ""
    assert by_id[6][0].text is None and by_id[6][0].n_lines == 0 and by_id[8][0].text == " \t\n" and by_id[10][0].text == ""
    assert by_id[13][0].text.split("\n")[0] == "" or OTHER not in by_id[13][0].text
    assert by_id[14][0].n_removed == 1 and by_id[14][0].text.startswith("fresh words")
    assert all(r.item == "clash" and r.key == 1 and r._gone == 2 for r in rows)
    assert lines.dedup_lines(empty).count() == 0


def test_common_ends():
    assert lines.common_ends("abcde", "abxde") == (2, 2) and lines.common_ends("aaa", "aa") == (2, 0) and lines.common_ends("", "x") == (0, 0)
    assert lines.common_ends("same", "same") == (4, 0)


def test_quick_bound_is_above_the_edit_distance():
    random = np.random.default_rng(9)
    for _ in range(300):
        a = [str(w) for w in random.choice(["a", "bc", "def", "ghij"], int(random.integers(1, 9)))]
        b = [w for w in a if random.random() < 0.8] + [str(w) for w in random.choice(["a", "xyz"], int(random.integers(0, 3)))]
        x, y = " ".join(a), " ".join(b)
        assert lines.edits_at_most(x, y) >= round((1 - similar(x, y)) * max(len(x), len(y), 1))
    assert lines.edits_at_most("a b c d", "a c d") == 2 and lines.edits_at_most("a b c", "a xx c") == 2 and lines.edits_at_most("q", "q") == 0


def test_rule_measures():
    text = "a b c a b c d\n\na b\nx#y $ <|\na b\n" + "LOUD!! " * 3
    n, chars, symbols, dup, repeated, *_ = rules.measure(text)
    words = text.split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    assert (n, chars, symbols, dup, repeated) == (len(words), sum(map(len, words)), 4, 1, len(marked))
    assert rules.measure("") == (0,) * 10 and rules.measure("  é")[:2] == (2, 2)


def test_rule_ledger_policies_and_ablations(docs, empty):
    book = rules.ledger(docs).cache()
    assert book.count() == len(ROWS) and rules.ledger(empty).count() == 0
    verdicts = {r.doc_id: r for r in rules.apply_policy(book, "v2").collect()}
    assert verdicts[1].kept and not verdicts[6].kept and verdicts[6].base_failed and not verdicts[12].kept
    table = {r.rule: r for r in rules.ablations(book, "v2").collect()}
    bits = [r.fail_bits for r in book.collect()]
    for i, rule in enumerate(rules.rules()):
        assert table[rule].failed == sum(b >> i & 1 for b in bits) and table[rule].failed_alone == sum(b == 1 << i for b in bits)
        assert table[rule].rejected_without == sum(b & ~(1 << i) != 0 for b in bits)


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.WordTokenizer(tokens.vocabulary_path())


@given(st.text(alphabet=st.one_of(st.sampled_from(list("abcXYZ 0129'`.,<|>_-ÀéßµªºÖ×²½­ \u0085 \t\n\x0b\x1c\x1f\x00日한🙂éİſẞΣς‍﻿")), st.characters(codec="utf-8")), max_size=20))
@settings(max_examples=400, deadline=None)
def test_tokens_equal_the_library(text):
    tokenizer = tokens.worker(tokens.vocabulary_path(), tokens.Encoder).tokenizer
    for body in (text, f"{text}<|endoftext|>x {text}'s"):
        want = tokenizer.library.encode(body, add_special_tokens=False).ids
        assert np.frombuffer(tokens.worker(tokens.vocabulary_path(), tokens.Encoder)(body), dtype="<u4").tolist() == want
        assert tokens.worker(tokens.vocabulary_path(), tokens.Counter)(body) == len(want)


def test_whole_tokens_are_proven(tokenizer):
    proven = tokens.whole_tokens(tokenizer)
    assert len(proven) > 30_000
    assert all(len(e.ids) == 1 for e in tokenizer.library.encode_batch(sorted(proven), add_special_tokens=False))


def test_token_counts(docs, empty, tokenizer):
    found = tokens.token_counts(docs).collect()
    want = Counter((r[0], len((r[1] or "").encode()), len(tokenizer.library.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in found) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in found) and tokens.token_counts(empty).count() == 0


def test_lower_bound_and_best_fit():
    random = np.random.default_rng(7)
    for _ in range(60):
        lengths = random.integers(1, 101, int(random.integers(1, 40)))
        bins, offsets = packing.best_fit_decreasing(lengths, 100)
        used = np.bincount(bins, weights=lengths)
        assert used.max() <= 100 and packing.lower_bound(lengths, 100) <= len(used)
        for b in range(len(used)):
            inside = sorted(zip(offsets[bins == b], lengths[bins == b], strict=True))
            assert [o for o, _ in inside] == np.concatenate(([0], np.cumsum([n for _, n in inside])[:-1])).tolist()
    assert packing.lower_bound(np.array([51] * 7), 100) == 7 and packing.lower_bound(np.array([34] * 6), 100) == 3


def test_packing_is_whole(docs, empty, tokenizer):
    pieces = packing.token_pieces(docs, keep_ids=True)
    rows = packing.pack(pieces, part=4).collect()
    whole = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4 * 2048
        whole[r.doc_id].append(r)
    for doc_id, text in {(r[0], r[1]) for r in ROWS if r[0] not in (1, None)}:
        ids = b"".join(r.ids for r in sorted(whole[doc_id], key=lambda r: r.piece))
        assert np.frombuffer(ids, dtype="<u4").tolist() == [*tokenizer.library.encode(text or "", add_special_tokens=False).ids, 0]
        assert [r.start for r in sorted(whole[doc_id], key=lambda r: r.piece)] == list(range(0, len(ids) // 4, 2048))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(held, held[1:], strict=False)) and held[0][0] == 0 and sum(held[-1]) <= 2048
    assert len(rows) == pieces.count() and len(sequences) <= -(-sum(r.length for r in rows) // 2048) + 1
    assert packing.pack(packing.token_pieces(empty)).count() == 0


def test_mix_meets_targets(spark, docs, empty):
    got = mixing.systematic_copies(docs).collect()
    assert len(got) == len(ROWS) and all(r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in got)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.systematic_copies(table).collect()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    total = sum(r.size for r in rows)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by_source))}
    target, left = {}, dict(weights)
    while True:
        share = {s: (1.5 * total - sum(target.values())) * w / sum(left.values()) for s, w in left.items()}
        over = [s for s in left if share[s] >= 2 * by_source[s][0].source_size]
        if not over:
            break
        for s in over:
            target[s] = 2 * by_source[s][0].source_size
            del left[s]
    target |= share
    for s, held in by_source.items():
        assert held[0].source_size == sum(r.size for r in held) and abs(held[0].target - target[s]) < 1e-6 * total
        assert abs(sum(r.taken for r in held) - held[0].target) <= max(r.size for r in held) + 2
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.systematic_copies(table.repartition(5)).collect()))
    assert mixing.systematic_copies(empty).count() == 0


def test_mix_repeats_rows(docs, empty):
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in mixing.systematic_copies(docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +want
    assert mixing.mix(empty).count() == 0


def test_shards_are_even_and_prune(docs, empty, spark):
    rows = sharding.hilbert_shards(docs, shards=5).collect()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(5))
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    assert sharding.hilbert_shards(empty).count() == 0
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bounds = sharding.shard_bounds(sharding.hilbert_shards(table)).collect()
    assert sum(b.lang_min <= "fr" <= b.lang_max for b in bounds) < 0.7 * len(bounds)
    assert sum(b.n_chars_max >= 20_000 for b in bounds) < 0.5 * len(bounds)


def test_hilbert_index_is_a_curve(spark):
    from pyspark.sql import functions as F

    grid = spark.range(512).select((F.col("id") % 8).alias("x"), (F.floor(F.col("id") / 8) % 8).alias("y"), F.floor(F.col("id") / 64).alias("z"))
    path = grid.withColumn("h", sharding.hilbert_index([F.col("x"), F.col("y"), F.col("z")], 3)).orderBy("h").collect()
    assert [r.h for r in path] == list(range(512))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1 for a, b in zip(path, path[1:], strict=False))


def test_words_of_long_texts():
    text = b"long " * 400_000
    hashes, counts = word_hashes([text, b"", b"long"])
    assert counts.tolist() == [400_000, 0, 1] and len(set(hashes.tolist())) == 1


def test_packing_encodes_a_few_texts_at_a_time(tokenizer):
    import pyarrow as pa

    texts = pa.RecordBatch.from_pydict({"doc_id": list(range(600)), "text": ["one two", None, ""] * 200})
    found = [b for keep in (False, True) for b in packing._piece_pass(tokens.vocabulary_path(), 2048, keep)(iter([texts]))]
    assert max(b.num_rows for b in found) <= packing.TEXTS and [c for b in found for c in b.column(0).to_pylist()] == 2 * list(range(600))
    kept = [r for b in found if "ids" in b.schema.names for r in b.to_pylist()]
    assert len(kept) == 600 and all(len(r["ids"]) == 4 * r["length"] for r in kept)


def test_packed_bucket_rows_meet_as_single_rows_do(monkeypatch):
    rng = np.random.default_rng(5)
    n = 400
    sims = rng.integers(0, 1 << 63, (n, 2 * lines.WORDS64), dtype=np.uint64)
    sims[100:300] = sims[50]  # one bucket of many near lines a block
    sims[300:] = sims[rng.integers(0, 40, 100)]
    lengths, words, items = np.full(n, 60), rng.integers(3, 20, n), np.arange(n) + (7 << 33)
    bucket, row, mark = lines.bucket_rows(sims, lengths, words, 0.8)
    order = np.lexsort((row, bucket.view(np.int64)))
    plain = pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)[order]), pa.array(items[row[order]]), pa.array(mark.view(np.int64)[order])], ["bucket", "item", "mark"])
    want = sorted(tuple(x.values()) for p in lines._meet_pass(iter([plain])) for x in p.to_pylist())
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in (items, lengths, words, *sims.view(np.int64).T)], ["item", "length", "words", *lines._SIMS])
    for held, size in ((1 << 22, 1 << 14), (500, 64)):  # the second relieves large buckets on the way
        monkeypatch.setattr(lines, "HELD", held)
        monkeypatch.setattr(lines, "SLICE", size)
        dealt = sorted((tuple(x.values()) for p in lines._deal_pass(0.8, 3)(iter([whole])) for x in p.to_pylist()), key=lambda x: x[:2])
        assert len(dealt) < len(bucket) / 20  # few rows are shuffled, not one a bucket
        packs = pa.RecordBatch.from_pylist([dict(zip(("part", "lo", "buckets", "offsets", "marks"), x, strict=True)) for x in dealt])
        got = sorted(tuple(x.values()) for p in lines._gather_pass(iter([packs])) for x in p.to_pylist())
        assert want and got == want


def test_edit_distances_of_many_pairs_equal_one_by_one():
    rng = np.random.default_rng(8)
    left = ["".join(rng.choice(list("ab é你"), rng.integers(1, 200))) for _ in range(120)]
    right = ["".join(c for c in x if rng.random() > 0.1) + "b" * int(rng.integers(0, 9)) for x in left]
    assert lines.edit_distances(left, right).tolist() == [lines.edit_distance(a, b, 999) for a, b in zip(left, right, strict=True)]
    known = lines.similar_short(left + [""], right + ["a"], 0.8).tolist()
    assert all(k < 0 or bool(k) == lines.similar(a, b, 0.8) for k, a, b in zip(known, left + [""], right + ["a"], strict=True)) and 1 in known and 0 in known


def test_later_links_join_whole_groups(spark):
    from gaugework.llm.linking import components, merged

    first = [(1, 2), (2, 3), (10, 11), (20, 21), (30, 31)]
    later = [(3, 11), (21, 40), (50, 51)]
    groups = components(spark.createDataFrame(first, "a long, b long"))
    got = {tuple(r) for r in merged(groups, spark.createDataFrame(later, "a long, b long")).collect()}
    assert got == {tuple(r) for r in components(spark.createDataFrame(first + later, "a long, b long")).collect()}
