"""Pages, toxicity, vectors and the pipeline on small tables with every awkward case."""

from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from gaugework.llm import html, packing, toxicity, vectors
from gaugework.llm.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Home</a></li></ul></nav><!-- ad 3 --><div class="top ad">Buy now</div><article><header>by me</header><h1>Title&nbsp;here</h1>
<p><b>Bold   start &lt;x&gt;<br><p>Second
 block, <i>in</i>line</p><div class="related-links">more</div><form><p>Your mail</p></form><section id="comments"><p>First!</p></section>
<table><tr><td>a</td><td>b</td></tr></table><p hidden>secret</p>tail</article><aside>side</aside><footer>&copy; us</footer></body></html>"""


def test_article_blocks():
    blocks = html.page_blocks(PAGE)
    assert [t for z, t in blocks if z == html.MAIN] == ["Title here", "Bold start <x>", "Second block, inline", "a b", "tail"]
    assert html.page_blocks(None) == [] and html.page_blocks("") == []
    assert html.page_blocks("<p>cut off &am") == [(html.OPEN, "cut off &am")]


ARTICLE = "<article><h1>Head</h1><p>Body text</p></article>"


@pytest.mark.parametrize("page", [
    f'<html class="js-nav"><body class="has-sidebar">{ARTICLE}</body></html>', f'<body class="comments-open">{ARTICLE}</body>', f'<div class="no-header">{ARTICLE}</div>', f"<form><nav>menu</nav>{ARTICLE}<p>send</p></form>",
    f"<aside><p>side</p>{ARTICLE}", '<article class="promo-story"><h1>Head</h1><p>Body text</p></article>', f'<main id="sidebar-main">{ARTICLE}</main>', f'<div class="sidebar"><article class="teaser">other</article></div>{ARTICLE}',
    f'<div class="site-header"><p>name</p></div>{ARTICLE}<div class="cookie-banner">ok?</div>', '<form><article><h1>Head</h1><p>Body text</p><form><p>mail</p></form><section class="comments"><article>First!</article></section></article></form>',
])
def test_frames_around_the_article_do_not_hide_it(page):
    assert [t for z, t in html.page_blocks(page) if z == html.MAIN] == ["Head", "Body text"]


def test_slugs_are_no_names_and_forms_alone_have_no_text():
    assert [t for z, t in html.page_blocks('<article><section id="notice-of-change"><p>Kept</p></section><div class="share-bar">x</div></article>') if z == html.MAIN] == ["Kept"]
    assert all(z == html.NEVER for z, _ in html.page_blocks("<form><p>Your mail</p></form><aside>x</aside>"))


@pytest.mark.parametrize("n", range(21))
def test_hosts_of_few_tokens(n):
    block = [f"t{i}" for i in range(n)]
    assert [r.tolist() for r in html.repeated_tokens([[block]])] == [[False] * n]
    assert [r.tolist() for r in html.repeated_tokens([[block], [block, ["x"]]])] == [[n > 0] * n, [n > 0] * n + [False]]


def test_repeated_runs_equal_brute_force():
    random = np.random.default_rng(2)
    shared = [f"s{i}" for i in range(30)]
    pages = []
    for k in range(12):
        own = [f"t{v}" for v in random.integers(0, 6, int(random.integers(0, 40)))]
        at = int(random.integers(0, len(own) + 1))
        pages.append([own[:at] + (shared[: int(random.integers(3, 30))] if k % 2 else []) + own[at:], [f"t{k % 3}"]])
    run = 5
    runs = lambda block: [tuple(block)] if len(block) < run else [tuple(block[i : i + run]) for i in range(len(block) - run + 1)]
    where = defaultdict(set)
    for p, page in enumerate(pages):
        for block in page:
            for r in runs(block):
                where[r].add(p)
    got = html.repeated_tokens(pages, run)
    for p, page in enumerate(pages):
        want = []
        for block in page:
            marks = [False] * len(block)
            for i, r in enumerate(runs(block)):
                if len(where[r]) > 1:
                    marks[i : i + len(r)] = [True] * len(r)
            want += marks
        assert got[p].tolist() == want


def test_undecided_blocks_lose_repeated_runs(spark):
    common = "one two three four five six seven eight nine ten"
    rows = [(i, "http://h.example/" + str(i), f"<div>{common}</div><div>only page {i} says this</div><p>{common} then {i}</p>", "extra") for i in range(4)]
    rows += [(9, None, None, "extra"), (10, "not a url", "", "extra"), (11, "http://h.example/11", PAGE, "extra"), (11, "http://h.example/11", PAGE, "extra")]
    out = html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()
    assert len(out) == len(rows)
    texts = defaultdict(list)
    for r in out:
        texts[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert texts[2] == ["only page 2 says this\n2"] and texts[9] == texts[10] == [""]
    assert texts[11] == ["Title here\nBold start <x>\nSecond block, inline\na b\ntail"] * 2
    assert html.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_copies_of_a_page_do_not_erase_each_other(spark):
    body = "<div>one two three four five six seven eight nine ten eleven</div>"
    rows = [(1, "http://h.example/1", body), (1, "http://h.example/1", body), (2, "http://h.example/2", body), (3, "http://h.example/3", "<div>other words here</div>")]
    out = html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    whole = ("one two three four five six seven eight nine ten eleven", 0)
    assert Counter((r.page_id, r.text, r.n_repeated_tokens) for r in out) == Counter({(1, *whole): 2, (2, *whole): 1, (3, "other words here", 0): 1})


def test_runs_of_a_whole_host_are_found(spark):
    # Two pages share a run, 700 apart; page 0 stands there again on another host, where nothing repeats it.
    pages = {i: [f"own {i} words {i * 7} of {i * 11} page", " ".join(f"s{i % 700}x{k}" for k in range(9)) + f" end{i}", "short one"] for i in range(1400)}
    page = lambda i: "".join(f"<div>{block}</div>" for block in pages[i])
    rows = [(i, f"http://big.example/{i}", page(i)) for i in pages] + [(5000, "http://other.example/0", page(0)), (5001, "http://OTHER.example/1", page(0))]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    got = {r.page_id: (r.text, r.n_repeated_tokens) for r in html.extract_main_text(table).collect()}
    covered = html.repeated_tokens([[block.split(" ") for block in pages[i]] for i in pages])
    assert len(got) == len(rows) and all(got[i] == (f"{pages[i][0]}\nend{i}", int(covered[i].sum())) for i in pages)
    assert got[5000] == got[5001] == ("\n".join(pages[0]), 0)


def test_pages_equal_their_articles(spark):
    import html as entities
    import re

    table = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r.page_id: r.text for r in html.extract_main_text(table).collect()}
    for r in table.collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?p>|</?h1>|<br>", body)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def labelled(spark):
    random = np.random.default_rng(11)
    mild = [f"calm{i}" for i in range(200)]
    rude = ["nastyword", "vileterm", "grufix", "grufola", "grufend"]
    rows, labels = [], []
    for d in range(900):
        words = list(random.choice(mild, 30))
        toxic = d % 4 == 0
        if toxic:
            for w in random.choice(rude, 3):
                words[int(random.integers(30))] = w
        if d % 5 == 0 or (toxic and d % 3 == 0):
            words[0] = "muslims" if d % 2 else "women"  # named more often in toxic texts
        rows.append((d, " ".join(words).capitalize(), "xx"))
        labels.append((d, int(toxic), 1))
    rows += [(2000, "", "xx"), (2001, None, "xx"), (None, "calm1 nastyword grufab vileterm", "xx"), (2002, "Refugees and jews calm1 calm2.", "xx"), (2002, "Refugees and jews calm1 calm2.", "xx")]
    labels += [(2005, 1, None), (None, 1, 1), (3, None, 1), (0, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_toxicity_held_out_and_counterfactuals(labelled):
    docs, labels = labelled
    found = toxicity.score_documents(docs, labels).collect()
    assert len(found) == docs.count()
    truth = {d: int(d % 4 == 0) for d in range(900)}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    by_id = {r.doc_id: r for r in found}
    assert by_id[2000].score == by_id[2001].score < 0.5 and by_id[2002].predicted == 0 and by_id[None].predicted == 1
    assert by_id[None].held_out and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    score = toxicity.train(docs, labels).scorer()
    free = toxicity.train(docs, labels, penalty=0.0).scorer()
    texts = [" ".join(f"calm{i + j}" for j in range(12)) for i in range(30)]
    gap = lambda s: np.mean([abs(s(f"{t} {term}") - s(t)) for t in texts for term in ("women", "muslims", "jews")])
    assert gap(score) <= gap(free) and gap(score) < 0.02
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in found if not r.predicted)


def test_repeated_ids_weigh_once(spark, labelled):
    docs, labels = labelled
    again = docs.where("doc_id in (7, 8)").crossJoin(spark.range(300)).drop("id")
    model, more = toxicity.train(docs, labels), toxicity.train(docs.unionByName(again), labels)
    assert more.bias == pytest.approx(model.bias, abs=1e-6) and more.weights == pytest.approx(model.weights, abs=1e-6)


def test_toxicity_without_labels_or_documents(spark, labelled):
    docs, labels = labelled
    assert {r.predicted for r in toxicity.score_documents(docs, labels.where("false")).collect()} == {0}
    assert toxicity.score_documents(docs.where("false"), labels).count() == 0


def test_swaps_stay_in_their_row():
    words, changed = toxicity.swapped(["the", "women", "and", "refugees"], 5)
    rows = [r for r in toxicity.IDENTITY_TERMS if "women" in r or "refugees" in r]
    assert words[1] != changed[1] in rows[0] and words[3] != changed[3] in rows[1] and changed[::2] == words[::2]
    words, changed = toxicity.swapped(["plain"], 12)
    assert changed[:1] == words and any(changed[1] in r for r in toxicity.IDENTITY_TERMS)


def test_quantisation_bounds_hold():
    random = np.random.default_rng(4)
    rows = random.normal(size=(200, 48)) * np.exp(random.normal(size=(200, 1)))
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    codes, scale, error = vectors.quantise(unit)
    assert (np.linalg.norm(unit - codes * scale[:, None], axis=1) <= error).all()
    gap = np.abs(unit @ unit.T - scale[:, None] * scale[None, :] * (codes.astype(int) @ codes.astype(int).T))
    assert (gap <= (1 + error)[:, None] * error[None, :] + error[:, None] + 1e-12).all()


def test_vectors_equal_brute_force(spark):
    random = np.random.default_rng(8)
    base = random.normal(size=(40, 16))
    rows = [(i, (base[i % 40] + random.normal(size=16) * random.choice([0.0, 0.1, 0.25, 0.45])).astype(np.float32).tolist(), i) for i in range(160)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)]
    odd = [(500, None), (501, []), (502, [0.0] * 16), (503, [1.0] * 15 + [None]), (504, [1.0] * 15 + [float("nan")]), (505, [1.0] * 15 + [float("inf")]), (506, [1.0] * 3), (506, [1.0] * 3), (507, [2.0] * 3), (None, [-1.0] * 3)]
    table = spark.createDataFrame(rows + [(i, v, 0) for i, v in odd], "vec_id long, embedding array<float>, item int").repartition(3)
    got = defaultdict(list)
    for r in vectors.near_vectors(table, tile=32).collect():
        got[r.vec_id].append((r.n_links, r.component_id, r.kept))
    points = np.array([r[1] for r in rows], dtype=np.float64)
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    component = list(ids)
    while True:
        after = [min([component[i], *[component[j] for j in np.flatnonzero(near[i])]]) for i in range(len(ids))]
        if after == component:
            break
        component = after
    for i, vec_id in enumerate(ids):
        assert got[vec_id] == [(int(near[i].sum()), component[i], component[i] == vec_id)]
    assert all(got[i] == [(0, i, True)] for i in range(500, 506))
    assert got[506] == [(2, 506, True)] * 2 and got[507] == [(2, 506, False)] and got[None][0][0] == 0
    assert vectors.near_vectors(table.where("false")).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, FOLDER).cache()
        if name != "packing":
            assert after.columns == columns and dict(after.dtypes) == dict(docs.dtypes)
        ids = Counter(r.doc_id for r in after.select("doc_id").collect())
        if name == "toxicity":
            scores = {r.doc_id: r.predicted for r in toxicity.score_documents(before, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
            assert ids == Counter(d for d, p in scores.items() if not p)
        elif name == "line_dedup":
            assert ids == Counter(r.doc_id for r in before.select("doc_id").collect())
            seen = Counter(" ".join(line.lower().split()) for r in after.collect() for line in r.text.split("\n") if any(c.isalnum() for c in line))
            assert max(seen.values()) == 1 and all(r.n_chars == len(r.text) for r in after.collect())
        elif name == "near_dedup":
            assert max(ids.values()) == 1 and len(set(r.text for r in after.collect())) == after.count()
        elif name == "mixing":
            assert max(ids.values()) <= 2
        before = after
    assert before.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= packing.LIMIT
    assert corpus_pipeline.run(spark, FOLDER).count() == before.count()


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0


def test_registered_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    from check_sql import TABLES, differences

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert differences(QUERIES[name](spark, FOLDER).toPandas(), con.execute(SQL[name]).df()) is None
