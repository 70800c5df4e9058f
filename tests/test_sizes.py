"""Results of operators that must not pair, copy or repeat more than their input, against plain rules."""

import random
import re
import unicodedata
from datetime import date

from pyspark.sql import functions as F

from gaugework.catalog import QUERIES
from gaugework.functions import text as tx
from gaugework.operators import facts as fo
from gaugework.operators import people as pe
from gaugework.operators import text as texts


def test_organisations_meet_on_whole_beginnings_only(spark):
    rng = random.Random(18)
    words = ["Acme", "Tools", "Group", "North", "Inc"]
    phrase = lambda: " ".join(["Supplier"] + [rng.choice(words) for _ in range(rng.randrange(4))])
    companies = [(f"T{i:03d}", phrase() + rng.choice(["", ".", " -"])) for i in range(25)] + [("T999", None), (None, "Lone Title"), ("T998", " - ")]
    names = sorted({phrase() + rng.choice(["", "!"]) for _ in range(120)} | {"Lone", "Supplier", "North College", "", "Nick"})
    tidy = lambda t: re.sub("[^a-z0-9]+", " ", t.lower()).strip()
    aliases = [("nick", "Lone Title")]
    want = {}
    for name in names:
        n = {tidy(a): tidy(t) for a, t in aliases}.get(tidy(name), tidy(name))
        hits = [(k, t) for k, t in companies if t is not None and tidy(t) and n and (n == tidy(t) or tidy(t).startswith(n + " ") or n.startswith(tidy(t) + " "))]
        want[name] = hits[0] if len(hits) == 1 else (None, None)
    assert sum(t is not None for _, t in want.values()) >= 2
    got = pe.resolve_organizations(
        spark.createDataFrame([(n,) for n in [*names, None]], "name string"), spark.createDataFrame(companies, "ticker string, title string"), spark.createDataFrame(aliases, "alias string, title string"),
    )
    assert {r.name: (r.ticker, r.matched_title) for r in got.collect()} == want | {None: (None, None)}
    # A condition beside the equal keys would mean that all names and titles of one first word are paired.
    assert "StartsWith" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_company_name_is_worked_out_once_and_as_before(spark):
    def before(text):
        """The rule with a condition, which repeated everything under it."""
        t = F.regexp_replace(F.regexp_replace(text, tx.R.SECURITY_WORDS, ""), r"\s+", " ")
        t = F.regexp_replace(t, r"^[ ,.-]+|[ ,.-]+$", "")
        for _ in range(3):
            t = F.regexp_replace(F.regexp_replace(t, tx.R.LEGAL_SUFFIX, ""), r"^[ ,.-]+|[ ,.-]+$", "")
            t = F.when(t.contains("."), t).otherwise(F.regexp_replace(t, r"(?i)\s+Group$", ""))
        return F.coalesce(F.nullif(t, F.lit("")), F.trim(text))

    names = ["Acme Group plc", "Acme  Tools GROUP Ltd.", "A.B. Group Inc", "Group", " Group Group ", "Acme.com Group", "Inc", " Ltd ", "", None, "Large ring Group Holdings plc Group", "Acme\nGroup", "X ADR Group", "Acme Group Online"]
    rows = spark.createDataFrame([(n,) for n in names], "name string").select("name", tx.company_name(F.col("name")).alias("now"), before(F.col("name")).alias("before"))
    assert [r.now for r in rows.collect()] == [r.before for r in rows.collect()]
    plan = spark.createDataFrame([("a", "b")], "name string, text string").select(tx.brand_match(F.col("name"), F.col("text")).alias("b"), tx.legal_match(F.col("name"), F.col("text")).alias("l"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Depositary") == 2  # once in each match


def test_company_matches_equal_plain_rules(spark):
    """The rules written as loops over one name, on names and texts in other scripts' forms and with many suffixes."""
    folded = lambda t: "".join(re.findall("[a-z0-9]+", unicodedata.normalize("NFKC", t).casefold()))
    strip = lambda t: t.strip(" ,.-")

    def short(name):
        name, last = strip(re.sub(r"\s+", " ", unicodedata.normalize("NFKC", name))), None
        while name != last:
            last = name
            name = strip(re.sub(r"(?i)[\s,.-]+(?:incorporated|inc|corporation|corp|limited|ltd|plc|holdings|holding)\.?$", "", name))
            name = name if "." in name else re.sub(r"(?i)\s+Group$", "", name)
        return name

    def legal(name, text):
        bare = "".join(w for w in re.findall("[a-z0-9]+", short(name).casefold()) if w not in ("group", "holding", "holdings"))
        return bool(bare) and bare in folded(text)

    def brand(name, text):
        whole = short(name)
        base = re.sub(r"(?i)\s+(?:group|online)$", "", whole)
        aliases = [whole, base, *base.split()[: len(base.split()) > 1], *([base.replace("-", "")] if "-" in base else [])]
        return any(len(a) >= 3 and len(folded(a)) >= 4 and folded(a) in folded(text) for a in aliases)

    names = ["Hot ring Group plc", "Acme Inc Corp Ltd Holdings plc Limited", "Acme Group Inc Group Corp Group Ltd Group", "\uff21\uff23\uff2d\uff25 Tools Inc", "Stra\u00dfe AG", "E\ufb03cient Labs Ltd", "Cafe\u0301 Noir plc", "Trip.com Group Ltd", "Global-e Online Ltd", "Foo_Group Bar", "ab", "\u01f0anus Werke"]
    texts = ["About hot x ", "About HOT RING.", "acme", "ACME tools", "die STRASSE ag", "efficient labs", "cafe noir", "cafenoir", "caf noir", "trip com group", "globale", "foobar", "foogroupbar", "ab", "janus werke", "corp", ""]
    rows = spark.createDataFrame([(n, t) for n in names for t in texts], "name string, text string")
    got = {(r.name, r.text): (r.legal, r.brand) for r in rows.select("name", "text", tx.legal_match(F.col("name"), F.col("text")).alias("legal"), tx.brand_match(F.col("name"), F.col("text")).alias("brand")).collect()}
    assert got == {(n, t): (legal(n, t), brand(n, t)) for n in names for t in texts}


def test_first_words_below_four_letters_are_no_brand(spark, tmp_path):
    spark.createDataFrame([(1, "hot ring", "Brand#12"), (2, "large ring", "Brand#2"), (3, "hot ring", "Brand#13")], "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    assert {r.partkey: (r.legal, r.brand) for r in QUERIES["company_text_match"](spark, str(tmp_path)).collect()} == {1: (False, False), 2: (False, True), 3: (True, True)}


def test_claims_of_a_document_are_taken_from_its_text_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(found):
        def rows(batches):
            for batch in batches:
                read.add(len(batch))
                yield batch

        return found.mapInPandas(rows, found.schema)

    said = [f"We expect revenue of ${n} million in the year, and margins of {n}% for the region." for n in range(6)]
    docs = spark.createDataFrame([(i, " ".join(said[i:] + said[:2])) for i in range(4)], "doc_id long, text string")
    candidates = texts.sentence_claims(texts.sentences(docs, "doc_id")).count()
    assert candidates > 4
    texts.extract_claims(docs, "doc_id", steps=[counted]).collect()
    assert read.value == candidates


def test_superseded_facts_meet_the_newest_without_copies_of_it(spark):
    rng = random.Random(25)
    facts = [(f"T{rng.randrange(3)}", rng.choice(["Rev", "Ocf"]), "USD", date(2000 + rng.randrange(2), 1, 1), date(2001, 12, 31), "FY", float(i), date(2002, 1, 1 + rng.randrange(3)), f"a{i:02d}") for i in range(40)]
    newest = {}
    for f in facts:
        newest[f[:6]] = max(newest.get(f[:6], f), f, key=lambda x: x[7:])
    frame = spark.createDataFrame(facts, "ticker string, concept string, unit string, period_start date, period_end date, fiscal_period string, value double, filed date, accn string")
    old = fo.canonical_facts(frame, spark.createDataFrame([("Rev", "revenue", 0), ("Ocf", "net_income", 0)], "concept string, metric string, tag_rank int"))[1]
    assert sorted(r.accn for r in old.collect()) == sorted(f[8] for f in facts if newest[f[:6]] != f)
    assert "_salt" not in old._jdf.queryExecution().optimizedPlan().toString()
