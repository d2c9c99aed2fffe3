"""Quality rules, secret scan and decontamination."""

import random

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

from kerbside.llm import decontaminate, quality, secrets
from kerbside.llm.oracles import ORACLES
from kerbside.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_statement(spark, con, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_repeated_words(spark):
    cases = [("a b c x a b c", 6), ("a a a a", 4), ("a b c", 0), ("", 0), ("a b c a b d a b c a", 8)]
    df = spark.createDataFrame([(t, n) for t, n in cases] + [(" ".join(["p q r s t u v"] * 40), 280)], "t string, n long")
    # More than 64 repeated windows take the sorted way.
    many = " ".join(f"a{i} b{i} c{i}" for i in range(100))
    df = df.unionByName(spark.createDataFrame([(f"{many} x {many}", 600)], "t string, n long"))
    got = df.select("n", quality.bind(F.split("t", " "), quality.repeated_words).alias("got")).collect()
    assert [r.got for r in got] == [r.n for r in got]


def test_quality_on_odd_rows(odd_docs, no_docs):
    rows = quality.quality(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(not r.kept for r in rows if r.n_words < 50)
    assert {r.base_failed for r in rows if r.doc_id == 8} == {True}
    assert quality.quality(no_docs).count() == 0


def test_quality_rejects_symbols(spark):
    rng = random.Random(1)
    pool = ["the", "of", "and", "to", "in", "a"] * 3 + ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(3, 9))) for _ in range(60)]

    def text(mark: str) -> str:
        return " ".join(rng.choice(pool) + mark for _ in range(120))

    docs = [(i, text(""), "en") for i in range(30)] + [(99, text("%%%"), "en")]
    rows = quality.quality(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    assert {r.doc_id for r in rows if not r.kept} == {99} and not any(r.base_failed for r in rows)
    (bad,) = [r for r in rows if r.doc_id == 99]
    assert bad.char_distance > quality.MAX_CHAR_DISTANCE


def test_js_distance(spark):
    df = spark.sql("SELECT array(1.0D, 0.0D) AS p, array(0.0D, 1.0D) AS q, array(0.5D, 0.5D) AS r")
    a, b, c = df.select(*[quality.js_distance(F.col(x), F.col(y)) for x, y in ("pq", "pp", "pr")]).first()
    assert (a, b) == (1.0, 0.0) and 0 < c < 1


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]+") == frozenset()
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == {frozenset([frozenset(["aki", "kia"])])}
    (member,) = secrets.trigram_query("(abcd|xyz)[0-9]+")
    assert member == {frozenset(["abc", "bcd"]), frozenset(["xyz"])}
    assert secrets.trigram_query("(abcd)?") == frozenset()
    assert secrets.trigram_query("ab?cd") == {frozenset([frozenset(["abc", "bcd"]), frozenset(["acd"])])}


def spans(row) -> list:
    return [(s["kind"], s["start"], s["end"]) for s in row.spans]


def test_scan_and_redaction(spark, odd_docs, no_docs):
    text = 'é😀 API_KEY = "abc123DEF" AKIA' + "A" * 16 + " " + "0a" * 12 + " token:short1 secret=x ghp_" + "z" * 36
    df = odd_docs.limit(1).withColumn("text", F.lit(text)).unionByName(odd_docs)
    rows = secrets.scan(df).collect()
    assert len(rows) == odd_docs.count() + 1
    (row,) = [r for r in rows if r.text == text]
    got = {k: text[a:b] for k, a, b in spans(row)}
    assert got == {
        "assign": "token:short1", "access": "AKIA" + "A" * 16, "hex": "0a" * 12, "github": "ghp_" + "z" * 36
    } and len(row.spans) == 5
    hidden = secrets.redacted(df)
    assert hidden.columns == df.columns
    (row,) = [r for r in hidden.collect() if r.text and "[secret]" in r.text]
    assert "abc123DEF" not in row.text and row.text.startswith("é😀 [secret]") and row.n_chars == len(row.text)
    assert sum(r.text is None for r in hidden.collect()) == sum(r.text is None for r in df.collect())
    assert secrets.scan(no_docs).count() == secrets.redacted(no_docs).count() == 0


def test_index_loses_nothing(spark):
    lines = ["my PassWord: hunter22", "passwd=abcdefgh", "Token = 'qwertyui'", "apikey:0123456", "sEcReT=abcdef1", "nothing here"]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r.doc_id: len(r.spans) for r in secrets.scan(df).collect()}
    assert found == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 0}


ITEM = "Anna has 12 apples and gives 5 apples to Bert before she walks 3 km home with the other 7 of them"


def test_decontamination_finds_changed_slots(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, "short item here"), (3, None), (4, "")], "item_id long, text string")
    filler = "quite other words stand in front of it and more words go on behind it as well"
    cases = {
        10: f"{filler}. {ITEM} {filler}",
        11: f"{filler}. " + ITEM.replace("12", "31").replace("5 ", "6 ").replace("Anna", "Carl").replace(" 3 ", " 9 ").replace(" 7 ", " 8 "),
        12: f"{filler}. " + ITEM.replace("12", "5"),  # two numbers of the item become one: no consistent slots
        13: filler,
        14: "this has a short item here inside",
    }
    df = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.exact for r in decontaminate.matches(df, items).collect()}
    assert found.pop((14, 2)) is True
    assert found[(10, 1)] is True and found[(11, 1)] is False and {d for d, _ in found} <= {10, 11, 12}
    kept = decontaminate.clean(df, items)
    assert {r.doc_id for r in kept.collect()} >= {13} and kept.columns == df.columns
    assert decontaminate.clean(odd_docs, items).count() == odd_docs.count()
    assert decontaminate.matches(no_docs, items).count() == 0
    assert decontaminate.matches(df, items.limit(0)).count() == 0


def test_decontamination_takes_a_number_as_one_slot(spark):
    item = "A train travels 60 miles in 2 hours. How far does it travel in 5 hours at the same speed?"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    texts = {1: item.replace(" 2 ", " 2.5 "), 2: item.replace("60", "1,250"), 3: item.replace(" 5 ", " 3/4 "), None: item, 4: "other words"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in decontaminate.matches(df, items).collect()} == {1, 2, 3, None}
    assert {r.doc_id for r in decontaminate.clean(df, items).collect()} == {4}


def test_planted_items_are_found(spark, docs, sf_dir):
    items = {r.item_id: " ".join(r.text.split()).lower() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    held = {(d, i) for d, t in docs.items() for i, x in items.items() if x in " ".join(t.split()).lower()}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontaminate"](spark, sf_dir).collect()}
    assert held <= found
