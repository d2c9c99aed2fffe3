"""Language model, page text and the pipeline."""

import html
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from kerbside.llm import html_text, language_model
from kerbside.llm.queries import QUERIES


def counts(docs: dict) -> tuple[Counter, dict]:
    seen, tokens = Counter(), {}
    for i, t in docs.items():
        tokens[i] = [*t.encode().lower().split(), None]
        if zlib.crc32(str(i).encode()) % 5 != 1:
            seen.update(tokens[i])
    return seen, tokens


def test_language_model_query(spark, docs, sf_dir):
    rows = QUERIES["op4_pitman_yor"](spark, sf_dir).collect()
    seen, tokens = counts(docs)
    n, v = sum(seen.values()), len(seen)
    assert len(rows) == len(docs)
    for r in rows:
        base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[r.doc_id]), sum(seen[w] > 0 for w in tokens[r.doc_id]), n)
        assert r.base_score == pytest.approx(base) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_predictions_sum_to_one(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i * k % 7}" for k in range(9))) for i in range(20)], "doc_id long, text string")
    state, samples = language_model.train(docs)
    payloads = [bytes(r.payload) for r in language_model._model_rows(state, samples, 1).collect()]
    model = language_model.Model(payloads, samples, int(samples[0].customers.sum()))
    words = np.append(model.w, np.uint64(12345))
    for z in range(language_model.CONTEXTS):
        score, _, known = model.score(words, np.full(len(words), z))
        assert (10**score).sum() == pytest.approx(1.0) and known.sum() == len(model.w)


def test_contexts_are_whole_words(spark):
    rows = [(i, "one_ab left two_ab right" if i % 2 else "two_ab right one_ab left") for i in range(40)]
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows += [(held[0], "one_ab left"), (held[1], "one_ab right")]
    got = {r.doc_id: r for r in language_model.train_and_score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]].score > got[held[1]].score + 0.5  # the words before end alike
    assert got[held[0]].base_score == pytest.approx(got[held[1]].base_score)


def test_spread_contexts(spark, monkeypatch):
    monkeypatch.setattr(language_model, "LOOKED_AT", 1)
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 100)
    texts = {i: "the " + " the ".join(f"w{i * k % 13} v{i * k % 5}" for k in range(9)) + f" only{i}" for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    state, samples = language_model.train(docs)
    spread = samples[0].layout.spread
    the = language_model.tokens(["the"])[0][0]
    assert the in spread and samples[0].layout.buckets > 12
    payloads = [bytes(r.payload) for r in language_model._model_rows(state, samples, 3).collect()]
    kept = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    word, context, _ = language_model.tokens(kept)
    total = int(samples[0].customers.sum())
    assert total == len(word) and samples[0].customers[np.flatnonzero(spread == the)[0]] == (context == the).sum()
    model = language_model.Model(payloads, samples, total, (context, word))
    for u in [*np.unique(context), np.uint64(12345)]:
        words = np.append(model.w, np.uint64(12345))
        assert (10 ** model.score(words, np.full(len(words), u))[0]).sum() == pytest.approx(1.0)
    for r in language_model.score(docs, state, samples).collect():
        word, context, _ = language_model.tokens([texts[r.doc_id]])
        assert r.score == pytest.approx(model.score(word, context)[0].sum())


def test_seating():
    rng = np.random.default_rng(1)
    customers = np.array([1, 2, 50, 1000, 100_000])
    tables = language_model.seat(customers, np.full(5, 2.0), 0.5, rng)
    assert tables[0] == 1 and (tables >= 1).all() and (tables <= customers).all() and tables[4] > tables[2]


def test_language_model_on_odd_rows(odd_docs, no_docs):
    rows = language_model.train_and_score(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(math.isfinite(r.score) for r in rows)
    assert language_model.train_and_score(no_docs).count() == 0


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav>menu</nav><div class="page"><main><article>
<header><h1>Ti&amp;tle</h1><span>By X</span></header><p>One  <b>bold</b>
two<p>Second<div class="ad-box">Buy</div><ul><li>a<li>b</ul><aside>side</aside><form><label>Name</label></form>
<section id="comments"><article class="comment"><p>Nice</p></article></section></article></main></div><footer>f</footer>"""


def test_page_parts():
    lines = html_text.lines_of(PAGE)
    assert html_text.main_text(lines, set()) == "Ti&tle\nOne bold two\nSecond\na\nb"
    assert html_text.lines_of("") == [] and html_text.main_text([], set()) == ""


def test_shared_lines_align():
    assert html_text.shared_lines([1, 2, 3, 9], [1, 5, 3, 9]) == [0, 2, 3]
    assert html_text.shared_lines([1, 2], [1, 2]) == [] == html_text.shared_lines([], [1])
    assert html_text.shared_lines([4, 1, 2, 3, 7], [5, 2, 1, 3, 8]) in ([1, 3], [2, 3])


def test_pages_without_marks_are_compared(spark):
    def page(i: int) -> str:
        return f"<div>Welcome to us</div><div>Article {i} says this</div><div>Call us now</div>"

    rows = [(i, f"http://h.example/news/{i}?x={i}", page(i), 1) for i in range(6)] + [
        (6, "http://h.example/news/5/", page(5), 1), (7, None, None, 1), (8, "::", page(8), 1), (None, "", "", 1),
        (9, "http://one.example/a", page(9), 1), (0, "http://h.example/news/0?x=0", page(0), 1),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, key int")
    got = [(r.page_id, r.text) for r in html_text.extract(df).collect()]
    want = [(i, f"Article {i} says this") for i in (0, 0, 1, 2, 3, 4, 5)]
    want += [(6, "Article 5 says this"), (7, ""), (8, "Welcome to us\nArticle 8 says this\nCall us now"), (None, "")]
    want += [(9, "Welcome to us\nArticle 9 says this\nCall us now")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert html_text.extract(df.limit(0)).count() == 0


def test_neighbours_do_not_depend_on_partitions(spark):
    rows = [("h", f"/a/{i:03d}", i) for i in range(50)] + [("g", "/z", 99), ("i", "/a", 98)]
    df = spark.createDataFrame(rows, "host string, path string, key long")
    results = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted((r.host, r.path, r.other) for r in html_text.neighbours(df).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] and len(results[0]) == 50


def test_page_query(spark, sf_dir):
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op7_html_text"](spark, sf_dir).collect()}
    for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        body = re.search(r"<article>(.*)</article>", p.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1|br)>", body)]
        want = "\n".join(x for x in blocks if x)
        assert got[p.page_id] == (want, len(want))


def test_pipeline(spark, sf_dir):
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.settle(stage(spark, docs, sf_dir), "test")
        if name != "packing":
            assert out.columns == docs.columns
            ids = {r.doc_id for r in out.select("doc_id").collect()}
            assert before is None or ids <= before
            if name == "secret scans":
                assert ids == before and out.where("text rlike '[0-9a-f]{24}'").count() == 0
            before = ids
            docs = out
    assert {r.doc_id for r in out.select("doc_id").collect()} == before


def test_pipeline_on_odd_rows(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:4]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
        corpus_pipeline.pack(spark, docs, sf_dir).count()
    groups = corpus_pipeline.keep_distinct(spark, odd_docs, sf_dir).collect()
    assert sorted(r.doc_id for r in groups if r.doc_id is not None) == [0, 1, 2, 3, 4, 5, 5, 7, 8, 8, 2**60 + 1]


def test_gathered_tokens_are_sorted_by_groups_of_whole_buckets(monkeypatch):
    monkeypatch.setattr(language_model, "SORTED", 50)
    layout = language_model.Layout(12)
    for buckets in ([], [3], [11] * 200, *(np.random.default_rng(k).integers(0, 12, 400) for k in range(5))):
        buckets = np.array(buckets, np.int32)
        groups = list(layout.groups(buckets))
        joined = np.concatenate(groups) if groups else np.zeros(0, np.int64)
        assert joined.tolist() == np.argsort(buckets, kind="stable").tolist()
        held = [set(buckets[g]) for g in groups]
        assert sum(map(len, held)) == len(set(buckets))
        assert all(len(g) <= 50 or len(h) == 1 for g, h in zip(groups, held, strict=True))
