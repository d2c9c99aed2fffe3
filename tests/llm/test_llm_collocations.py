import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from kerbside.llm import collocations as co
from kerbside.llm.oracles import ORACLES
from kerbside.llm.queries import op11_collocations

SPLIT, SPACE = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_rows(docs, max_words=3, min_count=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in SPLIT.split((text or "").translate(UPPER)):
            words = SPACE.findall(piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= min_count}
    dropped = set()
    for (lang, *w), a in candidates.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                inner = (lang, *w[i:j])
                if j - i < len(w) and 100 * a >= share * f[inner]:
                    dropped.add(inner)
    rows = []
    for g, a in candidates.items():
        if g not in dropped:
            cuts = []
            for k in range(2, len(g)):
                left, right = f[g[:k]], f[(g[0], *g[k:])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            rows.append((g[0], " ".join(g[1:]), a, left, right, n[g[0]], score))
    rows.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranks, out = Counter(), []
    for r in rows:
        ranks[r[0]] += 1
        if top is None or ranks[r[0]] <= top:
            out.append((r[0], ranks[r[0]], *r[1:]))
    return out


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def odd_texts(r, n):
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", "\x0b", ";\r"]
    words = ["a", "B", "b", "É", "é", "日本", "x\x85y", "-", "new", "York", "city"]
    return [
        (r.choice(["en", "fr", None, "und", ""]), "".join(r.choice(words) + r.choice(marks) for _ in range(r.randrange(0, 60))))
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "max_words,min_count,share,top,parts,numbered",
    [(3, 10, 50, 2000, 5, 0), (3, 10, 50, 2000, 5, 1000), (2, 3, 50, 7, 1, 1000), (3, 1, 90, 40, 300, 0), (3, 1, 90, 40, 300, 1000)],
)
def test_equals_brute_force(spark, max_words, min_count, share, top, parts, numbered):
    rows = odd_texts(random.Random(top), 300) + [("en", "new york city " * 50), (None, None), ("en", "")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    expected = plain_rows(rows, max_words, min_count, share, top)
    assert result(co.collocations(df, max_words, min_count, share, top, parts, numbered)) == sorted(expected)
    assert len(expected) > 20


def test_streams_keep_counts_and_stretches_lose_nothing():
    r = np.random.default_rng(1)
    ids, piece = r.integers(0, 9, 1000).astype(np.uint64) * np.uint64(2**61 + 7), np.cumsum(r.random(1000) < 0.1)
    some = np.unique(ids)[1:]
    for stretch, known in ((3, None), (64, None), (5000, None), (64, some)):
        f = Counter()
        for part, size, *stream in co.counted(ids, piece, 7, 3, stretch, known):
            words, counts = co.unpack(*stream, size, known)
            assert (co.gram_hash(words) % np.uint64(7) == part).all()
            for *w, c in zip(*words, counts, strict=True):
                f[tuple(int(x) for x in w)] += int(c)
        expected = Counter(
            tuple(int(x) for x in ids[i : i + n])
            for n in (2, 3)
            for i in range(1000 - n + 1)
            if piece[i] == piece[i + n - 1] and (known is None or np.isin(ids[i : i + n], known).all())
        )
        assert f == expected


def test_scores_are_exact(spark):
    big = 3_000_000_007
    rows = [(2, 1, 2, None, big), (2, 1, 3, None, 5), (2, 4, 4, None, 999_999_937)]
    grams = spark.createDataFrame(rows, "size int, w1 long, w2 long, w3 long, f long")
    words = spark.createDataFrame([(1, big + 2), (2, big + 9), (3, 5), (4, 10**9)], "id long, f long")
    got = {(r.w1, r.w2): r.cut.score for r in co.scored(grams, words, 2).collect()}
    expected = {(a, b): 1_000_000 * f * f // (dict(words.collect())[a] * dict(words.collect())[b]) for _, a, b, _, f in rows}
    assert got == expected


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLES['op11_collocations']})").fetchall()
    assert result(op11_collocations(spark, sf_dir)) == sorted(expected)
    assert len(expected) > 100


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert result(co.collocations(odd_docs)) == sorted(plain_rows(rows))
    assert co.collocations(no_docs).collect() == []
    assert co.collocations(odd_docs.where("doc_id = 3")).collect() == []
    with pytest.raises(ValueError):
        co.collocations(no_docs, max_words=4)
