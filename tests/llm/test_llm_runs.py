import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kerbside.llm import periodic_runs as pr
from kerbside.llm.queries import op13_periodic_runs


def plain_runs(words, min_length=6, exponent=4):
    """All runs by trying every period at every place."""
    n, out, covered = len(words), [], []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            if length >= max(min_length, exponent * q):
                smaller = any(s <= start and start + length <= s + k and q % p == 0 for s, k, p in covered)
                if not smaller:
                    out.append((start, length, q))
                    covered.append((start, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    text = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    milli = 1000 * best[1] // best[2] if best else None
    return (len(runs), *(best or (None, None, None)), milli,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest())


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("exponent,min_length", [(4, 6), (2, 2), (3, 10), (2, 9)])
def test_runs_are_those_of_brute_force(exponent, min_length):
    r = random.Random(exponent)
    texts = [[]]
    for i in range(400):
        words = []
        while len(words) < r.choice((5, 30, 90)):
            piece = [b"%d" % r.randrange(r.choice((2, 3, 50))) for _ in range(r.randrange(1, 9))]
            words += (piece * r.randrange(1, 9))[: r.randrange(1, 40)]
        texts.append(words)
    got = pr.runs_of(texts, min_length, exponent)
    assert got == [plain_runs(t, min_length, exponent) for t in texts]
    assert sum(map(len, got)) > 100


def test_cut_in_regions_nothing_is_lost_or_shortened():
    r = random.Random(7)
    for _ in range(150):
        words = []
        for _ in range(r.randrange(1, 6)):
            words += [b"x%d" % r.randrange(10**6) for _ in range(r.randrange(0, 12))]
            words += [b"p%d" % r.randrange(30) for _ in range(r.randrange(1, 14))] * r.randrange(1, 8)
            words += [b"a"] * r.randrange(0, 30)
        assert pr.runs_of([words, words[3:]], 6, 4) == [plain_runs(words), plain_runs(words[3:])]


def test_query_equals_brute_force(spark, sf_dir, docs):
    rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in op13_periodic_runs(spark, sf_dir).collect()}
    assert rows == {i: plain_row(i, t) for i, t in docs.items()}
    assert sum(r[0] > 0 for r in rows.values()) > 5


def test_odd_rows(spark, odd_docs, no_docs):
    rows = pr.periodic_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id in (0, 1, 2):
            assert (r.n_words, r.runs, r.collapsed) == (0, [], "")
        if r.doc_id in (8, 9):
            assert [tuple(x) for x in r.runs] == [(0, 90, 3)] and r.collapsed == "same words here"
    assert 2**60 + 1 in {r.doc_id for r in rows}
    assert pr.periodic_runs(no_docs).collect() == []
    assert pr.with_repeated_tail(odd_docs).columns == odd_docs.columns
    assert pr.with_repeated_tail(odd_docs).count() == odd_docs.count()


def test_very_long_texts():
    same = [b"a"] * 300_000
    mixed = [b"w%d" % (i % 70_000) for i in range(300_000)]
    assert pr.runs_of([same, mixed], 6, 4) == [[(0, 300_000, 1)], [(0, 300_000, 70_000)]]
    assert pr.collapsed(same, [(0, 300_000, 1)]) == "a"


def test_greatest_run_is_exact(spark):
    runs = sorted([(5, 8, 2), (2, 12, 3), (9, 2_147_483_645, 536_870_911), (11, 2_147_483_643, 536_870_911), (3, 4, 1)])
    df = spark.createDataFrame([(runs,), ([],)], "runs array<struct<start: long, length: long, period: long>>")
    got = [r[0] for r in df.select(pr.greatest(F.col("runs"))).collect()]
    assert tuple(got[0]) == (9, 2_147_483_645, 536_870_911) and got[1] is None
    ties = [(2, 12, 3), (2, 20, 5), (5, 8, 2)]
    df = spark.createDataFrame([(ties,)], "runs array<struct<start: long, length: long, period: long>>")
    assert tuple(df.select(pr.greatest(F.col("runs"))).first()[0]) == (2, 12, 3)
