"""Near duplicates, shared passages and repeated substrings against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from kerbside.llm import ngram_join, passages, substrings
from kerbside.llm.common import components
from kerbside.llm.queries import QUERIES


def shingles(text: str, width: int) -> frozenset:
    w = text.encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(docs: dict, width: int, num: int, den: int) -> dict:
    sets = {i: shingles(t, width) for i, t in docs.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[:k]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if den * small >= num * large:
                both = len(sets[a] & sets[b])
                if den * both >= num * (small + large - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(rng: random.Random, n: int) -> dict:
    """Texts around a few bases with some words changed, many near the threshold."""
    bases = [[f"b{k}w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 20, 60, 150, 400]))] for k in range(6)]
    out = {}
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4, 6])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        out[i] = " ".join(words)
    return out


def frame(spark, docs: dict):
    return spark.createDataFrame(list(docs.items()), "doc_id long, text string")


def test_join_on_near_copies(spark):
    docs = near_copies(random.Random(4), 400)
    for width, num, den in ((3, 90, 100), (5, 80, 100)):
        rows = ngram_join.near_duplicates(frame(spark, docs), width, num, den).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, width, num, den)


def test_join_with_dealt_groups(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP", 8)
    monkeypatch.setattr(ngram_join, "SENT_IDS", 3)
    docs = near_copies(random.Random(10), 200)
    rows = ngram_join.near_duplicates(frame(spark, docs), 3, 90, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, 3, 90, 100)


def test_join_query(spark, docs, sf_dir):
    rows = QUERIES["op1_ngram_jaccard_join"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, 3, 90, 100)


def test_join_on_odd_rows(odd_docs, no_docs):
    rows = ngram_join.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    groups = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert groups[2**60 + 1] == 2**60 + 1 and groups[5] == groups[6] == 5 and groups[8] == groups[9] == 8 and groups[0] == 0 and groups[2] == 2
    assert ngram_join.near_duplicates(no_docs).count() == 0


def test_signatures_are_shared_above_the_threshold():
    rng = np.random.default_rng(5)
    bands = ngram_join.Bands(90, 100)
    for n in [*range(1, 60), 100, 150, 333, 1000]:
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        k = int(bands.distance(2 * n))
        other = base.copy()
        other[: k // 2] = rng.integers(0, 1 << 63, k // 2).astype(np.uint64)
        both = len(np.intersect1d(base, other))
        assert 100 * both >= 90 * (2 * n - both)
        assert set(bands.signatures(base).tolist()) & set(bands.signatures(other).tolist())


def test_empty_parts_are_no_signature():
    """Sets that have nothing in common share next to none, and sets at the bound still do, also where parts become empty."""
    rng = np.random.default_rng(12)
    bands = ngram_join.Bands(80, 100)
    for n in (300, 1000, 4000):
        signed = np.concatenate([np.unique(bands.signatures(rng.integers(0, 1 << 63, n).astype(np.uint64))) for _ in range(40)])
        assert len(signed) - len(np.unique(signed)) <= 8
    for num in (50, 80, 90):
        bands = ngram_join.Bands(num, 100)
        for n in [*range(1, 200, 3), 333, 1000, 2001]:
            base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            k = int(bands.distance(2 * n))
            other = base.copy()
            other[: k // 2] = rng.integers(0, 1 << 63, k // 2).astype(np.uint64)
            fewer = base[: -(-n * num // 100)]
            # Whole parts of the band go first, so that as many as possible become empty.
            parts = bands.parameters[bands.band(n)][0] * bands.parameters[bands.band(n)][1]
            emptied = base[np.argsort(ngram_join.mixed(base, 5) % np.uint64(parts), kind="stable")][n - len(fewer) :]
            for near in (other, fewer, np.sort(emptied)):
                assert set(bands.signatures(base).tolist()) & set(bands.signatures(near).tolist()), (num, n)


def test_long_sketches_keep_links_and_part_other_sets():
    rng = np.random.default_rng(11)
    for num, width in ((90, 3), (80, 5)):
        bands = ngram_join.Bands(num, 100)
        for n in (1, 7, 60, 500, 601, 3000, 20_000):
            base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            for grown in (0, n // 20):
                k = int(bands.distance(2 * n + grown))
                linked, apart = base.copy(), base.copy()
                linked[: (k - grown) // 2] = rng.integers(0, 1 << 63, (k - grown) // 2).astype(np.uint64)
                apart[: n // 2] = rng.integers(0, 1 << 63, n // 2).astype(np.uint64)
                more = rng.integers(0, 1 << 63, grown).astype(np.uint64)
                x, y, z = (ngram_join.long_sketch(np.unique(np.concatenate([s, m])), bands) for s, m in ((base, more[:0]), (linked, more), (apart, more)))
                assert ngram_join.sketch_distance(x, y) <= k and ngram_join.sketch_distance(y, x) <= k
                assert n < 500 or ngram_join.sketch_distance(x, z) > k


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(rng.randrange(2000, 2500), rng.randrange(2000, 2500)) for _ in range(250)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def cut(docs: dict, length: int) -> dict:
    raw = {i: (t or "").encode() for i, t in docs.items()}
    count = Counter(r[p : p + length] for r in raw.values() for p in range(len(r) - length + 1))
    out = {}
    for i, r in raw.items():
        gone = np.zeros(len(r), bool)
        for p in range(len(r) - length + 1):
            if count[r[p : p + length]] > 1:
                gone[p : p + length] = True
        n = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out[i] = (len(r), int(gone.sum()), n, hashlib.sha256(kept).hexdigest())
    return out


def removed(rows) -> dict:
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}


def test_removal_query(spark, docs, sf_dir):
    assert removed(QUERIES["op10_substring_removal"](spark, sf_dir).collect()) == cut(docs, 200)


def test_removal_of_overlaps_and_periods(spark):
    rng = random.Random(7)
    stock = ["".join(rng.choices("ab é", k=rng.randrange(100, 500))) for _ in range(8)]
    docs = {i: "".join(rng.choices(stock, k=3))[rng.randrange(80) :] for i in range(60)}
    docs |= {100: "a" * 199, 101: "a" * 200, 102: "a" * 201, 103: "ab" * 300, 104: None, 105: "z" * 150}
    assert removed(substrings.remove_repeats(frame(spark, docs)).collect()) == cut(docs, 200)


def test_removal_in_long_buffers(monkeypatch):
    rng = np.random.default_rng(8)
    raw = [bytes(rng.integers(97, 123, n, np.uint8)) for n in (50, 3000, 199, 200, 5000)]
    whole = substrings.runs_of(substrings.Bytes(raw), 200)
    monkeypatch.setattr(substrings, "_PLACE", np.uint64(2047))
    parts = substrings._in_parts(substrings.Bytes(raw), 200)
    assert sum((parts[2] - parts[1] + 1).tolist()) == sum((whole[2] - whole[1] + 1).tolist())


def test_removal_on_odd_rows(odd_docs, no_docs):
    rows = substrings.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert all(r.n_removed == r.n_bytes for r in by_id[5] + by_id[8] + by_id[9])
    assert substrings.remove_repeats(no_docs).count() == 0


def test_passages_of_fifty_words_are_found(spark, docs, sf_dir):
    places = defaultdict(set)
    for i, t in docs.items():
        w = t.encode().lower().split()
        for k in range(len(w) - 49):
            places[tuple(w[k : k + 50])].add(i)
    must = {i for p in places.values() if len(p) > 1 for i in p}
    rows = QUERIES["op9_shared_passages"](spark, sf_dir).collect()
    assert must <= {r.doc_id for r in rows} | {r.other_doc_id for r in rows}
    for r in rows:
        a, b = (docs[i].encode().lower().split()[x:y] for i, x, y in ((r.doc_id, r.begin, r.end), (r.other_doc_id, r.other_begin, r.other_end)))
        assert min(len(a), len(b)) >= passages.MIN_WORDS
        assert r.n_common <= min(len(a), len(b)) and r.similarity >= passages.MIN_SIMILARITY


def test_fuzzy_passage(spark):
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(90)]

    def around(words: list[str]) -> str:
        return " ".join([*[f"q{rng.randrange(10**9)}" for _ in range(80)], *words, *[f"q{rng.randrange(10**9)}" for _ in range(80)]])

    changed = [w if i % 17 else "other" for i, w in enumerate(passage)]
    docs = {1: around(passage), 2: around(changed), 3: around(passage[:25]), 4: around([]), 5: around(passage[::-1])}
    (row,) = passages.shared_passages(frame(spark, docs)).collect()
    assert {row.doc_id, row.other_doc_id} == {1, 2} and row.n_common >= 80


def fresh(rng: random.Random, n: int) -> list[str]:
    return [f"q{rng.randrange(10**9)}" for _ in range(n)]


def test_passages_at_the_least_similarity(spark):
    """Every k-th word of a passage is another: similarity 0.8 to 0.92, at the least length and beyond it."""
    rng = random.Random(12)
    docs = {}
    for k in (5, 6, 8, 12):
        for words in (41, 60, 120):
            for _ in range(8):
                p = fresh(rng, words)
                q = [w if i % k != k // 2 else f"r{rng.randrange(10**9)}" for i, w in enumerate(p)]
                for side in (p, q):
                    docs[len(docs)] = " ".join([*fresh(rng, 50), *side, *fresh(rng, 50)])
    rows = passages.shared_passages(frame(spark, docs)).collect()
    assert {(min(r.doc_id, r.other_doc_id), max(r.doc_id, r.other_doc_id)) for r in rows} == {(i, i + 1) for i in range(0, len(docs), 2)}


def test_seeds_of_a_very_long_text(spark):
    n = (1 << 22) + 50_000
    texts = spark.range(1).select(F.lit(1).cast("long").alias("tid"), F.array_join(F.sequence(F.lit(1), F.lit(n)), " ").alias("text"))
    assert passages.seeds(texts).where(F.col("at") >= 1 << 22).count() > 5_000


def test_passages_whose_parts_other_texts_hold(spark):
    """Others hold parts of a passage, each too short, under smaller or larger ids; one repeats a phrase of it."""
    rng = random.Random(13)
    docs, must = {}, set()
    for _ in range(12):
        p = fresh(rng, 76)
        for part in (p[:38], p[38:], p[20:59], p[30:36] + fresh(rng, 30) + p[:10]):
            docs[len(docs)] = " ".join([*fresh(rng, 30), *part, *fresh(rng, 30)])
        must.add((len(docs), len(docs) + 1))
        for _ in range(2):
            docs[len(docs)] = " ".join([*fresh(rng, 30), *p, *fresh(rng, 30)])
    rows = passages.shared_passages(frame(spark, docs)).collect()
    assert {(min(r.doc_id, r.other_doc_id), max(r.doc_id, r.other_doc_id)) for r in rows} == must


def test_chains():
    x = np.array([0, 5, 10, 40, 45, 300, 305, 310])
    y = np.array([100, 105, 110, 20, 150, 7, 12, 17])
    found = sorted(c[:4] for c in passages.chains(x, y))
    assert found == [(0, 45, 100, 150), (300, 310, 7, 17)] or found == [(0, 10, 100, 110), (300, 310, 7, 17)]
    assert passages.common_words(list("abcbdab"), list("bdcaba")) == 4


def test_passages_on_odd_rows(odd_docs, no_docs):
    rows = passages.shared_passages(odd_docs).collect()
    assert {(r.doc_id, r.other_doc_id) for r in rows} & {(5, 5), (6, 5), (5, 6)}
    assert passages.shared_passages(no_docs).count() == 0


def test_all_occurrences_of_frequent_seeds_are_matched(spark, monkeypatch):
    """Also of seeds with more occurrences than one task matches, in several blocks."""
    monkeypatch.setattr(passages, "BLOCK", 50)
    rows = [(s, t, at) for s, n in ((1, 130), (2, 64), (3, 65), (4, 1)) for t in range(n) for at in ((0, 7) if t % 9 == 0 else (3,))]
    got = passages.matches(spark.createDataFrame(rows + rows[:20], "seed long, tid long, at int")).collect()
    want = sorted((t, x, u, y) for s, t, x in rows for r, u, y in rows if s == r and t < u)
    assert sorted(tuple(r) for r in got) == want


def test_passages_of_frequent_seeds_alone(spark):
    """A passage that two texts share without their first, while every seed is in more than a group of texts."""
    words = [f"w{i}" for i in range(60)]
    docs = {0: " ".join(words[:30])}
    docs |= {i: " ".join([f"a{i}", *words[max(0, i % 15 - 1) : i % 15 + 14], f"b{i}"]) for i in range(1, 500)}
    docs |= {i: " ".join([f"a{i}", *words[10 + i % 30 : 28 + i % 30], f"b{i}"]) for i in range(900, 1400)}
    docs |= {5000: " ".join(["x", *words, "y"]), 5001: " ".join(["p", "q", *words, "r"])}
    rows = passages.shared_passages(frame(spark, docs)).collect()
    pairs = {frozenset((r.doc_id, r.other_doc_id)): r.n_common for r in rows}
    assert pairs[frozenset((5000, 5001))] == 60
