import random

import numpy as np
import pytest
import xxhash

from kerbside.llm import simhash
from kerbside.llm.queries import op12_simhash


def plain_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, most):
    """Smallest index that links reach, by comparing all pairs."""
    label, fps = list(range(len(fps))), np.array(fps, np.uint64)
    for start in range(len(fps)):
        if label[start] != start:
            continue
        queue = [start]
        while queue:
            i = queue.pop()
            for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= most).tolist():
                if label[j] > start:
                    label[j] = start
                    queue.append(j)
    return label


def unsigned(fp):
    return fp & 0xFFFFFFFFFFFFFFFF


def near_prints(r, n):
    """Random fingerprints, chains of steps of four bits, and a cloud around one value."""
    fps = [r.getrandbits(64) for _ in range(n)]
    for i in range(n // 2):
        bits = sum(1 << b for b in r.sample(range(64), r.choice((1, 2, 3, 4, 4, 4, 5))))
        fps.append(r.choice(fps) ^ bits)
    hub = r.getrandbits(64)
    return fps + [hub ^ sum(1 << b for b in r.sample(range(0, 64, 3), r.randrange(4))) for _ in range(n)]


def test_fingerprints_by_definition():
    r = random.Random(1)
    texts = ["", " \n", "Word", "a b", "a b c d", "É Ab\x85c d e", *(" ".join(r.choices("abcdE", k=r.randrange(1, 40))) for _ in range(100))]
    assert [unsigned(simhash.fingerprint(t, 4)) for t in texts] == [plain_fingerprint(t) for t in texts]
    long = " ".join(r.choices("abcdefghij", k=simhash.CHUNK + 9))
    assert unsigned(simhash.fingerprint(long, 4)) == plain_fingerprint(long)


@pytest.mark.parametrize("most", [2, 4, 7])
def test_linked_fingerprints_share_a_key_that_keeps_them(most):
    r, ring = random.Random(most), simhash.Ring(most)
    for _ in range(3000):
        x = r.getrandbits(64)
        y = x ^ sum(1 << b for b in r.sample(range(64), r.randrange(most + 1)))
        fps = np.array([x, y], np.uint64)
        keys = ring.keys(fps)
        shared = np.flatnonzero(keys[0] == keys[1])
        assert any(ring.linked(fps[:1] ^ fps[1:], int(p))[0] for p in shared)


@pytest.mark.parametrize("held", [3, 50, None])
def test_links_span_the_components(spark, held):
    r = random.Random(3)
    fps = sorted(set(near_prints(r, 400)))
    rows = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long").repartition(8)
    found = simhash.links(simhash.keyed(rows, 4), 4, held=held).collect()
    wide = [(x.sig, x.a) for x in found if x.b is None]
    assert bool(wide) == (held == 3)
    if wide:
        dealt = simhash.dealt(spark.createDataFrame(wide, "sig long, a long"), held=20)
        assert dealt.select("sig").distinct().count() > len({s for s, _ in wide})
        found += simhash.links(dealt, 4, "key", None).collect()
    place = {f: i for i, f in enumerate(fps)}
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in found:
        if x.b is not None:
            a, b = unsigned(x.a), unsigned(x.b)
            assert (a ^ b).bit_count() <= 4
            lo, hi = sorted((root(place[a]), root(place[b])))
            parent[hi] = lo
    expected = plain_components(fps, 4)
    assert [root(i) for i in range(len(fps))] == expected
    assert len(set(expected)) < len(fps) - 300


def test_query_equals_brute_force(spark, sf_dir, docs):
    fps = [plain_fingerprint(t) for t in docs.values()]
    ids = list(docs)
    labels = plain_components(fps, 4)
    expected = {i: (f"{f:016x}", ids[c]) for i, f, c in zip(ids, fps, labels, strict=True)}
    rows = op12_simhash(spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == expected
    assert sum(c != i for i, c in enumerate(labels)) > 5


def test_odd_rows(spark, odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    # Texts without words: 0, 1, 2 and one without a key.
    assert all(by_id[i].component_id == 0 and by_id[i].fingerprint == "0" * 16 for i in (0, 1, 2))
    assert by_id[9].component_id == 8 and by_id[2**60 + 1].component_id == 2**60 + 1
    assert sorted(r.component_id is None for r in rows if r.doc_id is None) == [False, True]
    assert simhash.near_duplicates(no_docs).collect() == []
    with pytest.raises(ValueError):
        simhash.Ring(1)
