"""Encoding, packing and token shards."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kerbside.llm import packing, token_store
from kerbside.llm.queries import QUERIES
from kerbside.llm.tokens import Encoder

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def ids_of(name: str, texts: list[str]) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize(("name", "spaced"), [(BYTE, True), (WORD, False)])
def test_parts_give_the_ids_of_the_text(name, spaced):
    rng = random.Random(3)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "é", "it's", "12", "x1", ",", "...", " ", "\x1c", "😀", "<|endoftext|>", "日本", "\x85", "ÀÈ", "'ll", "word!!", "end###", "x'.", "a_b", "w$%&*"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(2000)]
    encoder = Encoder(public_tokenizers.path(name), spaced)
    got = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)]
    assert got == ids_of(name, texts)


@pytest.mark.parametrize(("name", "spaced"), [(BYTE, True), (WORD, False)])
def test_words_of_letters_are_encoded_together(name, spaced):
    """Line feeds are cuts too, so that the words at their sides are remembered apart, and words share one text."""
    words = ["Über", "naïve", "été", "Straße", "word", "İstanbul", "ÿ", "ǅ", "x|y", "|", "||", "a²", "ŉ"]
    rng = random.Random(4)
    texts = [" ".join(w + rng.choice(["", ".", "?!", "|"]) + rng.choice(["", "\n" + rng.choice(words)]) for w in rng.choices(words, k=9)) for _ in range(400)]
    texts += ["\nword", "word\n", "a\n\nb c", "a \nb", "a\n b", "a\n\u0301b c", "a\r\nb"]
    encoder = Encoder(public_tokenizers.path(name), spaced)
    asked: list[int] = []
    direct = encoder.direct
    encoder.direct = lambda own: asked.append(len(own)) or direct(own)
    got = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)]
    assert got == ids_of(name, texts)
    assert not any("\n" in u[1:] for u in encoder.known if u.strip("\n") and "\n\n" not in u and " " not in u and "\r" not in u)
    assert sum(asked[1:] if spaced else asked) < 60


@pytest.mark.parametrize(("name", "spaced"), [(BYTE, True), (WORD, False)])
def test_a_stretch_is_looked_up_once(name, spaced):
    """Not once a word: texts are taken apart and put together in arrays, marks behind a word do not make it another."""

    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            self.asked += 1
            return super().__contains__(key)

    words = ["one", "two,", "two", "é.", "x1", "one!"]
    texts = [" ".join(words * 50), "", " ", "\n".join(words * 40), "two  one\n", "a"] * 3
    encoder = Encoder(public_tokenizers.path(name), spaced)
    encoder.known = Counted()
    got = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)]
    assert got == ids_of(name, texts)
    assert encoder.known.asked < 40
    assert encoder.encode([]) == []


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_shards_give_back_all_ids(spark, docs, sf_dir):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op5_token_shards"](spark, sf_dir).collect()}
    at, want = 0, {}
    for doc_id, ids in zip(docs, ids_of(BYTE, list(docs.values())), strict=True):
        want[doc_id] = (at, len(ids) + 1, crc([*ids, 2]))
        at += len(ids) + 1
    assert got == want


def test_keyed_access(spark, odd_docs, no_docs):
    folder = token_store.store_folder(spark)
    manifest = token_store.write_shards(odd_docs, folder, public_tokenizers.path(BYTE), 2, shards=3)
    rows = token_store.read_back(manifest).collect()
    assert len(rows) == odd_docs.count() and sum(r.doc_id is None for r in rows) == 2
    shards = [token_store.Shard(r.path) for r in manifest.collect()]
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    for key in [*range(12), 2**60 + 1]:
        found = sorted(ids.tolist() for s in shards for ids in s.read(key))
        assert found == sorted([*x, 2] for x in ids_of(BYTE, texts.get(key, [])))
    empty = token_store.write_shards(no_docs, folder, public_tokenizers.path(BYTE), 2)
    assert token_store.read_back(empty).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000))
    index = token_store.build_hash(keys)
    slots = token_store.look_up(index, keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert len(token_store.look_up(token_store.build_hash(keys[:0]), keys)) == len(keys)


def check_pieces(rows, want: dict, window: int = 4096) -> None:
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert {d: sum(r.length for r in x) for d, x in by_doc.items()} == {d: len(i) for d, i in want.items()}
    for r in rows:
        assert r.ids_crc32 == crc(want[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(want[r.doc_id])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for x in by_sequence.values():
        at = 0
        for r in sorted(x, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window


def test_packing(spark, docs, sf_dir):
    rows = QUERIES["op2_packing"](spark, sf_dir).collect()
    want = {d: [*ids, 2] for d, ids in zip(docs, ids_of(WORD, list(docs.values())), strict=True)}
    check_pieces(rows, want)
    sequences = max(r.sequence_id for r in rows) + 1
    assert sum(r.length for r in rows) > 0.9 * 4096 * sequences


def test_packing_odd_rows(spark, odd_docs, no_docs):
    tokenizer = public_tokenizers.path(WORD)
    rows = packing.pack_documents(odd_docs, tokenizer, 2).collect()
    assert sum(r.start == 0 for r in rows) == odd_docs.count() and 2**60 + 1 in {r.doc_id for r in rows}
    assert packing.pack_documents(no_docs, tokenizer, 2).count() == 0


def test_plan_uses_up_the_histogram():
    rng = np.random.default_rng(2)
    for size in (1, 7, 64):
        histogram = rng.integers(0, 50, size + 1)
        histogram[0] = 0
        used = np.zeros(size + 1, int)
        for pattern, times in packing.plan(histogram):
            assert times > 0 and sum(pattern) <= size
            for n in pattern:
                used[n] += times
        assert (used == histogram).all()


def test_nnls_solves_exactly():
    found = packing.combinations(6, 3)
    assert set(found) == {(6,), (5, 1), (4, 2), (3, 3), (4, 1, 1), (3, 2, 1), (2, 2, 2)}
    members = np.array([c + (0,) * (3 - len(c)) for c in found])
    x = np.array([3.0, 0, 5, 0, 2, 0, 4])
    target = np.zeros(6)
    for j, c in enumerate(found):
        for n in c:
            target[n - 1] += x[j]
    got = packing.nnls(members, 6, target)
    back = np.zeros(6)
    for j, c in enumerate(found):
        for n in c:
            back[n - 1] += got[j]
    assert np.allclose(back, target, atol=1e-4) and (got >= 0).all()
