"""Phrase collocations by the layout of external stream estimation.

Every task counts the n-grams of a stretch of words and hands on one sorted, packed stream of them per part; a part merges
its streams and keeps the frequent n-grams. These are laid out twice: in prefix order (first word first) and in suffix
order (last word first). There an n-gram stands next to its beginning and its end, so that merge joins of two sorted
streams give the left and right counts of every n-gram and, the other way round, the extensions of a shorter one. No count
is looked up in a hash table, and no table of counts has to fit in memory.

A word is known by a 64-bit hash of its language and its bytes; its text comes from the table of word counts at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import settle
from kerbside.llm.token_store import mixed
from kerbside.llm.tokens import slices

NO_LANGUAGE = "und"
#: The longest phrases, and the most words that are numbered together: three numbers fit in 63 bits.
MAX_WORDS, MAX_NUMBERS = 3, 1 << 21
#: Words that a task counts together, and characters that it splits into words at once.
STRETCH, SLICE = 1 << 20, 1_000_000
#: Bytes of text that fall to a part.
PART_BYTES = 8 << 20

_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
#: 0: part of a word, 1: between words, 2: between pieces
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_ODD = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        factors = np.full(n + (n >> 3), base, np.uint64)
        factors[0] = 1
        _POWERS[base] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS[base][:n]


def salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Words:
    """All words of some texts, A-Z lower-cased: 64-bit hash (``ids``), number of the piece, number of the text."""

    def __init__(self, texts: list[str], langs: list[str]):
        raw = [t.encode() for t in texts]
        self.data = b"\n".join(raw) + b"\n"
        data = np.frombuffer(self.data, np.uint8)
        kind = _KIND[data]
        edges = np.flatnonzero(np.diff(kind == 0, prepend=False))
        self.begin, self.end = edges[::2], edges[1::2]
        self.piece = np.cumsum(kind == 2)[self.begin]
        at = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
        self.text = np.searchsorted(at, self.begin, side="right") - 1
        # Differences of running sums are polynomials of a word's bytes, times a power that the inverse takes out.
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LOWER[data] * _powers(_ODD, len(data)), dtype=np.uint64, out=sums[1:])
        own = (sums[self.end] - sums[self.begin]) * _powers(pow(_ODD, -1, 1 << 64), len(data))[self.begin]
        salts = {lang: salt(lang) for lang in set(langs)}
        langs_of = np.array([salts[lang] for lang in langs], np.uint64)
        self.ids = mixed(mixed(own + (self.end - self.begin).astype(np.uint64), 41) ^ langs_of[self.text], 42)

    def spelled(self, at: np.ndarray) -> list[bytes]:
        spans = zip(self.begin[at].tolist(), self.end[at].tolist(), strict=True)
        return [self.data[a:b].lower() for a, b in spans]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang")
    )


WORD_STREAM = "part int, lang string, n int, ids binary, words binary, counts binary"


def word_streams(docs: DataFrame, parts: int, stretch: int = STRETCH) -> DataFrame:
    """Counts of all words as streams per part and language, pre-aggregated in each task: ids in order, words, counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, names, size = [], {}, 0

        def streams() -> Iterator[tuple]:
            ids, counts, langs = (np.concatenate([h[k] for h in held]) for k in range(3))
            spelled = [w for h in held for w in h[3]]
            known, first, where = np.unique(ids, return_index=True, return_inverse=True)
            f = np.bincount(where, counts, len(known)).astype(np.int64)
            part, lang = (known % np.uint64(parts)).astype(np.int64), langs[first]
            order = np.lexsort((part, lang))
            edges = np.flatnonzero(np.diff(lang[order] * parts + part[order], prepend=-1, append=-1))
            texts = list(names)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = order[a:b]
                words = b"\n".join([spelled[i] for i in first[own].tolist()])
                steps = np.diff(known[own], prepend=np.uint64(0))
                yield int(part[own[0]]), texts[lang[own[0]]], len(own), _planes(steps), words, _planes(f[own])

        for batch in batches:
            texts, langs = batch["text"].tolist(), batch["lang"].tolist()
            for part in slices(texts, SLICE):
                words, own = Words(texts[part], langs[part]), langs[part]
                if not len(words.ids):
                    continue
                known, first, n = np.unique(words.ids, return_index=True, return_counts=True)
                codes = np.array([names.setdefault(lang, len(names)) for lang in own], np.int64)
                held.append((known, n, codes[words.text[first]], words.spelled(first)))
                size += len(words.ids)
                if size >= stretch:
                    yield from _frames(streams(), WORD_COLUMNS)
                    held, size = [], 0
        if size:
            yield from _frames(streams(), WORD_COLUMNS)

    return _texts(docs).mapInPandas(run, WORD_STREAM)


def frequent_words(streams: DataFrame, parts: int, min_count: int) -> DataFrame:
    """Per language id, word and f of words with ``min_count`` occurrences or more, and rows without id that add up to the
    occurrences of all words of the language.
    """

    def merged(lang: str, held: list[tuple]) -> pd.DataFrame:
        ids = np.concatenate([np.cumsum(_numbers(steps, n).view(np.uint64), dtype=np.uint64) for n, steps, _, _ in held])
        counts = np.concatenate([_numbers(c, n) for n, _, _, c in held])
        known, first, where = np.unique(ids, return_index=True, return_inverse=True)
        f = np.zeros(len(known), np.int64)
        np.add.at(f, where, counts)
        kept = np.flatnonzero(f >= min_count)
        spelled = [w for _, _, words, _ in held for w in words.split(b"\n")]
        return pd.DataFrame(
            {
                "lang": lang,
                "id": pd.array([None, *known[kept].view(np.int64).tolist()], "Int64"),
                "word": [None, *[spelled[i].decode() for i in first[kept].tolist()]],
                "f": [int(f.sum()), *f[kept].tolist()],
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (_, lang), held in _by_key(batches):
            yield merged(lang, held)

    ordered = streams.repartition(parts, "part").sortWithinPartitions("part", "lang")
    return ordered.mapInPandas(run, "lang string, id long, word string, f long")


def _by_key(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, list[tuple]]]:
    """The streams of each key: its two columns come first, and the rows are in their order."""
    held, key = [], None
    for batch in batches:
        for a, b, *stream in batch.itertuples(index=False):
            if held and (a, b) != key:
                yield key, held
                held = []
            key = a, b
            held.append(tuple(stream))
    if held:
        yield key, held


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of n-grams, given by the ids of their words (one array per place)."""
    total = np.zeros(len(words[0]), np.uint64)
    for j, w in enumerate(words):
        total = mixed(total + w, 50 + j)
    return total


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, all lowest ones first, with as many planes as the largest needs; high ones compress well."""
    width = max((int(values.max()).bit_length() + 7) // 8, 1)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(planes: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    given = np.frombuffer(planes, np.uint8).reshape(-1, n)
    out[:, : len(given)] = given.T
    return out.view("<i8").ravel()


def _places(codes: np.ndarray, size: int, base: int) -> list[np.ndarray]:
    """The word numbers of n-grams; ``codes`` are in prefix order, the first word in the highest place."""
    places = []
    for _ in range(size - 1):
        codes, last = np.divmod(codes, base)
        places.append(last)
    return [codes, *places[::-1]]


def _codes(places: list[np.ndarray], base: int) -> np.ndarray:
    code = places[0].astype(np.int64)
    for p in places[1:]:
        code = code * base + p
    return code


def pack(codes: np.ndarray, counts: np.ndarray, known: np.ndarray, size: int, listed: bool) -> tuple[int, bytes, bytes, bytes]:
    """A stream of n-grams in prefix order: their number, word ids, steps from n-gram to n-gram, counts.

    Unless all tasks know the words, they are ``listed``: those in the stream, and n-grams are numbered by these.
    """
    ids = b""
    if listed:
        used, numbers = np.unique(np.concatenate(_places(codes, size, len(known))), return_inverse=True)
        ids, codes = known[used].astype("<u8").tobytes(), _codes(list(numbers.reshape(size, -1)), len(used))
    return len(codes), ids, _planes(np.diff(codes, prepend=0)), _planes(counts)


def unpack(
    n: int, ids: bytes, steps: bytes, counts: bytes, size: int, known: np.ndarray | None
) -> tuple[list[np.ndarray], np.ndarray]:
    words = np.frombuffer(ids, "<u8") if known is None else known
    return [words[p] for p in _places(np.cumsum(_numbers(steps, n)), size, len(words))], _numbers(counts, n)


def counted(
    ids: np.ndarray, piece: np.ndarray, parts: int, max_words: int, stretch: int, known: np.ndarray | None
) -> Iterator[tuple]:
    """Streams (part, size, n, ids, steps, counts) of the n-grams of a task's words, counted by stretches.

    With ``known``, the sorted ids of all frequent words, n-grams with another word are left out.
    """
    for lo in range(0, len(ids), stretch):
        own, pieces = ids[lo : lo + stretch + max_words - 1], piece[lo : lo + stretch + max_words - 1]
        if known is None:
            words, numbers = np.unique(own, return_inverse=True)
            found = np.ones(len(own), bool)
        else:
            words = known
            numbers = np.minimum(np.searchsorted(words, own), len(words) - 1)
            found = words[numbers] == own
        for size in range(2, max_words + 1):
            n = min(stretch, len(own) - size + 1)
            if n <= 0:
                continue
            whole = pieces[:n] == pieces[size - 1 : size - 1 + n]
            for j in range(size):
                whole &= found[j : j + n]
            begin = np.flatnonzero(whole)
            codes, counts = np.unique(_codes([numbers[begin + j] for j in range(size)], len(words)), return_counts=True)
            part = (gram_hash([words[p] for p in _places(codes, size, len(words))]) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
            edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                mine = order[a:b]
                yield int(part[mine[0]]), size, *pack(codes[mine], counts[mine], words, size, known is None)


STREAM = "part int, size int, n int, ids binary, steps binary, counts binary"
COLUMNS, WORD_COLUMNS = (["part", "size", "n", "ids", "steps", "counts"], ["part", "lang", "n", "ids", "words", "counts"])
#: Bytes of streams that a task hands on at once.
FRAME = 4 << 20


def _frames(streams: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    rows, size = [], 0
    for stream in streams:
        rows.append(stream)
        size += sum(map(len, stream[3:]))
        if size >= FRAME:
            yield pd.DataFrame(rows, columns=columns)
            rows, size = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def gram_streams(
    docs: DataFrame, parts: int, max_words: int, known: Broadcast | None, stretch: int = STRETCH
) -> DataFrame:
    """Counts of the n-grams within pieces, as packed streams per part, pre-aggregated in each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, pieces, size, last = [], [], 0, 0

        def frames() -> Iterator[pd.DataFrame]:
            words = known.value if known else None
            return _frames(counted(np.concatenate(ids), np.concatenate(pieces), parts, max_words, stretch, words), COLUMNS)

        for batch in batches:
            texts, langs = batch["text"].tolist(), batch["lang"].tolist()
            for part in slices(texts, SLICE):
                words = Words(texts[part], langs[part])
                if not len(words.ids):
                    continue
                ids.append(words.ids)
                pieces.append(words.piece + last)
                last += int(words.piece[-1]) + 1
                size += len(words.ids)
                if size >= stretch:
                    yield from frames()
                    ids, pieces, size, last = [], [], 0, 0
        if size:
            yield from frames()

    return _texts(docs).mapInPandas(run, STREAM)


def frequent(streams: DataFrame, parts: int, max_words: int, min_count: int, known: Broadcast | None) -> DataFrame:
    """N-grams with ``min_count`` occurrences or more: size, word ids w1, w2 ... (null beyond its size), f.

    The parts are dealt to as many tasks, a number that small streams do not lower: a part is large once it is unpacked.
    """
    names = [f"w{j + 1}" for j in range(max_words)]

    def merged(size: int, held: list[tuple]) -> pd.DataFrame:
        streams = [unpack(*held.pop(), size, known.value if known else None) for _ in range(len(held))]
        words = [np.concatenate([s[0][j] for s in streams]) for j in range(size)]
        counts, hashes = np.concatenate([s[1] for s in streams]), gram_hash(words)
        del streams
        order = np.argsort(hashes, kind="stable")
        begin = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]))
        f = np.add.reduceat(counts[order], begin)
        first = order[begin[f >= min_count]]
        columns = {name: pd.array(w[first].view(np.int64), "Int64") for name, w in zip(names, words, strict=False)}
        columns |= {name: pd.array([None] * len(first), "Int64") for name in names[size:]}
        return pd.DataFrame({"size": size, **columns, "f": f[f >= min_count]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (_, size), held in _by_key(batches):
            yield merged(size, held)

    ordered = streams.repartition(parts, "part").sortWithinPartitions("part", "size")
    return ordered.mapInPandas(run, f"size int, {', '.join(f'{n} long' for n in names)}, f long")


def _looked_up(longer: DataFrame, shorter: DataFrame, names: list[str], count: str, how: str = "inner") -> DataFrame:
    """``longer`` with the count of the n-gram in its columns ``names``, by a merge join of streams sorted by these."""
    keys = [f"key{j}" for j in range(len(names))]
    side = shorter.select(*[F.col(f"w{j + 1}").alias(k) for j, k in enumerate(keys)], F.col("f").alias(count))
    on = [longer[n] == side[k] for n, k in zip(names, keys, strict=True)]
    return longer.hint("merge").join(side.hint("merge"), on, how).drop(*keys)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in exact decimals; a is at most l and r, so the result is small."""
    wide = [x.cast("decimal(18,0)") for x in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000), wide[1] * wide[2])


def scored(grams: DataFrame, words: DataFrame, max_words: int) -> DataFrame:
    """Every n-gram with its lowest-scoring cut: size, w1 ..., f, and cut (score, k, l, r)."""
    by_size = {1: words.select(F.col("id").alias("w1"), "f")}
    by_size |= {size: grams.where(F.col("size") == size) for size in range(2, max_words + 1)}
    out = None
    for size in range(2, max_words + 1):
        rows, names = by_size[size], [f"w{j + 1}" for j in range(size)]
        for k in range(1, size):
            rows = _looked_up(rows, by_size[k], names[:k], f"l{k}")  # prefix order
            rows = _looked_up(rows, by_size[size - k], names[k:], f"r{k}")  # suffix order
        cuts = [
            F.struct(_score(F.col("f"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                     F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
            for k in range(1, size)
        ]
        rows = rows.withColumn("cut", F.least(*cuts) if size > 2 else cuts[0]).select(*grams.columns, "cut")
        out = rows if out is None else out.unionByName(rows)
    return out


def without_parts(rows: DataFrame, grams: DataFrame, max_words: int, share: int) -> DataFrame:
    """``rows`` without n-grams that have a longer one around them with at least ``share`` percent of their count."""
    for size in range(2, max_words):
        inside = [
            grams.where(F.col("size") == longer).select(
                *[F.col(f"w{at + j + 1}").alias(f"w{j + 1}") for j in range(size)], F.col("f").alias("f")
            )
            for longer in range(size + 1, max_words + 1)
            for at in range(longer - size + 1)
        ]
        most = inside[0]
        for more in inside[1:]:
            most = most.unionByName(more)
        names = [f"w{j + 1}" for j in range(size)]
        most = most.groupBy(*names).agg(F.max("f").alias("f"))
        own = _looked_up(rows.where(F.col("size") == size), most, names, "around", "left")
        own = own.where(F.col("around").isNull() | (100 * F.col("around") < share * F.col("f"))).drop("around")
        rows = rows.where(F.col("size") != size).unionByName(own)
    return rows


def numbered(words: DataFrame, most: int) -> Broadcast | None:
    """The sorted ids of ``words`` for all tasks, if there are ``most`` or fewer: 16 MB at 8 bytes for two million."""
    if words.limit(most + 1).count() > most:
        return None
    ids = words.select("id").toPandas()["id"].to_numpy(np.int64).view(np.uint64)
    return words.sparkSession.sparkContext.broadcast(np.sort(ids))


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    min_count: int = 10,
    share: int = 50,
    top: int | None = 2000,
    parts: int | None = None,
    most_numbered: int = MAX_NUMBERS,
) -> DataFrame:
    """Phrases of 2 to ``max_words`` (2 or 3) words by how much more often than apart their words stand together.

    ``docs`` needs text and lang; other columns are ignored. Returns per language the first ``top`` phrases (None: all): lang,
    rank, phrase, its count a, the counts l and r of the two sides of its lowest-scoring cut, n words of the language, and
    score, floor(1000000 a a / (l r)). Null languages count as ``und``; null and empty texts have no words; repeated
    rows count as often as they occur; an empty table gives no phrases. Texts of any length are counted in stretches.
    ``parts`` is by default derived from the bytes of text, of which only the sum reaches the driver. If there are at most
    ``most_numbered`` frequent words (``MAX_NUMBERS`` at most), all tasks get their ids, and streams hold no others and no
    ids; if there are more, every stream lists its words, and is about three times as long. The rows are the same.
    """
    if not 2 <= max_words <= MAX_WORDS or most_numbered > MAX_NUMBERS:
        raise ValueError(f"max_words is 2 to {MAX_WORDS}, most_numbered {MAX_NUMBERS} at most")
    if parts is None:
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = 1 + total // PART_BYTES
    words = settle(frequent_words(word_streams(docs, parts), parts, min_count), "words")
    known = words.where("id IS NOT NULL")
    numbers = numbered(known, most_numbered)
    if numbers is not None and not len(numbers.value):
        docs = docs.limit(0)  # no frequent word, so no phrase
    streams = gram_streams(docs, parts, max_words, numbers)
    grams = settle(frequent(streams, parts, max_words, min_count, numbers), "grams")
    rows = without_parts(scored(grams, known, max_words), grams, max_words, share)
    for j in range(max_words):
        side = known.select(F.col("id").alias(f"w{j + 1}"), F.col("word").alias(f"word{j + 1}"), *(["lang"] if j == 0 else []))
        rows = rows.join(side, f"w{j + 1}", "left" if j >= 2 else "inner")
    phrase = F.concat_ws(" ", *[f"word{j + 1}" for j in range(max_words)])
    rows = rows.select("lang", phrase.alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        rows = rows.where(F.col("rank") <= top)  # on the rank itself, so that map tasks send no more either
    rows = rows.withColumn("rank", F.col("rank").cast("long"))
    totals = words.where("id IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
