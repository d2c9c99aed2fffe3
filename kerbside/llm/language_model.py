"""A hierarchical Pitman-Yor language model, trained by Gibbs sampling and scored on Spark.

The context of a token is the word before it, or the start of the text. Every context has a restaurant whose customers are
the tokens seen there; its tables are customers of the one parent restaurant over all words, and the parent's tables draw
from a uniform base over the known words and one unknown. A sweep reseats all customers of a word in a restaurant by the
Chinese restaurant rule, given the other words' tables; then the parent's. Predictive probabilities are averaged over the
sweeps after burn-in.

Restaurants lie in buckets by context, words in homes; the customers of very frequent contexts are spread over the buckets,
and their totals are shared with all tasks. In a sweep, buckets reseat the pairs seen at least twice (a pair seen once always
has one table) and tell the words' homes their tables; the homes reseat the parent's customers and answer with the words'
totals. To be scored, tokens are dealt to the buckets of their contexts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import settle
from kerbside.llm.ngram_join import word_hashes
from kerbside.llm.token_store import mixed
from kerbside.llm.tokens import slices

#: The most frequent contexts, at most, whose customers are spread over the buckets.
CONTEXTS = 64
START = 0
END = 0x454E44
SWEEPS, BURN_IN = 3, 1
STRENGTH, PARENT_STRENGTH = 5.0, 5.0
#: Tokens that a task gathers before it hands them on, and bytes of text of a bucket.
GATHERED = 3_000_000
#: Characters of text that are hashed at once, and gathered tokens (whole buckets of them) that are sorted at once.
HASHED, SORTED = 1_000_000, 400_000
BUCKET_BYTES = 12_000_000
#: One document of so many tells which contexts are spread; this moves rows and leaves nothing out.
LOOKED_AT = 64

ROW = "key long, kind int, source long, n long, m long, payload binary"
#: Kinds of rows for a bucket: seating, words of its pairs, a home's answer, words of a home, tokens.
SEATING, NAMES, ANSWER, VOCABULARY, TOKENS = range(5)
#: For a home: words; places of the words of a bucket, all and those of reseated pairs; the same told by hash; their tables.
WORDS, REQUEST, ASKED, TOLD_WORDS, TOLD_NAMES, TOLD_TABLES = range(5, 11)
#: Of what is added up for the driver: pairs and words seen once and twice, words and tokens, tables, spread contexts.
ONCE_PAIRS, ONCE_WORDS, SIZES, PARENT, SPREAD = range(11, 16)


def held_out(doc_id: str | None) -> bool:
    """Whether a document, by its doc_id as text, is kept from training."""
    return zlib.crc32((doc_id or "").encode()) % 5 == 1


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts the token hashes (words, then an end), those of the words before them, and the text of each."""
    hashes, at, _ = word_hashes(texts)
    counts = np.diff(at)
    text = np.repeat(np.arange(len(texts)), counts + 1)
    ends = np.cumsum(counts + 1) - 1
    word = np.full(len(text), END, np.uint64)
    inner = np.ones(len(text), bool)
    inner[ends] = False
    word[inner] = hashes
    context = np.full(len(text), START, np.uint64)
    context[np.flatnonzero(inner) + 1] = hashes
    return word, context, text


def _low(dtype: np.dtype) -> int:
    """Bytes of a value that compression does not make smaller: the low ones of hashes and scores."""
    return 6 if dtype.kind == "f" or dtype == np.uint64 else 0


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays in a row; high bytes are compressed plane by plane."""
    out = []
    for a in arrays:
        low = _low(a.dtype)
        planes = np.frombuffer(a.tobytes(), "u1").reshape(-1, a.itemsize)
        high = zlib.compress(planes[:, low:].T.tobytes(), 1)
        out += [np.array([len(a), len(high)], "<i8").tobytes(), high, planes[:, :low].tobytes()]
    return b"".join(out)


def _unpack(data: bytes, *dtypes: str) -> list[np.ndarray]:
    out, at = [], 0
    for dtype in map(np.dtype, dtypes):
        n, size = np.frombuffer(data, "<i8", 2, at).tolist()
        low, at = _low(dtype), at + 16
        planes = np.empty((n, dtype.itemsize), "u1")
        planes[:, low:] = np.frombuffer(zlib.decompress(data[at : at + size]), "u1").reshape(-1, n).T if n else 0
        planes[:, :low] = np.frombuffer(data, "u1", n * low, at + size).reshape(n, low)
        out.append(np.frombuffer(planes.tobytes(), dtype))
        at += size + n * low
    return out


def _pairs(context: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
    """Pairs to be packed: contexts and how many follow each, words and the place of each."""
    words, at = np.unique(word, return_inverse=True)
    return [*_runs(context), words, at.astype("<u4")]


#: What ``_pairs`` gives.
PAIRS = ("<u8", "<i8", "<u8", "<u4")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    """Rows (key, kind, source, n, m, payload)."""
    return pd.DataFrame(rows, columns=["key", "kind", "source", "n", "m", "payload"])


def _dealt(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows by key, sorted. A partition holds one bucket or home, and its share of the keys below 0."""
    rows = rows.repartitionById(partitions, F.pmod("key", F.lit(partitions)).cast("int"))
    return rows.sortWithinPartitions("key", "kind", "source")


def _by_key(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list]]:
    key, rows = None, []
    for batch in batches:
        for r in batch.itertuples(index=False):
            if rows and r.key != key:
                yield key, rows
                rows = []
            key = r.key
            rows.append(r)
    if rows:
        yield key, rows


def _emptied(parts: list[np.ndarray]) -> np.ndarray:
    """The arrays of ``parts`` as one; they are let go."""
    joined = np.concatenate(parts)
    parts.clear()
    return joined


def _joined(parts: list[list[np.ndarray]], *dtypes: str) -> list[np.ndarray]:
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, d) for k, d in enumerate(dtypes)]


def _find(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of ``wanted`` in sorted ``values``, and which of them are there."""
    if not len(values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return at, values[at] == wanted


def _order(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order with equal pairs side by side, contexts together, and where new pairs begin in it."""
    order = np.argsort((context & np.uint64(0xFFFFFFFF00000000)) | (word >> np.uint64(32)))
    context, word = context[order], word[order]
    return order, np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (context[1:] != context[:-1])]))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of runs of equal ones and their lengths."""
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[begin], np.diff(np.append(begin, len(values)))


@dataclass(frozen=True)
class Layout:
    """How contexts and words are dealt."""

    buckets: int
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def bucket(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        both = np.where(_find(self.spread, context)[1], context ^ mixed(word, 14), context)
        return (mixed(both, 12) % np.uint64(self.buckets)).astype(np.int64)

    def home(self, word: np.ndarray) -> np.ndarray:
        return (mixed(word, 13) % np.uint64(self.buckets)).astype(np.int64)

    def groups(self, bucket: np.ndarray) -> Iterator[np.ndarray]:
        """The places of ``bucket`` in the order of the buckets, in parts that hold whole buckets and few places beyond
        ``SORTED``, so that a sort of one needs little memory."""
        order = np.argsort(bucket, kind="stable")
        edges = np.cumsum(np.bincount(bucket, minlength=self.buckets))
        begin = 0
        for end, after in zip(edges.tolist(), [*edges[1:].tolist(), None], strict=True):
            if end > begin and (after is None or after - begin > SORTED):
                yield order[begin:end]
                begin = end

    def split(self, bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
        """The stretches of a sorted ``bucket``."""
        edges = np.searchsorted(bucket, np.arange(self.buckets + 1))
        return ((b, slice(lo, hi)) for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if hi > lo)


def layout(docs: DataFrame) -> Layout:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(12, -(-size // BUCKET_BYTES))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts):
                contexts, n = np.unique(tokens(texts[part])[1], return_counts=True)
                yield pd.DataFrame({"u": contexts.view(np.int64), "n": n})

    some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(LOOKED_AT)) == 0).mapInPandas(run, "u long, n long")
    some = some.groupBy("u").agg(F.sum("n").alias("n"))
    top = some.orderBy(F.desc("n"), "u").limit(CONTEXTS).collect()
    total = some.agg(F.sum("n")).first()[0] or 0
    spread = np.array([r["u"] for r in top if r["n"] * buckets > total], np.int64).view(np.uint64)
    return Layout(buckets, np.sort(spread))


def _gathered_pairs(docs: DataFrame, at: Layout) -> DataFrame:
    """The pairs of all documents with their training counts. Tasks add up what they can before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0

        def merged(context, word, count) -> tuple:
            order, new = _order(context, word)
            return context[order][new], word[order][new], np.add.reduceat(count[order], new)

        def rows() -> Iterator[pd.DataFrame]:
            parts = [list(x) for x in zip(*held, strict=True)]
            held.clear()
            context, word, count, bucket = (_emptied(x) for x in parts)
            for own in at.groups(bucket):
                u, w, c = merged(context[own], word[own], count[own])
                b = at.bucket(u, w)
                order = np.argsort(b, kind="stable")
                u, w, c, b = u[order], w[order], c[order], b[order]
                yield _frame([(b, 0, 0, 0, 0, _pack(*_pairs(u[s], w[s]), c[s].astype("<u4"))) for b, s in at.split(b)])

        for batch in batches:
            texts = batch["text"].tolist()
            kept = np.array([not held_out(k) for k in batch["doc_id"]], np.int32)
            for part in slices(texts):
                begin, few = part.start, []
                for own in slices(texts[part], HASHED):
                    word, context, text = tokens(texts[begin + own.start : begin + own.stop])
                    few.append((context, word, kept[begin + own.start : begin + own.stop][text]))
                u, w, c = merged(*(np.concatenate(x) for x in zip(*few, strict=True)))
                held.append((u, w, c, at.bucket(u, w).astype(np.int32)))
                size += len(u)
                if size > GATHERED:
                    yield from rows()
                    size = 0
        if held:
            yield from rows()

    return docs.mapInPandas(run, ROW)


class Seating:
    """A bucket's restaurants: contexts with a pair seen twice (and spread ones), and those pairs."""

    NAMES = ("u", "n", "once", "pairs", "homes", "wi", "c", "t", "seen", "tables")
    TYPES = ("<u8", "<i8", "<i8", "<i8", "<i8", "<u4", "<u4", "<u4", "<u4", "<i8")

    def __init__(self, *arrays: np.ndarray):
        #: contexts, customers, pairs seen once, other pairs; words of each home; of the pairs the word's place, customers,
        #: tables now and added up over samples; tables of the contexts, sample by sample
        for name, values in zip(self.NAMES, arrays, strict=True):
            setattr(self, name, values)
        self.ui = np.repeat(np.arange(len(self.u)), self.pairs)

    @classmethod
    def read(cls, payload: bytes) -> Seating:
        return cls(*_unpack(payload, "<i8", *cls.TYPES)[1:])

    def now(self) -> np.ndarray:
        """Tables of the contexts."""
        return self.once + np.bincount(self.ui, self.t, len(self.u)).astype(np.int64)

    def rows(self, bucket: int, at: Layout) -> list[tuple]:
        """The row of the bucket, the tables of its words for their homes, and the totals of spread contexts."""
        data = (getattr(self, k).astype(d) for k, d in zip(self.NAMES, self.TYPES, strict=True))
        out = [(bucket, SEATING, 0, 0, 0, _pack(np.array([SEATING, bucket]), *data))]
        tables = np.bincount(self.wi, self.t, int(self.homes.sum())).astype("<u4")
        told = np.split(tables, np.cumsum(self.homes)[:-1])
        out += [(h, TOLD_TABLES, bucket, 0, 0, _pack(t)) for h, t in enumerate(told) if len(t)]
        now = self.now()
        out += [
            (int(self.u[i].view(np.int64)), SPREAD, 0, int(self.n[i]), int(now[i]), b"")
            for i in np.flatnonzero(_find(at.spread, self.u)[1])
        ]
        return out


def count_tokens(docs: DataFrame, at: Layout) -> DataFrame:
    """The first seating, one table a pair, and what the homes are told of words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bucket, rows in _by_key(batches):
            parts = [_unpack(r.payload, *PAIRS, "<u4") for r in rows]
            u = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
            w, c = np.concatenate([p[2][p[3]] for p in parts]), np.concatenate([p[4] for p in parts])
            order, new = _order(u, w)
            u, w, c = u[order][new], w[order][new], np.add.reduceat(c[order].astype(np.int64), new)
            words, place = np.unique(w, return_inverse=True)
            home = at.home(words)
            order = np.argsort(home, kind="stable")
            told = [x[order] for x in (words, np.bincount(place, c), np.bincount(place, c == 1))]
            out = [
                (h, TOLD_WORDS, bucket, 0, 0, _pack(told[0][s], *(x[s].astype("<i8") for x in told[1:])))
                for h, s in at.split(home[order])
            ]
            out.append((0, ONCE_PAIRS, 0, int((c == 1).sum()), int((c == 2).sum()), b""))
            contexts, place = np.unique(u, return_inverse=True)
            again = c > 1
            n, pairs = np.bincount(place, c), np.bincount(place, again).astype(np.int64)
            own = (pairs > 0) | _find(at.spread, contexts)[1]
            again = np.flatnonzero(again)
            again = again[np.argsort(place[again], kind="stable")]
            words, wi = np.unique(w[again], return_inverse=True)
            home = at.home(words)
            order = np.argsort(home, kind="stable")
            words, home = words[order], home[order]
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            ones = np.ones(len(again), np.int64)
            once = np.bincount(place, c == 1).astype(np.int64)
            first = Seating(
                contexts[own], n[own], once[own], pairs[own], np.bincount(home, minlength=at.buckets), back[wi],
                c[again], ones, 0 * ones, np.zeros(0, np.int64),
            )
            out.append((bucket, NAMES, 0, 0, 0, _pack(np.array([NAMES, bucket]), words)))
            out += [(h, TOLD_NAMES, bucket, 0, 0, _pack(words[s])) for h, s in at.split(home)]
            yield _frame(out + first.rows(int(bucket), at))

    return _dealt(_gathered_pairs(docs, at), at.buckets).mapInPandas(run, ROW)


@dataclass(frozen=True)
class Totals:
    """What all tasks share: customers and tables of the spread contexts (and of all others together), and the parent's."""

    layout: Layout
    customers: np.ndarray
    tables: np.ndarray
    parent_customers: int
    parent_tables: int
    words: int
    discount: float
    parent_discount: float

    def base(self) -> float:
        return (PARENT_STRENGTH + self.parent_discount * self.parent_tables) / (self.words + 1)

    def parent(self, customers, tables):
        """The parent's probability of words with these customers and tables there."""
        return (customers - self.parent_discount * tables + self.base()) / (PARENT_STRENGTH + self.parent_customers)

    def mass(self, tables):
        """What a restaurant hands to the parent, times its size."""
        return STRENGTH + self.discount * tables

    def shared(self, context: np.ndarray, own: np.ndarray, values: np.ndarray) -> np.ndarray:
        """``own`` values of contexts, with those of ``values`` (customers or tables) for spread ones."""
        at, there = _find(self.layout.spread, context)
        return np.where(there, values[at], own)


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that so many customers of one dish take, one after the other; a new table has ``weight``.

    The first 64 customers sit down one by one; later ones in groups that grow with the number seated.
    """
    tables = np.ones(len(customers), np.int64)
    own = np.flatnonzero(customers > 1)
    n = 1
    while own.size:
        step = np.minimum(max(1, n // 16) if n >= 64 else 1, customers[own] - n)
        t = tables[own]
        chance = weight[own] / (weight[own] + n - discount * t)
        new = rng.random(len(own)) < chance if n < 64 else rng.binomial(step, chance)
        tables[own] = t + new
        n += max(1, n // 16) if n >= 64 else 1
        own = own[customers[own] > n]
    return tables


def sweep(rows: DataFrame, totals: Totals, keep: bool, seed: int) -> DataFrame:
    """Reseats the customers of every pair by the homes' answers; ``keep`` makes the new seating a sample."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bucket, rows in _by_key(batches):
            own = Seating.read(rows[0].payload)
            answers = [_unpack(r.payload, "<u4", "<u4") for r in rows[1:]]  # in the order of homes, as the words are
            customers, tables = (x.astype(np.int64) for x in _joined(answers, "<u4", "<u4"))
            mass = totals.mass(totals.shared(own.u, own.now(), totals.tables))
            weight = mass[own.ui] * totals.parent(customers, tables)[own.wi]
            rng = np.random.default_rng([seed, int(bucket)])
            own.t = seat(own.c.astype(np.int64), weight, totals.discount, rng)
            if keep:
                own.seen = own.seen + own.t
                own.tables = np.concatenate([own.tables, own.now()])
            yield _frame(own.rows(int(bucket), totals.layout))

    return _dealt(rows.where(F.col("kind").isin(SEATING, ANSWER)), totals.layout.buckets).mapInPandas(run, ROW)


def tell_homes(rows: DataFrame, at: Layout, totals: Totals | None, keep: bool, seed: int) -> DataFrame:
    """The words' homes add up the tables they are told of, reseat the parent's customers and answer.

    Without ``totals`` the words are new: each takes one table of the parent. Requests name the words of every bucket.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for home, rows in _by_key(batches):
            home, out, asked = int(home), [], {}
            if rows[0].kind == WORDS:
                w, c, once, samples = _unpack(rows[0].payload, "<u8", "<i8", "<i8", "<i8")
                asked = {r.source: _unpack(r.payload, "<u4")[0] for r in rows if r.kind == ASKED}
            else:
                told = {r.source: _unpack(r.payload, "<u8", "<i8", "<i8") for r in rows if r.kind == TOLD_WORDS}
                w, place = np.unique(np.concatenate([p[0] for p in told.values()]), return_inverse=True)
                c, once = (
                    np.bincount(place, np.concatenate([p[k] for p in told.values()])).astype(np.int64) for k in (1, 2)
                )
                samples = np.zeros(0, np.int64)
                requests = [(home, REQUEST, b, 0, 0, _pack(np.searchsorted(w, p[0]).astype("<u4"))) for b, p in told.items()]
                for r in rows:
                    if r.kind == TOLD_NAMES:
                        asked[r.source] = np.searchsorted(w, _unpack(r.payload, "<u8")[0]).astype("<u4")
                        requests.append((home, ASKED, r.source, 0, 0, _pack(asked[r.source])))
                known = c[c > 0]
                out = [*requests, (0, SIZES, 0, len(known), int(known.sum()), b"")]
                out.append((0, ONCE_WORDS, 0, int((c == 1).sum()), int((c == 2).sum()), b""))
            customers = once.copy()
            for r in rows:
                if r.kind == TOLD_TABLES:
                    customers[asked[r.source]] += _unpack(r.payload, "<u4")[0]
            tables = (customers > 0).astype(np.int64)
            if totals:
                rng = np.random.default_rng([seed, home, 1])
                tables *= seat(customers, np.full(len(w), totals.base()), totals.parent_discount, rng)
            if keep:
                samples = np.concatenate([samples, customers, tables])
            out.append((home, WORDS, 0, 0, 0, _pack(w, c, once, samples)))
            out += [(b, ANSWER, home, 0, 0, _pack(customers[i].astype("<u4"), tables[i].astype("<u4"))) for b, i in asked.items()]
            out.append((0, PARENT, 0, int(customers.sum()), int(tables.sum()), b""))
            yield _frame(out)

    kinds = [WORDS, ASKED, TOLD_WORDS, TOLD_NAMES, TOLD_TABLES]
    return _dealt(rows.where(F.col("kind").isin(kinds)), at.buckets).mapInPandas(run, ROW)


def _totals(rows: DataFrame, at: Layout, before: Totals | None = None) -> Totals:
    sums = rows.where(F.col("kind") >= ONCE_PAIRS)
    # At most CONTEXTS + 4 rows.
    sums = {(r["kind"], r["key"]): (r["n"], r["m"]) for r in sums.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect()}
    shared = np.array([sums.get((SPREAD, int(u)), (0, 0)) for u in at.spread.view(np.int64)], np.int64).reshape(-1, 2)
    customers, tables = sums.get((PARENT, 0), (0, 0))

    def discount(kind: int) -> float:
        n1, n2 = sums.get((kind, 0), (0, 0))
        return min(0.95, max(0.05, n1 / max(1, n1 + 2 * n2)))

    words, total = (before.words, int(before.customers.sum())) if before else sums.get((SIZES, 0), (0, 0))
    return Totals(
        at, np.append(shared[:, 0], total - shared[:, 0].sum()), np.append(shared[:, 1], customers - shared[:, 1].sum()),
        customers, tables, words,
        before.discount if before else discount(ONCE_PAIRS), before.parent_discount if before else discount(ONCE_WORDS),
    )


def train(docs: DataFrame, sweeps: int = SWEEPS, burn_in: int = BURN_IN, seed: int = 1) -> tuple[DataFrame, list[Totals]]:
    """The seating of buckets and words with what the sweeps from ``burn_in`` on sampled, and their totals.

    ``docs`` needs doc_id and text; those that ``held_out`` names are left out, only their words and contexts have a place.
    """
    docs = _rows(docs)
    at = layout(docs)
    seated = settle(count_tokens(docs, at), "seating")
    homes = settle(tell_homes(seated, at, None, False, seed), "words")
    names = seated.where(F.col("kind") == NAMES).unionByName(homes.where(F.col("kind") == REQUEST))
    asked = homes.where(F.col("kind") == ASKED)
    totals = _totals(seated.unionByName(homes), at)
    samples: list[Totals] = []
    for k in range(sweeps):
        rows = seated.where(F.col("kind") == SEATING).unionByName(homes.where(F.col("kind") == ANSWER))
        seated = settle(sweep(rows, totals, k >= burn_in, seed * 1000 + k), "seating")
        told = seated.where(F.col("kind") == TOLD_TABLES).unionByName(homes.where(F.col("kind") == WORDS)).unionByName(asked)
        homes = settle(tell_homes(told, at, totals, k >= burn_in, seed * 1000 + k), "words")
        totals = _totals(seated.unionByName(homes), at, totals)
        if k >= burn_in:
            samples.append(totals)
    state = seated.where(F.col("kind") == SEATING).unionByName(homes.where(F.col("kind") == WORDS))
    return state.unionByName(names), samples


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id as text (pandas would make doubles of whole numbers with nulls among them) and text without nulls."""
    return docs.select(F.col("doc_id").cast("long").cast("string"), F.coalesce("text", F.lit("")).alias("text"))


def _model_rows(state: DataFrame, samples: list[Totals], partitions: int) -> DataFrame:
    """The buckets' seatings, and for every bucket and home the words it asked for, with their samples."""
    n = 2 * len(samples)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for home, rows in _by_key(batches):
            w, c, _, told = _unpack(rows[0].payload, "<u8", "<i8", "<i8", "<i8")
            told = told.reshape(n, -1)
            for r in rows[1:]:
                (i,) = _unpack(r.payload, "<u4")
                data = _pack(np.array([VOCABULARY, r.source]), w[i], c[i], told[:, i].ravel())
                yield _frame([(r.source, VOCABULARY, home, 0, 0, data)])

    homes = _dealt(state.where(F.col("kind").isin(WORDS, REQUEST)), partitions).mapInPandas(run, ROW)
    return state.where(F.col("kind").isin(SEATING, NAMES)).unionByName(homes)


class Model:
    """A bucket's restaurants and words in memory.

    ``trained`` are the contexts and words of its training tokens, from which come the pairs seen once.
    """

    def __init__(self, payloads: list[bytes], samples: list[Totals], total: int, trained: tuple | None = None):
        self.samples, n = samples, len(samples)
        self.scale = total + 0.5 * (samples[0].words + 1)
        kinds = [_unpack(p, "<i8")[0].tolist() for p in payloads]
        words = [_unpack(p, "<i8", "<u8", "<i8", "<i8")[1:] for p, k in zip(payloads, kinds, strict=True) if k[0] == VOCABULARY]
        w, c = _joined([p[:2] for p in words], "<u8", "<i8")
        told = np.concatenate([p[2].reshape(2 * n, -1) for p in words], axis=1) if words else np.zeros((2 * n, 0))
        known = np.flatnonzero(c > 0)
        self.w, first = np.unique(w[known], return_index=True)
        first = known[first]
        self.c = c[first]
        self.parent = [t.parent(told[2 * k, first], told[2 * k + 1, first]) for k, t in enumerate(samples)]
        self.unknown = [t.parent(0, 0) for t in samples]

        names = {k[1]: _unpack(p, "<i8", "<u8")[1] for p, k in zip(payloads, kinds, strict=True) if k[0] == NAMES}
        seated = {k[1]: Seating.read(p) for p, k in zip(payloads, kinds, strict=True) if k[0] == SEATING}
        own = list(seated.values())
        u = np.concatenate([x.u for x in own] + [samples[0].layout.spread])
        customers = np.concatenate([x.n for x in own] + [0 * samples[0].customers[:-1]])
        tables = np.concatenate([x.tables.reshape(n, -1) for x in own] + [np.zeros((n, len(u) - sum(len(x.u) for x in own)))], axis=1)
        context, word = trained or (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        more, count = np.unique(context, return_counts=True)
        new = ~np.isin(more, u)  # all their pairs are seen once
        u = np.concatenate([u, more[new]])
        self.u, first = np.unique(u, return_index=True)
        customers = np.concatenate([customers, count[new]])[first]
        tables = np.concatenate([tables, np.tile(count[new], (n, 1))], axis=1)[:, first]
        self.customers = samples[0].shared(self.u, customers, samples[0].customers)
        self.mass = [t.mass(t.shared(self.u, tables[k], t.tables)) for k, t in enumerate(samples)]

        discount = samples[0].discount
        codes = [self._codes(x.u[x.ui], names[b][x.wi]) for b, x in seated.items()]
        parts = [x.c - discount * x.seen / n for x in own]
        single, count = np.unique(self._codes(context, word), return_counts=True)
        codes.append(single[count == 1])
        parts.append(np.full(len(codes[-1]), 1 - discount))
        codes, parts = np.concatenate(codes), np.concatenate(parts)
        by = np.argsort(codes)
        self.codes, self.parts = codes[by], parts[by]

    def _codes(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.u, context) * len(self.w) + np.searchsorted(self.w, word)

    def score(self, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability, base log10 probability and whether known, of every (word, context)."""
        at, known = _find(self.w, word)
        place, there = _find(self.u, context.astype(np.uint64))
        j, seen = _find(self.codes, place * len(self.w) + at)
        part = np.zeros(len(word))
        seen &= known & there
        part[seen] = self.parts[j[seen]]
        prob = np.zeros(len(word))
        for mass, parent, unknown in zip(self.mass, self.parent, self.unknown, strict=True):
            above = np.full(len(word), unknown)
            above[known] = parent[at[known]]
            prob += (np.where(there, mass[place], STRENGTH) if len(mass) else STRENGTH) * above
        prob = (part + prob / len(self.samples)) / (STRENGTH + (np.where(there, self.customers[place], 0) if len(self.u) else 0))
        count = np.zeros(len(word))
        count[known] = self.c[at[known]]
        return np.log10(prob), np.log10((count + 0.5) / self.scale), known


def _sums(doc: np.ndarray, score: np.ndarray, base: np.ndarray, known: np.ndarray) -> bytes:
    docs, at = np.unique(doc, return_inverse=True)
    return _pack(
        np.diff(docs.astype("<i8"), prepend=0), np.bincount(at, score), np.bincount(at, base), np.bincount(at, known).astype("<i8")
    )


def score(docs: DataFrame, state: DataFrame, samples: list[Totals]) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    ``docs`` are those that the model was trained with.
    """
    total = int(samples[0].customers.sum())
    layout = samples[0].layout

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        ids: list = []
        n_tokens: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pd.DataFrame]:
            gathered = (task << 32) + number
            lengths = np.concatenate(n_tokens)
            valid = np.array([i is not None for i in ids])
            apart = np.array([held_out(i) for i in ids])
            info = _pack(np.array([int(i or 0) for i in ids], "<i8"), valid.astype("u1"), lengths)
            yield _frame([(-1 - gathered, TOKENS, gathered, 0, 0, info)])
            parts = [list(x) for x in zip(*held, strict=True)]
            held.clear()
            words, contexts, docs, buckets = (_emptied(x) for x in parts)
            for own in layout.groups(buckets):
                out = []
                word, context, doc = words[own], contexts[own], docs[own]
                order, new = _order(context, word)
                doc = (2 * doc.astype(np.int64) + apart[doc])[order].astype("<u4")
                context, word = context[order][new], word[order][new]
                first, count = new, np.diff(np.append(new, len(doc)))
                bucket = layout.bucket(context, word)
                order = np.argsort(bucket, kind="stable")
                context, word, first, count, bucket = (x[order] for x in (context, word, first, count, bucket))
                for b, s in layout.split(bucket):
                    begin = np.cumsum(count[s]) - count[s]
                    there = doc[np.repeat(first[s] - begin, count[s]) + np.arange(count[s].sum())]
                    data = _pack(*_pairs(context[s], word[s]), count[s].astype("<u4"), there)
                    out.append((b, TOKENS, gathered, 0, 0, data))
                yield _frame(out)

        for batch in batches:
            texts, keys = batch["text"].tolist(), batch["doc_id"].tolist()
            for part in slices(texts, HASHED):
                word, context, doc = tokens(texts[part])
                held.append((word, context, (doc + len(ids)).astype(np.int32), layout.bucket(context, word).astype(np.int32)))
                n_tokens.append(np.bincount(doc, minlength=len(texts[part])))
                ids += keys[part]
                size += len(word)
                if size > GATHERED:
                    yield from flush()
                    number += 1
                    held, ids, n_tokens, size = [], [], [], 0
        if held:
            yield from flush()

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, rows in _by_key(batches):
            if key < 0:
                for r in rows:
                    yield pd.DataFrame({"gathered": [r.source], "kind": [1], "payload": [r.payload]})
                continue
            parts = [_unpack(r.payload, *PAIRS, "<u4", "<u4") for r in rows if r.kind == TOKENS]
            if not parts:
                continue
            pairs = [(np.repeat(p[0], p[1]), p[2][p[3]]) for p in parts]
            apart = [np.add.reduceat(p[5] & 1, np.cumsum(p[4], dtype=np.int64) - p[4], dtype=np.int64) for p in parts]
            times = [np.minimum(2, p[4] - a) for p, a in zip(parts, apart, strict=True)]  # only one or more is asked
            trained = tuple(
                np.concatenate([np.repeat(p[k], n) for p, n in zip(pairs, times, strict=True)]) for k in (0, 1)
            )
            model = Model([r.payload for r in rows if r.kind != TOKENS], samples, total, trained)
            sources = [r.source for r in rows if r.kind == TOKENS]
            for source, part, (context, word) in zip(sources, parts, pairs, strict=True):
                values = (np.repeat(x, part[4]) for x in model.score(word, context))
                yield pd.DataFrame({"gathered": [source], "kind": [2], "payload": [_sums(part[5] >> 1, *values)]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gathered, sums, info = None, None, None

        def done() -> pd.DataFrame:
            ids, valid, lengths = info
            keys = pd.arrays.IntegerArray(ids.copy(), valid == 0)
            names = [str(i) if v else None for i, v in zip(ids.tolist(), valid.tolist(), strict=True)]
            return pd.DataFrame(
                {
                    "doc_id": keys, "held_out": [held_out(k) for k in names], "n_tokens": lengths,
                    "n_known": sums[2].astype(np.int64), "train_tokens": total, "base_score": sums[1], "score": sums[0],
                }
            )

        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.kind == 1:
                    if info is not None:
                        yield done()
                    gathered = r.gathered
                    info = _unpack(r.payload, "<i8", "u1", "<i8")
                    sums = np.zeros((3, len(info[0])))
                else:
                    doc, *parts = _unpack(r.payload, "<i8", "<f8", "<f8", "<i8")
                    for k, p in enumerate(parts):
                        sums[k, np.cumsum(doc)] += p
        if gathered is not None:
            yield done()

    rows = _rows(docs).mapInPandas(gather, ROW).unionByName(_model_rows(state, samples, layout.buckets))
    met = _dealt(rows, layout.buckets).mapInPandas(meet, "gathered long, kind int, payload binary")
    met = met.repartition("gathered").sortWithinPartitions("gathered", "kind")
    return met.mapInPandas(
        add, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def train_and_score(docs: DataFrame, sweeps: int = SWEEPS, burn_in: int = BURN_IN, seed: int = 1) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text) by the model of those that are not held out.

    Null texts are empty and have their end alone; a null doc_id counts as an empty text for the choice of the held-out
    part; repeated rows count each. Without training documents every token is unknown.
    """
    state, samples = train(docs, sweeps, burn_in, seed)
    return score(docs, state, samples)
