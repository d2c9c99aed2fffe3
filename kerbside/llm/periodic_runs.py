"""Periodic runs of words: descending-LCP Kruskal over suffix classes.

A run is a maximal stretch of words with a smallest period q and a length of at least ``exponent * q``. If it begins at i,
the suffixes at i and i + q share length - q words, and in the class of all suffixes that share as many they are
neighbours by position: a third one between them would give a smaller period. So classes of suffixes are united by
decreasing common prefix, every class keeps its positions in order, and two positions that become neighbours at a
distance within their common prefix (divided by ``exponent - 1``) seed a run.

Only near-periodic regions are sorted. Every start of a run repeats its first few words at most one period later, and so
do the positions behind it; a stretch of such positions that is too short for the gaps in it can hold no run.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import bind, words_of
from kerbside.llm.token_store import mixed
from kerbside.llm.tokens import slices

#: start (word number), length, period
Run = tuple[int, int, int]


def least_prefix(min_length: int, exponent: int) -> int:
    """The shortest common prefix of the suffixes at the start of a run and one period later."""
    return min(max(min_length - q, (exponent - 1) * q) for q in range(1, max(min_length, 1) + 1))


def regions(ids: np.ndarray, owner: np.ndarray, least: int, exponent: int) -> Iterator[tuple[int, int]]:
    """Stretches of words (begin, end) that hold all runs, each with the word behind it where its text has one.

    A run of period q has at least (exponent - 1) * q - least + 1 starts in a row whose next ``least`` words recur within
    q. So in a stretch of s such positions no period exceeds (s + least - 1) / (exponent - 1), and positions whose words
    recur later than that are cut out, until nothing changes.
    """
    n = len(ids) - least + 1
    if n <= 0:
        return
    factors = mixed(np.arange(least), 31) | np.uint64(1)
    grams = mixed(owner[:n], 32)
    spread = mixed(ids, 33)
    for j in range(least):
        grams += spread[j : n + j] * factors[j]
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    gap = np.zeros(n, np.int64)
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    gap[owner[least - 1 :] != owner[:n]] = 0
    alive = np.flatnonzero(gap)
    while len(alive):
        new = np.concatenate([[True], (np.diff(alive) > 1) | (owner[alive[1:]] != owner[alive[:-1]])])
        begin = np.flatnonzero(new)
        longest = (np.diff(np.append(begin, len(alive))) + least - 1) // (exponent - 1)
        fits = gap[alive] <= longest[np.cumsum(new) - 1]
        if fits.all():
            ends = np.append(begin[1:], len(alive)) - 1
            stops = np.searchsorted(owner, owner[alive[begin]], side="right")
            last = np.minimum(alive[ends] + longest + least + 1, stops)
            yield from zip(alive[begin].tolist(), last.tolist(), strict=True)
            return
        alive = alive[fits]


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the common prefix of each with the one before it (0 for the first), by prefix doubling.

    ``symbols`` are at least 0; equal ones of different regions must differ, then no common prefix leaves its region.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    ranks, width = [rank], 1
    while True:
        behind = np.full(n, -1, np.int64)
        if width < n:
            behind[: n - width] = rank[width:]
        code = rank * (n + 1) + behind + 1
        order = np.argsort(code, kind="stable")
        ordered = code[order]
        if (ordered[1:] != ordered[:-1]).all():
            break
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        ranks.append(rank)
        width *= 2
    common = np.zeros(n, np.int64)
    x, y = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 1, -1, -1):
        inside = np.flatnonzero((x < n) & (y < n))
        equal = inside[ranks[level][x[inside]] == ranks[level][y[inside]]]
        for a in (x, y, common[1:]):
            a[equal] += 1 << level
    return order, common


def seeds(order: np.ndarray, common: np.ndarray, least: int, exponent: int) -> dict[tuple[int, int], int]:
    """The first start of each run, by (period, end).

    Classes are intervals of the suffix order, known at both ends; the smaller one's positions go into the larger.
    """
    first: dict[tuple[int, int], int] = {}
    links = np.flatnonzero(common >= least)
    links = links[np.argsort(-common[links], kind="stable")]
    touched = np.unique(np.concatenate([links - 1, links]))
    # At both ends of its interval a class is [positions, first index, last index].
    at = {t: [[p], t, t] for t, p in zip(touched.tolist(), order[touched].tolist(), strict=True)}
    for t, prefix in zip(links.tolist(), common[links].tolist(), strict=True):
        left, right = at[t - 1], at[t]
        large, small = (left[0], right[0]) if len(left[0]) >= len(right[0]) else (right[0], left[0])
        for p in small:
            insort(large, p)
        most, moved = prefix // (exponent - 1), set(small)
        for p in small:
            k = bisect_left(large, p)
            for i in (k, k + 1):
                # Neighbours that both come from the smaller class have met before, at a longer prefix.
                if 0 < i < len(large) and not (large[i - 1] in moved and large[i] in moved):
                    start, period = large[i - 1], large[i] - large[i - 1]
                    if period <= most:
                        key = (period, large[i] + prefix)
                        if first.get(key, start) >= start:
                            first[key] = start
        merged = [large, left[1], right[2]]
        at[left[1]] = at[right[2]] = merged
    return first


def runs_of(texts: list[list[bytes]], min_length: int, exponent: int) -> list[list[Run]]:
    """The runs of each text, given as its words, by start and period."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.array([numbers[w] for words in texts for w in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    owner, begins = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - sizes
    least = least_prefix(min_length, exponent)
    found: list[list[Run]] = [[] for _ in texts]
    held = list(regions(ids, owner, least, exponent))
    if not held:
        return found
    starts, ends = np.array(held).T
    lengths = ends - starts
    ends_text = ends == begins[owner[starts]] + sizes[owner[starts]]
    places = np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    region = np.repeat(np.arange(len(held)), lengths)
    order, common = suffix_order(region * len(numbers) + ids[places])
    borders = np.cumsum(lengths)
    for (period, end), start in seeds(order, common, least, exponent).items():
        at = region[start]
        # A run that stops with its region only is cut there; the region of its own start holds it whole.
        if end - start >= max(min_length, exponent * period) and (end < borders[at] or ends_text[at]):
            place = int(places[start])
            text = int(owner[place])
            found[text].append((place - int(begins[text]), end - start, period))
    # Two regions may overlap and hold the same run.
    return [sorted(set(runs), key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[Run]) -> str:
    """The words, joined by single spaces, without those behind the first period of a run."""
    if runs:
        dropped = np.zeros(len(words), bool)
        for start, length, period in runs:
            dropped[start + period : start + length] = True
        words = [w for w, d in zip(words, dropped.tolist(), strict=True) if not d]
    return b" ".join(words).decode()


RUNS = "doc_id string, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame, min_length: int = 6, exponent: int = 4) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_words, runs and collapsed.

    ``runs`` lists all maximal stretches of words with a smallest period and a length of at least ``min_length`` and
    ``exponent`` (2 or more) periods, by start and period; ``collapsed`` is the text without the repetitions, words joined
    by one space. Null and empty texts have no runs and an empty collapsed text; rows with equal or null doc_id are
    treated apart; an empty table gives an empty one. A text is handled whole in its task, in memory proportional to
    its near-periodic part times the logarithm of its longest run.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for part in slices(texts, 2_000_000):
                words = [t.encode().split() for t in texts[part]]
                runs = runs_of(words, min_length, exponent)
                yield pd.DataFrame(
                    {
                        "doc_id": keys[part],
                        "n_words": [len(w) for w in words],
                        "runs": [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs],
                        "collapsed": [collapsed(w, r) for w, r in zip(words, runs, strict=True)],
                    }
                )

    rows = docs.select(F.col("doc_id").cast("long").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, RUNS).withColumn("doc_id", F.col("doc_id").cast("long"))


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """``docs`` with the periodic tails that the query's contract writes into a tenth of the texts.

    With h the crc32 of the doc_id as text and g = floor(h / 10), a text with h % 10 = 0 repeats from word g % n on its
    first 1 + floor((n - g % n) / (3 + g % 8)) words there. A null doc_id leaves the text as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        period = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        piece = F.slice(words, (a + 1).cast("int"), period.cast("int"))
        tail = F.flatten(F.array_repeat(piece, F.ceil((n - a) / period).cast("int")))
        whole = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int")))
        return F.when(n > 0, F.array_join(whole, " "))

    changed = F.when(F.pmod(h, F.lit(10)) == 0, bind(words_of(F.col("text")), repeated))
    return docs.withColumn("text", F.coalesce(changed, "text"))


def greatest(runs: Column) -> Column:
    """The first run with the greatest length / period, compared exactly."""
    kind = "struct<start: long, length: long, period: long>"

    def better(best: Column, r: Column) -> Column:
        # Lengths and periods are below 2^31, so the products are exact.
        a, b = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (a > b), r).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(kind), better)
