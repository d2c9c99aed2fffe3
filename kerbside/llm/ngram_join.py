"""Jaccard self-join of word n-gram sets by PartEnum signatures.

Sets are put in bands of nearly equal size. Within a band a Jaccard similarity bounds the Hamming distance by some k. The
feature domain is cut into n1 parts and each of these into n2; if two sets differ in at most k features, some first-level
part holds at most k2 of the differences, and so some n2 - k2 of its second-level parts agree entirely. Every such subset
of parts is a signature, so that all pairs above the threshold share one. A set signs for its own band and the next.

Large sets have k + 1 parts on one level and ``spare`` more. At least spare + 1 of them agree, so that a set with no more
than ``spare`` empty parts has one with features among these, and leaves the signatures of its empty parts out: they
would be those of every other set with the same part empty. Sets with more empty parts sign for all.

Copies (equal sets) form one class first. Classes that share a signature are compared by odd sketches, whose distance
never exceeds the Hamming distance: by short ones within the group, then pair by pair by ones that grow with the largest
distance of a link, and what passes is verified on the whole sets. First every class is verified against the best connected
member of its signature group; then all remaining pairs that pass and lie in different components are. So no link is lost,
and a group of n near copies costs about n verifications instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, exp, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import components, settle
from kerbside.llm.token_store import mixed
from kerbside.llm.tokens import slices

SKETCH_WORDS = 4
BLOCK = 512
#: Documents to read again up to which their ids are sent to all tasks (about 64 bytes each); beyond it texts are shuffled.
SENT_IDS = 1_000_000
#: Sets of one signature that one task compares; larger groups are dealt out by pairs of blocks of this size.
GROUP = 1024

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        inverse = pow(_BASE, -1, 1 << 64)
        for f in (_BASE, inverse):
            factors = np.full(size + 1, f, np.uint64)
            factors[0] = 1
            _POWERS.append(np.cumprod(factors, dtype=np.uint64))
        del _POWERS[:-2]
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts (A-Z lower-cased), where each text's words begin (one more at the end), and
    the last two bytes of every word as a number.
    """
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    space = _SPACES[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin = edges[~space[edges]]
    if not space[0]:
        begin = np.concatenate([[0], begin])
    end = edges[space[edges]]
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    hashes = mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64), 1)
    starts = np.cumsum([0] + [len(r) + 1 for r in raw])
    last = _LOWER[data[end - 1]].astype(np.int64)
    before = np.where(end - begin > 1, _LOWER[data[end - 2]], 0)
    return hashes, np.searchsorted(begin, starts), last * 256 + before


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its ``width``-word shingles; all words as one if there are fewer."""
    hashes, at, _ = word_hashes(texts)
    factors = mixed(np.arange(width), 2) | np.uint64(1)
    n = max(0, len(hashes) - width + 1)
    whole = np.zeros(n, np.uint64)
    for j in range(width):
        whole += hashes[j : n + j] * factors[j]
    whole = mixed(whole, width)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= width:
            yield np.unique(whole[a : b - width + 1])
        elif b > a:
            yield mixed(np.array([(hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64)]), int(b - a))
        else:
            yield np.zeros(0, np.uint64)


class Bands:
    """Size bands and PartEnum parameters for a similarity of ``num`` / ``den`` or more."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.ends = [0]
        self.parameters: list[tuple] = [()]

    def band(self, n: int) -> int:
        while self.ends[-1] < n:
            self._add()
        return int(np.searchsorted(self.ends, n))

    def _add(self) -> None:
        end = (self.ends[-1] + 1) * self.den // self.num
        self.ends.append(end)
        k = self.distance(2 * end)
        if k == 0:
            n1, n2, size, spare = 1, 1, 1, 0
        elif k < 16:
            # k2 = 1; small sets take subsets of two parts, so that a signature still covers several features.
            n1, n2, size, spare = ceil((k + 1) / 2), 3, 2, 0
        else:
            spare = self._spare(k + 1, self.ends[max(0, len(self.ends) - 3)] + 1)
            n1, n2, size = k + 1 + spare, 1, 1
        subsets = np.zeros((n2, len(list(combinations(range(n2), size)))), np.uint64)
        for j, chosen in enumerate(combinations(range(n2), size)):
            subsets[list(chosen), j] = mixed(np.array(chosen), 3) | np.uint64(1)
        number = len(self.ends) - 1
        seeds = mixed(np.arange(n1 * subsets.shape[1]) + (number << 32), 4).reshape(n1, -1)
        self.parameters.append((n1, n2, subsets, seeds, spare))

    @staticmethod
    def _spare(least: int, n: int) -> int:
        """Parts beyond ``least``, a quarter of it at most: as many as nearly all sets of ``n`` features leave empty."""
        spare = 0
        while spare < least // 4:
            empty = (least + spare) * exp(-n / (least + spare))
            wanted = ceil(empty + 2 * sqrt(empty))
            if wanted <= spare:
                break
            spare = wanted
        return min(spare, least // 4)

    def distance(self, sizes):
        """The largest Hamming distance of two sets with this sum of sizes."""
        return sizes * (self.den - self.num) // (self.den + self.num)

    def signatures(self, features: np.ndarray) -> np.ndarray:
        own = self.band(len(features))
        while len(self.ends) < own + 2:
            self._add()
        out = []
        spread = mixed(features, 5)
        for number in (own, own + 1):
            n1, n2, subsets, seeds, spare = self.parameters[number]
            sums = np.zeros(n1 * n2, np.uint64)
            part = (spread % np.uint64(n1 * n2)).astype(np.int64)
            np.add.at(sums, part, mixed(features, 6))
            grouped = (sums.reshape(n1, n2)[:, :, None] * subsets[None]).sum(axis=1, dtype=np.uint64)
            signed = mixed(grouped ^ seeds, 7).ravel()
            if spare:
                filled = np.bincount(part, minlength=n1) > 0
                if n1 - np.count_nonzero(filled) <= spare:
                    signed = signed[filled]
            out.append(signed)
        return np.concatenate(out)


def odd_sketch(features: np.ndarray, bits: int = 64 * SKETCH_WORDS) -> bytes:
    odd = np.bincount((mixed(features, 8) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def long_sketch(features: np.ndarray, bands: Bands) -> bytes:
    """An odd sketch of a power of two of bits, four times the largest distance of a link or more.

    With fewer bits than that, most pairs look close enough: the distance of two sketches stays below half their bits.
    """
    least = max(4 * int(bands.distance(2 * len(features))), 64)
    return odd_sketch(features, 1 << (least - 1).bit_length())


def sketch_distance(x: bytes, y: bytes) -> int:
    """Of sketches of different lengths the longer one is folded: a place there is the place here, modulo the bits."""
    a, b = sorted((np.frombuffer(s, "<u8") for s in (x, y)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)))).sum())


def set_id(features: np.ndarray) -> int:
    total = mixed(features, 9).sum(dtype=np.uint64)
    return int(mixed(np.array([total], np.uint64) + np.uint64(len(features)), 10).view(np.int64)[0])


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id as text (pandas would make doubles of whole numbers with nulls among them) and text without nulls."""
    return docs.select(F.col("doc_id").cast("long").cast("string"), F.coalesce("text", F.lit("")).alias("text"))


def sign(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Per document: doc_id, n, sid (hash of its set), short and long sketch, signatures; these once per set and batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(num, den)
        for batch in batches:
            keys, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for part in slices(texts, 2_000_000):
                rows, seen = [], set()
                for features in shingle_sets(texts[part], width):
                    sid = set_id(features)
                    if sid in seen or not len(features):
                        rows.append((len(features), sid, None, None, None))
                    else:
                        seen.add(sid)
                        signed = bands.signatures(features).view(np.int64)
                        rows.append((len(features), sid, odd_sketch(features), long_sketch(features, bands), signed))
                out = pd.DataFrame(rows, columns=["n", "sid", "sketch", "long_sketch", "sigs"])
                out.insert(0, "doc_id", keys[part])
                yield out

    rows = _texts(docs).mapInPandas(run, "doc_id string, n long, sid long, sketch binary, long_sketch binary, sigs array<long>")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def _groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by ``key``, cut so that no group of equal keys lies in two of them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and (cut or keys[0] != held[-1][key].iloc[-1]):
            first = int(np.searchsorted(keys, held[-1][key].iloc[-1], side="right"))
            held.append(batch.iloc[:first])
            yield pd.concat(held)
            held, batch, cut = [], batch.iloc[first:], cut - first
        if not len(batch):
            continue
        if cut > 0:
            yield batch.iloc[:cut]
            batch = batch.iloc[cut:]
        held.append(batch)
    if held:
        yield pd.concat(held)


def shared(signed: DataFrame) -> DataFrame:
    """Signatures that two or more different sets have: (sig, sid, members)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _groups(batches, "sig"):
            sig, sid = rows["sig"].to_numpy(), rows["sid"].to_numpy()
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])])
            sig, sid = sig[new], sid[new]
            as_before = np.concatenate([[False], sig[1:] == sig[:-1]])
            own = as_before | np.concatenate([as_before[1:], [False]])
            group = np.cumsum(~as_before) - 1
            members = np.bincount(group)[group]
            yield pd.DataFrame({"sig": sig[own], "sid": sid[own], "members": members[own]})

    rows = signed.where("sigs is not null").select("sid", F.explode("sigs").alias("sig"))
    return rows.repartition("sig").sortWithinPartitions("sig", "sid").mapInPandas(run, "sig long, sid long, members long")


def dealt(groups: DataFrame) -> DataFrame:
    """Groups of more than ``GROUP`` sets as several: sets fall into blocks, and every two blocks form a group.

    So each pair of sets still meets, and a hot signature is spread over tasks. Small groups stay as they are.
    """
    blocks = F.ceil(F.col("members") / GROUP).cast("int")
    own = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    others = F.explode(F.sequence(F.lit(0), blocks - 1))
    small = groups.where(F.col("members") <= GROUP).select("sig", "sid")
    large = groups.where(F.col("members") > GROUP).select("sig", "sid", own.alias("own"), others.alias("other"))
    pair = F.xxhash64("sig", F.least("own", "other"), F.greatest("own", "other"))
    return small.unionByName(large.select(pair.alias("sig"), "sid"))


def _close(sketches: np.ndarray, sizes: np.ndarray, bands: Bands, block: slice) -> np.ndarray:
    """Of the rows in ``block`` against all: whether size and sketch allow a link."""
    apart = np.zeros((block.stop - block.start, len(sizes)), np.int64)
    for j in range(sketches.shape[1]):
        apart += np.bitwise_count(sketches[block, None, j] ^ sketches[None, :, j])
    a, b = sizes[block, None], sizes[None, :]
    fits = (apart <= bands.distance(a + b)) & (bands.den * np.minimum(a, b) >= bands.num * np.maximum(a, b))
    fits[np.arange(block.stop - block.start), np.arange(block.start, block.stop)] = False
    return fits


def candidates(groups: DataFrame, num: int, den: int, rest: bool) -> DataFrame:
    """Pairs to verify, (a, b) with a < b, from rows (sig, sid, n, sketch, label).

    First, stars: members of a group in the order of how many they may link with, each with those that no earlier star
    has. With ``rest``: all that may link and differ in label. Groups are compared in blocks of rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(num, den)
        for rows in _groups(batches, "sig"):
            sig, sids, sizes = (rows[c].to_numpy() for c in ("sig", "sid", "n"))
            sketches = np.frombuffer(b"".join(rows["sketch"]), "<u8").reshape(-1, SKETCH_WORDS)
            labels = rows["label"].to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1], [True]]))
            found: list[np.ndarray] = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                own = slice(lo, hi)
                if rest and (labels[own] == labels[lo]).all():
                    continue
                find = _crossing if rest else _stars
                found += find(sids[own], sizes[own], sketches[own], labels[own], bands)
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    ordered = groups.repartition("sig").sortWithinPartitions("sig", "sid")
    return ordered.mapInPandas(run, "a long, b long").distinct()


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)


def _blocks(n: int) -> Iterator[slice]:
    for begin in range(0, n, BLOCK):
        yield slice(begin, min(begin + BLOCK, n))


def _stars(sids, sizes, sketches, labels, bands) -> list[np.ndarray]:
    n = len(sids)
    degrees = np.zeros(n, np.int64)
    for block in _blocks(n):
        degrees[block] = _close(sketches, sizes, bands, block).sum(axis=1)
    free, out = degrees > 0, []
    for centre in np.lexsort((sids, -degrees)):
        if degrees[centre] == 0:
            break
        if free[centre]:
            near = _close(sketches, sizes, bands, slice(centre, centre + 1))[0] & free
            free[centre] = False
            free &= ~near
            out.append(_pairs(np.full(int(near.sum()), sids[centre]), sids[near]))
    return out


def _crossing(sids, sizes, sketches, labels, bands) -> list[np.ndarray]:
    out = []
    for block in _blocks(len(sids)):
        a, b = np.nonzero(_close(sketches, sizes, bands, block) & (labels[block, None] != labels[None, :]))
        a = a + block.start
        out.append(_pairs(sids[a[a < b]], sids[b[a < b]]))
    return out


def plausible(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose long sketches allow a link; only these need their whole sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(num, den)
        for batch in batches:
            most = bands.distance((batch["m"] + batch["n"]).to_numpy())
            apart = [sketch_distance(x, y) for x, y in zip(batch["x"], batch["y"], strict=True)]
            yield batch.loc[np.array(apart, np.int64) <= most, ["a", "b"]]

    left = classes.select(F.col("sid").alias("a"), F.col("n").alias("m"), F.col("long_sketch").alias("x"))
    right = classes.select(F.col("sid").alias("b"), "n", F.col("long_sketch").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose whole sets reach the similarity. Both joins can be split where one set is in many pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(den * both >= num * (len(p) + len(q) - both))
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("sid").alias("a"), F.col("features").alias("x"))
    right = sets.select(F.col("sid").alias("b"), F.col("features").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(run, "a long, b long")


def feature_sets(docs: DataFrame, width: int) -> DataFrame:
    """sid and features (packed sorted hashes) of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for part in slices(texts, 2_000_000):
                sets = list(shingle_sets(texts[part], width))
                yield pd.DataFrame({"sid": [set_id(s) for s in sets], "features": [s.tobytes() for s in sets]})

    return _texts(docs).select("text").mapInPandas(run, "sid long, features binary")


def linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The links among candidate pairs. Long sketches decide most; only texts of what is left are read and compared whole."""
    likely = settle(plausible(pairs, classes, num, den), "pairs")
    sids = likely.select(F.col("a").alias("sid")).unionByName(likely.select(F.col("b").alias("sid"))).distinct()
    wanted = settle(classes.join(sids, "sid").select(F.col("rep").cast("string").alias("rep")).distinct(), "wanted")
    few = wanted.limit(SENT_IDS + 1).count() <= SENT_IDS
    texts = _texts(docs)
    ids = F.broadcast(wanted) if few else wanted
    texts = texts.join(ids, texts["doc_id"].eqNullSafe(ids["rep"])).drop("rep")
    sets = feature_sets(texts, width).join(sids, "sid", "left_semi").dropDuplicates(["sid"])
    return settle(verified(likely, settle(sets, "sets"), num, den), "links")


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Components of documents whose shingle sets have ``den * intersection >= num * union``.

    ``docs`` needs doc_id and text; other columns are ignored. Returns doc_id, n_shingles, component_id (the smallest
    doc_id that links reach), one row per row of ``docs``. Texts without words, and null texts, are linked with nothing.
    Rows with a null doc_id are compared like others; a component without any doc_id has a null component_id.
    """
    signed = settle(sign(docs, width, num, den), "signed")
    once = [F.first(c, ignorenulls=True).alias(c) for c in ("n", "sketch", "long_sketch")]
    classes = signed.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"), *once)
    groups = settle(shared(signed), "shared")
    own = settle(classes.join(groups.select("sid").distinct(), "sid"), "classes")
    rows = dealt(groups).join(own.select("sid", "n", "sketch"), "sid")
    links = linked(candidates(rows.withColumn("label", F.col("sid")), num, den, rest=False), own, docs, width, num, den)
    labels = components(links)
    labelled = rows.join(labels.withColumnRenamed("id", "sid"), "sid", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "sid"))
    more = linked(candidates(labelled, num, den, rest=True), own, docs, width, num, den)
    labels = components(links.unionByName(more)) if more.limit(1).count() else labels
    merged = labels.join(own.select(F.col("sid").alias("id"), "rep"), "id")
    lowest = merged.groupBy("label").agg(F.min("rep").alias("component_id"))
    merged = merged.join(lowest, "label").select(F.col("id").alias("sid"), "component_id")
    placed = signed.select("doc_id", "n", "sid").join(classes.select("sid", "rep"), "sid", "left").join(merged, "sid", "left")
    component: Column = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "rep"))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
