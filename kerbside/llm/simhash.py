"""SimHash near duplicates by pigeonring filtering.

A fingerprint is a ring of m = most + 1 segments of bits. If two fingerprints differ in at most ``most`` bits, then some
segment begins a chain in which every l consecutive segments together differ in at most l * most / m bits, rounded down:
l - 1 bits. So the first segment is equal and the second differs in one bit at most; segment, neighbour without that
bit, and the bit's place are a key that both fingerprints have. A pair that shares a key has to keep the budgets of the
longer chains as well before all of its bits are compared.

Equal fingerprints are one class first. Of a key's fingerprints the links of a spanning forest are returned, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import components, settle
from kerbside.llm.tokens import slices

BITS = 64
SEED = 42
#: Shingles whose hashes are held at once.
CHUNK = 1 << 16
#: Fingerprints of one key that are compared pair by pair in vectors, and that one task holds. Larger groups are dealt out.
FEW, MANY = 8, 4096


def shingle_votes(words: list[bytes], width: int) -> tuple[np.ndarray, int]:
    """How many shingle hashes (XXH64) have each bit, highest first, and how many shingles there are."""
    from xxhash import xxh64_digest

    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(len(words) - width + 1, 1)
    ends = ends[width - 1 :] or [len(joined)]
    votes = np.zeros(BITS, np.int64)
    for lo in range(0, n, CHUNK):
        shingles = [joined[a:b] for a, b in zip(starts[lo : lo + CHUNK], ends[lo : lo + CHUNK], strict=False)]
        digests = np.frombuffer(b"".join(map(xxh64_digest, shingles, repeat(SEED))), np.uint8)
        votes += np.unpackbits(digests).reshape(-1, BITS).sum(axis=0, dtype=np.int32)
    return votes, n


def fingerprint(text: str, width: int) -> int:
    """The fingerprint as a signed 64-bit number; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    votes, n = shingle_votes(words, width)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """Per row of ``docs``: doc_id and fp, its fingerprint as a signed number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for part in slices(texts, 2_000_000):
                yield pd.DataFrame({"doc_id": keys[part], "fp": [fingerprint(t, width) for t in texts[part]]})

    rows = docs.select(F.col("doc_id").cast("long").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id string, fp long").withColumn("doc_id", F.col("doc_id").cast("long"))


class Ring:
    """Segments of a fingerprint, keys of chains of two, and budgets of longer chains."""

    def __init__(self, most: int):
        if not 2 <= most < BITS // 2:
            raise ValueError("most is from 2 to 31")  # chains of two must leave six bits of a key for the place
        self.most, m = most, most + 1
        edges = [i * BITS // m for i in range(m + 1)]
        self.starts, self.sizes = edges[:-1], [b - a for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.count = m
        #: For every key place: the segment that begins the chain.
        self.first = np.array([(s - 1) % m for s in range(m) for _ in range(self.sizes[s])])
        #: Of chains of three segments and more, but for the whole ring: their bits by first segment, and the budget.
        self.budgets = [(np.array([self.mask(f, n) for f in range(m)]), n - 1) for n in range(3, m)]

    def mask(self, first: int, length: int) -> np.uint64:
        segments = [(first + j) % self.count for j in range(length)]
        return np.uint64(sum(((1 << self.sizes[s]) - 1) << self.starts[s] for s in segments))

    def keys(self, fps: np.ndarray) -> np.ndarray:
        """One column per bit: its place, its segment without it, and the segment before."""
        out = np.empty((len(fps), BITS), np.uint64)
        place = 0
        for s in range(self.count):
            first = (s - 1) % self.count
            turn = self.starts[first]
            ring = (fps >> np.uint64(turn)) | (fps << np.uint64(BITS - turn) if turn else np.uint64(0))
            kept = ring & np.uint64((1 << (self.sizes[first] + self.sizes[s])) - 1)
            for bit in range(self.sizes[s]):
                without = kept & ~np.uint64(1 << (self.sizes[first] + bit))
                out[:, place] = without | np.uint64(place << 58)
                place += 1
        return out

    def linked(self, differ: np.ndarray, places: np.ndarray | int) -> np.ndarray:
        """Which differences keep the budgets of every chain that begins where their key's does, and of the whole."""
        alive = np.arange(len(differ))
        first = np.broadcast_to(self.first[places], len(differ))
        for masks, budget in self.budgets:
            alive = alive[np.bitwise_count(differ[alive] & masks[first[alive]]) <= budget]
        out = np.zeros(len(differ), bool)
        out[alive] = np.bitwise_count(differ[alive]) <= self.most
        return out


def forest(fps: np.ndarray, place: int, ring: Ring) -> list[tuple[int, int]]:
    """Links that span the components of the fingerprints of one key, by breadth-first search."""
    left, out = fps, []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            near = ring.linked(left ^ queue[-1], place)
            centre = queue.pop()
            found, left = left[near], left[~near]
            out += zip(repeat(int(centre)), found.tolist(), strict=False)
            queue += list(found)
    return out


def close_pairs(keys: np.ndarray, fps: np.ndarray, chains: np.ndarray, ring: Ring) -> np.ndarray:
    """Links of rows in order of their keys: all pairs of groups of a few, a spanning forest of larger ones."""
    places = (chains >> np.uint64(58)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(edges)
    found: list[np.ndarray] = []
    small = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
    at, step = np.flatnonzero(small), 1
    while len(at):
        at = at[at + step < len(keys)]
        at = at[keys[at + step] == keys[at]]
        near = at[ring.linked(fps[at] ^ fps[at + step], places[at])]
        found.append(np.stack([fps[near], fps[near + step]], axis=1))
        step += 1
    for g in np.flatnonzero(sizes > FEW):
        own = slice(edges[g], edges[g + 1])
        found.append(np.array(forest(fps[own], int(places[edges[g]]), ring), np.uint64).reshape(-1, 2))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    return np.unique(np.sort(pairs.view(np.int64), axis=1), axis=0)


def keyed(distinct: DataFrame, most: int) -> DataFrame:
    """(sig, sid): every fingerprint under each of its 64 keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ring = Ring(most)
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for lo in range(0, len(fps), 4096):
                part = fps[lo : lo + 4096]
                yield pd.DataFrame({"sig": ring.keys(part).ravel().view(np.int64), "sid": np.repeat(part, BITS).view(np.int64)})

    return distinct.select("fp").mapInPandas(run, "sig long, sid long")


def _link_rows(pairs: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"sig": pd.array([None] * len(pairs), "Int64"), "a": pairs[:, 0], "b": pairs[:, 1]})


def _wide_rows(key: np.uint64, fps: np.ndarray) -> pd.DataFrame:
    sig = np.full(len(fps), key, np.uint64).view(np.int64)
    return pd.DataFrame({"sig": sig, "a": fps.view(np.int64), "b": pd.array([None] * len(fps), "Int64")})


def links(rows: DataFrame, most: int, key: str = "sig", held: int | None = MANY) -> DataFrame:
    """Links among fingerprints ``sid`` of equal ``sig``: (null, a, b). ``key`` names the column that tells the chain.

    A group that does not end with its batch is held. If more than ``held`` fingerprints are (None: no bound), they and the
    rest of the group are handed on as (sig, a, null).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ring = Ring(most)
        keys, fps, chains, wide = *(np.zeros(0, np.uint64) for _ in range(3)), None
        for batch in batches:
            keys, fps, chains = (
                np.concatenate([old, batch[c].to_numpy(np.int64).view(np.uint64)])
                for old, c in ((keys, "sig"), (fps, "sid"), (chains, key))
            )
            if wide is not None and len(keys):
                own = int((keys == wide).sum())
                yield _wide_rows(wide, fps[:own])
                keys, fps, chains = keys[own:], fps[own:], chains[own:]
                wide = None if len(keys) else wide
            if not len(keys):
                continue
            last = int(np.argmax(keys == keys[-1]))
            yield _link_rows(close_pairs(keys[:last], fps[:last], chains[:last], ring))
            keys, fps, chains = keys[last:], fps[last:], chains[last:]
            if held is not None and len(keys) > held:
                wide = keys[0]
                yield _wide_rows(wide, fps)
                keys, fps, chains = keys[:0], fps[:0], chains[:0]
        yield _link_rows(close_pairs(keys, fps, chains, ring))

    ordered = rows.repartition("sig").sortWithinPartitions("sig", "sid")
    return ordered.mapInPandas(run, "sig long, a long, b long")


def dealt(wide: DataFrame, held: int = MANY) -> DataFrame:
    """Keys of very many fingerprints (sig, a) as several (sig, sid, key): fingerprints fall into blocks of about half of
    ``held``, and every two blocks form a group, so that all pairs still meet.
    """
    members = wide.groupBy("sig").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") * 2 / held).cast("int")
    own = F.pmod(F.xxhash64("a"), blocks).cast("int")
    rows = wide.join(members, "sig").select("sig", "a", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    pair = F.xxhash64("sig", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select(pair.alias("sig"), F.col("a").alias("sid"), F.col("sig").alias("key"))


def near_duplicates(docs: DataFrame, width: int = 4, most: int = 4) -> DataFrame:
    """Components of documents whose fingerprints differ in ``most`` bits or fewer.

    ``docs`` needs doc_id and text; other columns are ignored. Returns doc_id, fingerprint (16 hex digits) and component_id
    (the smallest doc_id that links reach), one row per row of ``docs``. Null texts and texts without words have the
    fingerprint 0 and are linked like any other. Rows with a null doc_id are compared as well; a component without any
    doc_id has a null component_id. Very long texts are hashed in pieces.
    """
    signed = settle(fingerprints(docs, width), "fingerprints")
    classes = signed.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = settle(links(keyed(classes.select("fp"), most), most), "links")
    edges, wide = found.where("b is not null").select("a", "b"), found.where("b is null").select("sig", "a")
    if wide.limit(1).count():
        edges = edges.unionByName(links(dealt(wide), most, "key", None).select("a", "b"))
    labels = components(edges.distinct())
    merged = labels.join(classes, labels["id"] == classes["fp"]).select("id", "label", "rep")
    lowest = merged.groupBy("label").agg(F.min("rep").alias("lowest"))
    merged = merged.join(lowest, "label").select(F.col("id").alias("fp"), "lowest")
    classes = classes.join(merged, "fp", "left").select("fp", F.coalesce("lowest", "rep").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return signed.join(classes, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")
