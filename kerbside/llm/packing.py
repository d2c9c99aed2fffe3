"""Packing documents into token windows by non-negative least squares.

Lengths are rounded up to a step; all combinations of at most ``depth`` lengths that fill a window are enumerated; their
repeat counts are solved against the histogram of lengths (Lawson-Hanson), rounded down, and what is left is packed
greedily, longest first. Only the histogram reaches the driver; its size does not depend on the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import settle
from kerbside.llm.tokens import encoder, slices

WINDOW = 4096
STEP = 16
DEPTH = 3
#: Pieces of one length that are ranked together; a hot length is spread over as many tasks as it needs.
RANKED = 100_000


def encode_pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, spaced: bool = False) -> DataFrame:
    """Every document's ids and the end id, cut each ``window`` ids: one row per piece.

    Columns doc_id, start, length, ids_crc32, doc_tokens. Null texts are empty and keep the end id.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer, spaced)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            keys, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for part in slices(texts):
                rows = []
                for key, raw in zip(keys[part], enc.encode(texts[part]), strict=True):
                    ids = np.frombuffer(raw, enc.dtype).astype("<u4").tobytes() + end
                    n = len(ids) // 4
                    for at in range(0, n, window):
                        piece = ids[4 * at : 4 * (at + window)]
                        rows.append((key, at, len(piece) // 4, zlib.crc32(piece), n))
                yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    # As text, since pandas would make doubles of whole numbers with nulls among them.
    rows = docs.select(F.col("doc_id").cast("long").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = rows.mapInPandas(run, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long")
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))


def combinations(size: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``depth`` positive numbers with sum ``size``."""
    out: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], left: int, most: int) -> None:
        if left == 0:
            out.append(head)
            return
        if len(head) < depth:
            for n in range(min(left, most), 0, -1):
                if n * (depth - len(head)) < left:
                    break
                extend((*head, n), left - n, n)

    extend((), size, size)
    return out


def nnls(members: np.ndarray, size: int, target: np.ndarray, steps: int = 3000) -> np.ndarray:
    """Least squares with x >= 0 by the active set of Lawson and Hanson.

    Column j of the matrix counts the numbers in row j of ``members`` (1 to ``size``, 0 for none); it stays sparse.
    """
    n = len(members)
    dense = np.zeros((size + 1, n), np.float32)
    for k in range(members.shape[1]):
        np.add.at(dense, (members[:, k], np.arange(n)), 1)
    dense[0] = 0
    x, active = np.zeros(n), np.zeros(n, bool)
    goal = np.concatenate([[0.0], target])
    limit = 1e-7 * max(1.0, float(goal.max(initial=0)))
    rest = goal.copy()
    for _ in range(steps):
        rest[0] = 0
        slope = rest[members].sum(axis=1)
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= limit:
            break
        active[best] = True
        while True:
            own = np.flatnonzero(active)
            a = dense[:, own].astype(float)
            part = np.linalg.lstsq(a.T @ a, a.T @ goal, rcond=None)[0]
            if part.min() > 0:
                x[:] = 0
                x[own] = part
                break
            falling = part <= 0
            ratio = x[own][falling] / np.maximum(x[own][falling] - part[falling], 1e-300)
            x[own] += ratio.min() * (part - x[own])
            x[own[falling][ratio <= ratio.min()]] = 0
            active &= x > limit
            x[~active] = 0
            if not active.any():
                break
        own = np.flatnonzero(active)
        rest = goal - dense[:, own] @ x[own]
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[list[int], int]]:
    """Patterns (lengths in steps, repeat count) that use up ``histogram`` (count by length in steps, 1 to its size)."""
    size = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    out: list[tuple[list[int], int]] = []
    there = [c for c in combinations(size, depth) if all(left[n] for n in c)]
    if there:
        members = np.array([c + (0,) * (depth - len(c)) for c in there])
        repeats = nnls(members, size, left[1:].astype(float))
        for j in np.argsort(-repeats, kind="stable"):
            used = {n: there[j].count(n) for n in there[j]}
            times = min(int(repeats[j]), *(int(left[n]) // k for n, k in used.items()))
            if times > 0:
                out.append((list(there[j]), times))
                for n, k in used.items():
                    left[n] -= k * times
    while left.any():
        pattern: list[int] = []
        room, own = size, left.copy()
        while room > 0 and (fits := np.flatnonzero(own[: room + 1])).size:
            n = int(fits[-1])
            take = min(int(own[n]), room // n)
            pattern += [n] * take
            own[n] -= take
            room -= n * take
        counts = np.bincount(pattern, minlength=size + 1)
        used_n = np.flatnonzero(counts)
        times = int((left[used_n] // counts[used_n]).min())
        out.append((pattern, times))
        left[used_n] -= counts[used_n] * times
    return out


def pack(pieces: DataFrame, window: int = WINDOW, step: int = STEP, depth: int = DEPTH) -> DataFrame:
    """``pieces`` (length at most ``window``, start, doc_id) with sequence_id and offset, gapless from 0.

    Equal pieces are interchangeable. An empty table gives an empty result.
    """
    size = window // step
    pieces = pieces.withColumn("bin", F.ceil(F.col("length") / step).cast("int"))
    total = pieces.count()
    chunks = max(16, -(-total // RANKED))
    pieces = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(chunks)).cast("int"))
    counted = pieces.groupBy("bin", "chunk").count()
    by_bin = counted.groupBy("bin").agg(F.sum("count").alias("n")).collect()  # at most window / step rows
    histogram = np.zeros(size + 1, np.int64)
    for r in by_bin:
        histogram[r["bin"]] = r["n"]
    before = F.sum("count").over(Window.partitionBy("bin").orderBy("chunk")) - F.col("count")
    offsets = counted.select("bin", "chunk", before.alias("before"))
    order = Window.partitionBy("bin", "chunk").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("own_rank", F.row_number().over(order) - 1).join(offsets, ["bin", "chunk"])
    ranked = ranked.withColumn("rank", F.col("own_rank") + F.col("before")).drop("own_rank", "before", "chunk")

    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(size + 1)]  # by bin: first rank, sequence, slot
    cursor, sequence = np.zeros(size + 1, np.int64), 0
    for pattern, times in plan(histogram, depth):
        for slot, n in enumerate(pattern):
            runs[n].append((int(cursor[n]), sequence, slot))
            cursor[n] += times
        sequence += times
    tables = [np.array(r, np.int64).reshape(-1, 3) for r in runs]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequences, slots = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            bins, ranks = batch["bin"].to_numpy(), batch["rank"].to_numpy()
            for n in np.unique(bins):
                own = bins == n
                at = np.searchsorted(tables[n][:, 0], ranks[own], side="right") - 1
                sequences[own] = tables[n][at, 1] + ranks[own] - tables[n][at, 0]
                slots[own] = tables[n][at, 2]
            yield batch.drop(columns=["bin", "rank"]).assign(sequence_id=sequences, slot=slots)

    kept = [f"{c} {'string' if c == 'doc_id' else 'long'}" for c in ranked.columns if c not in ("bin", "rank")]
    ranked = ranked.withColumn("doc_id", F.col("doc_id").cast("string"))
    placed = ranked.mapInPandas(place, ", ".join([*kept, "sequence_id long", "slot long"]))
    placed = placed.withColumn("doc_id", F.col("doc_id").cast("long"))
    order = Window.partitionBy("sequence_id").orderBy("slot")
    return placed.withColumn("offset", F.sum("length").over(order) - F.col("length")).drop("slot")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, spaced: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) encoded, cut and packed: one row per piece, see ``encode_pieces`` and ``pack``."""
    return pack(settle(encode_pieces(docs, tokenizer, end_id, window, spaced), "pieces"), window)
