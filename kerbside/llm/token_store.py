"""Token ids in binary shards with a minimal perfect hash index.

A shard holds the raw ids of consecutive documents and, behind them, an index from document key to record: a minimal
perfect hash (levels of bit arrays; a key belongs to the first level where its bit is its own), stored fingerprints that
reject unknown keys, and record offsets. A keyed read touches a fixed number of places of the file.

Layout, little endian: ids (2 or 4 bytes each); then the sections of ``SECTIONS``; then the footer: eight-byte numbers
(id width, end id, records, keys, ids, level sizes count, then each section's place and length in bytes), and last the
footer's place and the mark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import new_folder, settle
from kerbside.llm.tokens import encoder, slices

MARK = b"KTOKENS1"
SECTIONS = ("levels", "bits", "ranks", "prints", "first", "offsets", "keys", "valid")
GAMMA = 2.0


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of multiply-xorshift steps."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1_000_003) >> np.uint64(32)).astype("<u4")


def build_hash(keys: np.ndarray) -> dict[str, np.ndarray]:
    """The levels of a minimal perfect hash over distinct 64-bit ``keys``: levels (bits each), bits, ranks (per word)."""
    left, levels, words = keys.astype(np.uint64), [], []
    while left.size:
        size = int(max(64, -(-int(GAMMA * left.size) // 64) * 64))
        at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone.reshape(-1, 64)[:, ::-1], axis=1).view(">u8").ravel().astype("<u8"))
        left = left[~alone[at]]
        levels.append(size)
        if len(levels) > 200:
            raise ValueError("keys are not distinct")
    bits = np.concatenate(words) if words else np.zeros(0, "<u8")
    ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits))]).astype("<u8")
    return {"levels": np.array(levels, "<u8"), "bits": bits, "ranks": ranks}


def look_up(index: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 where no level has it. An unknown key may get a slot: compare fingerprints."""
    keys = keys.astype(np.uint64)
    slots = np.full(len(keys), -1, np.int64)
    base = 0
    for level, size in enumerate(index["levels"].tolist()):
        at = base + (mixed(keys, level) % np.uint64(size)).astype(np.int64)
        word, bit = index["bits"][at // 64], (at % 64).astype(np.uint64)
        hit = (slots < 0) & ((word >> bit) & np.uint64(1)).astype(bool)
        below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        slots[hit] = (index["ranks"][at // 64] + below)[hit].astype(np.int64)
        base += size
    return slots


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class Shard:
    """Reads one shard file. ``read(key)`` gives the ids of the records of a key."""

    def __init__(self, path: str):
        system, name = _file_system(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MARK:
            raise ValueError(f"not a token shard: {path}")
        at = int.from_bytes(tail[:8], "little")
        numbers = np.frombuffer(self.file.read_at(size - 16 - at, at), "<u8").tolist()
        self.width, self.end_id, self.n_records, self.n_keys, self.n_ids, _ = numbers[:6]
        self.places = dict(zip(SECTIONS, zip(numbers[6::2], numbers[7::2], strict=True), strict=True))
        self.index = {k: self.section(k, "<u8") for k in ("levels", "bits", "ranks")}

    def section(self, name: str, dtype: str) -> np.ndarray:
        at, size = self.places[name]
        return np.frombuffer(self.file.read_at(size, at), dtype)

    def number(self, name: str, i: int, dtype: str) -> int:
        width = np.dtype(dtype).itemsize
        return int(np.frombuffer(self.file.read_at(width, self.places[name][0] + i * width), dtype)[0])

    def ids(self, begin: int, end: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at((end - begin) * self.width, begin * self.width), f"<u{self.width}")

    def read(self, key: int) -> list[np.ndarray]:
        keys = np.array([key], np.int64)
        slot = int(look_up(self.index, keys)[0])
        if slot < 0 or self.number("prints", slot, "<u4") != int(fingerprints(keys)[0]):
            return []
        record, out = self.number("first", slot, "<u8"), []
        while record < self.n_records and self.number("keys", record, "<i8") == key and self.number("valid", record, "u1"):
            out.append(self.ids(self.number("offsets", record, "<u8"), self.number("offsets", record + 1, "<u8")))
            record += 1
        return out

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, whether they are not null, and offsets of all records; keys are looked up in the index."""
        keys, valid = self.section("keys", "<i8"), self.section("valid", "u1").astype(bool)
        offsets = self.section("offsets", "<u8").astype(np.int64)
        slots = look_up(self.index, keys[valid])
        if (self.section("prints", "<u4")[slots] != fingerprints(keys[valid])).any():
            raise ValueError("the index does not know a stored key")
        first = self.section("first", "<u8")[slots].astype(np.int64)
        return keys, valid, np.concatenate([self._starts(keys, valid, first, offsets), offsets[-1:]])

    def _starts(self, keys: np.ndarray, valid: np.ndarray, first: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        # The k-th record of a repeated key lies k records behind the one that the index names.
        records = np.arange(len(keys))
        same = np.concatenate([[False], (keys[1:] == keys[:-1]) & valid[1:] & valid[:-1]])
        run = records - np.maximum.accumulate(np.where(same, 0, records))
        at = records.copy()
        at[valid] = first + run[valid]
        return offsets[at]


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, spaced: bool = True, shards: int | None = None
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write them in ascending doc_id order; returns the manifest.

    The manifest has one row per shard: shard, path, records, ids. Null texts are empty; null keys come first and are
    not indexed; repeated keys follow each other in the order of their texts. Ids stream to the file; a task holds its
    keys and offsets only. Every attempt of a task writes a file of its own, and the manifest names the ones that count.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    count = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text")
    # Keys as text, since pandas would make doubles of whole numbers with nulls among them.
    rows = rows.select(F.col("doc_id").cast("string"), "text", F.spark_partition_id().alias("shard"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer, spaced)
        end = np.array([end_id], enc.dtype).tobytes()
        out, keys, valid, lengths, shard, path = None, [], [], [], 0, ""
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                shard = int(batch["shard"].iloc[0])
                path = f"{folder}/shard-{shard:08d}-{uuid4().hex}.bin"
                system, name = _file_system(path)
                system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(name)
            texts, ids = batch["text"].tolist(), batch["doc_id"].tolist()
            keys.append(np.array([int(i or 0) for i in ids], np.int64))
            valid.append(np.array([i is not None for i in ids]))
            for part in slices(texts):
                for raw in enc.encode(texts[part]):
                    out.write(raw)
                    out.write(end)
                    lengths.append(len(raw) // enc.dtype.itemsize + 1)
        if out is not None:
            _finish(out, np.concatenate(keys), np.concatenate(valid), lengths, enc.dtype.itemsize, end_id)
            yield pd.DataFrame({"shard": [shard], "path": [path], "records": [len(lengths)], "ids": [sum(lengths)]})

    return settle(rows.mapInPandas(write, "shard long, path string, records long, ids long"), "manifest")


def _finish(out, keys: np.ndarray, valid: np.ndarray, lengths: list[int], width: int, end_id: int) -> None:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    records = np.flatnonzero(valid)
    distinct, first = np.unique(keys[records], return_index=True)
    index = build_hash(distinct)
    slots = look_up(index, distinct)
    prints, firsts = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u8")
    prints[slots], firsts[slots] = fingerprints(distinct), records[first]
    parts = index | {"prints": prints, "first": firsts, "offsets": offsets, "keys": keys.astype("<i8"), "valid": valid.astype("u1")}
    at = int(offsets[-1]) * width
    numbers = [width, end_id, len(keys), len(distinct), int(offsets[-1]), len(index["levels"])]
    for name in SECTIONS:
        data = parts[name].tobytes()
        out.write(data)
        numbers += [at, len(data)]
        at += len(data)
    out.write(np.array(numbers, "<u8").tobytes())
    out.write(at.to_bytes(8, "little") + MARK)
    out.close()


def read_back(manifest: DataFrame) -> DataFrame:
    """Every record of the shards, from the files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    before = F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")  # one short row per shard
    placed = manifest.select("path", before.alias("base")).repartition("path")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"], strict=True):
                shard = Shard(path)
                keys, valid, offsets = shard.rows()
                ends = offsets[1:]
                for begin in range(0, len(keys), 2000):
                    own = slice(begin, min(begin + 2000, len(keys)))
                    low, high = int(offsets[own.start]), int(ends[own.stop - 1])
                    data = shard.ids(low, high).astype("<u4").tobytes()
                    crc = [zlib.crc32(data[4 * (a - low) : 4 * (b - low)]) for a, b in zip(offsets[own], ends[own], strict=False)]
                    doc_id = pd.arrays.IntegerArray(keys[own].copy(), ~valid[own])
                    yield pd.DataFrame(
                        {"doc_id": doc_id, "start": base + offsets[:-1][own], "n_tokens": ends[own] - offsets[:-1][own], "ids_crc32": crc}
                    )

    return placed.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_folder(spark: SparkSession) -> str:
    return new_folder(spark, "tokens")
