"""Exact removal of byte strings that occur more than once.

Every byte covered by a ``length``-byte string that also starts elsewhere is removed. Strings are found by anchors: of the
``length - GRAM + 1`` grams of ``GRAM`` bytes in a string, the smallest by hash is its anchor, so that equal strings have
equal anchors at equal places. Neighbouring strings with one anchor form a run. Runs are dealt out by their anchor's hash:
equal runs are repeated as a whole; where runs of one anchor differ, each of their strings is compared by hash. So only
about one row per 50 bytes is shuffled, and single strings only at the borders of what repeats.

Equal texts are one text with a count; a text that occurs twice is repeated as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import settle
from kerbside.llm.ngram_join import _groups, _powers
from kerbside.llm.token_store import mixed
from kerbside.llm.tokens import slices

LENGTH = 200
GRAM = 100
CHUNK = 1 << 21
_PLACE = np.uint64((1 << 23) - 1)


class Bytes:
    """Texts in one buffer with prefix sums for hashes of any stretch."""

    def __init__(self, raw: list[bytes]):
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.ends = np.cumsum([len(r) for r in raw]).astype(np.int64)
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        up, self.down = _powers(len(self.data) + 1)
        self.sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], dtype=np.uint64, out=self.sums[1:])

    def hashes(self, begin: np.ndarray, length) -> np.ndarray:
        return mixed((self.sums[begin + length] - self.sums[begin]) * self.down[begin], 21)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by minima from both ends of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def runs_of(text: Bytes, length: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor: index of the text, first and last start (in the buffer), anchor hash, run hash."""
    n = len(text.data)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty, empty
    grams = text.hashes(np.arange(n - GRAM + 1), GRAM)
    keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_minimum(keys, length - GRAM + 1) & _PLACE).astype(np.int64)
    owner = np.searchsorted(text.ends, np.arange(len(anchor)), side="right")
    inside = np.arange(len(anchor)) + length <= text.ends[owner]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return empty, empty, empty, empty, empty
    anchor, owner = anchor[starts], owner[starts]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    anchor, owner = anchor[new], owner[new]
    whole = text.hashes(first, last + length - first)
    run = mixed(whole + (anchor - first).astype(np.uint64) * np.uint64(1 << 20) + (last - first).astype(np.uint64), 22)
    return owner, first, last, grams[anchor].view(np.int64), run.view(np.int64)


def _chunks(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, Bytes]]:
    texts, keys = batch["text"].tolist(), batch["tid"].to_numpy()
    for part in slices(texts, CHUNK):
        raw = [t.encode() for t in texts[part]]
        yield keys[part], Bytes(raw)


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """Runs of all texts (tid, text): gram, run, tid, first, last; places in bytes of the text. Once per text and batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, text in _chunks(batch.drop_duplicates("tid")):
                owner, first, last, gram, whole = _in_parts(text, length)
                yield pd.DataFrame(
                    {"gram": gram, "run": whole, "tid": keys[owner], "first": first - text.begins[owner], "last": last - text.begins[owner]}
                )

    return texts.mapInPandas(run, "gram long, run long, tid long, first int, last int")


def _in_parts(text: Bytes, length: int) -> tuple[np.ndarray, ...]:
    """``runs_of``, in overlapping parts where a buffer is too long for the places in the keys."""
    limit = int(_PLACE)
    if len(text.data) <= limit:
        return runs_of(text, length)
    out = []
    step = limit - length + 1
    for begin in range(0, len(text.data) - length + 1, step):
        end = min(begin + limit, len(text.data))
        part = Bytes.__new__(Bytes)
        part.data = text.data[begin:end]
        inner = (text.ends > begin) & (text.begins < end)
        part.ends = np.minimum(text.ends[inner], end) - begin
        part.begins = np.maximum(text.begins[inner], begin) - begin
        part.sums, part.down = text.sums[begin : end + 1], text.down[begin : end + 1]
        owner, first, last, gram, run = runs_of(part, length)
        out.append((owner + int(np.flatnonzero(inner)[0]), first + begin, last + begin, gram, run))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def compared(rows: DataFrame) -> DataFrame:
    """Of the runs that share an anchor: kind 0 repeated as a whole, 1 to be compared, 2 for comparison only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in _groups(batches, "gram"):
            gram, whole = own["gram"].to_numpy(), own["run"].to_numpy()
            # A text that came from several tasks is one occurrence.
            again = (
                (gram[1:] == gram[:-1]) & (whole[1:] == whole[:-1])
                & (own["tid"].to_numpy()[1:] == own["tid"].to_numpy()[:-1])
                & (own["first"].to_numpy()[1:] == own["first"].to_numpy()[:-1])
            )
            if again.any():
                own = own[np.concatenate([[True], ~again])]
                gram, whole = own["gram"].to_numpy(), own["run"].to_numpy()
            same_gram = gram[1:] == gram[:-1]
            same_run = same_gram & (whole[1:] == whole[:-1])
            no = np.array([False])
            twice = np.concatenate([no, same_run]) | np.concatenate([same_run, no])
            begin = np.flatnonzero(np.concatenate([[True], ~same_gram]))
            group = np.cumsum(np.concatenate([[True], ~same_gram])) - 1
            distinct = np.add.reduceat(np.concatenate([[True], ~same_run]).astype(np.int64), begin)[group]
            leads = np.concatenate([[True], ~same_run])
            out = own[["tid", "first", "last"]]
            yield out[twice].assign(kind=0)
            yield out[~twice & (distinct > 1)].assign(kind=1)
            yield out[twice & leads & (distinct > 1)].assign(kind=2)

    ordered = rows.repartition("gram").sortWithinPartitions("gram", "run", "tid", "first")
    return ordered.mapInPandas(run, "tid long, first int, last int, kind int")


def single_strings(texts: DataFrame, length: int) -> DataFrame:
    """Strings of the runs of kind 1 and 2: hash, tid, at, last, n.

    Texts come with ``runs`` (first, last, kind). What occurs twice in a batch is settled there, as runs of starts from
    ``at`` to ``last`` (n = 3); one row per string goes on (n = 1: to be compared), so that a frequent string has no more
    rows than there are batches.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            parts = []
            for tid, text, runs in zip(batch["tid"], batch["text"], batch["runs"], strict=True):
                buffer = Bytes([text.encode()])
                r = np.array([(x["first"], x["last"], x["kind"]) for x in runs], np.int64).reshape(-1, 3)
                count = r[:, 1] - r[:, 0] + 1
                at = np.repeat(r[:, 0], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                # A string may lie in two runs of one text only if they are the same place.
                at, keep = np.unique(at, return_index=True)
                kind = np.repeat(r[:, 2], count)[keep]
                parts.append((buffer.hashes(at, length).view(np.int64), np.full(len(at), tid), at, kind))
            hashes, tid, at, kind = (np.concatenate(x) for x in zip(*parts, strict=True))
            _, lead, inverse, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            twice = count[inverse] > 1
            done = twice & (kind == 1)
            if done.any():
                t, first, last = merged(*_sorted(tid[done], at[done]))
                yield pd.DataFrame({"hash": 0, "tid": t, "at": first, "last": last - 1, "n": 3})
            n = np.where((count > 1) | (kind[lead] != 1), 2, 1)
            yield pd.DataFrame({"hash": hashes[lead], "tid": tid[lead], "at": at[lead], "last": at[lead], "n": n})

    return texts.mapInPandas(run, "hash long, tid long, at long, last long, n int")


def _sorted(tid: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((at, tid))
    return tid[order], at[order], at[order] + 1


def repeated_strings(strings: DataFrame) -> DataFrame:
    """Runs of starts (tid, at, last) of strings that occur elsewhere: in their batch, or in several batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in _groups(batches, "hash"):
            h = own["hash"].to_numpy()
            same = h[1:] == h[:-1]
            no = np.array([False])
            twice = np.concatenate([no, same]) | np.concatenate([same, no])
            hit = own.loc[twice & (own["n"].to_numpy() == 1), ["tid", "at"]]
            yield hit.assign(last=hit["at"])

    rows = strings.where("n <> 3").select("hash", "tid", "at", "n").repartition("hash").sortWithinPartitions("hash")
    found = rows.mapInPandas(run, "tid long, at long, last long")
    return found.unionByName(strings.where("n = 3").select("tid", "at", "last"))


def spans_of(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([new[1:], [True]])
    return starts[new], ends[last]


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (begin, end in bytes).

    Null texts are empty. Texts shorter than ``length`` bytes lose nothing. Each row counts as a document of its own,
    also if its doc_id repeats or is null. Other columns are ignored. ``length`` must be over ``GRAM``.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text, F.octet_length(text)).alias("tid"))
    whole = F.sha2("text", 256)
    info = settle(rows.select("doc_id", "tid", F.octet_length("text").cast("long").alias("n_bytes"), whole.alias("sha")), "info")
    runs = settle(compared(anchors(rows.where(F.octet_length("text") >= length).select("tid", "text"), length)), "runs")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    counts = info.where(F.col("n_bytes") >= length).groupBy("tid").agg(
        F.min(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("rep"), F.count("*").alias("copies")
    )
    touched = runs.groupBy("tid").agg(F.max("kind").alias("most")).join(counts, "tid").where("copies = 1 or most > 0")
    texts = rows.select("tid", "text", key.alias("rep")).join(touched.select("tid", "rep"), ["tid", "rep"])
    texts = settle(texts.select("tid", "text"), "touched")
    open_runs = runs.where("kind > 0").groupBy("tid").agg(F.collect_list(F.struct("first", "last", "kind")).alias("runs"))
    strings = settle(single_strings(texts.join(open_runs, "tid"), length), "strings")
    begun = runs.where("kind = 0").select("tid", F.col("first").cast("long").alias("b"), (F.col("last") + length).cast("long").alias("e"))
    found = begun.unionByName(repeated_strings(strings).select("tid", F.col("at").alias("b"), (F.col("last") + length).alias("e")))
    ranges = merged_ranges(found)
    once = counts.where("copies = 1").select("tid")
    result = settle(removed(texts.join(once, "tid").join(ranges, "tid")), "removed")
    joined = info.join(counts.select("tid", "copies"), "tid", "left").join(result, "tid", "left")
    again = (F.col("n_bytes") >= length) & (F.col("copies") > 1)
    none = F.array().cast("array<struct<begin:long,end:long>>")
    all_ = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    return joined.select(
        "doc_id", "n_bytes",
        F.when(again, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(again, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(again, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
        F.when(again, all_).otherwise(F.coalesce("spans", none)).alias("spans"),
    )


def merged_ranges(found: DataFrame) -> DataFrame:
    """Intervals (tid, b, e) as one row per text: arrays bs and es, merged where they touch within a batch of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                tid, b, e = merged(*(batch[c].to_numpy() for c in ("tid", "b", "e")))
                yield pd.DataFrame({"tid": tid, "b": b, "e": e})

    ordered = found.repartition("tid").sortWithinPartitions("tid", "b")
    flat = ordered.mapInPandas(run, "tid long, b long, e long")
    return flat.groupBy("tid").agg(F.collect_list("b").alias("bs"), F.collect_list("e").alias("es"))


def merged(tid: np.ndarray, b: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of each text's intervals; the input is sorted by text and start."""
    other = np.concatenate([[True], tid[1:] != tid[:-1]])
    group = np.cumsum(other) - 1
    width = int(e.max()) + 1
    reach = np.maximum.accumulate(group * width + e) - group * width
    new = other | np.concatenate([[True], b[1:] > reach[:-1]])
    last = np.concatenate([new[1:], [True]])
    return tid[new], b[new], reach[last]


def removed(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tid, text, bs, es in zip(batch["tid"], batch["text"], batch["bs"], batch["es"], strict=True):
                raw = text.encode()
                starts, ends = spans_of(np.asarray(bs), np.asarray(es))
                digest, at = hashlib.sha256(), 0
                for b, e in zip(starts.tolist(), ends.tolist(), strict=True):
                    digest.update(raw[at:b])
                    at = e
                digest.update(raw[at:])
                spans = [{"begin": b, "end": e} for b, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                out.append((tid, int((ends - starts).sum()), len(starts), digest.hexdigest(), spans))
            yield pd.DataFrame(out, columns=["tid", "n_removed", "n_spans", "kept", "spans"])

    return rows.mapInPandas(run, "tid long, n_removed long, n_spans long, kept string, spans array<struct<begin:long,end:long>>")
