"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, names and units become typed placeholders, so that a re-parameterised question has the same template as its
original. Windows of the templates are joined by hash; a match counts only if the slot values of the two windows map to
each other one to one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import bind

# Unit words that stand for a slot after a number.
UNITS = (
    "mm", "cm", "m", "km", "mile", "miles", "inch", "inches", "feet", "g", "kg", "lb", "oz", "ml", "l", "liter", "liters",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "year", "years",
    "dollar", "dollars", "euro", "euros", "cent", "cents", "percent",
)
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"

#: Words of a window, and the share of an item's windows that must match on one diagonal.
WINDOW = 8
MIN_SHARE = 0.5
#: The benchmark's windows are sent to every task up to this count (about 100 bytes each); beyond it both sides shuffle.
MAX_BROADCAST_WINDOWS = 1_000_000

_FIRST = "\u0001"
#: A point, a fraction's stroke or a comma before three digits, inside a number.
_INSIDE = r"(?<=\p{N})(?:[./](?=\p{N})|,(?=\p{N}{3}(?!\p{N})))"
_JOINED = "\u0003"


def raw_tokens(text: Column) -> Column:
    """Runs of letters and digits, a number with its separators as one; the first word of a sentence carries a mark if it
    is capitalised.
    """
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"(^\s*|[.!?][\"')\]]*\s+)(?=\p{Lu})", "$1 " + _FIRST)
    marked = F.regexp_replace(marked, _INSIDE, _JOINED)
    return F.array_remove(F.split(marked, rf"[^\p{{L}}\p{{N}}{_FIRST}{_JOINED}]+"), "")


def template(tokens: Column) -> Column:
    """Placeholders for slots, lower case for the rest. A unit is a slot after a number, a name inside a sentence."""

    def one(t: Column, i: Column) -> Column:
        low = F.lower(t)
        after_number = F.coalesce(F.get(tokens, i - 1).rlike(r"^\p{N}"), F.lit(False))
        return (
            F.when(t.rlike(r"^\p{N}"), NUMBER)
            .when(low.isin(*UNITS) & after_number, UNIT)
            .when(t.rlike(r"^\p{Lu}\p{Ll}+$"), NAME)
            .otherwise(F.ltrim(low, F.lit(_FIRST)))
        )

    return F.transform(tokens, one)


def window_hashes(hashes: Column, window: int) -> Column:
    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (window - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, window)]))


def consistent(a: Column, b: Column) -> Column:
    """Whether the values of two equally long token lists map to each other one to one."""
    low_a, low_b = F.transform(a, F.lower), F.transform(b, F.lower)
    pairs = F.size(F.array_distinct(F.zip_with(low_a, low_b, lambda x, y: F.concat_ws("\u0002", x, y))))
    return (pairs == F.size(F.array_distinct(low_a))) & (pairs == F.size(F.array_distinct(low_b)))


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = MIN_SHARE
) -> DataFrame:
    """Documents that hold a benchmark item: doc_id, item_id, n_windows, item_windows, exact (no slot was changed).

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are ignored. An item is found where at
    least ``min_share`` of its windows match on one diagonal (same distance between the places) with consistent slots.
    Items of fewer words than a window form one window of their whole length. Null and empty texts match nothing;
    repeated rows count once.
    """
    items = benchmark.select(F.col("item_id").alias("id"), "text").distinct()
    items = items.withColumn("raw", raw_tokens(F.col("text"))).where(F.size("raw") > 0)
    short = items.where(F.size("raw") < window).select(F.size("raw").alias("n")).distinct()
    lengths = sorted({r["n"] for r in short.collect()}) + [window]  # at most ``window`` numbers
    parts = []
    for n in lengths:
        own = items.where((F.size("raw") == n) if n < window else (F.size("raw") >= window))
        parts.append(_found(docs, own, n))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    best = found.groupBy("doc_id", "item_id", "item_windows", "diagonal").agg(
        F.count_distinct("item_at").alias("n_windows"), F.min("same").alias("exact")
    )
    best = best.where(F.col("n_windows") >= min_share * F.col("item_windows"))
    return best.groupBy("doc_id", "item_id").agg(
        F.max("n_windows").cast("long").alias("n_windows"),
        F.max("item_windows").cast("long").alias("item_windows"),
        F.max("exact").alias("exact"),
    )


def _windows(rows: DataFrame, window: int) -> Column:
    hashed = bind(F.col("raw"), lambda r: F.transform(template(r), lambda t: F.xxhash64(t)))
    return bind(hashed, lambda h: window_hashes(h, window))


def _found(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    item_windows = items.select(
        F.col("id").alias("item_id"),
        F.col("raw").alias("item_raw"),
        (F.size("raw") - (window - 1)).alias("item_windows"),
        F.posexplode(_windows(items, window)).alias("item_at", "win"),
    ).select("item_id", "item_windows", "item_at", "win", F.slice("item_raw", F.col("item_at") + 1, window).alias("item_slots"))
    if item_windows.limit(MAX_BROADCAST_WINDOWS + 1).count() <= MAX_BROADCAST_WINDOWS:
        item_windows = F.broadcast(item_windows)
    rows = docs.select(F.col("doc_id").alias("id"), "text").withColumn("raw", raw_tokens(F.col("text")))
    doc_windows = rows.select(
        F.col("id").alias("doc_id"), "raw", F.posexplode(_windows(rows, window)).alias("doc_at", "win")
    )
    slots = F.slice("raw", F.col("doc_at") + 1, window)
    return (
        doc_windows.join(item_windows, "win")
        .select("doc_id", "item_id", "item_windows", "item_at", (F.col("doc_at") - F.col("item_at")).alias("diagonal"),
                F.transform(slots, lambda t: F.ltrim(t, F.lit(_FIRST))).alias("slots"),
                F.transform("item_slots", lambda t: F.ltrim(t, F.lit(_FIRST))).alias("item_slots"))
        .where(consistent(F.col("slots"), F.col("item_slots")))
        .withColumn("same", F.array_join(F.transform("slots", F.lower), " ") == F.array_join(F.transform("item_slots", F.lower), " "))
        .drop("slots", "item_slots")
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay."""
    leaked = matches(docs, benchmark, window, min_share).select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(leaked, docs["doc_id"].eqNullSafe(leaked["leaked_id"]), "left_anti")
