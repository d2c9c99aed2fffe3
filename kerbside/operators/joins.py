"""Join helpers.

A missing key equals a missing key in most joins of these reports. ``eqNullSafe`` keeps such a join an equi-join, so
Spark still picks a broadcast, shuffled-hash or sort-merge plan by size and AQE can split skewed partitions. No side is
forced to be broadcast here: the threshold on estimated and, under AQE, on measured sizes decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KeyPair = str | tuple[str, str]


def _pairs(keys: Sequence[KeyPair]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in keys]


def join_on(
    left: DataFrame,
    right: DataFrame,
    null_safe: Sequence[KeyPair] = (),
    plain: Sequence[KeyPair] = (),
    how: str = "left",
    where: Column | None = None,
) -> DataFrame:
    """Join on pairs of key columns and drop the right keys.

    Keys in ``null_safe`` match null with null; those in ``plain`` do not (use it for keys that are never null, it
    makes narrower sort keys). ``where`` is an extra condition over columns of both sides.
    """
    safe, strict = _pairs(null_safe), _pairs(plain)
    right = right.withColumnsRenamed({r: f"__right_{r}" for _, r in [*safe, *strict]})
    terms = [F.col(lk).eqNullSafe(F.col(f"__right_{rk}")) for lk, rk in safe]
    terms += [F.col(lk) == F.col(f"__right_{rk}") for lk, rk in strict]
    if where is not None:
        terms.append(where)
    joined = left.join(right, reduce(and_, terms), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__right_{r}" for _, r in [*safe, *strict]])


def never_null(column: str, name: str) -> dict[str, Column]:
    """Two never-null columns, ``name`` and ``name``_none, that are equal for equal numbers and for missing ones.

    A null-safe comparison hashes expressions of its own, so its shuffle serves that one join. Joins and distincts on these
    columns share a shuffle, or the buckets of a stored table.
    """
    value = F.col(column).cast("bigint")
    return {name: F.coalesce(value, F.lit(0)), f"{name}_none": value.isNull()}


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct rows of ``df``, dealt by ``keys``.

    Copies are found by one sort that begins with ``keys``, which a join on them then needs no more, instead of two hash
    tables of all rows of a task beside that sort.
    """
    rows = Window.partitionBy(*keys, *[c for c in df.columns if c not in keys]).orderBy(keys[0])
    return df.repartition(*keys).withColumn("__copy", F.row_number().over(rows)).filter(F.col("__copy") == 1).drop("__copy")


def with_membership(left: DataFrame, key: str, members: DataFrame, member_key: str, flag: str) -> DataFrame:
    """Add the boolean ``flag``, never null: does ``key`` occur among the members (null does if a member is null)."""
    distinct = members.select(F.col(member_key).alias("__member")).distinct().withColumn("__hit", F.lit(True))
    joined = join_on(left, distinct, null_safe=[(key, "__member")])
    return joined.withColumn(flag, F.col("__hit").isNotNull()).drop("__hit")
