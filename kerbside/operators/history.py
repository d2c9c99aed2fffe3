"""Report history: overwriting the rows of given dates, and headings in two levels."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def check_columns(history: DataFrame, updates: DataFrame, allow_unmatched: bool = False) -> list[str]:
    """Columns of the history that the updates lack; an error unless ``allow_unmatched``, then a warning."""
    missing = [c for c in history.columns if c not in updates.columns]
    if missing:
        message = f"the updates lack these columns of the history: {missing}"
        if not allow_unmatched:
            raise ValueError(message)
        warnings.warn(message, stacklevel=3)
    return missing


def check_keys(history: DataFrame, updates: DataFrame, key: str) -> None:
    """Every key of the updates must be unique there and name exactly one row of the history.

    Only counts reach the driver.
    """
    wanted = updates.groupBy(quoted(key).alias("__key")).agg(F.count(F.lit(1)).alias("__updates"))
    held = history.groupBy(quoted(key).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
    joined = wanted.join(held, "__key", "left")
    repeated = F.col("__updates") > 1
    unclear = F.coalesce("__rows", F.lit(0)) != 1
    found = joined.agg(F.count_if(repeated).alias("repeated"), F.count_if(unclear).alias("unclear")).first()
    if found["repeated"]:
        raise ValueError(f"{found['repeated']} values of {key} occur more than once in the updates")
    if found["unclear"]:
        raise ValueError(f"{found['unclear']} values of {key} do not name exactly one row of the history")


def _guarded(history: DataFrame, renamed: DataFrame, key: str) -> DataFrame:
    """The left join of ``merge_history`` with the checks of ``check_keys`` inside: a bad key fails the job that reads it.

    Both sides are counted by key where the join needs them, so neither is read twice.
    """
    counted = Window.partitionBy("__key")
    wanted = renamed.withColumn("__updates", F.count(F.lit(1)).over(counted))
    held = history.withColumn("__held_key", quoted(key))
    held = held.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy("__held_key")))
    joined = held.join(wanted, F.col("__held_key") == F.col("__key"), "full")
    text = F.coalesce(F.col("__key").cast("string"), F.lit("null"))

    def fail(message: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{key} "), text, F.lit(f" {message}")))

    sound = (
        F.when(F.col("__updates") > 1, fail("occurs more than once in the updates"))
        .when(F.col("__updates").isNotNull() & (F.coalesce("__rows", F.lit(0)) != 1), fail("does not name exactly one row of the history"))
        .otherwise(F.lit(True))
    )
    return joined.filter(sound).drop("__updates", "__rows", "__held_key")


def merge_history(
    history: DataFrame,
    updates: DataFrame,
    key: str = "otp_date",
    allow_unmatched: bool = False,
    validate: bool | str = True,
) -> DataFrame:
    """The history with the rows of the updates' keys replaced whole; nothing is inserted.

    Columns that the updates lack become null in the replaced rows. Every key of the updates must be unique there and name
    one row of the history: by default this is counted at once, by a job that reads both, and is a ValueError. With
    ``validate="plan"`` the check is part of the plan: nothing runs now, the updates are read once, and the job that
    computes the result fails. Write the result to a new location, since the plan reads the history.
    """
    check_columns(history, updates, allow_unmatched)
    if validate not in (True, False, "plan"):
        raise ValueError("validate is True, False or 'plan'")
    if validate is True:
        check_keys(history, updates, key)
    values = [c for c in history.columns if c != key]
    shared = [c for c in values if c in updates.columns]
    new = {c: f"__new_{i}" for i, c in enumerate(shared)}
    renamed = updates.select(
        quoted(key).alias("__key"), *[quoted(c).alias(n) for c, n in new.items()], F.lit(True).alias("__hit")
    )
    if validate == "plan":
        joined = _guarded(history, renamed, key)
    else:
        joined = history.join(renamed, quoted(key) == F.col("__key"), "left")

    def merged(name: str) -> Column:
        value = F.col(new[name]) if name in new else F.lit(None)
        return F.when(F.col("__hit"), value).otherwise(quoted(name)).cast(history.schema[name].dataType).alias(name)

    return joined.select(*[quoted(c) if c == key else merged(c) for c in history.columns])


def quoted(name: str) -> Column:
    """A column whose name may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def flat_headings(groups: list[str | None], names: list[str | None]) -> list[str]:
    """Column names from a heading in two levels: the group runs on to the right, and the two are joined by ``_``."""
    flat, group = [], None
    for above, below in zip(groups, names, strict=True):
        group = above if above is not None else group
        text = f"{group}_{below or 'NA'}" if group else f"{below or 'NA'}"
        legal = re.sub(r"[^A-Za-z0-9._]", ".", text)
        flat.append(legal if re.match(r"[A-Za-z]|\.(?![0-9])", legal) else f"X{legal}")
    return flat


def fill_down(
    df: DataFrame,
    columns: list[str],
    partition_by: list[str],
    order_by: list[str],
    chunk: Column | None = None,
) -> DataFrame:
    """Fill missing values with the last one before them, in the order of ``order_by`` within ``partition_by``.

    ``chunk`` must not decrease along the order, such as the day or hour of a timestamp. Rows are then filled within
    chunks, and only one row per chunk is carried on from chunk to chunk, so a partition of any size is spread over
    many tasks. Without it each partition is one window.
    """
    if not partition_by or not order_by:
        raise ValueError("fill_down needs partition and order columns")
    order = [F.col(c) for c in order_by]
    if chunk is None:
        window = Window.partitionBy(*partition_by).orderBy(*order)
        running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(running) for c in columns})

    # Never-null texts as keys: the window and the join that follows it share one partitioning of the rows.
    names = [f"__key_{i}" for i in range(len(partition_by) + 1)]
    values = [*[F.col(c) for c in partition_by], chunk]
    keys = {n: F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("")) for n, v in zip(names, values, strict=True)}
    chunked = df.withColumn("__chunk", chunk).withColumns(keys)
    place = F.struct(*order)
    last_known = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"__last_{c}") for c in columns]
    ends = chunked.groupBy(*names, "__chunk").agg(*last_known)
    earlier = Window.partitionBy(*names[:-1]).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *names,
        *[F.last(f"__last_{c}", ignorenulls=True).over(earlier).alias(f"__carry_{c}") for c in columns],
    )
    within = (
        Window.partitionBy(*names)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = chunked.withColumns({c: F.last(c, ignorenulls=True).over(within) for c in columns})
    joined = local.join(carried, names, "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"__carry_{c}")) for c in columns}
    return joined.withColumns(filled).select(*df.columns)
