"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def squish(col: Column) -> Column:
    """Trim and collapse every run of white space, that of Unicode included, to one space."""
    return F.trim(F.regexp_replace(col, r"[\s\p{Z}]+", " "))


def squish_strings(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``squish`` on every string column but those to ``keep``, in one projection."""

    def clean(f: T.StructField) -> Column:
        value = F.col(f"`{f.name}`")
        return squish(value).alias(f.name) if isinstance(f.dataType, T.StringType) and f.name not in keep else value

    return df.select(*[clean(f) for f in df.schema.fields])


def text_or_na(col: Column) -> Column:
    """Text of a value, the letters NA for a missing one."""
    return F.coalesce(col.cast("string"), F.lit("NA"))


def ampm_of(route_set_name: Column) -> Column:
    """First whole word AM or PM of a route-set name, in capitals; null if there is none."""
    found = F.regexp_extract(route_set_name, r"(?i)\b(AM|PM)\b", 0)
    return F.upper(F.nullif(found, F.lit("")))


def garage_short(garage: Column) -> Column:
    """Garage name without everything from the first space on."""
    return F.regexp_replace(garage, " .*$", "")


def stop_text(custom_description: Column, description: Column) -> Column:
    """Custom description of a point, or its plain one where the custom one is null or empty."""
    return F.coalesce(F.nullif(custom_description, F.lit("")), description)


def number_text(df: DataFrame, name: str, qualified: str | None = None) -> Column:
    """A number as text in plain decimals, without trailing zeros; of floating-point numbers up to 15 places count."""
    col = F.col(qualified or name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        text = col.cast("string")
        plain = F.regexp_replace(col.try_cast("decimal(38,15)").cast("string"), r"\.?0+$", "")
        return F.when(text.rlike("E|\\.0$"), F.coalesce(F.when(plain == "", "0").otherwise(plain), text)).otherwise(text)
    return col.cast("string")


def clock_text(seconds: Column) -> Column:
    """Seconds after midnight as HH:MM:SS."""
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(seconds / 3600),
        F.floor(F.pmod(seconds, F.lit(3600)) / 60),
        F.pmod(seconds, F.lit(60)),
    )


def numeric(route: Column) -> Column:
    """A route as a double; null if its text is not a number (a type suffix such as D makes it none)."""
    number = F.when(F.trim(route.cast("string")).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), route)
    return number.try_cast("double")


def route_number(route: Column) -> Column:
    """A route as an integer, fractions cut; null if it is not numeric."""
    return numeric(route).try_cast("int")
