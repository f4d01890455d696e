"""Column expressions shared by the operators: lenient parsing, time and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.schema import MONEY

# Accepted time texts with their pattern (none: ISO, read by a cast), in the
# order they are tried, and the text of a number.
TIME_SHAPES = [
    (
        r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?( ?(Z|[+-]\d{2}:?\d{2}))?)?$",
        None,
    ),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^[A-Z][a-z]{2} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}$", "yyyy/M/d H:mm"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AaPp][Mm]$", "M/d/yyyy h:mm a"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]$", "M/d/yyyy h:mm:ss a"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2} [AaPp][Mm]$", "yyyy-M-d h:mm a"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]$", "yyyy-M-d h:mm:ss a"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4} \d{1,2}:\d{2}$", "d MMM yyyy H:mm"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4} \d{1,2}:\d{2}:\d{2}$", "d MMM yyyy H:mm:ss"),
]
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Cell texts read as missing, as in common CSV readers.
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def parsed_time(text: Column) -> Column:
    """UTC wall-clock time, or null for text in none of the accepted formats.

    An offset is applied and dropped; needs a UTC session. The shape is checked before a
    text is parsed, as failed parses are slow and a bare cast accepts partial times.
    """
    text = F.trim(text)
    tries = [
        F.when(
            text.rlike(shape),
            F.try_to_timestamp(text, F.lit(pattern)) if pattern else text.try_cast("timestamp"),
        )
        for shape, pattern in TIME_SHAPES
    ]
    return F.coalesce(*tries).cast(T.TimestampNTZType())


def parsed_number(text: Column) -> Column:
    """A finite double, or null (P5). ``12d`` and ``nan`` are not numbers."""
    text = F.trim(text)
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def parsed_money(text: Column) -> Column:
    """``decimal(12,2)``, rounded half up from the text itself."""
    text = F.trim(text)
    return F.when(text.rlike(NUMBER), text.try_cast(MONEY))


def parsed_label(text: Column) -> Column:
    """Integer label, missing or unreadable means 0."""
    return F.coalesce(parsed_number(text).try_cast("int"), F.lit(0))


def without_missing_tokens(text: Column) -> Column:
    return F.when(~text.isin(MISSING_TOKENS), text)


def truth(value: Column) -> Column:
    """The texts ``true`` and ``1`` in any case are true, all else is false."""
    return F.coalesce(F.lower(value.cast("string")).isin("true", "1"), F.lit(False))


def money(df: DataFrame, name: str) -> Column:
    """Column ``name`` as money, whatever its type; unreadable text and NaN become null."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        return parsed_money(value)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    return value.try_cast(MONEY)


def instant(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a time, whatever its type; unreadable text becomes null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parsed_time(F.col(name))
    return F.col(name)


def micros(time: Column) -> Column:
    """Microseconds since the epoch. Needs a UTC session."""
    return F.unix_micros(time.cast("timestamp"))


def hours_between(later_micros: Column, earlier_micros: Column) -> Column:
    return (later_micros - earlier_micros) / F.lit(1e6) / F.lit(3600.0)


def safe_ratio(value: Column, baseline: Column) -> Column:
    """``value / baseline``, or 1 where there is no positive baseline."""
    return F.when(baseline > 0, value / baseline).otherwise(F.lit(1.0))
