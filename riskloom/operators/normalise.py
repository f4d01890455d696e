"""Canonical columns and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalar import parsed_label, parsed_money, parsed_time
from riskloom.schema import RAW, TEXT_COLUMNS, TRANSACTION_COLUMNS


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trim and lower-case the column names."""
    return df.toDF(*[name.strip().lower() for name in df.columns])


def missing_columns(df: DataFrame) -> list[str]:
    return [name for name in TRANSACTION_COLUMNS if name not in df.columns]


def add_missing_columns(df: DataFrame) -> DataFrame:
    """Absent transaction columns become null text."""
    return df.withColumns({name: F.lit(None).cast("string") for name in missing_columns(df)})


def _typed(df: DataFrame, name: str, kind: T.DataType, parse):
    """Text is parsed leniently, a value that already has a type is cast; null if it doesn't fit."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse(F.col(name))
    return F.col(name).try_cast(kind)


def normalise(df: DataFrame) -> DataFrame:
    """The raw layer's columns and types, without ``loaded_at``.

    Text is trimmed and null stays null. Times lose their offset, money has two digits.
    """
    df = add_missing_columns(normalise_headers(df))
    values = {name: F.trim(F.col(name).cast("string")) for name in TEXT_COLUMNS}
    values["event_time"] = _typed(df, "event_time", T.TimestampNTZType(), parsed_time)
    values["amount"] = _typed(df, "amount", RAW["amount"].dataType, parsed_money)
    values["label"] = F.coalesce(
        _typed(df, "label", T.IntegerType(), parsed_label), F.lit(0)
    )
    return df.select(*[values[name].alias(name) for name in TRANSACTION_COLUMNS])


def loadable(normalised: DataFrame) -> DataFrame:
    """Rows that kept their time and amount (P10)."""
    return normalised.dropna(subset=["event_time", "amount"])


def dropped_rows(normalised: DataFrame) -> DataFrame:
    """How many rows :func:`loadable` keeps and drops, as one row."""
    lost = F.col("event_time").isNull() | F.col("amount").isNull()
    return normalised.agg(
        F.count_if(~lost).alias("kept_rows"), F.count_if(lost).alias("dropped_rows")
    )
