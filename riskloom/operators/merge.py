"""Keyed merge of two tables, counts of what it did, and table comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merged(
    target: DataFrame, source: DataFrame, key: str, insert_only: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``target`` updated by ``source`` plus its new rows, with an ``action`` column.

    A matched row takes every value from the source except ``insert_only`` columns, which
    keep the value they were first loaded with. Keys are unique on both sides.
    """
    old, new = target.alias("old"), source.alias("new")
    matched = F.col(f"new.{key}").isNotNull()
    known = F.col(f"old.{key}").isNotNull()

    def value(name: str) -> Column:
        if name == key:
            return F.coalesce(f"old.{key}", f"new.{key}")
        if name in insert_only:
            return F.when(known, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))
        return F.when(matched, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))

    action = F.when(~known, "inserted").when(matched, "updated").otherwise("kept")
    return old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer").select(
        *[value(name).alias(name) for name in target.columns], action.alias("action")
    )


def action_counts(merge: DataFrame) -> DataFrame:
    """Inserted and updated rows and the size of the table after it (K7), as one row."""
    return merge.agg(
        F.count_if(F.col("action") == "inserted").alias("inserted"),
        F.count_if(F.col("action") == "updated").alias("updated"),
        F.count(F.lit(1)).alias("table_rows"),
    )


def check_source(source: DataFrame, key: str) -> None:
    """A merge source must not repeat a key or leave it out (D3)."""
    keys = source.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    wrong = keys.where("key IS NULL OR copies > 1").take(1)
    if wrong:
        problem = "has rows without" if wrong[0]["key"] is None else "repeats"
        raise ValueError(f"merge source {problem} {key}")


def first_per_key(source: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Keep the smallest row of each key by ``order``, then by the other columns.

    The minimum combines before the shuffle, so a key with very many rows is no burden.
    """
    rest = [name for name in source.columns if name not in order]
    first = F.min(F.struct(*order, *rest))
    return source.groupBy(F.col(key).alias("_key")).agg(first.alias("row")).select(
        *[F.col(f"row.{name}").alias(name) for name in source.columns]
    )


def table_diff(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], tolerance: float = 1e-6
) -> DataFrame:
    """Compare two result tables by key: one row per column."""
    a, b = left.alias("a"), right.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    gaps = {
        name: F.max(F.abs(F.col(f"a.{name}").cast("double") - F.col(f"b.{name}").cast("double")))
        for name in columns
    }
    totals = both.agg(
        F.count(f"a.{key}").alias("left_rows"),
        F.count(f"b.{key}").alias("right_rows"),
        F.count_if(F.col(f"a.{key}").isNull() | F.col(f"b.{key}").isNull()).alias("unmatched"),
        *[gap.alias(f"_{name}") for name, gap in gaps.items()],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("column"), F.col(f"_{name}").alias("max_diff"))
                for name in columns
            ]
        )
    )
    return totals.select("left_rows", "right_rows", "unmatched", rows.alias("r")).select(
        "left_rows",
        "right_rows",
        "unmatched",
        "r.*",
        F.coalesce(
            (F.col("r.max_diff") < tolerance) & (F.col("unmatched") == 0), F.lit(False)
        ).alias("matches"),
    )


def layer_counts(layers: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows and distinct keys per layer: equal counts mean nothing was lost or doubled."""
    counted = None
    for name, layer in layers.items():
        one = layer.agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_keys")
        ).select(F.lit(name).alias("layer"), "rows", "distinct_keys")
        counted = one if counted is None else counted.unionByName(one)
    return counted
