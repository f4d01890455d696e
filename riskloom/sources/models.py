"""Stored isolation forests: a node table and one metadata row per version."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.forest import Forest

METADATA = (
    "version string, trained_at timestamp_ntz, features array<string>, n_training_rows long, "
    "n_users long, contamination double, seed long, threshold double, threshold_rule string, "
    "params string, first_event timestamp_ntz, last_event timestamp_ntz, sample int, "
    "score_offset double"
)


@dataclass(frozen=True)
class StoredModel:
    version: str
    forest: Forest
    threshold: float
    rule: str


def save(
    spark: SparkSession,
    folder: str,
    version: str,
    forest: Forest,
    *,
    trained_at: datetime,
    rows: int,
    users: int,
    contamination: float,
    seed: int,
    threshold: float,
    rule: str,
    params: dict,
    span: tuple[datetime, datetime],
) -> None:
    """The nodes are written first: a metadata row marks a complete model."""
    forest.nodes.coalesce(1).write.mode("overwrite").parquet(f"{folder}/nodes/version={version}")
    row = (
        version,
        trained_at,
        list(forest.columns),
        rows,
        users,
        contamination,
        seed,
        threshold,
        rule,
        json.dumps(params, sort_keys=True),
        *span,
        forest.sample,
        forest.offset,
    )
    spark.createDataFrame([row], METADATA).write.mode("overwrite").parquet(
        f"{folder}/metadata/of={version}"
    )


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/metadata").drop("of")


def latest(spark: SparkSession, folder: str) -> StoredModel:
    """The model with the lexicographically last version; one without a threshold is refused."""
    newest = F.max_by(F.struct("*"), F.col("version")).alias("row")
    row = metadata(spark, folder).agg(newest).select("row.*").first()
    if row is None or row["version"] is None:
        raise LookupError(f"no model in {folder}")
    if row["threshold"] is None:
        raise ValueError(f"model {row['version']} has no threshold; train it again")
    nodes = spark.read.parquet(f"{folder}/nodes/version={row['version']}")
    forest = Forest(nodes, tuple(row["features"]), row["sample"], row["score_offset"])
    return StoredModel(row["version"], forest, row["threshold"], row["threshold_rule"])
