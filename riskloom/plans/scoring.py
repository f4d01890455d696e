"""Turning features into scored, flagged rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.metrics import (
    CONTAMINATION,
    alert_rate_thresholds,
    best_f1,
    curve,
    min_max_scaled,
)
from riskloom.schema import SCORE_COLUMNS

BEST_F1 = "max F1 on the precision/recall curve"
FALLBACK = f"contamination fallback ({CONTAMINATION})"


@dataclass(frozen=True)
class Threshold:
    value: float
    rule: str


def choose_threshold(
    raw_scores: DataFrame, labelled: bool = True, rate: float = CONTAMINATION
) -> Threshold:
    """The line on ``raw_score``: best F1 on ``label``, or the alert rate without positives.

    Labels only draw the line on the ranking; the model has not seen them.
    """
    named = raw_scores.withColumn("model", F.lit("all"))
    best = best_f1(curve(named, score="raw_score")).first() if labelled else None
    if best is not None:
        return Threshold(best["threshold"], BEST_F1)
    cut = alert_rate_thresholds(named, {"threshold": rate}, "raw_score").first()
    return Threshold(cut["threshold"], FALLBACK)


def scored_rows(
    raw_scores: DataFrame, threshold: float, version: str, scored_at: datetime, carry: Sequence[str] = ()
) -> DataFrame:
    """The score columns plus ``raw_score`` and ``carry``. The flag looks at the raw score: the
    scaled one depends on the batch it was scaled in."""
    return (
        min_max_scaled(raw_scores, "raw_score", "score")
        .withColumn("flagged", F.col("raw_score") >= F.lit(threshold))
        .withColumn("model_version", F.lit(version))
        .withColumn("scored_at", F.lit(scored_at).cast("timestamp_ntz"))
        .select(*SCORE_COLUMNS, "raw_score", *carry)
    )
