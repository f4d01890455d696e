"""Ranking metrics and threshold rules on ``(model, score, label)`` rows.

All functions take several models at once: ``model`` is a grouping column, so evaluating
one more model adds rows, not jobs. Rows with equal scores are one point of a curve.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordered import positions, quantiles, running, sliced

# Evaluation parameters.
TRAIN_FRACTION = 0.70
FOLDS = 5
ALERT_RATES = [0.001, 0.0028, 0.005, 0.01, 0.02]
RECALL_TARGETS = [float(target) for target in np.linspace(0.05, 0.85, 9)]
CONTAMINATION = 0.02
LEGITIMATE = "legitimate"


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    both = precision + recall
    return F.when(both > 0, F.lit(2.0) * precision * recall / both).otherwise(F.lit(0.0))


def curve(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Precision and recall at every distinct score, per model.

    Models without a positive label have no curve and are left out.
    """
    points = scores.groupBy("model", F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("hits"), F.count(F.lit(1)).alias("rows")
    )
    order = [F.col("threshold").desc()]
    cut = sliced(points, ["model", *order])
    totals = cut.groupBy("model").agg(
        F.sum("hits").alias("positives"), F.sum("rows").alias("total_rows")
    )
    ranked = running(cut, ["model"], order, sums={"tp": "hits", "flagged": "rows"})
    precision = F.col("tp") / F.col("flagged")
    recall = F.col("tp") / F.col("positives")
    return (
        ranked.join(totals, "model")
        .where("positives > 0")
        .select(
            "model",
            "threshold",
            "hits",
            "rows",
            "tp",
            "flagged",
            "positives",
            "total_rows",
            precision.alias("precision"),
            recall.alias("recall"),
            _f1(precision, recall).alias("f1"),
        )
    )


def best_f1(points: DataFrame) -> DataFrame:
    """The point with the largest F1, ties to the lowest threshold (E2); no positives, no row."""
    best = F.max_by(
        F.struct("threshold", "precision", "recall", "f1"),
        F.struct(F.col("f1"), (-F.col("threshold")).alias("low")),
    )
    return points.groupBy("model").agg(best.alias("best")).select("model", "best.*")


def areas(points: DataFrame) -> DataFrame:
    """Average precision and ROC-AUC per model, both with ties as one step."""
    misses = F.col("rows") - F.col("hits")
    ranked_below = F.col("tp") - F.col("hits") + F.col("hits") / 2
    negatives = F.max("total_rows") - F.max("positives")
    return points.groupBy("model").agg(
        F.sum(F.col("hits") / F.col("positives") * F.col("precision")).alias("pr_auc"),
        F.when(
            negatives > 0, F.sum(misses * ranked_below) / (F.max("positives") * negatives)
        ).alias("roc_auc"),
    )


def curve_samples(points: DataFrame) -> DataFrame:
    """The curve points nearest to fixed recall targets (E9), each recall once (4 digits)."""
    nearest = [
        F.min(
            F.struct(
                F.abs(F.col("recall") - F.lit(target)).alias("distance"),
                "threshold",
                "recall",
                "precision",
            )
        ).alias(f"_{number}")
        for number, target in enumerate(RECALL_TARGETS)
    ]
    stacked = F.explode(
        F.array(
            *[
                F.struct(F.lit(number).alias("target_no"), F.col(f"_{number}").alias("point"))
                for number in range(len(RECALL_TARGETS))
            ]
        )
    )
    return (
        points.groupBy("model")
        .agg(*nearest)
        .select("model", stacked.alias("s"))
        .groupBy("model", F.round("s.point.recall", 4).alias("_key"))
        .agg(F.min_by("s.point", "s.target_no").alias("point"))
        .select("model", "point.recall", "point.precision", "point.threshold")
    )


def alert_rate_thresholds(
    scores: DataFrame, rates: dict[str, float], score: str = "score"
) -> DataFrame:
    """Per model, the score that flags each share of the rows."""
    return quantiles(scores, score, {name: 1.0 - rate for name, rate in rates.items()}, ["model"])


def _at(flag: Column, label: str, suffix: str = "") -> list[Column]:
    return [
        F.count_if(flag).alias(f"flagged{suffix}"),
        F.count_if(flag & (F.col(label) == 1)).alias(f"true_positives{suffix}"),
    ]


def _rates(flagged: Column, caught: Column) -> list[Column]:
    precision, recall = _share(caught, flagged), _share(caught, F.col("positives"))
    return [
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
        flagged.alias("flagged"),
        caught.alias("true_positives"),
        (flagged / F.col("total_rows")).alias("alert_rate"),
    ]


def _totals(label: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(label) == 1).alias("positives"),
    ]


def metrics_at(
    scores: DataFrame, thresholds: DataFrame, score: str = "score", label: str = "label"
) -> DataFrame:
    """Operating point per model (E4). ``thresholds`` has one row ``(model, threshold)`` each."""
    flag = F.col(score) >= F.col("threshold")
    # One threshold per model: the broadcast side is bounded by the number of models.
    judged = scores.join(F.broadcast(thresholds.select("model", "threshold")), "model")
    return (
        judged.groupBy("model", "threshold")
        .agg(*_totals(label), *_at(flag, label))
        .select("model", "threshold", *_rates(F.col("flagged"), F.col("true_positives")))
    )


def alert_budgets(
    scores: DataFrame,
    rates: Sequence[float] = tuple(ALERT_RATES),
    score: str = "score",
    label: str = "label",
) -> DataFrame:
    """Metrics if a fixed share of rows can be reviewed (E8): one scan for all rates."""
    cuts = alert_rate_thresholds(scores, {f"_cut{i}": r for i, r in enumerate(rates)}, score)
    counted = []
    for number in range(len(rates)):
        counted += _at(F.col(score) >= F.col(f"_cut{number}"), label, str(number))
    grouping = ["model", *[f"_cut{number}" for number in range(len(rates))]]
    wide = scores.join(F.broadcast(cuts), "model").groupBy(*grouping).agg(*_totals(label), *counted)
    stacked = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(rate).alias("budget"),
                    F.col(f"_cut{number}").alias("threshold"),
                    F.col(f"flagged{number}").alias("n"),
                    F.col(f"true_positives{number}").alias("caught"),
                )
                for number, rate in enumerate(rates)
            ]
        )
    )
    return wide.select("model", "total_rows", "positives", stacked.alias("s")).select(
        "model", "s.budget", "s.threshold", *_rates(F.col("s.n"), F.col("s.caught"))
    )


def typology_recall(
    scores: DataFrame, thresholds: DataFrame, score: str = "score", typology: str = "fraud_type"
) -> DataFrame:
    """Recall per kind of fraud at each model's threshold."""
    caught = F.count_if(F.col(score) >= F.col("threshold"))
    count = F.count(F.lit(1))
    return (
        scores.where(F.col(typology) != LEGITIMATE)
        .join(F.broadcast(thresholds.select("model", "threshold")), "model")
        .groupBy("model", F.col(typology).alias("typology"))
        .agg(count.alias("n"), caught.alias("caught"), (caught / count).alias("recall"))
    )


def min_max_scaled(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Display score in [0, 1] over the batch; 0 if all scores are equal."""
    bounds = df.agg(F.min(raw).alias("_low"), F.max(raw).alias("_high"))
    span = F.col("_high") - F.col("_low")
    scaled = F.when(span != 0, (F.col(raw) - F.col("_low")) / span).otherwise(F.lit(0.0))
    # The broadcast side is one row.
    return df.crossJoin(F.broadcast(bounds)).withColumn(out, scaled).drop("_low", "_high")


def split_cutoff(df: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """The day from which rows are test rows, as one row (M8).

    The sorted array holds calendar days, so its length is bounded by the time span.
    """
    days = df.select(F.to_date("event_time").alias("day")).distinct()
    ordered = F.sort_array(F.collect_list("day"))
    index = F.floor(F.size(ordered) * F.lit(fraction)).cast("int")
    return days.agg(F.get(ordered, index).alias("cutoff"))


def with_split(df: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Add ``split``: ``train`` before the cutoff day, ``test`` from it on."""
    day = F.to_date("event_time")
    named = F.when(day < F.col("cutoff"), "train").otherwise("test")
    cutoff = F.broadcast(split_cutoff(df, fraction))  # one row
    return df.crossJoin(cutoff).withColumn("split", named).drop("cutoff")


def split_summary(split: DataFrame) -> DataFrame:
    """Rows, positives and prevalence per side."""
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("label") == 1).alias("positives"),
        F.avg(F.col("label").cast("double")).alias("prevalence"),
    )


def with_folds(train: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Add the walk-forward ``fold`` (M9).

    The last ``folds`` blocks of ``rows // (folds + 1)`` rows in time order are folds 1 to
    ``folds``; earlier rows are fold 0, which is only trained on.
    """
    placed = positions(train.withColumn("_t", F.col("event_time")), ["_t", "transaction_id"])
    rows = F.broadcast(train.agg(F.count(F.lit(1)).alias("_rows")))  # one row
    block = F.floor(F.col("_rows") / (folds + 1))
    from_end = F.floor((F.col("_rows") - F.col("position")) / block)
    fold = F.when((block > 0) & (from_end < folds), F.lit(folds) - from_end).otherwise(F.lit(0))
    return placed.crossJoin(rows).withColumn("fold", fold.cast("int")).drop("_t", "_rows", "position")


def balanced_weights(train: DataFrame) -> DataFrame:
    """Add ``weight`` = rows / (2 * rows of the class) (M7)."""
    classes = train.groupBy("label").agg(F.count(F.lit(1)).alias("_class"))
    total = classes.agg(F.sum("_class").alias("_all"))
    # Two class rows and one total row.
    weights = classes.crossJoin(F.broadcast(total)).select(
        "label", (F.col("_all") / (2.0 * F.col("_class"))).alias("weight")
    )
    return train.join(F.broadcast(weights), "label")


def random_score(seed: int) -> Column:
    """A repeatable uniform score from the id (M11), independent of the partitioning."""
    digest = F.md5(F.concat(F.col("transaction_id"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
