"""Held-out evaluation of rankings on a temporal split (B4: M5-M11, E1-E10, A14, K11)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import forest, metrics, supervised
from riskloom.operators.features import compute
from riskloom.schema import ABSOLUTE_FEATURES, FEATURES
from riskloom.session import pinned

SEED = 42

FOREST_4 = "Isolation Forest, 4 absolute features"
FOREST_7 = "Isolation Forest, 7 features"
LOGISTIC_7 = "Logistic regression, 7 features"
RANDOM_FOREST_7 = "Random forest, 7 features"
BY_AMOUNT = "rank by amount, no model"
BY_CHANCE = "random ordering"
ALL = [FOREST_4, FOREST_7, LOGISTIC_7, RANDOM_FOREST_7, BY_AMOUNT, BY_CHANCE]

DEFAULT_THRESHOLD = 0.5


@dataclass(frozen=True)
class Evaluation:
    """``report`` is long: ``(model, metric, slice, value)``."""

    split: DataFrame
    report: DataFrame
    samples: DataFrame


def labelled_features(transactions: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """Features with amount, label, kind of fraud and split, written once.

    Amount and label travel with the rows, so only the side table is joined. Features of
    the whole set are computed before the split; that is safe because they are causal.
    """
    rows = compute(transactions, carry=["amount", "label"])
    if truth is None:
        rows = rows.withColumn("fraud_type", F.lit(metrics.LEGITIMATE))
    else:
        rows = rows.join(truth, "transaction_id", "left").withColumn(
            "fraud_type", F.coalesce("fraud_type", F.lit(metrics.LEGITIMATE))
        )
    return pinned(metrics.with_split(pinned(rows)))


_SCORED = ["transaction_id", "label", "fraud_type", "score"]


def unsupervised(split: DataFrame, columns: Sequence[str], seed: int) -> tuple[DataFrame, DataFrame]:
    """Raw scores of the training rows (for the threshold) and of the test rows."""
    model, train = forest.fit_and_score(
        split.where("split = 'train'"), columns, seed, out="score"
    )
    test = forest.with_raw_score(split.where("split = 'test'"), model, "score")
    return train.select(*_SCORED), test.select(*_SCORED)


def learned(
    split: DataFrame, kind: str, columns: Sequence[str], seed: int
) -> tuple[DataFrame, DataFrame]:
    """Walk-forward scores of the training rows and final scores of the test rows."""
    train = split.where("split = 'train'")
    folded = pinned(metrics.with_folds(train))
    final, earlier = supervised.side_by_side([
        lambda: supervised.fit(kind, train, columns, seed),
        lambda: supervised.walk_forward(kind, folded, columns, seed).select(*_SCORED),
    ])
    test = split.where("split = 'test'")
    if final is None:
        return earlier, test.withColumn("score", F.lit(0.0)).select(*_SCORED)
    return earlier, supervised.probability(final, test, columns).select(*_SCORED)


def scored(split: DataFrame, models: Sequence[str], seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """``(model, ...)`` rows to choose thresholds on and rows to report on."""
    columns = {FOREST_4: ABSOLUTE_FEATURES, FOREST_7: FEATURES}
    kinds = {LOGISTIC_7: supervised.LOGISTIC, RANDOM_FOREST_7: supervised.RANDOM_FOREST}
    choosing, reporting = [], []
    for name in models:
        if name in columns:
            pair = unsupervised(split, columns[name], seed)
        elif name in kinds:
            pair = learned(split, kinds[name], FEATURES, seed)
        else:
            value = F.col("amount").cast("double") if name == BY_AMOUNT else metrics.random_score(seed)
            pair = tuple(
                split.where(F.col("split") == side).withColumn("score", value).select(*_SCORED)
                for side in ("train", "test")
            )
        choosing.append(pair[0].withColumn("model", F.lit(name)))
        reporting.append(pair[1].withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, choosing), reduce(DataFrame.unionByName, reporting)


def _long(wide: DataFrame, slice_of, values: Sequence[str]) -> DataFrame:
    stacked = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
                for name in values
            ]
        )
    )
    return wide.select("model", slice_of.alias("slice"), stacked.alias("s")).select(
        "model", "s.metric", "slice", "s.value"
    )


_POINT = ["precision", "recall", "f1", "flagged", "true_positives", "alert_rate"]


def report(choosing: DataFrame, reporting: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Everything that is reported per model (E10), and the sampled curves."""
    points = pinned(metrics.curve(reporting))
    best = metrics.best_f1(metrics.curve(choosing)).select("model", "threshold")
    named = reporting.select("model").distinct()
    thresholds = pinned(
        named.join(best, "model", "left").withColumn(
            "threshold", F.coalesce("threshold", F.lit(DEFAULT_THRESHOLD))
        )
    )
    everything = F.lit("all")
    parts = [
        _long(metrics.areas(points), everything, ["pr_auc", "roc_auc"]),
        _long(thresholds, everything, ["threshold"]),
        _long(metrics.metrics_at(reporting, thresholds), everything, _POINT),
        _long(
            metrics.alert_budgets(reporting),
            F.concat(F.lit("budget="), F.col("budget").cast("string")),
            ["threshold", *_POINT],
        ),
        _long(
            metrics.typology_recall(reporting, thresholds),
            F.concat(F.lit("typology="), F.col("typology")),
            ["n", "caught", "recall"],
        ),
    ]
    return reduce(DataFrame.unionByName, parts), metrics.curve_samples(points)


def ranked_summary(long_report: DataFrame) -> DataFrame:
    """Models by PR-AUC."""
    return (
        long_report.where("metric = 'pr_auc'")
        .select("model", F.col("value").alias("pr_auc"))
        .orderBy(F.col("pr_auc").desc(), "model")
    )


def evaluate(
    transactions: DataFrame,
    truth: DataFrame | None = None,
    models: Sequence[str] = tuple(ALL),
    seed: int = SEED,
) -> Evaluation:
    split = labelled_features(transactions, truth)
    choosing, reporting = (pinned(part) for part in scored(split, models, seed))
    long_report, samples = report(choosing, reporting)
    return Evaluation(metrics.split_summary(split), long_report, samples)


def as_json(evaluation: Evaluation) -> DataFrame:
    """The report as one JSON text per model."""
    entry = F.struct("metric", "slice", "value")
    return evaluation.report.groupBy("model").agg(
        F.to_json(F.sort_array(F.collect_list(entry))).alias("report")
    )
