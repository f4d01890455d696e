"""Supervised models on the feature table: fits and walk-forward scores (M5-M7, M9)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import random_forest
from riskloom.operators.metrics import FOLDS, balanced_weights
from riskloom.operators.random_forest import RandomForest

LOGISTIC = "logistic"
RANDOM_FOREST = "random_forest"

# Training parameters.
MAX_ITERATIONS = 1000
TOLERANCE = 1e-4
FOREST_TREES = 100
FOREST_DEPTH = 30

# The rows of a forest are dealt into a number of partitions that depends on them only.
FOREST_PARTITIONS = 8
FOREST_ROWS = 50_000  # a partition above FOREST_PARTITIONS of them
FITS = 3  # at once, so that one fit's last tasks and the driver's steps leave no core idle


def forest_partitions(rows: int) -> int:
    return max(FOREST_PARTITIONS, -(-rows // FOREST_ROWS))


def _pipeline(columns: Sequence[str], rows: int) -> Pipeline:
    inputs = VectorAssembler(inputCols=list(columns), outputCol="_vector")
    scaler = StandardScaler(inputCol="_vector", outputCol="_scaled", withMean=True)
    # Balanced weights add up to the number of rows: a unit penalty is 1 / rows here.
    model = LogisticRegression(
        featuresCol="_scaled",
        labelCol="label",
        weightCol="weight",
        maxIter=MAX_ITERATIONS,
        tol=TOLERANCE,
        regParam=1.0 / rows,
        standardization=False,
    )
    return Pipeline(stages=[inputs, scaler, model])


def fit(
    kind: str,
    train: DataFrame,
    columns: Sequence[str],
    seed: int = 42,
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
) -> PipelineModel | RandomForest | None:
    """Fit with balanced class weights; None where the rows hold a single class."""
    classes = train.groupBy("label").count().collect()  # one row per class
    if len(classes) < 2:
        return None
    rows = sum(row["count"] for row in classes)
    keys = [name for name in ("transaction_id",) if name in train.columns]
    filled = train.select(*keys, "label", *columns).fillna(0.0, list(columns))
    if kind == RANDOM_FOREST:
        held = {row["label"]: row["count"] for row in classes}
        weights = [rows / (2.0 * held[label]) if held.get(label) else 1.0 for label in (0, 1)]
        known = filled.where("label IS NOT NULL")
        return random_forest.fit(known, columns, keys, weights, forest_partitions(rows), trees, depth, seed)
    return _pipeline(columns, rows).fit(balanced_weights(filled))


def probability(
    model: PipelineModel | RandomForest, df: DataFrame, columns: Sequence[str], out: str = "score"
) -> DataFrame:
    if isinstance(model, RandomForest):
        return random_forest.probability(model, df, out)
    scored = model.transform(df.fillna(0.0, list(columns)))
    return scored.withColumn(out, vector_to_array("probability")[1]).select(*df.columns, out)


def side_by_side(calls: Sequence[Callable]) -> list:
    """Results of calls that run Spark jobs of their own, up to ``FITS`` at once."""
    with ThreadPoolExecutor(FITS) as pool:
        waiting = [pool.submit(inheritable_thread_target(call)) for call in calls]
        return [call.result() for call in waiting]


def walk_forward(
    kind: str, folded: DataFrame, columns: Sequence[str], seed: int = 42, folds: int = FOLDS
) -> DataFrame:
    """Out-of-fold scores: each fold is scored by a model of the rows before it.

    The loop is over the fixed number of folds; every fit is a distributed job. Rows of
    fold 0 have no out-of-fold score and are not in the result.
    """

    def scored(fold: int) -> DataFrame | None:
        model = fit(kind, folded.where(F.col("fold") < fold), columns, seed)
        return None if model is None else probability(model, folded.where(F.col("fold") == fold), columns)

    # The longest first.
    found = side_by_side([partial(scored, fold) for fold in range(folds, 0, -1)])
    parts = [part for part in reversed(found) if part is not None]
    if not parts:
        return folded.withColumn("score", F.lit(None).cast("double")).where("false")
    return reduce(DataFrame.unionByName, parts)
