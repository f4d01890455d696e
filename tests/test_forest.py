from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import forest
from riskloom.operators.metrics import min_max_scaled
from riskloom.plans.scoring import BEST_F1, FALLBACK, choose_threshold, scored_rows
from riskloom.schema import SCORE_COLUMNS

COLUMNS = ["x", "y"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    inside = [(f"t{i}", "U", float(a), float(b), 0) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))]
    outside = [(f"o{i}", "U", 40.0 + i, -40.0 - i, 1) for i in range(6)]
    schema = "transaction_id string, user_id string, x double, y double, label int"
    rows = spark.createDataFrame(inside + outside, schema)
    return rows.withColumn("event_time", F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz")).cache()


@pytest.fixture(scope="module")
def raw(points):
    return forest.with_raw_score(points, forest.fit(points, COLUMNS)).cache()


def test_planted_outliers_rank_highest(raw):
    top = raw.orderBy(F.col("raw_score").desc()).limit(6).collect()
    assert all(row["label"] == 1 for row in top)


def test_offset_puts_the_contamination_share_above_zero(raw):
    share = raw.where("raw_score > 0").count() / raw.count()
    assert abs(share - forest.CONTAMINATION) < 0.005


def test_same_seed_same_scores_whatever_the_partitions(points, raw):
    again = forest.with_raw_score(points, forest.fit(points.repartition(5), COLUMNS))
    one = {r["transaction_id"]: r["raw_score"] for r in raw.collect()}
    two = {r["transaction_id"]: r["raw_score"] for r in again.collect()}
    assert one == two
    other = forest.with_raw_score(points, forest.fit(points, COLUMNS, seed=7))
    assert {r["transaction_id"]: r["raw_score"] for r in other.collect()} != one


def test_trees_are_complete_and_bounded(points):
    model = forest.fit(points, COLUMNS)
    nodes = model.nodes.toPandas()
    assert nodes["tree"].nunique() == forest.TREES
    assert nodes.groupby("tree").size().max() <= 2 * forest.SAMPLE - 1
    drawn = forest.draw_samples(points, COLUMNS, 606, 42, forest.TREES, forest.SAMPLE)
    assert {r["count"] for r in drawn.groupBy("tree").count().collect()} == {forest.SAMPLE}


def test_path_lengths_of_a_hand_made_tree():
    # x <= 1 is a leaf of one point at depth 1, else y <= 5 splits leaves of 1 and 4 points.
    four = forest.average_path(4)
    feature = np.array([[0, 0, 1, 0, 0]])
    split = np.array([[1.0, np.inf, 5.0, np.inf, np.inf]])
    left, right = np.array([[1, 1, 3, 3, 4]]), np.array([[2, 1, 4, 3, 4]])
    path = np.array([[0.0, 1.0, 0.0, 2.0, 2.0 + four]])
    rows = np.array([[0.0, 9.0], [2.0, 5.0], [2.0, 6.0]])
    found = forest.mean_paths(rows, (feature, split, left, right, path), 8)
    assert found.tolist() == [1.0, 2.0, 2.0 + four]
    assert forest.average_path(2) == 1 and forest.average_path(1) == 0


def test_grown_tree_isolates_every_distinct_point():
    nodes = forest.grow(np.arange(8.0).reshape(8, 1), 10, np.random.default_rng(0))
    leaves = [node for node in nodes if node[1] == -1]
    assert len(leaves) == 8 and len(nodes) == 15


def test_threshold_rule_and_fallback(raw):
    assert choose_threshold(raw).rule == BEST_F1
    none = choose_threshold(raw.withColumn("label", F.lit(0)))
    assert none.rule == FALLBACK
    assert choose_threshold(raw, labelled=False).value == none.value


def test_training_rows_are_scored_as_any_other_rows(points):
    model, scored = forest.fit_and_score(points, COLUMNS)
    again = forest.with_raw_score(points, model).select("transaction_id", F.col("raw_score").alias("b"))
    gaps = scored.join(again, "transaction_id").where("abs(raw_score - b) > 1e-12")
    assert scored.count() == points.count() and gaps.count() == 0


def test_scored_contract(raw):
    threshold = choose_threshold(raw).value
    rows = scored_rows(raw, threshold, "v1", datetime(2026, 1, 2))
    assert rows.columns == [*SCORE_COLUMNS, "raw_score"]
    facts = rows.agg(
        F.min("score").alias("low"),
        F.max("score").alias("high"),
        F.count_distinct("transaction_id").alias("ids"),
        F.count_if(F.col("flagged") != (F.col("raw_score") >= threshold)).alias("wrong"),
    ).first()
    assert (facts["low"], facts["high"], facts["ids"], facts["wrong"]) == (0.0, 1.0, 606, 0)


def test_equal_scores_scale_to_zero(spark):
    rows = spark.createDataFrame([(0.3,), (0.3,)], "raw double")
    assert [r["s"] for r in min_max_scaled(rows, "raw", "s").collect()] == [0.0, 0.0]
