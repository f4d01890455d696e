"""Trees of the random forest against plain recursion, large nodes, equal rows, rows that no tree drew."""

import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import random_forest, supervised


def plainly(x, ones, weight, key, levels, weights, found):
    """Leaf shares of rows, by trying every split of every drawn feature."""
    key = np.array([key], np.uint64)

    def split(rows, key, level):
        c = [int(weight[rows][ones[rows] == side].sum()) for side in (0, 1)]
        constant = np.array([len(set(line[rows])) < 2 for line in x])
        if level == levels or not all(c) or constant.all():
            found[rows] = weights[1] * c[1] / (weights[1] * c[1] + weights[0] * c[0])
            return
        options = []
        for turn, f in enumerate(random_forest.drawn(key, constant[None])[0]):
            for cut in sorted(set(x[f][rows]))[:-1] if f >= 0 else []:
                sides = [rows[x[f][rows] <= cut], rows[x[f][rows] > cut]]
                cost = 0
                for part in sides:
                    l0, l1 = (weights[s] * weight[part][ones[part] == s].sum() for s in (0, 1))
                    cost += l0 * l1 / (l0 + l1)
                options.append((cost, turn, cut, sides))
        sides = min(options, key=lambda option: option[:3])[3]
        for part, child in zip(sides, random_forest._children(key)):
            split(part, np.array([child]), level + 1)

    split(np.arange(len(ones)), key, 0)
    return found


@pytest.mark.parametrize("levels", [0, 3, 30])
def test_a_tree_equals_plain_recursion(levels):
    random = np.random.default_rng(levels)
    x = random.integers(0, 6, (5, 300)).astype(np.uint8)
    x[4] = 3
    ones = (x[0] + random.integers(0, 6, 300) > 6).astype(int)
    weight = random.integers(1, 4, 300)
    weights = [0.75, 1.5]
    tree = random_forest.grow(x, (16 * ones + weight).astype(np.uint8), 99, levels, weights)
    found = tree[3][random_forest.leaves(tree, x, np.zeros(300, np.int64))]
    assert found.tolist() == plainly(x, ones, weight, 99, levels, weights, np.zeros(300)).tolist()


def frame(spark, n, seed=2):
    random = np.random.default_rng(seed)
    x = random.normal(size=(n, 3)).round(2)
    label = (x[:, 0] + random.normal(size=n) > 1).astype(int)
    rows = [(f"t{i}", *map(float, x[i]), int(label[i])) for i in range(n)]
    return spark.createDataFrame(rows, "transaction_id string, x double, y double, z double, label int")


def scores(model, rows):
    found = supervised.probability(model, rows, ["x", "y", "z"]).collect()
    assert len(found) == rows.count()
    return {row.transaction_id: row.score for row in found}


def test_large_nodes_are_split_as_small_ones(spark, monkeypatch):
    rows = frame(spark, 600)
    wanted = scores(supervised.fit(supervised.RANDOM_FOREST, rows, ["x", "y", "z"], trees=6, depth=8), rows)
    assert np.mean([(wanted[r.transaction_id] > 0.5) == r.label for r in rows.collect()]) > 0.85
    monkeypatch.setattr(random_forest, "LOCAL", 40)
    monkeypatch.setattr(random_forest, "OPEN_NODES", 5)
    model = supervised.fit(supervised.RANDOM_FOREST, rows, ["x", "y", "z"], trees=6, depth=8)
    assert len(model.below) > 60 and scores(model, rows) == wanted


def test_equal_rows_are_drawn_apart_and_few_rows_are_enough(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 0.0, int(i % 2)) for i in range(400)], "x double, y double, z double, label int")
    model = supervised.fit(supervised.RANDOM_FOREST, rows, ["x", "y", "z"], trees=3, depth=4)
    shares = [np.frombuffer(row.share)[0] for row in model.subtrees.collect()]
    assert all(0.4 < share < 0.6 for share in shares) and len(set(shares)) > 1
    rows = spark.createDataFrame([("a", 0.0, 1.0, 2.0, 0), ("b", 1.0, None, float("nan"), 1)], frame(spark, 1).schema)
    model = supervised.fit(supervised.RANDOM_FOREST, rows, ["x", "y", "z"], trees=20, depth=4)
    found = scores(model, rows)
    assert model.subtrees.count() < 20 and found["a"] < 0.5 < found["b"]


def test_deep_trees_on_noise_end_in_time(spark):
    names = [f"f{i}" for i in range(7)]
    rows = spark.range(100_000).select(
        F.col("id").cast("string").alias("transaction_id"),
        (F.rand(1) < 0.2).cast("int").alias("label"),
        *[F.rand(i + 2).alias(name) for i, name in enumerate(names)],
    )
    rows = rows.localCheckpoint()
    began = time.monotonic()
    model = supervised.fit(supervised.RANDOM_FOREST, rows, names)
    assert supervised.probability(model, rows, names).count() == 100_000
    assert time.monotonic() - began < 60


def test_a_tree_of_many_rows_is_grown_without_a_pass_a_level(spark, monkeypatch):
    monkeypatch.setattr(random_forest, "_split_top", lambda *_: pytest.fail("a pass over all rows"))
    rows = spark.range(600_000).select(
        F.col("id").cast("string").alias("transaction_id"),
        (F.rand(1) < 0.2).cast("int").alias("label"),
        *[F.rand(i + 2).alias(name) for i, name in enumerate("xyz")],
    )
    model = supervised.fit(supervised.RANDOM_FOREST, rows.localCheckpoint(), ["x", "y", "z"], trees=2, depth=4)
    assert model.subtrees.count() == 2


@pytest.mark.parametrize("width, values", [(1, 32), (7, 32), (8, 3), (17, 32)])
def test_large_nodes_and_blocks_equal_plain_recursion(monkeypatch, width, values):
    for name, size in (("BLOCK", 64), ("ALONE", 16), ("NODES", 3), ("COMPARED", 2)):
        monkeypatch.setattr(random_forest.growth, name, size)
    random = np.random.default_rng(width)
    x = random.integers(0, values, (width, 400)).astype(np.uint8)
    ones = (x[0] + random.integers(0, values, 400) > values).astype(int)
    weight = random.integers(1, 16, 400)
    seen, weights = (16 * ones + weight).astype(np.uint8), [0.75, 1.5]
    tree = random_forest.grow(x, seen, 7, 12, weights)
    at = random_forest.leaves(tree, x, np.zeros(400, np.int64))
    assert tree[3][at].tolist() == plainly(x, ones, weight, 7, 12, weights, np.zeros(400)).tolist()
    rows = random_forest.seen_in(random_forest.pack(x), seen)
    assert random_forest.growth.reached(random_forest.growth.steps(tree), rows).tolist() == at.tolist()


def test_slices_of_scored_rows_and_odd_bundles_add_up_exactly(spark, monkeypatch):
    rows = frame(spark, 500)
    model = supervised.fit(supervised.RANDOM_FOREST, rows, ["x", "y", "z"], trees=7, depth=8)
    wanted = scores(model, rows)
    sums = np.array(list(wanted.values())) * 7 * random_forest.UNIT
    assert (np.abs(sums - np.rint(sums)) < 1).all()
    monkeypatch.setattr(random_forest, "LOCAL", 200)
    monkeypatch.setattr(random_forest, "BUNDLE", 3)
    assert scores(model, rows) == wanted
    assert scores(model, rows.where("transaction_id < 't2'").repartition(5)).items() <= wanted.items()


@pytest.mark.parametrize("n", [1, 31, 40, 3000])
def test_cuts_ranked_in_a_task_equal_those_of_the_distributed_way(spark, monkeypatch, n):
    random = np.random.default_rng(n)
    data = zip(*[random.integers(0, top, n).astype(float).tolist() for top in (1, 3, 50, 10**6)], strict=True)
    rows = spark.createDataFrame([(a, b, c - 25, d if i % 3 else 7.5) for i, (a, b, c, d) in enumerate(data)], "a double, b double, c double, d double")
    found = random_forest._cuts(rows, n, ["a", "b", "c", "d"])
    monkeypatch.setattr(random_forest, "LOCAL", 0)
    assert [cut.tolist() for cut in found] == [cut.tolist() for cut in random_forest._cuts(rows, n, ["a", "b", "c", "d"])]


def test_fits_run_side_by_side_and_keep_their_order(spark):
    meet = threading.Barrier(supervised.FITS, timeout=60)

    def call(number):
        meet.wait()
        return spark.range(number).count()

    assert supervised.side_by_side([lambda n=n: call(n) for n in range(2 * supervised.FITS)]) == list(range(2 * supervised.FITS))
    with pytest.raises(ZeroDivisionError):
        supervised.side_by_side([lambda: 1 // 0])


def test_folds_are_scored_as_by_single_fits(spark):
    rows = frame(spark, 300).withColumn("fold", F.expr("substring(transaction_id, 2) % 3").cast("int"))
    found = supervised.walk_forward(supervised.LOGISTIC, rows, ["x", "y", "z"], folds=3).collect()
    assert {row.fold for row in found} == {1, 2} and len(found) == 200
    model = supervised.fit(supervised.LOGISTIC, rows.where("fold < 2"), ["x", "y", "z"])
    wanted = {r.transaction_id: r.score for r in supervised.probability(model, rows.where("fold = 2"), ["x", "y", "z"]).collect()}
    assert {r.transaction_id: pytest.approx(r.score, abs=1e-9) for r in found if r.fold == 2} == wanted
