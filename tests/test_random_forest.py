"""The same rows and seed give the same random forest, however the rows are dealt."""

import numpy as np

from riskloom.operators import supervised


def test_partitions_follow_from_the_rows_alone():
    found = [supervised.forest_partitions(rows) for rows in (0, 400_000, 400_001, 10**9)]
    assert found == [8, 8, 9, 20_000]


def test_random_forest_does_not_depend_on_partitions_or_order(spark):
    x = np.random.default_rng(1).normal(size=(400, 2))
    data = [(f"t{i}", float(a), float(b), int(a + b > 1)) for i, (a, b) in enumerate(x)]
    rows = spark.createDataFrame(data, "transaction_id string, x double, y double, label int")
    found = []
    for dealt in (rows.coalesce(1), rows.repartition(7), rows.orderBy("y")):
        model = supervised.fit(supervised.RANDOM_FOREST, dealt, ["x", "y"], trees=5, depth=4)
        scored = supervised.probability(model, rows, ["x", "y"])
        found.append({r.transaction_id: r.score for r in scored.collect()})
    assert found[0] == found[1] == found[2]
