import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import metrics, ordered
from riskloom.operators.ordered import SLICE, positions, quantiles, running, sliced
from riskloom.plans import inputs


def ranking(spark, labels, scores, model="m"):
    rows = [(model, f"t{i}", int(y), float(s)) for i, (y, s) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(rows, "model string, transaction_id string, label int, score double")


def test_threshold_needs_a_positive(spark):
    quiet = ranking(spark, [0, 0, 0], [0.7, 0.2, 0.2], "quiet")
    busy = ranking(spark, [0, 1, 0], [0.7, 0.2, 0.2], "busy")
    found = metrics.best_f1(metrics.curve(quiet.union(busy))).collect()
    assert [row["model"] for row in found] == ["busy"]


def test_best_threshold_of_a_ranking_by_hand(spark):
    """Cuts after 1, 2, 4 and 5 rows catch 1, 1, 3 and 3 of 3: F1 1/2, 2/5, 6/7 and 3/4."""
    rows = ranking(spark, [1, 0, 1, 1, 0], [9.0, 8.0, 5.0, 5.0, -1.0])
    best = metrics.best_f1(metrics.curve(rows)).first()
    assert (best["threshold"], best["recall"], best["precision"]) == (5.0, 1.0, 0.75)
    assert best["f1"] == pytest.approx(6 / 7)
    applied = metrics.metrics_at(rows, metrics.best_f1(metrics.curve(rows))).first()
    assert (applied["flagged"], applied["recall"], applied["precision"]) == (4, 1.0, 0.75)


def test_alert_rates_of_two_models_at_once(spark):
    steps = [float(i) for i in range(201)]
    rows = ranking(spark, [0] * 201, steps, "up").union(ranking(spark, [0] * 201, [-s for s in steps], "down"))
    found = metrics.alert_rate_thresholds(rows, {"tenth": 0.1, "odd": 0.0125})
    cuts = {row["model"]: (row["tenth"], row["odd"]) for row in found.collect()}
    assert cuts["up"] == pytest.approx((180.0, 197.5)) and cuts["down"] == pytest.approx((-20.0, -2.5))


def test_zero_denominators_give_zero(spark):
    rows = ranking(spark, [0, 0, 0], [0.1, 0.2, 0.3])
    thresholds = spark.createDataFrame([("m", 0.9)], "model string, threshold double")
    point = metrics.metrics_at(rows, thresholds).first()
    assert (point["precision"], point["recall"], point["f1"], point["flagged"]) == (0, 0, 0, 0)


def test_equal_scores_are_one_step(spark):
    rows = ranking(spark, [1, 0, 1, 0], [0.5] * 4)
    found = metrics.areas(metrics.curve(rows)).first()
    assert found["pr_auc"] == 0.5 and found["roc_auc"] == 0.5


def test_ties_go_to_the_lowest_threshold(spark):
    # F1 is 2/3 at 0.9 (P 1, R 1/2) and at 0.3 (P 1/2, R 1).
    rows = ranking(spark, [1, 0, 0, 1, 0], [0.9, 0.6, 0.5, 0.3, 0.1])
    assert metrics.best_f1(metrics.curve(rows)).first()["threshold"] == 0.3


def test_folds_follow_blocks_from_the_end(spark):
    rows = spark.range(20).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("event_time"),
    )
    folds = {int(r["transaction_id"]): r["fold"] for r in metrics.with_folds(rows).collect()}
    assert [folds[i] for i in range(20)] == [0] * 5 + [f for f in range(1, 6) for _ in range(3)]


def test_split_cutoff_is_the_day_at_70_percent(spark):
    rows = spark.range(10).select(
        F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("event_time")
    )
    assert str(metrics.split_cutoff(rows).first()["cutoff"]) == "1970-01-08"


def test_sliced_totals_equal_a_plain_window(spark, folder):
    rows = inputs.skewed_transactions(spark, folder).select("user_id", "event_time", "amount")
    order = ["event_time", "amount"]
    cut = sliced(rows, ["user_id", *order], slices=7)
    assert cut.select(SLICE).distinct().count() > 1
    found = running(cut, ["user_id"], order, {"total": "amount"}, {"before": "event_time"})
    window = Window.partitionBy("user_id").orderBy(*order)
    expected = rows.withColumns(
        {
            "total": F.sum("amount").over(window.rowsBetween(Window.unboundedPreceding, 0)),
            "before": F.max("event_time").over(window.rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    columns = ["user_id", *order, "total", "before"]
    assert sorted(map(str, found.select(*columns).collect())) == sorted(
        map(str, expected.select(*columns).collect())
    )


def test_positions_are_a_permutation_in_order(spark, folder):
    rows = positions(inputs.order_transactions(spark, folder), ["event_time", "transaction_id"])
    found = rows.orderBy("position").select("position", "event_time", "transaction_id").collect()
    assert [row["position"] for row in found] == list(range(1, len(found) + 1))
    keys = [(row["event_time"], row["transaction_id"]) for row in found]
    assert keys == sorted(keys)


def test_quantiles_match_numpy(spark):
    values = np.random.default_rng(3).lognormal(size=501).round(1)
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    wanted = {"low": 0.0, "q": 0.123, "half": 0.5, "high": 1.0}
    found = quantiles(rows, "v", wanted).first()
    for name, p in wanted.items():
        assert found[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


WANTED = {"low": 0.0, "q": 0.123, "half": 0.5, "most": 0.999, "high": 1.0}


@pytest.mark.parametrize("rounds, bins", [(2, 1 << 14), (1, 4), (0, 4)])
def test_selected_quantiles_of_groups(spark, monkeypatch, rounds, bins):
    """Ties, one value that most rows have, both signs, a range of 600 decades, a null group."""
    monkeypatch.setattr(ordered, "ROUNDS", rounds)
    monkeypatch.setattr(ordered, "BINS", bins)
    rng = np.random.default_rng(8)
    groups = {
        "ties": rng.integers(-3, 4, 400) / 4,
        "one": np.where(rng.random(500) < 0.9, 7.5, rng.normal(size=500)),
        "wide": 10.0 ** rng.uniform(-300, 300, 300) * rng.choice([-1, 1], 300),
        "single": np.array([3.25]),
        None: rng.normal(size=50),
    }
    rows = [(name, float(v)) for name, values in groups.items() for v in values] + [("ties", None)]
    frame = spark.createDataFrame(rows, "g string, v double")
    expected = {name: [float(np.quantile(v, p)) for p in WANTED.values()] for name, v in groups.items()}
    counted = frame.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    for found in (quantiles(frame, "v", WANTED, ["g"]), quantiles(counted, "v", WANTED, ["g"], "n", steady=True)):
        got = {row["g"]: [row[name] for name in WANTED] for row in found.collect()}
        assert got.keys() == expected.keys()
        for name in expected:
            assert got[name] == pytest.approx(expected[name], rel=1e-12), name


def test_selected_quantiles_of_odd_values(spark):
    values = [float("-inf"), -1.0, 0.0, -0.0, 2.0, float("inf"), float("nan")]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    found = quantiles(frame, "v", {"second": 1 / 6, "middle": 0.5}).first()
    assert (found["second"], found["middle"]) == (-1.0, 0.0)
    nothing = quantiles(frame.where("v > 5 AND v < 6"), "v", {"half": 0.5}).collect()
    assert [row["half"] for row in nothing] == [None]


def test_selection_never_orders_all_rows(spark, folder, capsys):
    rows = spark.read.parquet(f"{folder}/lineitem.parquet")
    found = quantiles(rows, "l_extendedprice", WANTED, ["l_returnflag"], steady=True)
    found.explain()
    assert "rangepartitioning" not in capsys.readouterr().out
