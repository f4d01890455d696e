import random
from bisect import insort
from datetime import datetime, timedelta
from decimal import Decimal
from statistics import median

import numpy as np
import pytest

from riskloom.operators.features import compute, latest_per_user, trailing_counts, trailing_windows
from riskloom.operators.merge import table_diff
from riskloom.operators.prefix_median import medians_in_slice, prefix_medians, streamed
from riskloom.plans import inputs
from riskloom.schema import FEATURES

SCHEMA = "transaction_id string, user_id string, event_time timestamp_ntz, amount double"
NOON = datetime(2026, 1, 1, 12)


def day(number, **extra):
    return NOON + timedelta(days=number - 1, **extra)


def rows_of(*cells, user="U1"):
    return [(f"{user}-{i}", user, when, float(amount)) for i, (when, amount) in enumerate(cells)]


def run(spark, rows, **options):
    found = compute(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return {row["transaction_id"]: row for row in found}


def values(row):
    return [round(row[name], 9) for name in FEATURES]


HISTORY = [100, 110, 90, 105, 95, 100, 100, 99999]


def test_prefixes_give_the_same_features(spark):
    rows = rows_of(*[(day(i + 1), amount) for i, amount in enumerate(HISTORY)])
    whole = run(spark, rows)
    for length in (1, 4, 7):
        for key, row in run(spark, rows[:length]).items():
            assert values(row) == values(whole[key])


def test_a_later_row_changes_nothing_before_it(spark):
    rows = rows_of(*[(day(i + 1), amount) for i, amount in enumerate(HISTORY)])
    before = run(spark, rows)
    after = run(spark, [*rows, ("U1-later", "U1", day(9), 50000.0)])
    assert all(values(after[key]) == values(row) for key, row in before.items())


def test_amount_baseline_leaves_out_the_row_itself(spark):
    found = run(spark, rows_of((day(1), 100), (day(2), 200), (day(3), 10000)))
    assert found["U1-2"]["amount_vs_user_median"] == pytest.approx(10000 / 150)


def test_count_baseline_leaves_out_the_row_itself(spark):
    found = run(spark, rows_of(*[(day(i), 100) for i in range(1, 5)]))
    assert found["U1-3"]["count_vs_user_typical"] == pytest.approx(2 / (5 / 3))


def test_a_change_moves_only_later_rows(spark):
    amounts = [100, 110, 90, 105, 95, 100]
    plain = run(spark, rows_of(*[(day(i + 1), a) for i, a in enumerate(amounts)]))
    amounts[4] = 250000
    bumped = run(spark, rows_of(*[(day(i + 1), a) for i, a in enumerate(amounts)]))
    assert all(values(plain[f"U1-{i}"]) == values(bumped[f"U1-{i}"]) for i in range(4))
    assert plain["U1-5"]["amount_vs_user_median"] != bumped["U1-5"]["amount_vs_user_median"]


def test_first_row_is_neutral(spark):
    row = run(spark, rows_of((day(1), 5000)))["U1-0"]
    assert [row[name] for name in FEATURES] == [5000, 1, 5000, -1, 1, 1, 1]


def test_users_do_not_mix(spark):
    one = rows_of((day(1), 100), (day(2), 100))
    other = rows_of((day(1, hours=1), 50000), (day(2, hours=1), 50000), user="U2")
    alone, together = run(spark, one), run(spark, one + other)
    assert all(values(together[key]) == values(row) for key, row in alone.items())


def test_window_includes_exactly_24_hours(spark):
    found = run(spark, rows_of((day(1), 100), (day(2), 100), (day(4), 100)))
    assert [found[f"U1-{i}"]["txn_count_24h"] for i in range(3)] == [1, 2, 1]


def test_half_open_window_excludes_exactly_24_hours(spark):
    rows = spark.createDataFrame(rows_of((day(1), 1), (day(2), 1), (day(2, seconds=-1), 1)), SCHEMA)
    for options in ({}, {"hot_rows": 0}):
        counts = {r["transaction_id"]: r["txn_count_24h"] for r in trailing_counts(rows, **options).collect()}
        assert counts == {"U1-0": 1, "U1-2": 2, "U1-1": 2}


@pytest.mark.parametrize("options", [{}, {"hot_rows": 0, "slice_rows": 1}])
def test_rows_of_one_instant_see_only_rows_before_them(spark, options):
    cells = [(day(1), 100), (day(2), 200), (day(2), 300), (day(2, seconds=1), 10)]
    found = run(spark, rows_of(*cells), **options)
    assert [found[f"U1-{i}"]["total_amount_24h"] for i in range(4)] == [100, 300, 600, 510]
    assert [found[f"U1-{i}"]["txn_count_24h"] for i in range(4)] == [1, 2, 3, 3]


def test_missing_column_is_refused(spark):
    with pytest.raises(ValueError, match="amount"):
        compute(spark.createDataFrame(rows_of((day(1), 1)), SCHEMA).drop("amount"))


def test_empty_input_keeps_the_columns(spark):
    found = compute(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["transaction_id", "user_id", "event_time", *FEATURES]
    assert found.count() == 0


def test_missing_values(spark):
    rows = [("a", "U", day(1), None), ("b", "U", None, 5.0), ("c", None, day(1), 7.0), ("d", None, day(2), 9.0)]
    for options in ({}, {"hot_rows": 0}):
        found = run(spark, rows, **options)
        assert set(found) == {"a", "c", "d"}
        assert found["a"]["total_amount_24h"] == 0
        assert found["d"]["total_amount_24h"] == 16


def plain_loop(rows):
    """The definition, one row at a time."""
    result, users = {}, {}
    for key, user, when, amount in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        seen = users.setdefault(user, [])
        inside = [a for t, a, *_ in seen if t >= when - timedelta(hours=24)] + [Decimal(str(amount))]
        count, total = len(inside), float(sum(inside))
        gap = (when - seen[-1][0]).total_seconds() / 3600 if seen else None
        amounts = [float(a) for _, a, *_ in seen]
        counts = [c for _, _, c, _ in seen]
        gaps = [g for *_, g in seen if g is not None]

        def ratio(value, base):
            return value / base if base and base > 0 else 1.0

        result[key] = [
            total,
            count,
            total / count,
            -1.0 if gap is None else gap,
            ratio(amount, median(amounts) if amounts else None),
            ratio(count, sum(counts) / len(counts) if counts else None),
            1.0 if gap is None else ratio(gap, median(gaps) if gaps else None),
        ]
        seen.append((when, Decimal(str(amount)), count, gap))
    return result


def random_rows(seed, count=400):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        # A third of the rows belong to one user; times are coarse, so many tie.
        user = "busy" if rng.random() < 0.35 else f"U{rng.randrange(6)}"
        when = NOON + timedelta(hours=6 * rng.randrange(0, 60))
        rows.append((f"t{i:04d}", user, when, round(rng.choice([5.0, 5.0, rng.lognormvariate(4, 1)]), 2)))
    return rows


@pytest.mark.parametrize(
    "options", [{}, {"hot_rows": 100, "slice_rows": 16}, {"hot_rows": 0, "slice_rows": 3}]
)
def test_random_rows_with_ties_match_the_definition(spark, options):
    rows = random_rows(7)
    found, expected = run(spark, rows, **options), plain_loop(rows)
    assert set(found) == set(expected)
    for key, wanted in expected.items():
        assert [found[key][name] for name in FEATURES] == pytest.approx(wanted, abs=1e-9)


def test_hot_path_equals_light_path_on_a_skewed_table(spark, folder):
    rows = inputs.skewed_transactions(spark, folder)
    light = compute(rows)
    hot = compute(rows, hot_rows=100, slice_rows=40)
    for row in table_diff(light, hot, "transaction_id", FEATURES, 1e-9).collect():
        assert row["matches"], row


def test_carried_columns_and_latest_row_per_user(spark, folder):
    rows = compute(inputs.transactions(spark, folder), carry=["label", "amount"])
    assert rows.columns[-2:] == ["label", "amount"]
    latest = latest_per_user(rows)
    assert latest.count() == rows.select("user_id").distinct().count()


def test_features_use_one_exchange(spark, folder):
    plan = compute(inputs.transactions(spark, folder))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1


def test_windows_alone_equal_the_features_and_stay_on_the_jvm(spark, folder):
    rows = inputs.skewed_transactions(spark, folder)
    whole = compute(rows).select("transaction_id", *FEATURES[:3])
    for options in ({}, {"hot_rows": 100}):
        alone = trailing_windows(rows, **options)
        assert "MapInArrow" not in alone._jdf.queryExecution().executedPlan().toString()
        for row in table_diff(whole, alone, "transaction_id", FEATURES[:3], 1e-9).collect():
            assert row["matches"], row


@pytest.mark.parametrize("seed", range(5))
def test_prefix_medians_match_sorted_lists(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 40, 300).astype(float)
    values[rng.random(300) < 0.2] = np.nan
    starts = np.maximum.accumulate(np.where(rng.random(300) < 0.05, np.arange(300), 0))
    found = prefix_medians(values, starts)
    for row, start in enumerate(starts):
        earlier = [value for value in values[start:row] if not np.isnan(value)]
        assert (np.isnan(found[row]) and not earlier) or found[row] == median(earlier)


def test_medians_go_on_over_batches(spark):
    rows = [(f"U{i // 37}", i, float(i * 7919 % 101) if i % 5 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "u string, i int, v double").coalesce(1).sortWithinPartitions("u", "i")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    kept = spark.conf.get(name)
    spark.conf.set(name, 6)
    try:
        found = {row["i"]: row["m"] for row in streamed(df, "u", {"v": "m"}).collect()}
    finally:
        spark.conf.set(name, kept)
    for user, i, _ in rows:
        earlier = [v for u, j, v in rows if u == user and j < i and v is not None]
        assert found[i] == (median(earlier) if earlier else None)


@pytest.mark.parametrize("seed", range(5))
def test_medians_in_slice_match_sorted_lists(seed):
    rng = np.random.default_rng(seed)
    past = np.sort(rng.integers(0, 30, rng.integers(0, 200)).astype(float))
    own = rng.integers(0, 60, 25).astype(float)
    own[rng.random(25) < 0.2] = np.nan
    low = max(0, (len(past) - 1) // 2 - 13)
    high = len(past) // 2 + 14
    found = medians_in_slice(past[low : high + 1], low if len(past) else 0, len(past), own)
    seen = past.tolist()
    for value, result in zip(own, found):
        assert (np.isnan(result) and not seen) or result == median(seen)
        if not np.isnan(value):
            insort(seen, value)
