from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskloom.operators.merge import first_per_key
from riskloom.plans import inputs
from riskloom.sources import files, snapshots, tables
from riskloom.sources.tables import feature_store, raw_table, score_table


def loaded(spark, folder, at):
    rows = inputs.transactions(spark, folder)
    for name in ("merchant_id", "merchant_country", "device_id", "ip_address"):
        rows = rows.withColumn(name, F.lit(None).cast("string"))
    return rows.withColumn("loaded_at", F.lit(at).cast("timestamp_ntz"))


def test_replay_updates_and_keeps_loaded_at(spark, folder, tmp_path):
    table = raw_table(spark, f"{tmp_path}/raw")
    first, second = datetime(2026, 1, 1), datetime(2026, 1, 2)
    assert table.merge(loaded(spark, folder, first), "a") == {
        "inserted": 1000, "updated": 0, "table_rows": 1000,
    }
    assert table.merge(loaded(spark, folder, second), "b") == {
        "inserted": 0, "updated": 1000, "table_rows": 1000,
    }
    assert [r[0] for r in table.read().select("loaded_at").distinct().collect()] == [first]
    assert files.children(spark, f"{table.path}/staging") == []


def score_rows(spark, *rows):
    return spark.createDataFrame(
        [(key, "U", when, score, False, "v1", datetime(2026, 1, 9)) for key, when, score in rows],
        "transaction_id string, user_id string, event_time timestamp_ntz, score double, "
        "flagged boolean, model_version string, scored_at timestamp_ntz",
    )


def test_a_row_can_move_to_another_day(spark, tmp_path):
    table = score_table(spark, f"{tmp_path}/scores")
    one, two = datetime(2026, 1, 1, 5), datetime(2026, 1, 2, 5)
    table.merge(score_rows(spark, ("a", one, 0.1), ("b", two, 0.2)), "r1")
    counts = table.merge(score_rows(spark, ("a", two, 0.9)), "r2")
    assert counts == {"inserted": 0, "updated": 1, "table_rows": 2}
    found = {r["transaction_id"]: (r["event_time"], r["score"]) for r in table.read().collect()}
    assert found == {"a": (two, 0.9), "b": (two, 0.2)}
    assert list(table.snapshot().data) == ["event_date=2026-01-02"]
    table.merge(score_rows(spark, ("a", one, 0.4), ("c", one, 0.5)), "r3")  # and back again
    assert {r["transaction_id"]: r["score"] for r in table.read().collect()} == {"a": 0.4, "b": 0.2, "c": 0.5}


def test_untouched_days_are_not_rewritten(spark, tmp_path):
    table = score_table(spark, f"{tmp_path}/scores")
    one, two = datetime(2026, 1, 1, 5), datetime(2026, 1, 2, 5)
    table.merge(score_rows(spark, ("a", one, 0.1), ("b", two, 0.2)), "r1")
    before = table.snapshot().data
    table.merge(score_rows(spark, ("b", two, 0.3), ("c", two, 0.4)), "r2")
    after = table.snapshot().data
    assert after["event_date=2026-01-01"] == before["event_date=2026-01-01"]
    assert after["event_date=2026-01-02"] != before["event_date=2026-01-02"]
    assert table.read().count() == 3


def test_a_run_that_dies_before_publishing_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table = score_table(spark, f"{tmp_path}/scores")
    one, two = datetime(2026, 1, 1, 5), datetime(2026, 1, 2, 5)
    table.merge(score_rows(spark, ("a", one, 0.1)), "r1")
    with monkeypatch.context() as patch:
        def fail(*args):
            raise RuntimeError("lost")

        patch.setattr(snapshots, "publish", fail)
        with pytest.raises(RuntimeError):
            table.merge(score_rows(spark, ("a", two, 0.5)), "r2")
    assert {r["transaction_id"]: r["score"] for r in table.read().collect()} == {"a": 0.1}
    assert table.merge(score_rows(spark, ("a", two, 0.5)), "r2")["updated"] == 1  # the retry
    counts = table.merge(score_rows(spark, ("b", two, 0.2)), "r3")
    assert counts == {"inserted": 1, "updated": 0, "table_rows": 2}
    assert {r["transaction_id"]: r["score"] for r in table.read().collect()} == {"a": 0.5, "b": 0.2}


def test_a_reader_finishes_on_its_version_and_unused_files_go_after_the_lease(spark, tmp_path):
    table = score_table(spark, f"{tmp_path}/scores")
    one = datetime(2026, 1, 1, 5)
    table.merge(score_rows(spark, ("a", one, 0.1)), "r1")
    reader = table.read()
    table.merge(score_rows(spark, ("a", one, 0.2)), "r2")
    files.write_text(spark, f"{table.path}/data/run=alive/part", "unfinished")
    snapshots.clean(spark, table.path)  # younger than the lease
    assert "run=alive" in files.children(spark, f"{table.path}/data")
    snapshots.clean(spark, table.path, lease=-1)
    assert "run=alive" not in files.children(spark, f"{table.path}/data")
    assert [r["score"] for r in reader.collect()] == [0.1]
    table.merge(score_rows(spark, ("a", one, 0.3)), "r3")
    snapshots.clean(spark, table.path, lease=-1)
    assert len(files.children(spark, f"{table.path}/data")) == 2  # of the two kept versions
    assert [r["score"] for r in table.read().collect()] == [0.3]


def test_the_second_of_two_writers_starts_again(spark, tmp_path, monkeypatch):
    table = score_table(spark, f"{tmp_path}/scores")
    one, two = datetime(2026, 1, 1, 5), datetime(2026, 1, 2, 5)
    table.merge(score_rows(spark, ("a", one, 0.1)), "r1")
    publish, calls = snapshots.publish, []

    def late(*args):
        calls.append(args)
        if len(calls) == 1:  # another writer is faster
            table.merge(score_rows(spark, ("a", two, 0.2), ("b", two, 0.3)), "other")
        publish(*args)

    monkeypatch.setattr(snapshots, "publish", late)
    counts = table.merge(score_rows(spark, ("b", one, 0.9), ("c", one, 0.4)), "own")
    assert counts == {"inserted": 1, "updated": 1, "table_rows": 3} and len(calls) == 3
    found = {r["transaction_id"]: (r["event_time"], r["score"]) for r in table.read().collect()}
    assert found == {"a": (two, 0.2), "b": (one, 0.9), "c": (one, 0.4)}


def test_the_directory_is_read_by_bucket_filtered_before_an_exchange_and_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "DIRECTORY_RUNS", 3)
    table = score_table(spark, f"{tmp_path}/scores")
    one, two = datetime(2026, 1, 1, 5), datetime(2026, 1, 2, 5)
    for number in range(6):
        day = two if number % 2 else one
        table.merge(score_rows(spark, ("moves", day, number / 10), (f"k{number}", one, 0.5)), f"r{number}")
    snapshot = table.snapshot()
    assert len(snapshot.keys) <= 3 and snapshot.rows == table.read().count() == 7
    keys = spark.createDataFrame([("moves",), ("none",)], "transaction_id string")
    buckets = [r[0] for r in keys.selectExpr("CAST(pmod(xxhash64(transaction_id), 32) AS INT)").collect()]
    found = table.located(snapshot, keys, buckets, 2)
    assert [tuple(r) for r in found.collect()] == [("moves", "event_date=2026-01-02")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    exchange = plan.index("Exchange hashpartitioning(transaction_id")
    assert exchange < plan.index("BroadcastHashJoin")  # printed from the top: the join lies below the exchange


def test_source_with_repeated_or_missing_keys_is_refused(spark, tmp_path):
    table = score_table(spark, f"{tmp_path}/scores")
    when = datetime(2026, 1, 1)
    with pytest.raises(ValueError, match="repeats"):
        table.merge(score_rows(spark, ("a", when, 0.1), ("a", when, 0.2)), "r1")
    with pytest.raises(ValueError, match="without"):
        table.merge(score_rows(spark, (None, when, 0.1)), "r2")
    assert table.read().count() == 0


def test_first_per_key(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("b", 5, None)], "k string, o int, v string")
    assert sorted(map(tuple, first_per_key(rows, "k", ["o"]).collect())) == [("a", 1, "z"), ("b", 5, None)]


def test_feature_store_is_keyed_by_user(spark, tmp_path):
    table = feature_store(spark, f"{tmp_path}/store")
    schema = (
        "user_id string, last_24h_total decimal(12,2), last_24h_txn_count int, "
        "last_24h_avg_amount decimal(12,2), updated_at timestamp_ntz"
    )
    from decimal import Decimal as D

    rows = [(f"U{i}", D("1.00"), 1, D("1.00"), datetime(2026, 1, 1)) for i in range(20)]
    assert table.merge(spark.createDataFrame(rows, schema), "a")["inserted"] == 20
    later = [(u, D("3.00"), 2, D("1.50"), datetime(2026, 1, 2)) for u, *_ in rows[:5]]
    assert table.merge(spark.createDataFrame(later, schema), "b")["updated"] == 5
    assert table.read().where("last_24h_txn_count = 2").count() == 5
