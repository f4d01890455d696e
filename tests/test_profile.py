from datetime import datetime

from riskloom.plans.profile import dataset

SCHEMA = "user_id string, event_time timestamp_ntz, label int"


def test_rows_without_time_user_or_label(spark):
    at = [datetime(2026, 1, 1, 5), datetime(2026, 1, 1, 6), datetime(2026, 1, 2)]
    rows = [("u", at[0], 1), ("u", at[0], None), ("v", at[1], 0), (None, None, 0), ("v", at[2], 0)]
    found = dataset(spark.createDataFrame(rows, SCHEMA)).first().asDict()
    assert found == {
        "rows": 5,
        "users": 2,
        "first_event": at[0],
        "last_event": at[2],
        "distinct_times": 3,
        "distinct_time_share": 0.6,
        "distinct_days": 2,
        "fraud_rows": 1,
        "fraud_rate": 0.25,
    }


def test_empty_table(spark):
    found = dataset(spark.createDataFrame([], SCHEMA)).first()
    assert (found["rows"], found["users"], found["distinct_times"]) == (0, 0, 0)
    assert found["fraud_rate"] is None


def test_no_row_is_copied(spark):
    df = spark.createDataFrame([("u", datetime(2026, 1, 1), 0)], SCHEMA)
    assert "Expand" not in dataset(df)._jdf.queryExecution().executedPlan().toString()
