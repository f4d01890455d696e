import pytest

from riskloom.operators.normalise import loadable, missing_columns, normalise
from riskloom.operators.validate import RULES, annotate, invalid_rows, rule_counts, valid_rows
from riskloom.plans import inputs
from riskloom.schema import TRANSACTION_COLUMNS

GOOD = {
    "transaction_id": "k-sample",
    "user_id": "holder-7",
    "event_time": "2025-03-17 18:42:09",
    "amount": "31.05",
    "merchant_id": "Corner Bakery",
    "merchant_country": "PT",
    "txn_type": "refund",
    "device_id": "kiosk",
    "ip_address": "172.20.4.63",
    "label": "1",
}


def landing(spark, *overrides, columns=tuple(TRANSACTION_COLUMNS)):
    cells = [
        {**GOOD, "transaction_id": f"t-{number}", **override}
        for number, override in enumerate(overrides)
    ]
    schema = ", ".join(f"`{name}` string" for name in columns) + ", source_file string, row_pos long"
    rows = [[*[row[name.strip().lower()] for name in columns], "f", i] for i, row in enumerate(cells)]
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    "override, reason",
    [
        ({"event_time": "next tuesday"}, "invalid_event_time"),
        ({"event_time": ""}, "invalid_event_time"),
        ({"event_time": "18:42"}, "invalid_event_time"),
        ({"amount": "31 euro"}, "invalid_amount"),
        ({"amount": "7f"}, "invalid_amount"),
        ({"amount": "NaN"}, "invalid_amount"),
        ({"amount": "3e700"}, "invalid_amount"),
        ({"amount": "-0.4"}, "negative_amount"),
        ({"transaction_id": None}, "missing_transaction_id"),
        ({"ip_address": "a.b.c.d"}, "invalid_ip"),
        ({"ip_address": "172.20.4.256"}, "invalid_ip"),
        ({"ip_address": "172.20.4"}, "invalid_ip"),
        ({"ip_address": "172.20.4.63.0"}, "invalid_ip"),
        ({"ip_address": None}, "invalid_ip"),
        ({"amount": "-8", "ip_address": "::1"}, "negative_amount;invalid_ip"),
    ],
)
def test_a_broken_rule_is_named(spark, override, reason):
    bad = invalid_rows(annotate(landing(spark, {}, override))).collect()
    assert [row["failure_reason"] for row in bad] == [reason]


@pytest.mark.parametrize(
    "override",
    [{"ip_address": ip} for ip in ("0.0.0.0", "255.255.255.255", "99.100.199.200", "249.250.9.10")]
    + [{"amount": "0.00"}],
)
def test_boundary_values_are_valid(spark, override):
    good = valid_rows(annotate(landing(spark, override)))
    assert good.count() == 1 and good.columns == TRANSACTION_COLUMNS


def test_first_of_repeated_ids_is_kept(spark):
    rows = annotate(landing(spark, {}, {"transaction_id": "t-0"}, {"transaction_id": "t-0"}))
    assert valid_rows(rows).count() == 1
    counts = rule_counts(rows).first()
    assert counts["duplicate_transaction_id"] == 2 and counts["invalid_rows"] == 2


def test_repeated_missing_ids_break_two_rules(spark):
    rows = annotate(landing(spark, {"transaction_id": None}, {"transaction_id": None}))
    reasons = sorted(row["failure_reason"] for row in invalid_rows(rows).collect())
    assert reasons == [
        "missing_transaction_id",
        "missing_transaction_id;duplicate_transaction_id",
    ]


def test_missing_column_is_reported_and_others_still_checked(spark):
    columns = tuple(name for name in TRANSACTION_COLUMNS if name != "ip_address")
    rows = landing(spark, {}, {"amount": "-5"}, columns=columns)
    assert missing_columns(rows) == ["ip_address"]
    counts = rule_counts(annotate(rows)).first()
    assert counts["invalid_ip"] == 2 and counts["negative_amount"] == 1


def test_headers_are_normalised_before_the_rules(spark):
    columns = tuple(f" {name.upper()} " for name in TRANSACTION_COLUMNS)
    assert valid_rows(annotate(landing(spark, {}, columns=columns))).count() == 1


def test_totals_add_up(spark, folder):
    checked = annotate(inputs.landing(spark, folder))
    counts = rule_counts(checked, by=()).first()
    assert counts["valid_rows"] + counts["invalid_rows"] == counts["rows"] == 1000
    assert sum(counts[rule] for rule in RULES) >= counts["invalid_rows"]


def test_repeated_id_plan_has_no_window(spark, folder):
    plan = annotate(inputs.landing(spark, folder))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_normalise(spark):
    raw = landing(spark, {"user_id": " U1 ", "amount": "125.505", "label": None},
                  {"event_time": "2025-03-17T18:42:09+02:00", "label": "1", "device_id": None},
                  {"event_time": "Mar 17 2025"}, {"amount": "x"})
    rows = {row["transaction_id"]: row for row in normalise(raw).collect()}
    assert rows["t-0"]["user_id"] == "U1" and str(rows["t-0"]["amount"]) == "125.51"
    assert rows["t-0"]["label"] == 0 and rows["t-1"]["label"] == 1
    assert str(rows["t-1"]["event_time"]) == "2025-03-17 16:42:09"
    assert rows["t-1"]["device_id"] is None
    assert str(rows["t-2"]["event_time"]) == "2025-03-17 00:00:00"
    assert loadable(normalise(raw)).count() == 3
