from pathlib import Path

import pytest

from riskloom.schema import TRANSACTION_COLUMNS
from riskloom.sources.landing import ground_truth, processed_layer, read_landing
from riskloom.sources.tables import raw_table
from riskloom.streaming.ingest import Layers, affected_rows, ingest_available
from tests.test_validation import GOOD


def write(folder, name, rows, columns=tuple(TRANSACTION_COLUMNS)):
    Path(folder).mkdir(parents=True, exist_ok=True)
    lines = [",".join(columns)] + [",".join(row[c.strip().lower()] for c in columns) for row in rows]
    Path(folder, name).write_text("\n".join(lines) + "\n")


def good(key, **extra):
    return {**GOOD, "transaction_id": key, **extra}


def test_columns_are_matched_by_name(spark, tmp_path):
    Path(tmp_path, "a.csv").write_text("transaction_id,amount\nt1,5\n")
    Path(tmp_path, "b.csv").write_text("amount,transaction_id\n6,t2\n")
    Path(tmp_path, "c.csv").write_text("transaction_id\nt3\n")
    Path(tmp_path, "d.csv").write_text("")
    rows = read_landing(spark, [f"{tmp_path}/{n}.csv" for n in "abcd"])
    found = sorted((r["transaction_id"], r["amount"]) for r in rows.collect())
    assert found == [("t1", "5"), ("t2", "6"), ("t3", None)]


def test_missing_tokens_and_the_country_code(spark, tmp_path):
    write(tmp_path, "a.csv", [good("t1", device_id="NA", merchant_country="NA")])
    row = read_landing(spark, [f"{tmp_path}/a.csv"]).first()
    assert row["device_id"] is None and row["merchant_country"] == "NA"


def test_only_new_files_are_processed(spark, tmp_path):
    layers = Layers(str(tmp_path))
    write(layers.landing, "day1.csv", [good("t1"), good("t2", amount="-5")])
    assert ingest_available(spark, layers) == 1
    checked = spark.read.parquet(layers.checked)
    assert checked.where("NOT cast(is_bad as boolean)").count() == 1
    assert [r["failure_reason"] for r in checked.where("cast(is_bad as boolean)").collect()] == ["negative_amount"]
    assert ingest_available(spark, layers) == 0

    upper = tuple(name.upper() for name in reversed(TRANSACTION_COLUMNS))
    write(layers.landing, "day2.csv", [good("t3"), good("t1", amount="9")], upper)
    assert ingest_available(spark, layers) == 1
    rows = {r["transaction_id"]: str(r["amount"]) for r in raw_table(spark, layers.raw).read().collect()}
    assert rows == {"t1": "9.00", "t3": "31.05"}
    assert processed_layer(spark, layers.processed).count() == 3
    loads = spark.read.parquet(f"{layers.reports}/load").orderBy("batch_id").collect()
    found = [(r["inserted"], r["updated"], r["table_rows"], r["dropped"]) for r in loads]
    assert found == [(1, 0, 1, 0), (1, 1, 2, 0)]


def test_no_bad_folder_without_bad_rows_and_broken_rows_are_kept(spark, tmp_path):
    layers = Layers(str(tmp_path))
    write(layers.landing, "a.csv", [good("t1")])
    ingest_available(spark, layers, load_raw=False)
    assert not list(Path(layers.checked).rglob("is_bad=true"))
    Path(layers.landing, "b.csv").write_text(
        ",".join(TRANSACTION_COLUMNS) + "\n" + ",".join(GOOD.values()) + ",too,many\n"
    )
    ingest_available(spark, layers, load_raw=False)
    bad = spark.read.parquet(layers.checked).where("cast(is_bad as boolean)").collect()
    assert [r["failure_reason"] for r in bad] == ["unreadable_row"]
    assert "too,many" in bad[0]["_corrupt"]


@pytest.mark.parametrize("first", [[], [good("t9", amount="-1")], [good("t9", amount="99999999999")]])
def test_a_batch_without_a_valid_row_does_not_stop_later_ones(spark, tmp_path, first):
    layers = Layers(str(tmp_path))
    write(layers.landing, "a.csv", first)
    assert ingest_available(spark, layers) == 1
    assert raw_table(spark, layers.raw).read().count() == 0
    write(layers.landing, "b.csv", [good("t1"), good("t2", amount="99999999999")])
    assert ingest_available(spark, layers) == 1
    assert [r["transaction_id"] for r in raw_table(spark, layers.raw).read().collect()] == ["t1"]
    bad = spark.read.parquet(f"{layers.checked}/batch_id=1").where("cast(is_bad as boolean)").collect()
    assert [r["failure_reason"] for r in bad] == ["amount_out_of_range"]


def test_rows_without_a_user_are_affected_too(spark):
    schema = "transaction_id string, user_id string"
    raw = spark.createDataFrame([("t1", "a"), ("t2", None), ("t3", "b"), ("t4", None)], schema)
    found = affected_rows(raw, raw.where("transaction_id = 't2'")).collect()
    assert sorted(r["transaction_id"] for r in found) == ["t2", "t4"]


def test_ground_truth_is_optional(spark, tmp_path):
    assert ground_truth(spark, f"{tmp_path}/none.csv") is None
    Path(tmp_path, "truth.csv").write_text("transaction_id,fraud_type\nt1,subtle\n")
    assert ground_truth(spark, f"{tmp_path}/truth.csv").count() == 1


@pytest.mark.parametrize("archive", [False, True])
def test_processed_layer_reads_live_and_archive(spark, tmp_path, archive):
    spark.range(3).write.parquet(f"{tmp_path}/live")
    spark.range(2).write.parquet(f"{tmp_path}/old")
    rows = processed_layer(spark, f"{tmp_path}/live", f"{tmp_path}/old" if archive else None)
    assert rows.count() == (5 if archive else 3)


def test_a_file_that_is_no_table_does_not_stop_the_others(spark, tmp_path):
    layers = Layers(str(tmp_path))
    write(layers.landing, "a.csv", [good("t1"), good("t2", merchant_id='"a ""b"", c"')])
    Path(layers.landing, "b.csv").write_bytes(b"\x01\xff.x,`y,,a,a\n\x02\x03\n")
    assert ingest_available(spark, layers) == 2
    rows = {r["transaction_id"]: r["merchant_id"] for r in raw_table(spark, layers.raw).read().collect()}
    assert rows == {"t1": "Corner Bakery", "t2": 'a "b", c'}
    bad = spark.read.parquet(layers.checked).where("cast(is_bad as boolean)").collect()
    assert len(bad) == 2 and all("unreadable_row" in row["failure_reason"] for row in bad)
