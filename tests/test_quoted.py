import csv
import random
from pathlib import Path

import pytest
from pyspark.sql import types as T

from riskloom.sources.landing import read_landing
from riskloom.sources.quoted import lines_of_records, read_quoted, with_line_breaks
from riskloom.streaming.ingest import Layers, ingest_available
from riskloom.sources.tables import raw_table
from riskloom.schema import TRANSACTION_COLUMNS
from tests.test_ingest import good

SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ("a", "b", "c", "_corrupt")])
SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    kept = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, 97)
    yield
    spark.conf.set(SPLIT, kept)


def cells(rng):
    kinds = ["x", 'in "quotes"', "two\nlines", 'a\n"\n\nb', ",", "ends\n", '5" pipe', "1,\n2"]
    return [rng.choice(kinds) for _ in range(3)]


@pytest.mark.parametrize("seed", range(3))
def test_records_over_many_splits_match_the_csv_module(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    wanted = [[f"{i}", *cells(rng)[1:]] for i in range(60)]
    with open(tmp_path / "a b.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([["a", "b", "c"], *wanted])
    rows = read_quoted(spark, [f"{tmp_path}/a b.csv"], SCHEMA, "_corrupt").orderBy("row_pos").collect()
    assert [[r["a"], r["b"], r["c"]] for r in rows] == wanted
    assert all(r["_corrupt"] is None for r in rows)


def test_quote_inside_a_plain_cell_opens_nothing(spark, tmp_path, small_splits):
    Path(tmp_path, "a.csv").write_text('a,b,c\n1,5" pipe,z\n2,y,z\n3,"x"y",z\n')
    assert with_line_breaks(spark, [f"{tmp_path}/a.csv"]) == []
    Path(tmp_path, "b.csv").write_text('a,b,c\n\n1,5" pipe,"z\n\nz"\n\n2,"y""\n",z\n')
    assert with_line_breaks(spark, [f"{tmp_path}/{n}.csv" for n in "ab"]) == [f"{tmp_path}/b.csv"]
    rows = read_quoted(spark, [f"{tmp_path}/b.csv"], SCHEMA, "_corrupt").orderBy("row_pos").collect()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [("1", '5" pipe', "z\n\nz"), ("2", 'y"\n', "z")]


def test_unclosed_quote_gives_single_lines(spark, tmp_path):
    Path(tmp_path, "a.csv").write_text('a,b,c\n1,2,3\n4,"5,6\n' + "".join(f"{i},x,y\n" for i in range(20)))
    rows = read_quoted(spark, [f"{tmp_path}/a.csv"], SCHEMA, "_corrupt", record_lines=10).orderBy("row_pos").collect()
    assert rows[0]["a"] == "1" and rows[0]["_corrupt"] is None
    assert [r["_corrupt"] for r in rows[1:]] == ['4,"5,6', *[f"{i},x,y" for i in range(20)]]


def test_lines_of_a_file_stay_in_splits(spark, tmp_path):
    Path(tmp_path, "a.csv").write_text('a,b,c\n1,"2\n",3\n')
    plan = lines_of_records(spark, [f"{tmp_path}/a.csv"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_ingest_keeps_line_breaks(spark, tmp_path):
    layers = Layers(str(tmp_path))
    Path(layers.landing).mkdir(parents=True)
    with open(Path(layers.landing, "a.csv"), "w", newline="") as file:
        writer = csv.DictWriter(file, TRANSACTION_COLUMNS, lineterminator="\n")
        writer.writeheader()
        writer.writerows([good("t1", device_id="one\ntwo"), good("t2", amount="-1"), good("t3")])
    Path(layers.landing, "b.csv").write_text("transaction_id,amount\nt9,5\n")
    assert ingest_available(spark, layers) == 2
    rows = {r["transaction_id"]: r["device_id"] for r in raw_table(spark, layers.raw).read().collect()}
    assert rows["t1"] == "one\ntwo" and set(rows) == {"t1", "t3"}


def test_plain_and_broken_files_of_one_header(spark, tmp_path):
    Path(tmp_path, "a.csv").write_text("transaction_id,device_id\nt1,d\n")
    Path(tmp_path, "b.csv").write_text('transaction_id,device_id\nt2,"d\ne"\nt3\n')
    rows = read_landing(spark, [f"{tmp_path}/{n}.csv" for n in "ab"]).collect()
    found = sorted((r["transaction_id"], r["device_id"], r["_corrupt"]) for r in rows)
    assert found == [("t1", "d", None), ("t2", "d\ne", None), ("t3", None, "t3")]
