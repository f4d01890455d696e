from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.plans import evaluate, inputs, jobs
from riskloom.sources import models
from riskloom.sources.tables import raw_table, score_table
from riskloom.streaming.ingest import Layers, late_rows

NOW = datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def base(spark, folder, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("jobs"))
    rows = inputs.landing(spark, folder).drop("row_pos", "source_file")
    rows.coalesce(2).write.option("header", True).csv(f"{base}/landing")
    return base


@pytest.fixture(scope="module")
def trained(spark, base):
    return jobs.daily(spark, base, now=NOW)


def test_batches_wait_for_the_first_valid_row(spark, tmp_path):
    for job, base in ((jobs.local_batch, f"{tmp_path}/one"), (jobs.daily, f"{tmp_path}/two")):
        (tmp_path / base[-3:] / "landing").mkdir(parents=True)
        (tmp_path / base[-3:] / "landing" / "bad.csv").write_text("transaction_id,amount\nt1,lots\n")
        assert job(spark, base) is None


def test_training_stores_a_model_and_scores(spark, base, trained):
    rows = raw_table(spark, Layers(base).raw).read()
    assert trained.scored.count() == rows.count() > 800
    model = models.latest(spark, Layers(base).models)
    assert model.version == trained.version == "isoforest_20240131000000"
    assert model.threshold == trained.threshold
    wrong = trained.scored.where(F.col("flagged") != (F.col("raw_score") >= trained.threshold))
    assert wrong.count() == 0


def test_scoring_twice_updates(spark, base, trained):
    counts, alerts = jobs.hourly(spark, base, now=NOW)
    rows = raw_table(spark, Layers(base).raw).read().count()
    assert counts == {"inserted": rows, "updated": 0, "table_rows": rows}
    assert 0 < alerts.count() <= 5
    again, _ = jobs.hourly(spark, base, now=NOW + timedelta(minutes=1))
    assert again["inserted"] == 0 and again["updated"] > 0 and again["table_rows"] == rows
    views = jobs.monitoring(spark, base)
    assert views["kpis"].first()["scored"] == rows
    assert views["buckets"].agg(F.sum("transactions")).first()[0] == rows


def test_late_rows_rescore_their_users(spark, base, trained):
    raw = raw_table(spark, Layers(base).raw).read()
    late = raw.where(F.col("user_id") == raw.first()["user_id"]).limit(1)
    counts = jobs.rescore_late(spark, base, late, now=NOW + timedelta(hours=1))
    assert counts["inserted"] + counts["updated"] == raw.join(late, "user_id", "left_semi").count()
    assert late_rows(raw).count() == raw.count()


def test_feature_store_refresh(spark, base, trained):
    recent = raw_table(spark, Layers(base).raw).read().where(
        F.col("event_time") >= F.lit(NOW - timedelta(hours=24)).cast("timestamp_ntz")
    )
    counts = jobs.refresh_feature_store(spark, base, now=NOW)
    assert counts["inserted"] == recent.select("user_id").distinct().count()


def test_evaluation_report(spark, base, folder, trained):
    names = [evaluate.FOREST_7, evaluate.LOGISTIC_7, evaluate.BY_AMOUNT]
    found = jobs.evaluate(spark, base, which=names)
    report = {(r["model"], r["metric"], r["slice"]): r["value"] for r in found.report.collect()}
    assert {name for name, *_ in report} == set(names)
    for name in names:
        assert 0 < report[name, "pr_auc", "all"] <= 1
        assert 0 <= report[name, "roc_auc", "all"] <= 1
        assert report[name, "precision", "budget=0.02"] >= 0
    assert {r["split"] for r in found.split.collect()} == {"train", "test"}
    assert found.samples.count() > 0
    ranked = evaluate.ranked_summary(found.report).collect()
    assert [r["pr_auc"] for r in ranked] == sorted((r["pr_auc"] for r in ranked), reverse=True)


def test_scoring_without_a_threshold_is_refused(spark, base, trained, tmp_path):
    stored = models.metadata(spark, Layers(base).models)
    stored.withColumn("threshold", F.lit(None).cast("double")).write.parquet(f"{tmp_path}/metadata/of=x")
    with pytest.raises(ValueError, match="threshold"):
        models.latest(spark, str(tmp_path))


def test_scores_do_not_depend_on_the_scored_window(spark, base, trained):
    layers = Layers(base)
    raw = raw_table(spark, layers.raw).read()
    whole = jobs.score_rows(spark, raw, layers, NOW, None)
    part = jobs.score_rows(spark, raw, layers, NOW, NOW - timedelta(days=5))
    both = whole.select("transaction_id", F.col("flagged").alias("a")).join(
        part.select("transaction_id", F.col("flagged").alias("b")), "transaction_id"
    )
    assert both.count() == part.count() > 0
    assert both.where("a != b").count() == 0
    assert score_table(spark, layers.scores).read().count() > 0
