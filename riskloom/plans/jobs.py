"""The jobs a user runs (B1-B7). Each takes a session and the folders it works in."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import forest
from riskloom.operators.features import compute, latest_per_user, trailing_windows
from riskloom.operators.merge import first_per_key
from riskloom.operators.metrics import CONTAMINATION
from riskloom.operators.normalise import loadable
from riskloom.plans import evaluate as evaluation
from riskloom.plans import monitor, profile
from riskloom.plans.scoring import choose_threshold, scored_rows
from riskloom.schema import FEATURES, SCORE_COLUMNS
from riskloom.session import pinned, prepare
from riskloom.sources import models
from riskloom.sources.landing import ground_truth, processed_layer
from riskloom.sources.tables import (
    feature_store,
    last_day,
    raw_table,
    score_table,
    since_latest,
)
from riskloom.streaming.ingest import Layers, affected_rows, ingest_available, utc_now


@dataclass(frozen=True)
class Trained:
    version: str
    threshold: float
    rule: str
    scored: DataFrame


def train(
    spark: SparkSession,
    transactions: DataFrame,
    layers: Layers,
    days: int | None = None,
    contamination: float = CONTAMINATION,
    seed: int = 42,
    now: datetime | None = None,
) -> Trained:
    """Fit, choose the threshold, store the model, score the training rows."""
    prepare(spark)
    now = now or utc_now()
    rows = transactions.where(F.col("event_time").isNotNull())
    if days:
        rows = since_latest(rows, days)
    features = pinned(compute(rows, carry=["label"]))
    facts = features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("user_id").alias("users"),
        F.min("event_time").alias("first"),
        F.max("event_time").alias("last"),
        F.count_if(F.col("label").isNull()).alias("unlabelled"),
    ).first()
    model, raw = forest.fit_and_score(features, FEATURES, seed, contamination)
    choice = choose_threshold(raw, labelled=facts["unlabelled"] == 0)
    version = f"isoforest_{now:%Y%m%d%H%M%S}"
    models.save(
        spark,
        layers.models,
        version,
        model,
        trained_at=now,
        rows=facts["rows"],
        users=facts["users"],
        contamination=contamination,
        seed=seed,
        threshold=choice.value,
        rule=choice.rule,
        params={"trees": forest.TREES, "sample": model.sample},
        span=(facts["first"], facts["last"]),
    )
    scored = scored_rows(raw, choice.value, version, now, carry=["label"])
    scored.write.mode("overwrite").parquet(f"{layers.reports}/training_scores/of={version}")
    stored = spark.read.parquet(f"{layers.reports}/training_scores/of={version}")
    return Trained(version, choice.value, choice.rule, stored)


def processed_rows(spark: SparkSession, layers: Layers) -> DataFrame:
    """The processed layer, live and archived, with one row per id: files are checked one by
    one, so an id may come from several; its earliest event is kept, as in the raw table."""
    rows = processed_layer(spark, layers.processed, f"{layers.archive}/processed")
    return first_per_key(loadable(rows), "transaction_id", ["event_time", "amount", "user_id"])


def local_batch(spark: SparkSession, base: str, **options) -> Trained | None:
    """B1: check and normalise new files, then train on the processed layer and score it.

    None as long as no file had a valid row.
    """
    layers = Layers(base)
    ingest_available(spark, layers, load_raw=False)
    rows = processed_rows(spark, layers)
    return None if rows.isEmpty() else train(spark, rows, layers, **options)


def daily(spark: SparkSession, base: str, **options) -> Trained | None:
    """B2: as B1, but new files are also loaded into the raw table, which is trained on."""
    layers = Layers(base)
    ingest_available(spark, layers)
    rows = raw_table(spark, layers.raw).read()
    return None if rows.isEmpty() else train(spark, rows, layers, **options)


def score_rows(
    spark: SparkSession, transactions: DataFrame, layers: Layers, now: datetime, since: datetime | None
) -> DataFrame:
    """Score with the latest stored model. Features use the whole history; ``since`` then
    limits which rows are scored."""
    model = models.latest(spark, layers.models)
    features = compute(transactions)
    if since is not None:
        features = features.where(F.col("event_time") >= F.lit(since).cast("timestamp_ntz"))
    raw = pinned(forest.with_raw_score(features, model.forest).drop(*FEATURES))
    return scored_rows(raw, model.threshold, model.version, now).select(*SCORE_COLUMNS)


def hourly(
    spark: SparkSession,
    base: str,
    days: int = 30,
    history_days: int | None = None,
    alert_threshold: int = 1,
    now: datetime | None = None,
) -> tuple[dict[str, int], DataFrame]:
    """Score the last ``days`` into the score table; returns merge counts and alerts.

    ``history_days`` limits the rows that features see, None means all.
    """
    prepare(spark)
    layers, now = Layers(base), now or utc_now()
    raw = raw_table(spark, layers.raw).read()
    if history_days is not None:
        start = now - timedelta(days=history_days)
        raw = raw.where(F.col("event_time") >= F.lit(start).cast("timestamp_ntz")).where(
            F.col("event_date") >= F.lit(start.date())
        )
    scored = score_rows(spark, raw, layers, now, now - timedelta(days=days))
    table = score_table(spark, layers.scores)
    counts = table.merge(scored, f"score-{now:%Y%m%d%H%M%S}")
    return counts, monitor.alerts(table.read(), now, alert_threshold)


def rescore_late(
    spark: SparkSession, base: str, batch: DataFrame, now: datetime | None = None
) -> dict[str, int]:
    """Score all rows of the users in ``batch`` again after late rows arrived."""
    prepare(spark)
    layers, now = Layers(base), now or utc_now()
    rows = affected_rows(raw_table(spark, layers.raw).read(), batch)
    scored = score_rows(spark, rows, layers, now, None)
    return score_table(spark, layers.scores).merge(scored, f"late-{now:%Y%m%d%H%M%S}")


def evaluate(
    spark: SparkSession,
    base: str,
    truth_path: str | None = None,
    which: Sequence[str] = tuple(evaluation.ALL),
) -> evaluation.Evaluation:
    """Held-out evaluation of all models on the processed layer; writes the report."""
    prepare(spark)
    layers = Layers(base)
    rows = processed_rows(spark, layers)
    result = evaluation.evaluate(rows, ground_truth(spark, truth_path), which)
    result.report.write.mode("overwrite").parquet(f"{layers.reports}/evaluation")
    evaluation.as_json(result).write.mode("overwrite").json(f"{layers.reports}/evaluation_json")
    return result


def monitoring(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The monitoring views of the score table."""
    prepare(spark)
    scores = score_table(spark, Layers(base).scores).read()
    return {
        "kpis": monitor.kpis(scores),
        "buckets": monitor.buckets(scores),
        "histogram": monitor.histogram(scores),
        "top": monitor.top_scored(scores),
        "daily": monitor.daily_flags(scores),
        "summary": monitor.summary(scores),
    }


def refresh_feature_store(
    spark: SparkSession, base: str, now: datetime | None = None
) -> dict[str, int]:
    """One row per user active in the last 24 hours, from its latest transaction."""
    prepare(spark)
    layers, now = Layers(base), now or utc_now()
    recent = last_day(raw_table(spark, layers.raw).read(), now, extra=("transaction_id",))
    rows = latest_per_user(trailing_windows(recent)).withColumn(
        "updated_at", F.lit(now).cast("timestamp_ntz")
    )
    return feature_store(spark, layers.feature_store).merge(rows, f"store-{now:%Y%m%d%H%M%S}")


def profiling(df: DataFrame) -> dict[str, DataFrame]:
    """The profile of a transaction table."""
    prepare(df.sparkSession)
    return {
        "dataset": profile.dataset(df),
        "rows_per_user": profile.rows_per_user(df),
        "rows_in_24h": profile.rows_in_24h(df),
        "amounts_by_label": profile.amounts_by_label(df),
        "overlap": profile.overlap(df),
        "by_hour": profile.by_hour(df),
    }
