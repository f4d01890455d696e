"""Monitoring queries on the scored table (B5: S5, P13-P15, A7-A12, L2-L4, J6, J7)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Limits of the interactive views and of the alert message.
TOP_ROWS = 50
TOP_ROWS_MAX = 1000
DRILL_DOWN_ROWS = 200
ALERT_ROWS = 5
HISTOGRAM_BINS = 60
FEW_BUCKETS = 5

SHOWN = ["transaction_id", "user_id", "event_time", "score", "flagged", "model_version"]


def in_window(
    scores: DataFrame, start: date, end: date, min_score: float = 0.0, flagged_only: bool = False
) -> DataFrame:
    """Rows of the days ``start`` to ``end`` with at least ``min_score``.

    Day bounds are turned into time bounds, which the scan can use.
    """
    first = datetime(start.year, start.month, start.day)
    after = datetime(end.year, end.month, end.day) + timedelta(days=1)
    rows = scores.where(
        (F.col("event_time") >= F.lit(first).cast("timestamp_ntz"))
        & (F.col("event_time") < F.lit(after).cast("timestamp_ntz"))
        & (F.col("score") >= min_score)
    )
    if "event_date" in scores.columns:
        rows = rows.where(F.col("event_date").between(F.lit(start), F.lit(end)))
    return rows.where("flagged") if flagged_only else rows


def kpis(scores: DataFrame) -> DataFrame:
    """Scored and flagged rows, alert rate and top score."""
    return scores.agg(
        F.count(F.lit(1)).alias("scored"),
        F.count_if("flagged").alias("flagged"),
        F.avg(F.col("flagged").cast("double")).alias("alert_rate"),
        F.max("score").alias("max_score"),
    )


def buckets(scores: DataFrame) -> DataFrame:
    """Rows and flags per time bucket.

    The bucket is 5 minutes, an hour or a day wide, by the span of the rows; empty buckets
    are kept, and ``few_buckets`` warns where a shape means little.
    """
    hour = 3_600_000_000
    micros = F.unix_micros(F.col("event_time").cast("timestamp"))
    span = scores.agg(F.min(micros).alias("_first"), F.max(micros).alias("_last"))
    hours = (F.col("_last") - F.col("_first")) / hour
    width = (
        F.when(hours <= 3, F.lit(hour // 12)).when(hours <= 48, F.lit(hour)).otherwise(24 * hour)
    )
    start = F.col("_first") - F.pmod(F.col("_first"), F.col("_width"))
    bounds = span.where("_first IS NOT NULL").withColumn("_width", width)
    # One row; the sequence has at most 48 entries or one per day.
    empty = bounds.select(
        F.explode(F.sequence(start, F.col("_last"), F.col("_width"))).alias("_start"), "_width"
    )
    counted = (
        scores.crossJoin(F.broadcast(bounds.select("_width")))
        .groupBy((micros - F.pmod(micros, F.col("_width"))).alias("_start"))
        .agg(F.count("score").alias("_n"), F.count_if("flagged").alias("_f"))
    )
    rows = empty.join(counted, "_start", "left").select(
        F.timestamp_micros("_start").cast("timestamp_ntz").alias("bucket"),
        (F.col("_width") / 60_000_000).cast("bigint").alias("minutes"),
        F.coalesce("_n", F.lit(0)).alias("transactions"),
        F.coalesce("_f", F.lit(0)).alias("flagged"),
    )
    size = empty.agg((F.count(F.lit(1)) < FEW_BUCKETS).alias("few_buckets"))
    return rows.crossJoin(F.broadcast(size))


def histogram(scores: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Rows per score bin of [0, 1] and flag (A9). The last bin includes 1."""
    bin_no = F.least(F.floor(F.col("score") * bins) + 1, F.lit(bins)).cast("bigint")
    return scores.groupBy(bin_no.alias("bin"), "flagged").agg(
        F.count(F.lit(1)).alias("transactions")
    )


def flags_by_label(scores: DataFrame) -> DataFrame:
    """Rows and flags per label (A10)."""
    return scores.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("flagged").alias("flagged")
    )


def daily_flags(scores: DataFrame) -> DataFrame:
    """Rows and flags per day."""
    return scores.groupBy(F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("txns"), F.count_if("flagged").alias("flagged")
    )


def summary(scores: DataFrame) -> DataFrame:
    """Size, alert share, score range and models of the score table."""
    return scores.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("flagged").alias("flagged"),
        (F.avg(F.col("flagged").cast("double")) * 100).alias("alert_pct"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.count_distinct("model_version").alias("models"),
    )


def top_scored(scores: DataFrame, rows: int = TOP_ROWS) -> DataFrame:
    """The highest scores, ties by id (L2; L4 with ``DRILL_DOWN_ROWS``)."""
    if not 1 <= rows <= TOP_ROWS_MAX:
        raise ValueError(f"rows must be between 1 and {TOP_ROWS_MAX}")
    return scores.orderBy(F.col("score").desc(), "transaction_id").limit(rows).select(*SHOWN)


def top_with_raw(scores: DataFrame, raw: DataFrame, rows: int = 10) -> DataFrame:
    """The highest scores of rows that are in the raw layer, with amount and label."""
    return (
        scores.join(raw.select("transaction_id", "amount", "label"), "transaction_id")
        .orderBy(F.col("score").desc(), "transaction_id")
        .limit(rows)
        .select(
            "transaction_id", "user_id", "event_time", "amount", "score", "flagged", "label"
        )
    )


def lookup(scores: DataFrame, transaction_id: str) -> DataFrame:
    """One scored transaction."""
    return scores.where(F.col("transaction_id") == transaction_id).limit(1)


def alerts(
    scores: DataFrame, as_of: datetime, threshold: int = 1, rows: int = ALERT_ROWS
) -> DataFrame:
    """The top flagged rows scored in the last 24 hours, if there are at least ``threshold`` (L3).

    All matching rows are counted before the top is taken.
    """
    since = F.lit(as_of - timedelta(hours=24)).cast("timestamp_ntz")
    recent = scores.where(F.col("flagged") & (F.col("scored_at") >= since))
    count = recent.agg(F.count(F.lit(1)).alias("flagged_rows")).where(
        F.col("flagged_rows") >= threshold
    )
    top = recent.orderBy(F.col("score").desc(), "transaction_id").limit(rows)
    # One row, or none if the threshold is not reached.
    return top.crossJoin(F.broadcast(count)).select(
        "transaction_id", "score", "model_version", "scored_at", "flagged_rows"
    )
