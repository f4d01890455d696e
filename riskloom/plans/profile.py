"""Profile of a transaction table (B7: A1-A6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.features import trailing_counts
from riskloom.operators.ordered import quantiles
from riskloom.session import pinned


def dataset(df: DataFrame) -> DataFrame:
    """Rows, users, time span, distinct times and days, fraud rows and rate (A1).

    Rows are combined by time, times by day: several distinct counts in one aggregate would
    copy every row once for each.
    """
    totals = {"rows": F.count(F.lit(1)), "fraud_rows": F.sum("label"), "labelled": F.count("label")}
    by_time = df.groupBy("event_time").agg(*[value.alias(name) for name, value in totals.items()])
    sums = [F.sum(name).alias(name) for name in totals]
    ends = [F.min("event_time").alias("first_event"), F.max("event_time").alias("last_event")]
    by_day = by_time.groupBy(F.to_date("event_time").alias("day")).agg(
        *sums, *ends, F.count("event_time").alias("distinct_times")
    )
    whole = by_day.agg(
        *sums,
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        F.sum("distinct_times").alias("distinct_times"),
        F.count("day").alias("distinct_days"),
    )
    users = df.agg(F.count_distinct("user_id").alias("users"))
    count = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    return whole.crossJoin(F.broadcast(users)).select(  # both are one row
        count("rows"),
        "users",
        "first_event",
        "last_event",
        count("distinct_times"),
        F.try_divide("distinct_times", "rows").alias("distinct_time_share"),
        "distinct_days",
        "fraud_rows",
        F.try_divide("fraud_rows", "labelled").alias("fraud_rate"),
    )


def rows_per_user(df: DataFrame) -> DataFrame:
    """Smallest, median, mean and largest number of rows per user (A2)."""
    counts = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    ends = counts.agg(
        F.min("n").alias("min_rows"), F.avg("n").alias("mean_rows"), F.max("n").alias("max_rows")
    )
    # Both sides are one row.
    return ends.crossJoin(F.broadcast(quantiles(counts, "n", {"median_rows": 0.5})))


def rows_in_24h(df: DataFrame) -> DataFrame:
    """Distribution of a row's own trailing 24-hour count (A3)."""
    counted = pinned(trailing_counts(df).groupBy("txn_count_24h").agg(F.count(F.lit(1)).alias("n")))
    one = F.when(F.col("txn_count_24h") == 1, F.col("n")).otherwise(0)
    ends = counted.agg(
        (F.sum(F.col("txn_count_24h") * F.col("n")) / F.sum("n")).alias("mean_count"),
        F.max("txn_count_24h").alias("max_count"),
        (F.sum(one) / F.sum("n")).alias("share_of_one"),
    )
    median = quantiles(counted, "txn_count_24h", {"median_count": 0.5}, weight="n")
    return ends.crossJoin(F.broadcast(median))


def amounts_by_label(df: DataFrame) -> DataFrame:
    """Amount percentiles per label (A4)."""
    found = quantiles(df, "amount", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, ["label"])
    top = df.groupBy("label").agg(F.max("amount").cast("double").alias("max_amount"))
    return found.join(F.broadcast(top), "label")  # one row per label


def overlap(df: DataFrame) -> DataFrame:
    """Share of fraud rows with an ordinary amount, between the legitimate p5 and p95 (A5)."""
    legitimate = df.where("label = 0")
    band = quantiles(legitimate, "amount", {"low": 0.05, "high": 0.95})
    inside = F.col("amount").cast("double").between(F.col("low"), F.col("high"))
    return (
        df.where("label = 1")
        .crossJoin(F.broadcast(band))  # one row
        .agg(F.avg(inside.cast("double")).alias("overlap_share"))
    )


def by_hour(df: DataFrame) -> DataFrame:
    """Rows per hour of day."""
    return df.groupBy(F.hour("event_time").alias("hour")).agg(F.count(F.lit(1)).alias("transactions"))
