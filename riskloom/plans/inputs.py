"""The given tables seen as transactions, landing rows, scores and batches.

``events`` stands in for card transactions and ``orders`` for a second source whose times
have day resolution and therefore ties.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import prepare

AS_OF = datetime(2024, 1, 31)
SEEN_UNTIL = datetime(2024, 1, 21)
BATCH_FROM = datetime(2024, 1, 11)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("timestamp_ntz").alias("event_time"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
        F.col("event_type").alias("txn_type"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )


def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("event_time"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("label"),
    )


def skewed_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """As ``transactions``, with about a third of the rows under one user."""
    rows = transactions(spark, folder)
    hot = F.col("user_id").cast("long") % 3 == 0
    return rows.withColumn("user_id", F.when(hot, "busy").otherwise(F.col("user_id")))


def dense_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """As ``transactions``, all of one user and of one day."""
    rows = transactions(spark, folder)
    into_day = F.col("event_time") - F.date_trunc("day", F.col("event_time"))
    day = F.lit(AS_OF).cast("timestamp_ntz")
    return rows.withColumns({"user_id": F.lit("busy"), "event_time": (day + into_day).cast("timestamp_ntz")})


def landing(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as text with defects of every kind, one file per day."""
    number = F.col("event_id")

    def every(step: int):
        return number % step == 0

    money = F.col("value").cast("decimal(12,2)").cast("string")
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), F.col("user_id") % 256, number % 256)
    return table(spark, folder, "events").select(
        F.when(every(97), None)
        .when(every(89), (number - 1).cast("string"))
        .otherwise(number.cast("string"))
        .alias("transaction_id"),
        F.concat(F.lit(" U"), F.col("user_id").cast("string"), F.lit(" ")).alias("user_id"),
        F.when(every(83), "not-a-date")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("event_time"),
        F.when(every(79), "twelve pounds")
        .when(every(73), F.concat(F.lit("-"), money))
        .otherwise(money)
        .alias("amount"),
        F.concat(F.lit("m"), number % 10).alias("merchant_id"),
        F.when(every(7), "NA").otherwise("IN").alias("merchant_country"),
        F.col("event_type").alias("txn_type"),
        F.when(every(71), "999.999.999.999").when(every(67), None).otherwise(ip).alias("ip_address"),
        F.when(every(61), None)
        .when(F.col("event_type") == "error", "1")
        .otherwise("0")
        .alias("label"),
        F.date_format("ts", "yyyy-MM-dd").alias("source_file"),
        number.alias("row_pos"),
    )


def rankings(spark: SparkSession, folder: str) -> DataFrame:
    """Two models over the transactions: ``value`` has few equal scores, ``hour`` very many."""
    rows = with_truth(spark, folder)
    score = F.explode(
        F.array(
            F.struct(F.lit("value").alias("model"), F.col("amount").cast("double").alias("score")),
            F.struct(
                F.lit("hour").alias("model"), F.hour("event_time").cast("double").alias("score")
            ),
        )
    )
    return rows.select("transaction_id", "label", "fraud_type", score.alias("s")).select(
        "transaction_id", "label", "fraud_type", "s.*"
    )


def ground_truth(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds of fraud of the positive rows."""
    kind = F.element_at(
        F.array(F.lit("card_testing"), F.lit("account_takeover"), F.lit("subtle")),
        (F.col("user_id").cast("int") % 3 + 1),
    )
    return transactions(spark, folder).where("label = 1").select(
        "transaction_id", kind.alias("fraud_type")
    )


def with_truth(spark: SparkSession, folder: str) -> DataFrame:
    truth = ground_truth(spark, folder)
    return transactions(spark, folder).join(truth, "transaction_id", "left").withColumn(
        "fraud_type", F.coalesce("fraud_type", F.lit("legitimate"))
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """A scored table: the score is the amount on a fixed scale, flags start at 100."""
    return transactions(spark, folder).select(
        "transaction_id",
        "user_id",
        "event_time",
        (F.col("amount").cast("double") / 1000.0).alias("score"),
        (F.col("amount") >= 100).alias("flagged"),
        F.concat(F.lit("v-"), F.col("txn_type")).alias("model_version"),
        (F.col("event_time") + F.expr("INTERVAL 1 HOUR")).alias("scored_at"),
        "label",
    )


def seen(rows: DataFrame) -> DataFrame:
    """Rows that a table held before the batch came."""
    return rows.where(F.col("event_time") < F.lit(SEEN_UNTIL).cast("timestamp_ntz"))


def batch(rows: DataFrame) -> DataFrame:
    """A later batch that overlaps the seen rows and corrects their amounts by one."""
    return rows.where(F.col("event_time") >= F.lit(BATCH_FROM).cast("timestamp_ntz")).withColumn(
        "amount", (F.col("amount") + F.lit(1)).cast("decimal(12,2)")
    )
