"""Column lists and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# Column names and their order are part of the data contract.
TRANSACTION_COLUMNS = [
    "transaction_id",
    "user_id",
    "event_time",
    "amount",
    "merchant_id",
    "merchant_country",
    "txn_type",
    "device_id",
    "ip_address",
    "label",
]

ABSOLUTE_FEATURES = [
    "total_amount_24h",
    "txn_count_24h",
    "avg_amount_24h",
    "hours_since_last_txn",
]

RELATIVE_FEATURES = [
    "amount_vs_user_median",
    "count_vs_user_typical",
    "gap_vs_user_typical",
]

FEATURES = ABSOLUTE_FEATURES + RELATIVE_FEATURES

SCORE_COLUMNS = [
    "transaction_id",
    "user_id",
    "event_time",
    "score",
    "flagged",
    "model_version",
    "scored_at",
]

# Text columns that the normaliser trims.
TEXT_COLUMNS = [
    "transaction_id",
    "user_id",
    "merchant_id",
    "merchant_country",
    "txn_type",
    "device_id",
    "ip_address",
]

# The landing layer is text only: a value is cast after it has been checked.
LANDING = T.StructType([T.StructField(name, T.StringType()) for name in TRANSACTION_COLUMNS])

RAW = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("event_time", T.TimestampNTZType(), False),
        T.StructField("amount", MONEY, False),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_country", T.StringType()),
        T.StructField("txn_type", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("label", T.IntegerType(), False),
        T.StructField("loaded_at", T.TimestampNTZType(), False),
    ]
)

SCORES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("event_time", T.TimestampNTZType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("flagged", T.BooleanType(), False),
        T.StructField("model_version", T.StringType(), False),
        T.StructField("scored_at", T.TimestampNTZType(), False),
    ]
)

FEATURE_STORE = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("last_24h_total", MONEY, False),
        T.StructField("last_24h_txn_count", T.IntegerType(), False),
        T.StructField("last_24h_avg_amount", MONEY, False),
        T.StructField("updated_at", T.TimestampNTZType(), False),
    ]
)
