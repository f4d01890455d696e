"""Quality rules over a landing batch, and the split into valid and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import parsed_number, parsed_time
from riskloom.operators.normalise import add_missing_columns, normalise_headers
from riskloom.schema import TRANSACTION_COLUMNS
from riskloom.session import pinned

# Rule names in reporting order, and the dotted-quad pattern.
RULES = [
    "invalid_event_time",
    "invalid_amount",
    "negative_amount",
    "invalid_ip",
    "missing_transaction_id",
    "duplicate_transaction_id",
]
IPV4 = r"^((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"

FILE, ROW = "source_file", "row_pos"


# Repeated ids up to this many are a few dozen MB and are broadcast; the rows then need no
# shuffle. More of them are joined by shuffle, where a hot id is split as a skewed partition.
BROADCAST_REPEATS = 200_000


def _repeats(rows: DataFrame) -> DataFrame:
    """First row of every id that occurs more than once in its file.

    Counting combines before the shuffle, so an id (or a missing id) that fills a third of
    a file costs nothing special, unlike a ``row_number`` over it.
    """
    repeats = (
        rows.groupBy(F.col(FILE).alias("_file"), F.col("transaction_id").alias("_id"))
        .agg(F.min(ROW).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .where("_copies > 1")
        .drop("_copies")
    )
    repeats = pinned(repeats)
    return F.broadcast(repeats) if repeats.count() <= BROADCAST_REPEATS else repeats


def annotate(rows: DataFrame) -> DataFrame:
    """Parse time and amount, add one boolean per rule, ``is_bad`` and ``failure_reason``.

    ``rows`` is all text, plus ``source_file`` and an orderable ``row_pos`` that is unique
    within a file. Missing transaction columns are added as null first.
    """
    rows = add_missing_columns(normalise_headers(rows))
    repeats = _repeats(rows)
    same = F.col(FILE).eqNullSafe(F.col("_file")) & F.col("transaction_id").eqNullSafe(
        F.col("_id")
    )
    amount = parsed_number(F.col("amount"))
    checks: dict[str, Column] = {
        "invalid_event_time": F.col("_time").isNull(),
        "invalid_amount": F.col("_amount").isNull(),
        "negative_amount": F.coalesce(F.col("_amount") < 0, F.lit(False)),
        "invalid_ip": ~F.coalesce(F.col("ip_address").rlike(IPV4), F.lit(False)),
        "missing_transaction_id": F.col("transaction_id").isNull(),
        "duplicate_transaction_id": F.coalesce(F.col(ROW) != F.col("_first"), F.lit(False)),
    }
    named = [F.when(F.col(rule), F.lit(rule)) for rule in RULES]
    return (
        rows.join(repeats, same, "left")
        .withColumns({"_time": parsed_time(F.col("event_time")), "_amount": amount})
        .withColumns({rule: checks[rule] for rule in RULES})
        .withColumn("failure_reason", F.concat_ws(";", *named))
        .withColumn("is_bad", F.col("failure_reason") != "")
        .withColumns({"event_time": F.col("_time"), "amount": F.col("_amount")})
        .drop("_time", "_amount", "_file", "_id", "_first")
    )


def valid_rows(annotated: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return annotated.where(~F.col("is_bad")).select(*TRANSACTION_COLUMNS, *extra)


def invalid_rows(annotated: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return annotated.where("is_bad").select(*TRANSACTION_COLUMNS, "failure_reason", *extra)


def rule_counts(annotated: DataFrame, by: Sequence[str] = (FILE,)) -> DataFrame:
    """Rows broken per rule and in total (V9). A row may break several rules."""
    return annotated.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("is_bad")).alias("valid_rows"),
        F.count_if("is_bad").alias("invalid_rows"),
        *[F.count_if(rule).alias(rule) for rule in RULES],
    )
