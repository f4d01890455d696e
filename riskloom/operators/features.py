"""Causal per-user features.

Every frame ends at the current row or before it, so a row's features never change when
later rows arrive. Users up to ``hot_rows`` rows share one exchange on the user: windows on
the JVM, then one Arrow pass for the prefix medians. Larger users are cut by time and
value instead (see :func:`_hot`), so that no task ever holds one user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scalar import hours_between, instant, micros, money, safe_ratio
from riskloom.operators.ordered import SLICE, running, sliced
from riskloom.operators.prefix_median import hot_medians, streamed
from riskloom.schema import FEATURES
from riskloom.session import pinned, prepare

REQUIRED = ["transaction_id", "user_id", "event_time", "amount"]

# The length of the trailing window and the two neutral fill values.
DAY_MICROS = 24 * 60 * 60 * 1_000_000
NO_PREVIOUS_TXN = -1.0
NO_BASELINE_RATIO = 1.0

# Above this many rows a user is cut into slices. The values of a user of this length fit a
# Python worker easily, and ranking them again with each batch stays cheap.
HOT_ROWS = 100_000

# A hot-user list up to this length is a few MB and is broadcast; a longer one is shuffled.
BROADCAST_USERS = 100_000

_INPUTS = {"_amount_d": "_base_amount", "_gap": "_base_gap"}


def _base(df: DataFrame, carry: Sequence[str]) -> DataFrame:
    missing = [name for name in [*REQUIRED, *carry] if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    amount = F.coalesce(money(df, "amount"), F.lit(0).cast("decimal(12,2)"))
    time = instant(df, "event_time")
    return df.where(time.isNotNull()).select(
        "transaction_id",
        "user_id",
        time.alias("event_time"),
        *[F.col(name).alias(f"carry_{name}") for name in carry],
        amount.alias("_amount"),
        # Rows without a user form one group of their own.
        F.coalesce(F.col("user_id").cast("string"), F.lit("\u0001")).alias("_u"),
        micros(time).alias("_t"),
    )


def _moves(base: DataFrame, opened_at_start: bool) -> DataFrame:
    """Each row enters its window and leaves it a day later, as two rows of one timeline.

    With a closed window a row leaves after everything at exactly 24 hours; with a
    half-open one it leaves before. Leaving rows carry no other columns.
    """
    enters = F.struct(
        F.lit(0).alias("_kind"),
        F.col("_t").alias("_at"),
        F.col("_amount").alias("_delta"),
        F.lit(1).cast("long").alias("_step"),
    )
    leaves = F.struct(
        F.lit(-1 if opened_at_start else 1).alias("_kind"),
        (F.col("_t") + F.lit(DAY_MICROS)).alias("_at"),
        (-F.col("_amount")).cast("decimal(12,2)").alias("_delta"),
        F.lit(-1).cast("long").alias("_step"),
    )
    entering = F.col("_move._kind") == 0
    kept = ["_u", "transaction_id"]
    return base.withColumn("_move", F.explode(F.array(enters, leaves))).select(
        *kept,
        *[F.when(entering, F.col(name)).alias(name) for name in base.columns if name not in kept],
        "_move.*",
        F.when(entering, F.col("_t")).alias("_entered"),
        entering.cast("long").alias("_row"),
    )


_TIMELINE = ["_u", "_at", "_kind", "transaction_id"]


def _entered(base: DataFrame, opened_at_start: bool = False) -> DataFrame:
    """Trailing sum, count and previous time of users that fit one task.

    A RANGE frame adds up a whole day again for each row, which is quadratic in a dense
    day. On the timeline both are running totals, so a row costs two steps however many
    rows its day has. Exploding after the exchange keeps the shuffle at one row each.
    """
    order = Window.partitionBy("_u").orderBy(*_TIMELINE[1:])
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    moves = _moves(base.repartition("_u"), opened_at_start)
    totals = {
        "_total": F.sum("_delta").over(upto),
        "_count": F.sum("_step").over(upto),
        "_previous": F.max("_entered").over(before),
    }
    return moves.withColumns(totals).where("_kind = 0").drop("_delta", "_step", "_row", "_entered")


def _light(base: DataFrame) -> DataFrame:
    """All features of users that fit one task, on one exchange and one sort."""
    earlier = (
        Window.partitionBy("_u")
        .orderBy(*_TIMELINE[1:])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = (
        _entered(base)
        .withColumn("_base_count", F.avg("_count").over(earlier))
        .withColumn("_gap", hours_between(F.col("_t"), F.col("_previous")))
        .withColumn("_amount_d", F.col("_amount").cast("double"))
        .sortWithinPartitions(*_TIMELINE)
        .drop("_previous", "_amount", "_at", "_kind")
    )
    return streamed(rows, "_u", _INPUTS)


def _trailing(base: DataFrame, opened_at_start: bool = False) -> DataFrame:
    """Trailing sum, count, position and previous time as prefix sums over the timeline."""
    cut = sliced(_moves(base, opened_at_start), _TIMELINE)
    totals = running(
        cut,
        ["_u"],
        _TIMELINE[1:],
        sums={"_total": "_delta", "_count": "_step", "_position": "_row"},
        prior_max={"_previous": "_entered"},
    )
    return totals.where("_kind = 0").drop("_delta", "_step", "_row", "_entered")


def _hot(base: DataFrame, slice_rows: int) -> DataFrame:
    """The same columns for users that no single task should hold."""
    entered = pinned(
        _trailing(base)
        .withColumn("_gap", hours_between(F.col("_t"), F.col("_previous")))
        .withColumn("_amount_d", F.col("_amount").cast("double"))
        .drop("_previous", "_amount")
    )
    counted = running(entered, ["_u"], _TIMELINE[1:], sums={"_count_sum": "_count"})
    rows = counted.withColumn(
        "_base_count",
        F.when(
            F.col("_position") > 1,
            (F.col("_count_sum") - F.col("_count")) / (F.col("_position") - 1),
        ),
    ).drop("_count_sum", "_at", "_kind", SLICE)
    return hot_medians(rows, "_u", "_position", _INPUTS, slice_rows).drop("_position", "_rows")


def split_hot(base: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary users and, if there are any, rows of users above ``hot_rows``.

    Hot rows carry the number of rows of their user as ``_rows``.
    """
    counts = base.groupBy("_u").agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.where(F.col("_rows") > hot_rows)
    if hot.isEmpty():
        return base, None
    hot = pinned(hot)
    if hot.count() <= BROADCAST_USERS:
        hot = F.broadcast(hot)
    return base.join(hot, "_u", "left_anti"), base.join(hot, "_u")


def _window_values() -> dict[str, Column]:
    total = F.col("_total").cast("double")
    return {
        "total_amount_24h": total,
        "txn_count_24h": F.col("_count"),
        "avg_amount_24h": total / F.col("_count").cast("double"),
    }


def trailing_windows(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The three window features alone (W1-W3), without a pass through Python."""
    prepare(df.sparkSession)
    light, hot = split_hot(_base(df, []), hot_rows)
    values = [value.alias(name) for name, value in _window_values().items()]
    names = ["transaction_id", "user_id", "event_time", *values]
    rows = _entered(light).select(*names)
    return rows if hot is None else rows.unionByName(_trailing(hot).select(*names))


def compute(
    df: DataFrame,
    carry: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    slice_rows: int | None = None,
) -> DataFrame:
    """One row per transaction with the seven features (W9); ``carry`` passes columns through.

    Rows without an event time cannot be placed and are left out; a missing amount is 0.
    """
    prepare(df.sparkSession)
    light, hot = split_hot(_base(df, carry), hot_rows)
    rows = _light(light)
    if hot is not None:
        rows = rows.unionByName(_hot(hot, slice_rows or hot_rows))
    count = F.col("_count").cast("double")
    values = _window_values() | {
        "hours_since_last_txn": F.coalesce("_gap", F.lit(NO_PREVIOUS_TXN)),
        "amount_vs_user_median": safe_ratio(F.col("_amount_d"), F.col("_base_amount")),
        "count_vs_user_typical": safe_ratio(count, F.col("_base_count")),
        "gap_vs_user_typical": F.coalesce(
            safe_ratio(F.col("_gap"), F.col("_base_gap")), F.lit(NO_BASELINE_RATIO)
        ),
    }
    return rows.select(
        "transaction_id",
        "user_id",
        "event_time",
        *[values[name].alias(name) for name in FEATURES],
        *[F.col(f"carry_{name}").alias(name) for name in carry],
    )


def trailing_counts(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of the same user in ``(t - 24h, t]``, for profiling."""
    prepare(df.sparkSession)
    light, hot = split_hot(_base(df, []), hot_rows)
    names = ["transaction_id", "user_id", "event_time", "txn_count_24h"]
    rows = _entered(light, opened_at_start=True).withColumnRenamed("_count", "txn_count_24h")
    rows = rows.select(*names)
    if hot is not None:
        counted = _trailing(hot, opened_at_start=True)
        rows = rows.unionByName(counted.withColumnRenamed("_count", "txn_count_24h").select(*names))
    return rows


def latest_per_user(features: DataFrame) -> DataFrame:
    """One row per user: the window of its latest transaction.

    ``max_by`` combines before the shuffle, so a user with very many rows is no burden.
    """
    last = F.max_by(
        F.struct("total_amount_24h", "txn_count_24h", "avg_amount_24h"),
        F.struct("event_time", "transaction_id"),
    )
    return (
        features.groupBy("user_id")
        .agg(last.alias("last"))
        .select(
            "user_id",
            F.col("last.total_amount_24h").cast("decimal(12,2)").alias("last_24h_total"),
            F.col("last.txn_count_24h").cast("int").alias("last_24h_txn_count"),
            F.col("last.avg_amount_24h").cast("decimal(12,2)").alias("last_24h_avg_amount"),
        )
    )
