"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Every row gets a number from 0 to N - 1 that depends on the rows alone, the permutation moves
number ``x`` to place ``p``, and ``p`` gives shard ``p mod shards`` and slot ``p div shards``.
Shards therefore differ by one row at most, slots have no gaps, and for any row number both
can be computed without the table (``place``), as can the row number of a place (``origin``).

Numbers. Equal rows are counted before they are shuffled and numbered as a run, so a row that
fills a third of the table costs one record per task. Distinct rows are dealt by hash into
buckets, the bucket totals (one row per bucket) are summed up, and a window numbers each
bucket. Nothing is sorted globally.

Permutation. The domain is ``a * b`` with ``a = ceil(sqrt(N))`` and ``b = ceil(N / a)``; each
round adds a hash of one half to the other. Fewer than ``a`` places lie outside 0 to N - 1. A
row that lands there walks on along its cycle, and as the places of a walk are distinct, one
step more than there are such places always suffices. About one row in ``a`` walks.

Edge cases. Nulls are values like others. Rows that are equal in all columns can't be told
apart: they get different places, and which is which doesn't matter. An empty table stays
empty. Columns named like the new ones get the new ones an underscore longer. Columns that
can't be grouped (maps) are refused by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import free_name, table

ROUNDS = 6
BUCKETS = 2048


def _half(left: Column, right: Column, size: Column, number: Column | int, seed: int) -> Column:
    number = F.lit(number) if isinstance(number, int) else number
    return F.pmod(left + F.pmod(F.xxhash64(right, number, F.lit(seed)), size), size)


def _div(value: Column, by: Column | int) -> Column:
    """Integer division that is exact for all 64-bit numbers."""
    return F.call_function("div", value, F.lit(by) if isinstance(by, int) else by)


def sides(rows: Column) -> tuple[Column, Column]:
    """Sides of the smallest near-square domain that holds ``rows`` numbers."""
    a = F.greatest(F.ceil(F.sqrt(rows.cast("double"))), F.lit(1)).cast("long")
    return a, _div(rows + a - 1, a)


def _walked(left: Column, right: Column, rows: Column, a: Column, b: Column, seed: int) -> Column:
    """Rounds repeated from a place outside until one inside is reached."""
    state = F.struct(left.alias("l"), right.alias("r"))
    steps = F.sequence(F.lit(0).cast("long"), (a * b - rows + 1) * ROUNDS - 1)

    def step(held: Column, i: Column) -> Column:
        done = (F.pmod(i, F.lit(ROUNDS)) == 0) & (held.l * b + held.r < rows)
        number = F.pmod(i, F.lit(ROUNDS)).cast("int")
        even = F.pmod(i, F.lit(2)) == 0
        moved = F.struct(
            F.when(even, _half(held.l, held.r, a, number, seed)).otherwise(held.l).alias("l"),
            F.when(even, held.r).otherwise(_half(held.r, held.l, b, number, seed)).alias("r"),
        )
        # A finished walk keeps its place: l < 0 marks it.
        found = F.struct((-held.l - 1).alias("l"), held.r.alias("r"))
        return F.when(held.l < 0, held).when(done, found).otherwise(moved)

    def value(held: Column) -> Column:
        return F.when(held.l < 0, -held.l - 1).otherwise(held.l) * b + held.r

    return F.aggregate(steps, state, step, value)


def place(df: DataFrame, number: str, rows: str, seed: int, out: str) -> DataFrame:
    """Adds ``out``: where the permutation of 0 to ``rows`` - 1 puts ``number``."""
    kept = df.columns
    a, b, left, right = (free_name(df, name) for name in ("side_a", "side_b", "left", "right"))
    size = sides(F.col(rows))
    df = df.withColumns({a: size[0], b: size[1]})
    df = df.withColumns(
        {left: _div(F.col(number), F.col(b)), right: F.pmod(number, b)}
    )
    for i in range(ROUNDS):
        moved, other, side = (left, right, a) if i % 2 == 0 else (right, left, b)
        df = df.withColumn(moved, _half(F.col(moved), F.col(other), F.col(side), i, seed))
    first = F.col(left) * F.col(b) + F.col(right)
    walked = _walked(F.col(left), F.col(right), F.col(rows), F.col(a), F.col(b), seed)
    return df.select(*kept, F.when(first < F.col(rows), first).otherwise(walked).alias(out))


def numbered(df: DataFrame, seed: int) -> tuple[DataFrame, str, str, str]:
    """Distinct rows with the number of the first copy, how many there are, and the total."""
    copies, start, total, bucket, before = (
        free_name(df, name) for name in ("copies", "start", "total", "bucket", "before")
    )
    names = df.columns
    hashed = F.xxhash64(*[F.col(name) for name in names], F.lit(seed))
    rows = df.groupBy(*names).agg(F.count(F.lit(1)).alias(copies))
    rows = rows.withColumn(bucket, F.pmod(hashed, F.lit(BUCKETS)))
    totals = rows.groupBy(bucket).agg(F.sum(copies).alias(total))  # one row per bucket
    running = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = totals.select(
        bucket,
        F.coalesce(F.sum(total).over(running), F.lit(0)).alias(before),
        F.sum(total).over(everything).alias(total),
    )
    inside = Window.partitionBy(bucket).orderBy(hashed, *names)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.col(before) + F.sum(copies).over(inside) - F.col(copies)
    # BUCKETS rows at most. A left join adds no filter to ``rows``, so its exchange is reused.
    rows = rows.join(F.broadcast(totals), bucket, "left")
    return rows.withColumn(start, first).drop(bucket, before), start, copies, total


def assign(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """All rows of ``df`` with ``row_number``, ``shard`` and ``slot``."""
    if shards < 1:
        raise ValueError("shards must be positive")
    names = df.columns
    row, shard, slot = (free_name(df, name) for name in ("row_number", "shard", "slot"))
    rows, start, copies, total = numbered(df, seed)
    at = free_name(rows, "at")
    block, width = free_name(rows, "block"), 1 << 16
    # Long runs are opened in two steps: first into blocks, then into rows.
    rows = rows.withColumn(
        block, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(width).cast("long")))
    )
    last = F.least(F.col(copies) - 1, F.col(block) + width - 1)
    rows = rows.withColumn(row, F.explode(F.sequence(F.col(start) + F.col(block), F.col(start) + last)))
    rows = place(rows, row, total, seed, at)
    return rows.select(
        *names,
        row,
        F.pmod(at, F.lit(shards)).cast("int").alias(shard),
        _div(F.col(at), shards).alias(slot),
    )


def origin(at: int, rows: int, seed_hash, seed: int = 0) -> int:
    """Row number that the permutation puts at ``at``: the rounds in reverse.

    ``seed_hash(value, round, seed)`` is xxhash64 as Spark computes it.
    """
    a = 1
    while a * a < rows:
        a += 1
    b = -(-rows // a)
    while True:
        left, right = divmod(at, b)
        for i in reversed(range(ROUNDS)):
            if i % 2 == 0:
                left = (left - seed_hash(right, i, seed) % a) % a
            else:
                right = (right - seed_hash(left, i, seed) % b) % b
        at = left * b + right
        if at < rows:
            return at


def query(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by one at most."""
    text = F.coalesce("text", F.lit(""))
    documents = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return assign(documents, shards=24, seed=20).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
