"""Median of a user's earlier values, for every row.

``percentile`` over a growing frame sorts its whole buffer again for each row, so its cost
is quadratic in a user's history. Two forms replace it:

* :func:`streamed` answers all rows of an Arrow batch at once by a wavelet matrix over their
  values; only the values of the user that goes on into the next batch are kept. It fits users
  up to the hot limit.
* :func:`hot_medians` serves users of any size. Their rows are cut into time slices of
  ``b`` rows. A median moves by at most half a rank per row, so inside a slice it can only
  be one of the slice's own rows or one of about ``b`` earlier values around the median at
  the start of the slice. Counts per time slice and value slice tell where those values
  are; only they travel to the slice. Every group is bounded by a small multiple of ``b``
  and the result is exact.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.ordered import SLICE, ranged
from riskloom.session import pinned


def _with_doubles(schema: T.StructType, names) -> T.StructType:
    wider = copy.deepcopy(schema)
    for name in names:
        wider.add(name, T.DoubleType())
    return wider


def kth_smallest(ranks: np.ndarray, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
    """For each query the ``k``-th smallest (from 0) of ``ranks[left:right]``; all at once.

    A wavelet matrix: the ranks are parted stably by their top bit, then by the next one.
    A query follows its range into the zeros or the ones, whichever hold its place, so it
    costs one step for each bit of the largest rank.
    """
    found = np.zeros(len(k), np.int64)
    for bit in range(int(ranks.max(initial=0)).bit_length() - 1, -1, -1):
        zero = (ranks >> bit) & 1 == 0
        zeros = np.concatenate([[0], np.cumsum(zero)])
        a, b = zeros[left], zeros[right]
        up = k >= b - a
        k = np.where(up, k - (b - a), k)
        left = np.where(up, zeros[-1] + left - a, a)
        right = np.where(up, zeros[-1] + right - b, b)
        found |= up.astype(np.int64) << bit
        ranks = np.concatenate([ranks[zero], ranks[~zero]])
    return found


def _middles(
    values: np.ndarray, left: np.ndarray, right: np.ndarray, size: np.ndarray, skipped: int = 0
) -> np.ndarray:
    """Median of ``size`` values (at least one) of which ``values[left:right]`` are those from rank ``skipped`` on."""
    distinct, ranks = np.unique(values, return_inverse=True)
    low = distinct[kth_smallest(ranks, left, right, (size - 1) // 2 - skipped)]
    even = np.flatnonzero(size % 2 == 0)
    high = kth_smallest(ranks, left[even], right[even], size[even] // 2 - skipped)
    low[even] = (low[even] + distinct[high]) / 2
    return low


def prefix_medians(values: np.ndarray, starts: np.ndarray, first: int = 0) -> np.ndarray:
    """Median of the earlier values of a row's owner, for the rows from ``first`` on.

    ``starts`` holds the first row of each row's owner. NaN stands for no value.
    """
    present = ~np.isnan(values)
    upto = np.concatenate([[0], np.cumsum(present)])
    left, right = upto[starts[first:]], upto[first:-1]
    result = np.full(len(left), np.nan)
    asked = np.flatnonzero(right > left)
    if len(asked):
        left, right = left[asked], right[asked]
        result[asked] = _middles(values[present], left, right, right - left)
    return result


def _doubles(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def streamed(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Add the prefix median of each ``columns`` input (a nullable double) under its new name.

    ``df`` must hold all rows of a key in one partition, sorted by key and time. A batch is
    answered as a whole; of the key that its last row belongs to, the values go on to the next.
    """
    sources, outputs = list(columns), list(columns.values())

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, seen = None, {name: np.empty(0) for name in sources}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column(key)
            new = np.ones(len(keys), bool)
            new[0] = keys[0].as_py() != owner
            new[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            begins = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
            medians = []
            for name in sources:
                past = np.empty(0) if new[0] else seen[name]
                starts = np.where(begins < 0, 0, begins + len(past))
                starts = np.concatenate([np.zeros(len(past), np.int64), starts])
                values = np.concatenate([past, _doubles(batch.column(name))])
                found = prefix_medians(values, starts, len(past))
                medians.append(pa.array(found, pa.float64(), from_pandas=True))
                last = values[starts[-1] :]
                seen[name] = last[~np.isnan(last)]
            owner = keys[-1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *medians], names=[*batch.schema.names, *outputs]
            )

    return df.mapInArrow(fill, _with_doubles(df.schema, outputs))


def medians_in_slice(
    window: np.ndarray, skipped: int, size: int, values: np.ndarray
) -> np.ndarray:
    """Prefix medians of one slice.

    ``window`` holds the sorted earlier values from rank ``skipped`` on, out of ``size``
    earlier values in all; ``values`` are the slice's own values in time order (NaN: none).
    """
    present = ~np.isnan(values)
    known = np.cumsum(present) - present
    result = np.full(len(values), np.nan)
    asked = np.flatnonzero(known + size)
    if len(asked):
        pool = np.concatenate([window, values[present]])
        right = len(window) + known[asked]
        result[asked] = _middles(pool, np.zeros_like(right), right, known[asked] + size, skipped)
    return result


def _history(rows: DataFrame, key: str, columns: Mapping[str, str], sizes: DataFrame) -> DataFrame:
    """The earlier values that can become a median inside each time slice.

    Returns ``(_owner, _for, _series, _value, _n, _below, _size, _low, _high)``: ``_n``
    copies of ``_value``; ``_below`` earlier values lie under the value slice it came from.
    """
    spark = rows.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    series = F.explode(
        F.array(*[F.struct(F.lit(s).alias("_series"), F.col(s).alias("_value")) for s in columns])
    )
    stacked = rows.select(key, "_q", "_b", series.alias("_s")).select(key, "_q", "_b", "_s.*")
    counts = (
        stacked.where(F.col("_value").isNotNull())
        .groupBy(key, "_series", "_value", "_q", "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # Value slices of about the length of a time slice. Equal values share a rank, so they
    # stay in one slice; ``_v`` numbers the slices in the order of their values.
    place = F.rank().over(Window.partitionBy(key, "_series", SLICE).orderBy("_value"))
    cut = pinned(
        ranged(counts, [key, "_series", "_value"])
        .withColumn("_part", F.floor((place - 1) / F.col("_b")))
        .withColumn("_v", F.col(SLICE) * F.lit(2**32) + F.col("_part"))
        .drop(SLICE, "_part", "_b")
    )

    # How many values of each value slice were seen before each time slice.
    cells = cut.groupBy(key, "_series", "_v", "_q").agg(F.sum("_n").alias("_n"))
    last = F.floor((F.col("_rows") - 1) / F.col("_b"))
    grid = (
        cells.select(key, "_series", "_v")
        .distinct()
        .join(sizes, key)
        .withColumn("_q", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    )
    earlier = (Window.unboundedPreceding, -1)
    by_time = Window.partitionBy(key, "_series", "_v").orderBy("_q").rowsBetween(*earlier)
    by_rank = Window.partitionBy(key, "_series", "_q").orderBy("_v")
    half = F.floor(F.col("_b") / 2)
    seen = (
        grid.join(cells, [key, "_series", "_v", "_q"], "left")
        .withColumn("_before", F.coalesce(F.sum("_n").over(by_time), F.lit(0)))
        .where("_before > 0")
        .withColumn("_upto", F.sum("_before").over(by_rank))
        .withColumn("_size", F.sum("_before").over(Window.partitionBy(key, "_series", "_q")))
        .withColumn("_below", F.col("_upto") - F.col("_before"))
        .withColumn(
            "_low", F.greatest(F.lit(0), F.floor((F.col("_size") - 1) / 2) - half - F.lit(1))
        )
        .withColumn("_high", F.floor(F.col("_size") / 2) + half + F.lit(1))
    )
    wanted = seen.where("_below <= _high AND _upto > _low").select(
        key, "_series", "_v", F.col("_q").alias("_for"), "_below", "_size", "_low", "_high"
    )
    # The value slice around the median is wanted by nearly every time slice: salted.
    salted = wanted.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    values = cut.withColumn("_salt", F.pmod(F.xxhash64("_value", "_q"), F.lit(salts)))
    return (
        values.join(salted, [key, "_series", "_v", "_salt"])
        .where(F.col("_q") < F.col("_for"))
        .groupBy(key, "_series", "_for", "_value", "_below", "_size", "_low", "_high")
        .agg(F.sum("_n").alias("_n"))
        .withColumnRenamed(key, "_owner")
    )


def hot_medians(
    rows: DataFrame, key: str, position: str, columns: Mapping[str, str], slice_rows: int
) -> DataFrame:
    """Prefix medians for keys of any size.

    ``position`` numbers the rows of a key from 1, ``_rows`` holds how many it has.
    """
    sources, outputs = list(columns), list(columns.values())
    # A slice is never shorter than sqrt(rows): the grid of slices stays below the rows.
    length = F.greatest(F.lit(slice_rows).cast("long"), F.ceil(F.sqrt("_rows")))
    placed = rows.withColumn("_b", length).withColumn(
        "_q", F.floor((F.col(position) - 1) / F.col("_b"))
    )
    sizes = placed.select(key, "_rows", "_b").distinct()
    history = _history(placed, key, columns, sizes)
    # New attributes, as both sides of the cogroup descend from the same rows.
    history = history.select(*[F.col(name).alias(name) for name in history.columns])

    def fill(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by(position)
        for name, out in zip(sources, outputs):
            values = left.column(name).to_pandas().to_numpy(dtype=float)
            past = right.filter(pc.equal(right.column("_series"), name)).sort_by("_value")
            window, skipped, size = np.empty(0), 0, 0
            if past.num_rows:
                size, low, high = (past.column(c)[0].as_py() for c in ("_size", "_low", "_high"))
                ends = past.column("_below")[0].as_py() + np.cumsum(past.column("_n").to_numpy())
                starts = ends - past.column("_n").to_numpy()
                kept = np.clip(np.minimum(ends, high + 1) - np.maximum(starts, low), 0, None)
                window = np.repeat(past.column("_value").to_numpy(), kept)
                skipped = low
            medians = medians_in_slice(window, skipped, size, values)
            left = left.append_column(out, pa.array(medians, pa.float64(), from_pandas=True))
        return left

    return (
        placed.groupBy(key, "_q")
        .cogroup(history.groupBy("_owner", "_for"))
        .applyInArrow(fill, _with_doubles(placed.schema, outputs))
        .drop("_q", "_b")
    )
