"""Running totals, positions and exact quantiles over an order that no single task could hold.

A plain ``Window.orderBy`` without a partition key, or one whose key holds a third of
the rows, is evaluated by one task. Here the rows are range-partitioned on a *total*
order instead, so every slice has about the same number of rows whatever the keys look
like. Each slice is summed, the slice sums are accumulated (one row per key and slice)
and added to a window that never leaves its slice.

The slices are checkpointed because two passes have to agree on them: range bounds come
from sampling, and a recomputed sample may cut differently.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import pinned

SLICE = "_slice"

Order = Sequence[str | Column]


def ranged(df: DataFrame, order: Order, slices: int | None = None) -> DataFrame:
    """Cut ``df`` into contiguous slices of ``order`` (keys first) and name the slice.

    Without ``slices`` the number follows ``spark.sql.shuffle.partitions`` and may be
    coalesced at run time; neighbouring slices are merged, so the order survives. The
    result is for one pass; :func:`sliced` is for several.
    """
    parts = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    return parts.withColumn(SLICE, F.spark_partition_id())


def sliced(df: DataFrame, order: Order, slices: int | None = None) -> DataFrame:
    """As :func:`ranged`, written once so that several passes agree."""
    return pinned(ranged(df, order, slices))


def slice_offsets(
    cut: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str] | None = None,
    prior_max: Mapping[str, str] | None = None,
) -> DataFrame:
    """What earlier slices of a key add up to: one row per key and slice."""
    sums, prior_max = dict(sums or {}), dict(prior_max or {})
    totals = cut.groupBy(*keys, SLICE).agg(
        *[F.sum(source).alias(f"_sum_{out}") for out, source in sums.items()],
        *[F.max(source).alias(f"_max_{out}") for out, source in prior_max.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = {
        out: F.coalesce(F.sum(f"_sum_{out}").over(earlier), F.lit(0)).alias(f"_off_{out}")
        for out in sums
    }
    tops = [F.max(f"_max_{out}").over(earlier).alias(f"_top_{out}") for out in prior_max]
    inside = [f"_sum_{out}" for out in sums]
    return totals.select(*keys, SLICE, *inside, *before.values(), *tops)


def running(
    cut: DataFrame,
    keys: Sequence[str],
    order: Order,
    sums: Mapping[str, str] | None = None,
    prior_max: Mapping[str, str] | None = None,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """Add running sums (current row included) and maxima of strictly earlier rows.

    ``cut`` comes from :func:`sliced` with the same keys and order. ``sums`` and
    ``prior_max`` map an output column to its input column. Only slices listed in
    ``offsets`` are computed (default: all).
    """
    sums, prior_max = dict(sums or {}), dict(prior_max or {})
    if offsets is None:
        offsets = slice_offsets(cut, keys, sums, prior_max)
    offsets = offsets.drop(*[f"_sum_{out}" for out in sums])
    here = Window.partitionBy(*keys, SLICE).orderBy(*order)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    if not keys:
        # One row per slice: the bound is the number of slices, not the data.
        offsets = F.broadcast(offsets)
    added = {out: F.col(f"_off_{out}") + F.sum(source).over(upto) for out, source in sums.items()}
    added |= {
        out: F.greatest(F.col(f"_top_{out}"), F.max(source).over(before))
        for out, source in prior_max.items()
    }
    names = [*cut.columns, *added]
    return cut.join(offsets, [*keys, SLICE]).withColumns(added).select(*names)


def positions(df: DataFrame, order: Order, out: str = "position") -> DataFrame:
    """Global row number from 1 along a total order."""
    one = f"_one_{out}"
    cut = sliced(df.withColumn(one, F.lit(1).cast("long")), order)
    return running(cut, [], order, sums={out: one}).drop(one, SLICE)


# Bins of a selection round, rounds before the rest is sorted, and the longest list of cells to broadcast.
BINS, ROUNDS = 1 << 14, 2
BROADCAST_CELLS = 100_000


def _bin() -> Column:
    """Number of the bin of ``_v`` within its cell: never falls as the value grows.

    Each step of the formula is monotone in double arithmetic, which is all that selection
    needs. The ends have bins of their own, so infinities and NaN leave after one round.
    """
    v, low, high = F.col("_v"), F.col("_low"), F.col("_high")
    width = high - low
    inside = F.floor((v - low) / width * BINS)
    finite = (width > 0) & (width < float("inf"))
    return (
        F.when(v <= low, 0)
        .when(v >= high, BINS + 2)
        .when(finite, F.least(F.greatest(inside, F.lit(0)), F.lit(BINS)) + 1)
        .otherwise(1)
    )


def _in_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows with the cell they fall into; the cells of a group don't overlap."""
    if cells.count() <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    within = (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high"))
    matched = (F.col("_g") == F.col("_of")) & within
    return rows.join(cells.withColumnRenamed("_g", "_of"), matched).drop("_of")


def _held_ranks() -> Column:
    """Wanted ranks among the ``_n`` rows that end at the running count ``_end``."""
    begin = F.col("_before") + F.col("_end") - F.col("_n")
    return F.filter("_ranks", lambda rank: (rank >= begin) & (rank < begin + F.col("_n")))


def _narrower(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The bins of ``cells`` that hold a wanted rank, as the cells of the next round."""
    binned = _in_cells(rows, cells).groupBy("_g", "_size", "_ranks", "_before", "_low", _bin().alias("_bin"))
    bins = binned.agg(F.sum("_n").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    # At most BINS + 3 rows a cell.
    upto = Window.partitionBy("_g", "_low").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    held = bins.withColumn("_end", F.sum("_n").over(upto)).withColumn("_held", _held_ranks()).where(F.size("_held") > 0)
    return held.select(
        "_g",
        "_size",
        F.col("_held").alias("_ranks"),
        (F.col("_before") + F.col("_end") - F.col("_n")).alias("_before"),
        F.col("_least").alias("_low"),
        F.col("_most").alias("_high"),
    )


def _sorted_out(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """As :func:`_narrower` down to single values, by sorting the rows of the cells."""
    known = ["_g", "_size", "_ranks", "_before", "_low"]
    counts = _in_cells(rows, cells).groupBy(*known, "_v").agg(F.sum("_n").alias("_n"))
    ends = running(sliced(counts, ["_g", "_low", "_v"]), ["_g", "_low"], ["_v"], {"_end": "_n"})
    held = ends.withColumn("_held", _held_ranks()).where(F.size("_held") > 0)
    return held.select("_g", "_size", F.col("_held").alias("_ranks"), F.col("_v").alias("_low"))


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    weight: str | None = None,
    steady: bool = False,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    ``percentile`` would keep all distinct values of a group in one aggregation buffer. Here
    the wanted ranks are selected: a histogram between least and greatest value shows which
    bins hold them, a second one looks into those bins only, and what two histograms can't
    tell apart is sorted. Each histogram combines before its shuffle, so a group of any size
    is no burden and no pass orders all rows.

    ``probabilities`` maps output column to probability; ``weight`` names a column with the
    number of rows that a row stands for. Passes must agree: unless ``df`` is ``steady``
    (files, or written before), key, value and weight are written once.
    """
    by = list(by)
    copies = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    rows = df.where(F.col(value).isNotNull())
    rows = rows.select(group.alias("_g"), F.col(value).cast("double").alias("_v"), copies.alias("_n"))
    rows = rows if steady else pinned(rows)
    spots = {
        name: F.lit(float(probability)) * (F.col("_size") - 1)
        for name, probability in probabilities.items()
    }
    ranks = [rank(spot).cast("long") for spot in spots.values() for rank in (F.floor, F.ceil)]
    spans = rows.groupBy("_g").agg(
        F.sum("_n").alias("_size"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    cells = pinned(
        spans.select(
            "_g",
            "_size",
            F.array_distinct(F.array(*ranks)).alias("_ranks"),
            F.lit(0).cast("long").alias("_before"),
            "_low",
            "_high",
        )
    )
    known = ["_g", "_size", "_ranks", "_low"]
    found = [cells.where("_low = _high").select(*known)]
    rest = cells.where("_low < _high")
    for _ in range(ROUNDS):
        if rest.isEmpty():
            break
        cells = pinned(_narrower(rows, rest))
        found.append(cells.where("_low = _high").select(*known))
        rest = cells.where("_low < _high")
    if not rest.isEmpty():
        found.append(_sorted_out(rows, rest).select(*known))

    def at(rank: Column) -> Column:
        return F.max(F.when(F.array_contains("_ranks", rank.cast("long")), F.col("_low")))

    picks = []
    for name, spot in spots.items():
        picks += [
            at(F.floor(spot)).alias(f"_low_{name}"),
            at(F.ceil(spot)).alias(f"_high_{name}"),
            F.max(spot - F.floor(spot)).alias(f"_part_{name}"),
        ]
    picked = reduce(DataFrame.unionByName, found).groupBy(*["_g"] * bool(by)).agg(*picks)
    return picked.select(
        *[F.col("_g")[name].alias(name) for name in by],
        *[
            (
                F.col(f"_low_{name}")
                + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * F.col(f"_part_{name}")
            ).alias(name)
            for name in probabilities
        ],
    )
