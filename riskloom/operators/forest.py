"""Isolation forest (Liu, Ting, Zhou 2008) as Spark jobs (M1, M2).

Spark draws one small sample per tree in a single pass, grows the trees in parallel and
scores rows in Arrow batches. Sampling is decided by hashes of the transaction id, so the
model depends on the seed and the data, not on the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ordered import quantiles
from riskloom.session import pinned

# Forest parameters.
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.02

NODES = "tree int, node int, feature int, split double, left int, right int, path double"

_EULER = 0.5772156649015329


@dataclass(frozen=True)
class Forest:
    """``nodes`` has at most ``trees * (2 * sample - 1)`` rows, however large the data."""

    nodes: DataFrame
    columns: tuple[str, ...]
    sample: int
    offset: float


def average_path(size: float) -> float:
    """Mean depth of an unsuccessful search among ``size`` points."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (np.log(size - 1.0) + _EULER) - 2.0 * (size - 1.0) / size


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(2**53)) / F.lit(float(2**53))


def draw_samples(
    df: DataFrame, columns: Sequence[str], rows: int, seed: int, trees: int, sample: int
) -> DataFrame:
    """``sample`` rows without replacement for every tree, in one pass over ``df``.

    Rows are thinned first, so that only the few survivors are paired with all trees. The
    rate leaves half as many again as needed; the smallest hashes are kept per tree.
    """
    rate = min(1.0, 1.5 * sample / rows)
    thin = min(1.0, 8.0 * trees * rate)
    values = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in columns]
    pairs = (
        df.where(_uniform(F.col("transaction_id"), F.lit(seed), F.lit("row")) < thin)
        .select("transaction_id", *values)
        .withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("_draw", _uniform(F.col("transaction_id"), F.col("tree"), F.lit(seed)))
        .where(F.col("_draw") < rate / thin)
        # A fixed number of parts: the sample is small, but growing its trees is not cheap.
        .repartition(min(trees, df.sparkSession.sparkContext.defaultParallelism), "tree")
    )
    smallest = Window.partitionBy("tree").orderBy("_draw", "transaction_id")
    return (
        pairs.withColumn("_rank", F.row_number().over(smallest))
        .where(F.col("_rank") <= sample)
        .drop("_draw")
    )


def grow(points: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple]:
    """One tree as ``(node, feature, split, left, right, path)``; ``feature`` is -1 at a leaf."""
    nodes: list[tuple | None] = [None]
    todo = [(0, points, 0)]
    while todo:
        node, inside, depth = todo.pop()
        low, high = inside.min(axis=0), inside.max(axis=0)
        choices = np.flatnonzero(high > low)
        if depth >= limit or len(inside) <= 1 or len(choices) == 0:
            nodes[node] = (node, -1, 0.0, node, node, depth + average_path(len(inside)))
            continue
        feature = int(rng.choice(choices))
        split = float(rng.uniform(low[feature], high[feature]))
        below = inside[:, feature] <= split
        left, right = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[node] = (node, feature, split, left, right, 0.0)
        todo += [(left, inside[below], depth + 1), (right, inside[~below], depth + 1)]
    return nodes


def fit(df: DataFrame, columns: Sequence[str], *args, **options) -> Forest:
    """The forest of :func:`fit_and_score`."""
    return fit_and_score(df, columns, *args, **options)[0]


def fit_and_score(
    df: DataFrame,
    columns: Sequence[str],
    seed: int = 42,
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    sample: int = SAMPLE,
    out: str = "raw_score",
) -> tuple[Forest, DataFrame]:
    """Grow the forest and score the rows it was grown on.

    The offset puts ``contamination`` of ``df`` above 0. It needs the score of every row,
    so the scored rows (without the features) are returned as well.
    """
    columns = list(columns)
    rows = df.count()
    if rows == 0:
        raise ValueError("no rows to fit on")
    sample = min(sample, rows)
    limit = int(np.ceil(np.log2(max(sample, 2))))

    def grow_one(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        points = group.sort_values("_rank")[columns].to_numpy()
        grown = grow(points, limit, np.random.default_rng([seed, tree]))
        names = ["node", "feature", "split", "left", "right", "path"]
        return pd.DataFrame(grown, columns=names).assign(tree=tree)[
            ["tree", *names]
        ]

    drawn = draw_samples(df, columns, rows, seed, trees, sample)
    nodes = pinned(drawn.groupBy("tree").applyInPandas(grow_one, NODES))
    plain = Forest(nodes, tuple(columns), sample, 0.0)
    scored = pinned(with_raw_score(df, plain, out).drop(*columns))
    offset = float(quantiles(scored, out, {"offset": 1.0 - contamination}, steady=True).first()["offset"])
    forest = Forest(nodes, tuple(columns), sample, offset)
    return forest, scored.withColumn(out, F.col(out) - F.lit(offset))


def _arrays(nodes: DataFrame) -> tuple[np.ndarray, ...]:
    """The node table as arrays of shape (trees, nodes); its size does not grow with the data."""
    table = nodes.toPandas().sort_values(["tree", "node"])
    tree = table["tree"].rank(method="dense").to_numpy(dtype=int) - 1
    shape = (tree.max() + 1, int(table["node"].max()) + 1)
    feature = np.zeros(shape, dtype=np.int64)
    split = np.full(shape, np.inf)
    left = np.tile(np.arange(shape[1]), (shape[0], 1))
    right = left.copy()
    path = np.zeros(shape)
    node = table["node"].to_numpy()
    leaf = table["feature"].to_numpy() < 0
    feature[tree, node] = np.where(leaf, 0, table["feature"])
    split[tree, node] = np.where(leaf, np.inf, table["split"])
    left[tree, node] = table["left"]
    right[tree, node] = table["right"]
    path[tree, node] = table["path"]
    return feature, split, left, right, path


def mean_paths(points: np.ndarray, arrays: tuple[np.ndarray, ...], levels: int) -> np.ndarray:
    feature, split, left, right, path = arrays
    flat, width = points.ravel(), points.shape[1]
    start = np.arange(len(points)) * width
    total = np.zeros(len(points))
    for tree in range(len(path)):
        at = np.zeros(len(points), dtype=np.int64)
        for _ in range(levels):
            value = flat[start + feature[tree].take(at)]
            at = np.where(value <= split[tree].take(at), left[tree].take(at), right[tree].take(at))
        total += path[tree].take(at)
    return total / len(path)


def with_raw_score(df: DataFrame, forest: Forest, out: str = "raw_score") -> DataFrame:
    """Add the anomaly score; larger is more anomalous, above 0 is beyond the offset (M2)."""
    shared = df.sparkSession.sparkContext.broadcast(_arrays(forest.nodes))
    levels = int(np.ceil(np.log2(max(forest.sample, 2))))
    scale = average_path(forest.sample) or 1.0
    offset = forest.offset

    @F.pandas_udf("double")
    def raw(*columns: pd.Series) -> pd.Series:
        points = np.ascontiguousarray(np.column_stack([c.to_numpy(dtype=float) for c in columns]))
        return pd.Series(np.power(2.0, -mean_paths(points, shared.value, levels) / scale) - offset)

    values = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in forest.columns]
    return df.withColumn(out, raw(*values))
