"""Exact top-k inner products of integer vectors by a Voronoi join.

Pivots (a bounded sample, lowest hash first) divide data and queries into cells. Summaries of a
cell are how many ids it holds and the radius around its pivot. For a group of queries with
pivot g and radius u, a datum x scores between <g,x> - u|x| and <g,x> + u|x| with any of them
(Cauchy-Schwarz), and a cell with pivot c and radius r between <g,c> -+ (u|c| + (|g| + u) r).
The cells with the best lower bounds that together hold k + 1 ids give the group a threshold;
only data whose upper bound reaches it are replicated to the group. They are solved there, in
blocks, by exact integer products. Data with a wide spread are hardly pruned; results are exact
all the same.

Products run in double precision where all partial sums are below 2**53, which makes them exact,
and in Python integers beyond.

Edge cases. Vectors that are null, of another length than most, or hold null or non-finite
components take no part; zero vectors do. A component whose scaled value doesn't fit into a
long, or a score that doesn't, stops the job. Repeated rows count once, ties go to smaller
ids, and a query never finds its own id. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.vectors import (
    QUERY_ROWS,
    best,
    blocks_for,
    classes,
    merged,
    numbered_queries,
    same_length,
    stacked,
    usable,
)
from riskloom.session import pinned

PIVOTS = 64
GROUP_QUERIES = 512


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def nearest(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and distance to its pivot of each vector."""
    square = (vectors**2).sum(1)[:, None] - 2 * vectors @ pivots.T + (pivots**2).sum(1)
    cell = square.argmin(1)
    return cell, np.linalg.norm(vectors - pivots[cell], axis=1)


def _celled(rows: DataFrame, shared, extra: str) -> DataFrame:
    """``rows`` with their cell and distance, computed in Arrow batches."""

    def run(batches):
        for batch in batches:
            cell, distance = nearest(stacked(batch.vector), shared.value)
            yield batch.assign(cell=cell.astype(np.int32), distance=distance)

    return rows.mapInPandas(run, f"vector array<long>, {extra}, cell int, distance double")


def thresholds(queries: list, data: list, pivots: np.ndarray, need: int) -> dict[int, tuple[float, float]]:
    """Radius and threshold of each group, from (cell, radius, count) of data and query cells."""
    norms = np.linalg.norm(pivots, axis=1)
    cells = np.array([row.cell for row in data])
    radius, count = (np.array([row[i] for row in data], np.float64) for i in (1, 2))
    found = {}
    for group, u, _ in queries:
        center = pivots[cells] @ pivots[group]
        low = center - u * norms[cells] - (norms[group] + u) * radius
        order = np.argsort(-low)
        enough = np.searchsorted(np.cumsum(count[order]), need)
        bound = low[order][enough] if enough < len(order) else -np.inf
        found[group] = (u, bound - 1e-6 * (1 + abs(bound)) if np.isfinite(bound) else -np.inf)
    return found


def search(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` largest inner products; both hold (id, vector)."""
    context = rows.sparkSession.sparkContext
    kept = pinned(classes(rows, k + 1))
    numbered = numbered_queries(queries)
    count, asked = kept.count(), numbered.count()
    if not count or not asked:
        empty = queries.where("false")
        return empty.selectExpr("id AS query_id", "0 AS rank", "id AS vec_id", "id AS score")
    order = (F.xxhash64("vector"), F.col("vector"))
    sample = kept.orderBy(*order).limit(PIVOTS).select("vector").collect()
    pivots = np.array([row.vector for row in sample], np.float64)
    # Fewer pivots for the queries, so that a group is worth a copy of the data it needs.
    few = min(len(pivots), max(1, -(-asked // GROUP_QUERIES)))
    asking = _celled(numbered, context.broadcast(pivots[:few]), "qid long")
    data = pinned(_celled(kept, context.broadcast(pivots), "ids array<long>"))
    summary = data.groupBy("cell").agg(F.max("distance"), F.sum(F.size("ids")))
    groups = asking.groupBy("cell").agg(F.max("distance"), F.count(F.lit(1))).collect()  # PIVOTS rows
    bounds = thresholds(groups, summary.collect(), pivots, k + 1)  # PIVOTS rows
    slots = {row[0]: max(1, -(-row[2] // QUERY_ROWS)) for row in groups}
    blocks = blocks_for(count)
    facts = context.broadcast((pivots, bounds))

    def replicated(batches):
        pivots, bounds = facts.value
        own = sorted(bounds)
        for batch in batches:
            vectors = stacked(batch.vector)
            norms = np.linalg.norm(vectors, axis=1)
            inner = vectors @ pivots[own].T
            for i, group in enumerate(own):
                u, least = bounds[group]
                upper = inner[:, i] + u * norms
                rows = batch[upper + 1e-6 * (1 + np.abs(upper)) >= least]
                if len(rows):
                    yield rows[["vector", "ids"]].assign(cell=np.int32(group))

    deal = lambda n: F.pmod(F.xxhash64("vector", F.lit(1)), n).cast("int")
    spread = data.mapInPandas(replicated, "vector array<long>, ids array<long>, cell int")
    width = F.create_map(*[F.lit(x) for pair in slots.items() for x in pair])[F.col("cell")]
    spread = spread.select(
        "vector",
        "ids",
        "cell",
        deal(F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), width - 1)).alias("slot"),
    )
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asking = asking.select("qid", "vector", "cell", deal(width).alias("slot"), each_block)

    def solve(asking: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(data):
            return pd.DataFrame({"qid": [], "vec_id": [], "score": []})
        ids = data.ids.to_numpy()
        score = products(stacked(asking.vector, np.int64), stacked(data.vector, np.int64))
        found = [best(ids, row, k + 1) for row in score]
        return pd.DataFrame(
            {
                "qid": np.repeat(asking.qid.to_numpy(), [len(ids) for ids, _ in found]),
                "vec_id": np.concatenate([ids for ids, _ in found]),
                "score": np.concatenate([value for _, value in found]),
            }
        )

    names = ["cell", "slot", "block"]
    pairs = asking.groupBy(*names).cogroup(spread.groupBy(*names))
    return merged(pairs.applyInPandas(solve, "qid long, vec_id long, score long"), numbered, queries, k)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """20 largest integer inner products of every 20th vector."""
    rows = table(spark, folder, "embeddings").where("vec_id IS NOT NULL")
    rows = rows.where(usable("embedding"))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("long"))
    rows, _ = same_length(rows.select(F.col("vec_id").alias("id"), scaled.alias("vector")), "vector")
    return search(rows, rows.where("id % 20 = 0"), 20)


ORACLE = """
WITH valid AS (
    SELECT DISTINCT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM valid q JOIN valid c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
