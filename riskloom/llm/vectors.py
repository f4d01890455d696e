"""What both vector searches share: valid vectors, classes of equal vectors, and merging.

Equal vectors score alike, so of each class only the ``keep`` smallest ids can appear among the
nearest of anything. The rest is dropped before the shuffle, which is why one vector may fill
any share of the table. Queries with equal vectors are likewise searched once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import pinned

LEAST_BLOCKS, BLOCK_ROWS, QUERY_ROWS = 24, 4096, 4096


def usable(vector: str) -> Column:
    """Not null, and all components finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def same_length(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows whose vectors have the most common length, and that length (0 without rows)."""
    sizes = rows.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = sizes.n if sizes else 0
    return rows.where(F.size(vector) == size), size


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(vector, ids): distinct vectors with their ``keep`` smallest ids in order."""
    order = Window.partitionBy("vector").orderBy("id")
    few = rows.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def numbered_queries(queries: DataFrame) -> DataFrame:
    """(vector, qid): each distinct query vector with a number of its own, written once."""
    distinct = queries.select("vector").distinct()
    return pinned(distinct.withColumn("qid", F.monotonically_increasing_id()))


def blocks_for(rows: int) -> int:
    return max(LEAST_BLOCKS, -(-rows // BLOCK_ROWS))


def best(ids: list, scores: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` best (id, score) among classes with these id lists, ties to smaller ids."""
    if len(scores) > keep:
        least = np.partition(scores, len(scores) - keep)[len(scores) - keep]
        chosen = np.flatnonzero(scores >= least)
    else:
        chosen = np.arange(len(scores))
    flat = np.concatenate([ids[i] for i in chosen]).astype(np.int64)
    value = np.repeat(scores[chosen], [len(ids[i]) for i in chosen])
    order = np.lexsort((flat, -value))[:keep]
    return flat[order], value[order]


def stacked(vectors: pd.Series, kind=np.float64) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(kind)


def merged(found: DataFrame, numbered: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Nearest ``k`` of every query from (qid, vec_id, score) of all blocks; drops the own id."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    one = F.struct(F.col("place"), F.col("vec_id"), F.col("score"))
    lists = top.groupBy("qid").agg(F.sort_array(F.collect_list(one)).alias("near"))
    lists = lists.join(numbered, "qid").select("vector", "near")
    rows = queries.distinct().join(lists, "vector")
    others = F.filter("near", lambda x: x.vec_id != F.col("id"))
    rows = rows.select("id", F.posexplode(F.slice(others, 1, k)).alias("rank", "hit"))
    return rows.select(
        F.col("id").alias("query_id"),
        (F.col("rank") + 1).alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.score").alias("score"),
    )
