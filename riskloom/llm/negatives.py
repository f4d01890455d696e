"""Hard negatives: rows of another label whose score lies just below that of a positive.

Scores are integer inner products. Anchors and candidates meet in tiles; a tile's scores are
one Strassen product of int64 matrices, padded with zeros, whose additions are exact: int64
arithmetic is a ring modulo 2**64, so results are right whenever they fit themselves.

* Pass 1 keeps, for each anchor and tile, a heap of its best rows of the same label.
* Pass 2 keeps, for each anchor, positive and tile, a heap of the best rows of other labels
  within the positive's window.

Heaps are sorted by score, then id, and merge by taking the first of their union: in a task over its
tiles, before the shuffle (the window's group limit), and after it. Candidates are dealt by
a hash of their id into blocks of about ``BLOCK_ROWS``, anchors into slots of about
``ANCHOR_ROWS``; every slot meets every block, which is the search of a stated set against all
rows, and a task holds one of each. Equal vectors or one frequent label change nothing in that.

Edge cases. Rows without an id, label or vector, or with a null or non-finite component take no
part, nor do rows whose scaled components have a sum of squares of 2**62 or more, whose scores may
not fit a long. Of rows with one id the smallest (label, vector) counts. Shorter vectors are padded with zeros. Ties go to the smaller
id. Anchors without a positive, and positives without a row in their window, give no row.
Empty tables stay empty. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.vectors import usable
from riskloom.session import pinned

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
LEAST_BLOCKS, BLOCK_ROWS, ANCHOR_ROWS = 24, 4096, 2048
TILE = 512  # anchors multiplied at a time
LEAF = 16  # matrices with a side up to this are multiplied directly
_NONE = np.iinfo(np.int64).min


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices by Strassen's seven products, with odd sides padded by zeros."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    x, y, z = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a11, a12, a21, a22 = a[:x, :y], a[:x, y:], a[x:, :y], a[x:, y:]
    b11, b12, b21, b22 = b[:y, :z], b[:y, z:], b[y:, :z], b[y:, z:]
    p1 = product(a11 + a22, b11 + b22, leaf)
    p2 = product(a21 + a22, b11, leaf)
    p3 = product(a11, b12 - b22, leaf)
    p4 = product(a22, b21 - b11, leaf)
    p5 = product(a11 + a12, b22, leaf)
    p6 = product(a21 - a11, b11 + b12, leaf)
    p7 = product(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * x, 2 * z), np.int64)
    out[:x, :z] = p1 + p4 - p5 + p7
    out[:x, z:] = p3 + p5
    out[x:, :z] = p2 + p4
    out[x:, z:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of int64, shorter ones padded with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for row, vector in enumerate(vectors):
        out[row, : len(vector)] = vector
    return out


def heap(scores: np.ndarray, allowed: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``keep`` highest allowed scores of each row, best first.

    Columns come in order of their ids, and the first of equal scores is taken.
    """
    open_scores = np.where(allowed, scores, _NONE)
    rows, columns, lines = [], [], np.arange(len(scores))
    for _ in range(min(keep, scores.shape[1])):
        best = open_scores[lines].argmax(axis=1) if len(lines) else np.zeros(0, np.int64)
        filled = open_scores[lines, best] != _NONE
        lines, best = lines[filled], best[filled]
        rows.append(lines)
        columns.append(best)
        open_scores[lines, best] = _NONE
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(columns)


def prepared(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(id, label, vector of longs) of the rows that take part, one per id; ``rows`` hold (id, label, vector)."""
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL").where(usable("vector"))
    scaled = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = rows.select(F.col("id").cast("long").alias("id"), "label", scaled.alias("vector"))
    fits = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x) < F.lit(2.0**62)
    rows = rows.where(fits).select("id", "label", F.transform("vector", lambda x: x.cast("long")).alias("vector"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")


def _met(anchors: DataFrame, candidates: DataFrame, blocks: int, slots: int, solve, schema: str) -> DataFrame:
    """``solve`` of every slot of anchors with every block of candidates."""
    deal = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = candidates.select(*[F.col(name).alias(name) for name in candidates.columns])  # new attributes
    asking = anchors.select("*", deal("id", slots).alias("slot"), every(blocks).alias("block"))
    spread = candidates.select("*", deal("id", blocks).alias("block"), every(slots).alias("slot"))
    keys = ["slot", "block"]
    return asking.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(solve, schema)


def _tiles(anchors: pd.DataFrame, candidates: pd.DataFrame):
    """(anchors, scores) tile by tile; the columns of the scores are ``candidates`` in their order."""
    width = max(anchors.vector.map(len).max(), candidates.vector.map(len).max())
    right = np.ascontiguousarray(matrix(candidates.vector, width).T)
    for start in range(0, len(anchors), TILE):
        tile = anchors.iloc[start : start + TILE]
        yield tile, product(matrix(tile.vector, width), right)


def _best_positives(keep: int):
    def solve(anchors: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        names = ["anchor", "id", "score"]
        candidates = candidates.sort_values("id", ignore_index=True)
        found = []
        for tile, scores in _tiles(anchors, candidates) if len(anchors) and len(candidates) else ():
            same = tile.label.to_numpy()[:, None] == candidates.label.to_numpy()
            other = tile.id.to_numpy()[:, None] != candidates.id.to_numpy()
            row, column = heap(scores, same & other, keep)
            parts = tile.id.to_numpy()[row], candidates.id.to_numpy()[column], scores[row, column]
            found.append(pd.DataFrame(dict(zip(names, parts))))
        return pd.concat(found) if found else pd.DataFrame({name: [] for name in names})

    return solve


def _best_negatives(keep: int, low: int, high: int):
    def solve(anchors: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        names = ["anchor", "positive", "positive_score", "id", "score"]
        candidates = candidates.sort_values("id", ignore_index=True)
        found = []
        for tile, scores in _tiles(anchors, candidates) if len(anchors) and len(candidates) else ():
            other = tile.label.to_numpy()[:, None] != candidates.label.to_numpy()
            width = tile.near.map(len).max()
            for place in range(width):
                has = tile.near.map(len).to_numpy() > place
                own, line = tile[has], np.flatnonzero(has)
                hits = [near[place] for near in own.near]
                positive, score = (np.array([hit[name] for hit in hits], np.int64) for name in ("id", "score"))
                # Whole scores within the window: from ceil(low %) to floor(high %), both included.
                least = [-(-low * int(x) // 100) for x in score]
                most = [high * int(x) // 100 for x in score]
                inside = scores[line]
                inside = (inside >= np.array(least)[:, None]) & (inside <= np.array(most)[:, None])
                row, column = heap(scores[line], other[line] & inside, keep)
                parts = (
                    own.id.to_numpy()[row],
                    positive[row],
                    score[row],
                    candidates.id.to_numpy()[column],
                    scores[line[row], column],
                )
                found.append(pd.DataFrame(dict(zip(names, parts))))
        return pd.concat(found) if found else pd.DataFrame({name: [] for name in names})

    return solve


def _first(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """The merged heaps: the ``keep`` best of each key, numbered as ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """Negatives of every anchor and positive; both inputs hold (id, label, vector of longs), unique ids.

    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    rows, anchors = pinned(rows), pinned(anchors)
    blocks = max(LEAST_BLOCKS, -(-rows.count() // BLOCK_ROWS))
    slots = max(1, -(-anchors.count() // ANCHOR_ROWS))
    near = _met(anchors, rows, blocks, slots, _best_positives(positives), "anchor long, id long, score long")
    near = _first(near, ["anchor"], positives)
    lists = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("near"))
    asking = anchors.join(lists, F.col("id") == F.col("anchor")).drop("anchor")
    schema = "anchor long, positive long, positive_score long, id long, score long"
    found = _met(asking, rows, blocks, slots, _best_negatives(negatives, low, high), schema)
    found = _first(found, ["anchor", "positive"], negatives)
    return found.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every 50th vector; every 7th vector has its label moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings")
    rows = prepared(rows.select(F.col("vec_id").alias("id"), moved.alias("label"), F.col("embedding").alias("vector")))
    return mine(rows, rows.where("id % 50 = 0"))


ORACLE = """
WITH valid AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id, c.label,
        list_sum([p[1] * p[2] FOR p IN list_zip(a.v, c.v)])::BIGINT AS score
    FROM valid a JOIN valid c ON a.vec_id <> c.vec_id
    WHERE a.vec_id % 50 = 0
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
    s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id
WHERE s.label <> s.own AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
