"""Connected components of a link table, with joins that no frequent node can fill a task with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored

SALTS = 16
LEAST_PARTS, PART_ROWS = 8, 200_000


def parts_for(rows: int) -> int:
    """Files of a table of ids of about so many rows: many rounds on a small table shall not pay for empty tasks."""
    return max(LEAST_PARTS, -(-rows // PART_ROWS))


def looked_up(rows: DataFrame, key: str, spread: str, known: DataFrame, name: str, value: str) -> DataFrame:
    """``rows`` with ``value`` of ``known`` where its ``name`` equals ``key`` (inner join).

    Rows of one key are dealt over SALTS tasks by their column ``spread``.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    table = known.select(F.col(name).alias("_key"), F.col(value).alias(value), every)
    matched = (F.col(key) == F.col("_key")) & (F.col("_own") == F.col("_salt"))
    return rows.withColumn("_own", salt).join(table, matched).drop("_own", "_key", "_salt")


def connected(links: DataFrame) -> DataFrame:
    """(node, label) of every node of a link (x, y): the smallest node that links lead to.

    Labels spread to neighbours and jump to the label of their label until none changes. Each
    round is written to the shared folder as a table: a checkpoint would hand the constraints of
    its plan on to the next round, where they multiply.
    """
    edges = links.select("x", "y").union(links.select("y", "x")).toDF("x", "y").where("x <> y").distinct()
    parts = parts_for(2 * links.count())
    edges = stored(edges, parts)
    labels = edges.groupBy("x").agg(F.min("y").alias("y")).selectExpr("x AS node", "least(x, y) AS label")
    labels = stored(labels, parts)
    while True:
        near = looked_up(edges, "y", "x", labels, "node", "label").groupBy("x").agg(F.min("label").alias("near"))
        old = labels.withColumnRenamed("label", "old")
        new = old.join(near, F.col("node") == F.col("x")).selectExpr("node", "old", "least(old, near) AS label")
        new = stored(new, parts)
        # Labels are nodes, and of each only one row is needed to know where it leads.
        leads = new.select(F.col("label").alias("at")).distinct()
        leads = leads.join(new.selectExpr("node AS at", "label AS far"), "at")
        new = looked_up(new, "label", "node", leads, "at", "far").selectExpr("node", "old", "least(label, far) AS label")
        new = stored(new, parts)
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels
