"""Documents to packed sequences in five stages, each of which applies one operator.

Every stage works on all that the one before kept. All but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import jaccard, language, packing, quality, substrings
from riskloom.llm.common import free_name, stored, table
from riskloom.session import pinned


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or like none of the learned languages, go."""
    return language.recognised(docs)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be of low quality go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that share 5-word shingles at 0.8, the one with the smallest id stays (a null id is the smallest).

    Rows are told apart by their id; if ids repeat or are null, by a number of their own.
    """
    key, rows = "doc_id", docs
    repeated = docs.groupBy(F.col("doc_id").cast("long").alias("id")).count().where("count > 1 OR id IS NULL")
    if repeated.limit(1).count():
        key = free_name(docs, "row")
        rows = stored(docs.withColumn(key, F.monotonically_increasing_id()))  # written, so that numbers stay
    found = jaccard.components(rows.select(F.col(key).alias("doc_id"), "text"), size=5, percent=80)
    if key == "doc_id":
        gone = found.where("component_id <> doc_id").select("doc_id")
    else:
        own = rows.select(F.col(key).alias("doc_id"), F.col("doc_id").alias("id"))
        found = pinned(found.select("doc_id", "component_id").join(own, "doc_id"))
        stays = found.groupBy("component_id").agg(F.min(F.struct("id", "doc_id")).alias("first"))
        gone = found.join(stays.select("first.doc_id"), "doc_id", "left_anti").select(F.col("doc_id").alias(key))
    gone = pinned(gone)
    if gone.count() <= jaccard.BROADCAST_KEYS:  # then the texts need not be shuffled
        gone = F.broadcast(gone)
    return rows.join(gone, key, "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 20 words that stood earlier are cut; documents without a word left go."""
    return substrings.rewritten(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of at most 2048 tokens."""
    return packing.packed_documents(docs)


STAGES = [
    ("language ID", tell_language),
    ("quality classifier", judge_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
