"""Quality by nearest-neighbour voting in a latent-semantic space.

Training takes at most ``PER_CLASS`` labelled documents of each class (lowest hash first; only
documents that are there and have a text). Their
byte trigrams, log-damped and weighted by how few of them hold the trigram, and the share of
words that repeat the one before are factorised; the
leading ``RANK`` right singular vectors span the space. Every document is projected and compared
with all labelled vectors by exact cosine products, a block of documents at a time; the
``NEIGHBOURS`` most similar ones vote, weighted by similarity to the power ``POWER``.

What is broadcast has a fixed bound: 2 * PER_CLASS labelled vectors of RANK numbers, the
projection of WIDTH times RANK, and one weight per trigram, together below 4 MB.

Edge cases. A text without trigrams, null or empty, gets the share of label 1 in the
sample, as do all documents if one class is missing (0.5 without any label). Rows of ``labels``
with null quality or without a document teach nothing; repeated ones count once, and a document
labelled both ways counts as 1. Repeated documents are scored each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.llm.common import fold, small_batches, table, utf8
from riskloom.llm.features import WIDTH, counts, unit
from riskloom.llm.hashing import row_slices, words

PER_CLASS = 1500
RANK = 48
NEIGHBOURS = 15
POWER = 4
REPEATS = 2


def damped(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Log-damped trigram counts and, behind them, the share of words that repeat the last one."""
    raw, offsets = utf8(texts)
    repeated = np.zeros(len(texts), np.float32)
    for first, end, part, own in row_slices(raw, offsets):
        hashes, _, _, bounds = words(part, own)
        same = np.zeros(len(hashes) + 1, np.int64)
        same[2:] = np.cumsum(hashes[1:] == hashes[:-1])
        pairs = np.maximum(np.diff(bounds) - 1, 0)
        found = same[bounds[1:]] - same[np.minimum(bounds[:-1] + 1, bounds[1:])]
        repeated[first:end] = found / np.maximum(pairs, 1)
    for first, end, found in counts(texts):
        yield first, end, np.hstack([np.log1p(found), repeated[first:end, None]])


def weighted(x: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Unit rows; the share of repeats weighs up to REPEATS times all trigrams together."""
    rows = np.empty_like(x)
    np.multiply(x[:, :-1], rarity, out=rows[:, :-1])
    rows[:, -1] = REPEATS * x[:, -1] * np.linalg.norm(rows[:, :-1], axis=1)
    return unit(rows)


def sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, text) of the labelled documents that are learned from."""
    known = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("label"))
    usable = documents.where("text IS NOT NULL").select("doc_id")  # others must not take up places
    known = known.where(fold("doc_id", 3) != 1).join(usable, "doc_id", "left_semi")
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit(6)), "doc_id")
    chosen = known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PER_CLASS)
    # 2 * PER_CLASS ids at most
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen.drop("place")), "doc_id")
    return rows.where("text IS NOT NULL").dropDuplicates(["doc_id"]).select("label", "text")


def _factorised(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["label", "x"])
    x = np.stack([np.frombuffer(row, np.float16) for row in rows.x]).astype(np.float32)
    rarity = np.log((1 + len(x)) / (1 + (x[:, :-1] > 0).sum(0))).astype(np.float32) + 1
    x = weighted(x, rarity)
    random = np.random.default_rng(6)
    rank = min(RANK, len(x))
    range_of = x @ random.standard_normal((WIDTH + 1, rank + 16)).astype(np.float32)
    for _ in range(2):
        range_of = x @ (x.T @ np.linalg.qr(range_of)[0])
    q = np.linalg.qr(range_of)[0]
    space = np.linalg.svd(q.T @ x, full_matrices=False)[2][:rank].T
    known = unit(x @ space)
    parts = [rarity, space, known, rows.label.to_numpy()]
    return pd.DataFrame({"part": range(4), "data": [np.ascontiguousarray(p, np.float32).tobytes() for p in parts]})


def fit(documents: DataFrame, labels: DataFrame) -> dict[int, bytes]:
    """Trigram weights, projection, labelled vectors and their labels."""

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row.astype(np.float16).tobytes() for _, _, x in damped(batch.column(1)) for row in x]
            columns = [batch.column(0), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "x"])

    small_batches(documents.sparkSession)
    rows = sample(documents, labels).mapInArrow(featured, "label int, x binary")
    # One group: the sample has a fixed bound.
    fitted = rows.groupBy().applyInPandas(_factorised, "part int, data binary")
    return {row.part: bytes(row.data) for row in fitted.collect()}


class Model:
    def __init__(self, parts: dict[int, bytes]):
        self.rarity, space, known, self.labels = (np.frombuffer(parts[i], np.float32) for i in range(4))
        self.space = space.reshape(WIDTH + 1, -1)
        self.known = known.reshape(len(self.labels), -1)
        self.prior = float(self.labels.mean())

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.prior in (0.0, 1.0):
            return np.full(len(x), self.prior)
        cosines = unit(weighted(x, self.rarity) @ self.space) @ self.known.T
        near = np.argpartition(-cosines, min(NEIGHBOURS, len(self.labels)) - 1, 1)[:, :NEIGHBOURS]
        weights = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** POWER
        total = weights.sum(1)
        votes = (weights * self.labels[near]).sum(1)
        return np.where(total > 0, votes / np.where(total > 0, total, 1), self.prior)


def judge(documents: DataFrame, parts: dict[int, bytes]) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    fields = StructType.fromDDL("held_out boolean, score double, predicted int").fields
    schema = StructType([documents.schema["doc_id"], *fields])
    shared = documents.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value) if shared.value else None
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5)
            if model:
                for first, end, x in damped(batch.column(2)):
                    scores[first:end] = model.score(x)
            scores = np.clip(scores, 0, 1)
            columns = [batch.column(0), batch.column(1), pa.array(scores)]
            columns.append(pa.array((scores >= 0.5).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = documents.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text")
    return rows.mapInArrow(run, schema)


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(documents, fit(documents, labels))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` without those predicted to have label 0."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value) if shared.value else None
        for batch in batches:
            kept = np.ones(batch.num_rows, bool)
            if model:
                for first, end, x in damped(batch.column(place)):
                    kept[first:end] = model.score(x) >= 0.5
            yield batch.filter(pa.array(kept))

    return documents.mapInArrow(run, documents.schema)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    return judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
