"""Language identification: the family first, then linear SVMs between its languages.

Training takes at most ``PER_LANGUAGE`` documents of each label that occurs (those with the
lowest hash, so the sample doesn't depend on order or partitions).
Families come from ``FAMILIES``; a label that isn't listed is a family of its own. A linear
support vector machine per family tells it from the others, and one per pair of languages of a
family separates the two. Each is fitted in its own Spark task. Features are square roots of
hashed byte trigrams of the whole lower-cased text, scaled to length one.

Prediction takes the family with the largest margin, then lets the pairs of that family vote;
equal votes are settled by the sum of margins. The score is the product of the logistic values
of the family's margin and of the mean margin of the winner's pairs.

The model is one row of ``WIDTH`` numbers per machine: one per family and one per pair of
languages of a family. A family's machine sees the samples of all labels in one task.

Documents are recognised if they have a letter and score at least as much as all but the
``REJECTED`` share of all labelled documents that are held out: each of them is scored, and the
rank is selected exactly. If nothing could be learned or no such document is there, a letter is enough.

Edge cases. A text that is null or has no letter is ``und`` with score 0, as is every text if no
label could be learned. Null labels aren't learned from. Repeated rows are predicted each.
Texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.llm.common import fold, small_batches, table, utf8
from riskloom.llm.features import FOLDED, WIDTH, counts, unit
from riskloom.llm.hashing import row_slices
from riskloom.operators.ordered import quantiles
from riskloom.session import pinned

PER_LANGUAGE = 500
BROADCAST_ROWS = 500_000
REJECTED = 0.005
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk ky",
    "semitic": "ar he am mt",
    "indic": "hi bn ur mr gu pa ne",
    "celtic": "ga cy gd br",
    "baltic": "lt lv",
    "malayic": "id ms jv su tl",
}
UNKNOWN = "und"
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, "own:" + language)


def vectors(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    for first, end, found in counts(texts, FOLDED):
        yield first, end, unit(np.sqrt(found))


def has_letter(texts: pa.Array) -> np.ndarray:
    raw, offsets = utf8(texts)
    found = np.zeros(len(texts), bool)
    for first, end, part, own in row_slices(raw, offsets):
        seen = np.concatenate([[0], np.cumsum(_LETTER[part], dtype=np.int32)])
        found[first:end] = seen[own[1:]] > seen[own[:-1]]
    for row in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[row] = any(c.isalpha() for c in raw[offsets[row] : offsets[row + 1]].tobytes().decode())
    return found


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 4.0, passes: int = 20) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss; the last column of ``x`` is 1, for the bias."""
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diagonal = np.einsum("ij,ij->i", x, x, dtype=np.float64) + 0.5 / penalty
    random = np.random.default_rng(7)
    for _ in range(passes):
        for i in random.permutation(len(x)):
            gradient = y[i] * (w @ x[i]) - 1 + alpha[i] * 0.5 / penalty
            new = max(alpha[i] - gradient / diagonal[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def sample(labelled: DataFrame) -> DataFrame:
    """At most PER_LANGUAGE rows of each label."""
    hashed = labelled.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(3)).alias("h"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = hashed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PER_LANGUAGE)
    chosen = pinned(chosen.select("doc_id", "lang").distinct())
    if chosen.count() <= BROADCAST_ROWS:  # then the texts need not be shuffled
        chosen = F.broadcast(chosen)
    return labelled.join(chosen, ["doc_id", "lang"])


def fit(documents: DataFrame) -> tuple[list[str], list[tuple[str, str, np.ndarray]]]:
    """Known languages and machines (positive side, negative side, weights); families are told from ``""``, the others."""
    small_batches(documents.sparkSession)
    labelled = documents.where("lang IS NOT NULL AND text IS NOT NULL AND NOT held_out")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row.astype(np.float16).tobytes() for _, _, x in vectors(batch.column(1)) for row in x]
            columns = [batch.column(0), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "x"])

    # Written once: the sample is small, and the texts behind it are not read for each problem.
    rows = sample(labelled).select("lang", "text").mapInArrow(featured, "lang string, x binary")
    rows = pinned(rows)
    known = sorted(row[0] for row in rows.select("lang").distinct().collect())  # one row per label
    families = sorted({family_of(code) for code in known})
    problems = [(family, "") for family in families] if len(families) > 1 else []
    for family in families:
        own = [code for code in known if family_of(code) == family]
        problems += [(a, b) for i, a in enumerate(own) for b in own[i + 1 :]]
    members = []
    for number, (a, b) in enumerate(problems):
        for code in known:
            if b == "":
                members.append((code, number, 1 if family_of(code) == a else -1))
            elif code in (a, b):
                members.append((code, number, 1 if code == a else -1))
    if not problems:
        return known, []
    sides = rows.sparkSession.createDataFrame(members, "lang string, problem int, side int")

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "x"])
        x = np.ones((len(rows), WIDTH + 1), np.float32)
        for at, row in enumerate(rows.x):
            x[at, :-1] = np.frombuffer(row, np.float16)
        w = svm(x, rows.side.to_numpy(np.float64))
        return pd.DataFrame({"problem": rows.problem.iloc[:1], "w": [w.astype(np.float64).tobytes()]})

    fitted = rows.join(F.broadcast(sides), "lang").groupBy("problem").applyInPandas(train, "problem int, w binary")
    machines = [(*problems[row.problem], np.frombuffer(row.w)) for row in fitted.orderBy("problem").collect()]
    return known, machines


class Model:
    def __init__(self, known: list[str], machines: list[tuple[str, str, np.ndarray]]):
        self.known = known
        self.families = sorted({family_of(code) for code in known})
        self.machines = [(a, b) for a, b, _ in machines]
        self.weights = np.array([w for _, _, w in machines]).reshape(-1, WIDTH + 1).T

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the language in ``known``, and score, of each row."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        column = {pair: margins[:, i] for i, pair in enumerate(self.machines)}
        none = np.zeros(len(x))
        own = np.stack([column.get((family, ""), none) for family in self.families], 1)
        chosen = own.argmax(1)
        score = 1 / (1 + np.exp(-4 * own.max(1))) if len(self.families) > 1 else np.ones(len(x))
        best = np.zeros(len(x), np.int64)
        for f, family in enumerate(self.families):
            codes = [i for i, code in enumerate(self.known) if family_of(code) == family]
            votes, sums = np.zeros((2, len(x), len(codes)))
            for i, a in enumerate(codes):
                for j in range(i + 1, len(codes)):
                    margin = column[(self.known[a], self.known[codes[j]])]
                    votes[:, i] += margin >= 0
                    votes[:, j] += margin < 0
                    sums[:, i] += margin
                    sums[:, j] -= margin
            rows = chosen == f
            pick = (votes + 1e-3 * np.tanh(sums / max(len(codes), 1))).argmax(1)
            best[rows] = np.array(codes)[pick][rows]
            if len(codes) > 1:
                mean = sums[np.arange(len(x)), pick] / (len(codes) - 1)
                score = np.where(rows, score / (1 + np.exp(-4 * mean)), score)
        return best, score


def identified(texts: pa.Array, known: list[str], machines: list) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    if known:
        own, letters = Model(known, machines), has_letter(texts)
        for first, end, x in vectors(texts):
            best, score = own.predict(x)
            inside = letters[first:end]
            names[first:end][inside] = np.array(known, object)[best][inside]
            scores[first:end][inside] = score[inside]
    return names, scores


def identify(documents: DataFrame, model: tuple) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row (doc_id, text, held_out)."""
    schema = StructType(
        [documents.schema["doc_id"], documents.schema["held_out"]]
        + StructType.fromDDL("lang_pred string, score double").fields
    )
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = identified(batch.column(2), *shared.value)
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return documents.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def least_score(documents: DataFrame, model: tuple) -> float:
    """The score below which a language can't be told: exact, from all labelled documents that are held out."""
    if not model[1]:
        return 0.0
    unseen = documents.where("lang IS NOT NULL AND text IS NOT NULL AND held_out")
    scores = pinned(identify(unseen, model).where(F.col("lang_pred") != UNKNOWN).select("score"))
    rows = scores.count()
    if rows < 2:
        return float(scores.first().score) if rows else 0.0
    # The share whose product with rows - 1 is the wanted rank, so that nothing is interpolated.
    place, last = int(REJECTED * rows), rows - 1
    share = min((math.nextafter(place / last, to) for to in (place / last, 0, 1)), key=lambda p: abs(p * last - place))
    return float(quantiles(scores, "score", {"least": share}, steady=True).first().least)


def recognised(documents: DataFrame) -> DataFrame:
    """``documents`` without those whose language can't be told: no letter, or too low a score."""
    rows = documents.select("doc_id", "text", "lang", (fold("doc_id", 4) == 2).alias("held_out"))
    known, machines = fit(rows)
    least = least_score(rows, (known, machines))
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            kept = has_letter(texts)
            if shared.value:
                kept &= identified(texts, known, shared.value)[1] >= least
            yield batch.filter(pa.array(kept))

    shared = documents.sparkSession.sparkContext.broadcast(machines)
    return documents.mapInArrow(run, documents.schema)


def predicted(documents: DataFrame) -> DataFrame:
    """Fits on the documents that aren't held out and predicts all."""
    rows = documents.select("doc_id", "text", "lang", (fold("doc_id", 4) == 2).alias("held_out"))
    return identify(rows, fit(rows))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    return predicted(table(spark, folder, "documents"))
