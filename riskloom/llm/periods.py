"""Maximal periodic runs of words in whole texts, and texts without the repeated part of a run.

A run is a stretch of words with smallest period q and at least ``max(6, 4q)`` words that no
neighbouring word extends. In a run, 3q words at least stand before an equal word q places
on, one of them at a multiple of 3q: so for every q the grid of these multiples meets every
run of period q. Grid places whose word recurs after q words are extended to both sides by
longest common extensions on a grammar of the text (:mod:`riskloom.llm.recompression`). A
stretch found with several periods has the smallest; Fine and Wilf's theorem makes it one of
the candidates. A text of n words has about n ln(n) / 3 grid places.

Documents are independent: one Arrow pass without a shuffle, texts of a slice share one grammar
with separators between them.

Edge cases. A null or empty text has no words and no runs. Words are compared by 64-bit
hashes of their bytes. Repeated rows and equal ids are treated alike, each on its own. Empty
tables stay empty. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, table, utf8
from riskloom.llm.hashing import row_slices, words
from riskloom.llm.recompression import Grammar

SHORTEST, POWER = 6, 4
SLICE = 1 << 20  # bytes of text that share a grammar
GRID = 1 << 20  # grid places looked at in one go

#: Of a document id and its number of words, the places its words are taken from (None: as they are).
Order = Callable[[int | None, int], np.ndarray | None]


def _candidates(names: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, period) of all grid places whose word recurs a period later."""
    count = np.diff(bounds)
    periods = count // POWER
    edges = np.concatenate([[0], np.cumsum(periods)])
    document = np.repeat(np.arange(len(count)), periods)
    period = np.arange(edges[-1]) - edges[document] + 1
    step = (POWER - 1) * period
    places = -(-(count[document] - period) // step)
    ends = np.cumsum(places)
    found = []
    start = 0
    while start < len(period):
        stop = max(int(np.searchsorted(ends, ends[start] - places[start] + GRID, "right")), start + 1)
        own = slice(start, stop)
        which = np.repeat(np.arange(start, stop), places[own])
        number = np.arange(len(which)) - np.repeat(np.cumsum(places[own]) - places[own], places[own])
        place = bounds[document[which]] + number * step[which]
        same = names[place] == names[place + period[which]]
        found.append((document[which[same]], place[same], period[which[same]]))
        start = stop
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found))


def runs_of(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start in it, length, period) of all runs, by document, start and period.

    ``hashes`` are the words of all documents, ``bounds`` their n + 1 edges.
    """
    _, names = np.unique(hashes, return_inverse=True)
    document, place, period = _candidates(names, bounds)
    if not len(place):
        return (np.zeros(0, np.int64),) * 4
    # Only documents with a candidate go into the grammar, each behind a separator.
    held = np.unique(document)
    count = np.diff(bounds)[held]
    base = np.concatenate([[0], np.cumsum(count + 1)])
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    sequence = np.zeros(base[-1] + 1, np.int64)
    sequence[base] = int(names.max()) + 1 + np.arange(len(base))
    sequence[np.repeat(base[:-1] + 1, count) + inside] = names[np.repeat(bounds[held], count) + inside]
    first = base[np.searchsorted(held, document)] + 1
    i = first + place - bounds[document]
    grammar = Grammar(sequence)
    ahead = grammar.extension(i, i + period)
    behind = grammar.extension(i - 1, i + period - 1, back=True)
    length, start = ahead + behind + period, i - behind - first
    kept = length >= np.maximum(SHORTEST, POWER * period)
    document, start, length, period = (part[kept] for part in (document, start, length, period))
    order = np.lexsort((period, length, start, document))
    document, start, length, period = (part[order] for part in (document, start, length, period))
    new = np.ones(len(start), bool)
    new[1:] = (document[1:] != document[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    document, start, length, period = (part[new] for part in (document, start, length, period))
    order = np.lexsort((period, start, document))
    return document[order], start[order], length[order], period[order]


def periodic_runs(documents: DataFrame, order: Order | None = None) -> DataFrame:
    """doc_id, runs and the collapsed text of every row of (doc_id, text).

    ``runs`` are (start, length, period) by start and period; ``collapsed`` has the words, joined by
    one space, that are in no run or among the first ``period`` words of every run they are in.
    """
    small_batches(documents.sparkSession)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            raw, offsets = utf8(batch.column(1))
            for first, end, part, own in row_slices(raw, offsets, SLICE):
                hashes, _, _, bounds = words(part, own)
                taken: dict[int, np.ndarray] = {}
                for row in range(end - first) if order is not None else ():
                    places = order(ids[first + row].as_py(), int(bounds[row + 1] - bounds[row]))
                    if places is not None:
                        taken[row] = places
                        hashes[bounds[row] : bounds[row + 1]] = hashes[bounds[row] + places]
                document, start, length, period = runs_of(hashes, bounds)
                edges = np.searchsorted(document, np.arange(end - first + 1))
                # Each run takes its words behind the first period: +1 where that begins, -1 at its end.
                change = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(change, bounds[document] + start + period, 1)
                np.add.at(change, bounds[document] + start + length, -1)
                kept = np.cumsum(change[:-1]) == 0
                texts = []
                for row in range(end - first):
                    pieces = part[own[row] : own[row + 1]].tobytes().split()
                    if row in taken:
                        pieces = [pieces[place] for place in taken[row].tolist()]
                    if edges[row] < edges[row + 1]:
                        pieces = compress(pieces, kept[bounds[row] : bounds[row + 1]].tolist())
                    texts.append(b" ".join(pieces).decode())
                spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(run_type))
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), spans)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), lists, pa.array(texts, pa.string())], names=["doc_id", "runs", "collapsed"]
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def planted(doc_id: int | None, count: int) -> np.ndarray | None:
    """The order of words that the query prescribes: for about a tenth of the ids, all from a
    place on repeat a stretch of words. A null id keeps its words."""
    if doc_id is None or not count:
        return None
    number = zlib.crc32(str(doc_id).encode())
    if number % 10:
        return None
    given = number // 10
    start = given % count
    period = 1 + (count - start) // (3 + given % 8)
    places = np.arange(count)
    places[start:] = start + (places[start:] - start) % period
    return places


def strongest(runs: str) -> Column:
    """The run of greatest length / period, exactly; ties by start, then period. Null without runs."""

    def order(x: Column, y: Column) -> Column:
        a, b = x.length * y.period, y.length * x.period
        return (
            F.when(a != b, F.when(a > b, -1).otherwise(1))
            .when(x.start != y.start, F.when(x.start < y.start, -1).otherwise(1))
            .otherwise(F.when(x.period < y.period, -1).when(x.period > y.period, 1).otherwise(0))
        )

    return F.get(F.array_sort(runs, order), F.lit(0))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, with the words of a tenth of them reordered as the query prescribes."""
    found = periodic_runs(table(spark, folder, "documents"), planted)
    best = found.withColumn("best", strongest("runs"))
    line = lambda run: F.concat_ws(",", run.start, run.length, run.period)
    lines = F.aggregate("runs", F.lit(""), lambda text, run: F.concat(text, line(run), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
