"""Removal of word runs that occurred before, found by fixed-block anchors.

Reference blocks are the ``BLOCK`` words at every multiple of BLOCK in a document. A run of
``WINDOW`` words (at least 2 * BLOCK - 1) holds a whole reference block wherever it starts, so if it
occurs twice, each place holds a rolling run of BLOCK words that is a reference block of the
other. The work has three steps:

1. Probe: the hash of every rolling run, with a mark on reference blocks, goes to the bucket of
   its hash, once per document. Runs that stand in several places, one of them a reference
   block, are anchors and are reported to their documents.
2. Extend: around its anchors each document hashes the windows that contain one, which joins
   neighbouring anchors to maximal repeats. These hashes meet in buckets again, where all
   documents but the one with the smallest id learn which of their windows came earlier.
3. Remove: words covered by such a window, or by one that stood earlier in the same document.

Documents, not positions, are shipped: 4 bytes for each different run of a document in step 1
and 8 for each candidate window in step 2, as packed arrays per bucket. Runs shared by documents of one
batch (FLUSH runs) are settled there and sent on once, so a run that stands in a third of all
documents costs one entry per batch. There are as many buckets as shuffle partitions; a bucket
is about (words / buckets) entries. Step 1 may report too much (32-bit hashes), which costs
time only; windows are compared by 64-bit hashes.

Edge cases. Null and empty texts have no words. Documents are ordered by id, a null id first;
rows with the same id don't count as earlier than each other, so repeated rows get equal
results. Texts with fewer words than a window lose nothing. Empty tables stay empty. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.llm.common import free_name, small_batches, table, utf8
from riskloom.llm.hashing import grams, row_slices, words

WINDOW = 20
BLOCK = 10
FLUSH = 1 << 20  # runs or windows that are settled among themselves at a time
_PACKED = "bucket int, settled boolean, docs binary, counts binary, hashes binary, marks binary"
_FIRST = np.iinfo(np.int64).min


def _first_of_runs(*keys: np.ndarray) -> np.ndarray:
    """Marks where any of the sorted keys changes."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return new


def _packed(bucket: np.ndarray, doc: np.ndarray, hashes: np.ndarray, marks: np.ndarray, settled: bool) -> list[tuple]:
    """One packed row per bucket: its documents, entries per document, hashes and marks."""
    order = np.lexsort((doc, bucket))
    bucket, doc, hashes, marks = bucket[order], doc[order], hashes[order], marks[order]
    edges = np.append(np.flatnonzero(_first_of_runs(bucket)), len(bucket))
    rows = []
    for a, b in zip(edges[:-1], edges[1:]):
        start = np.append(np.flatnonzero(_first_of_runs(doc[a:b])), b - a)
        rows.append(
            (
                int(bucket[a]),
                settled,
                doc[a:b][start[:-1]].tobytes(),
                np.diff(start).astype(np.uint32).tobytes(),
                hashes[a:b].tobytes(),
                np.packbits(marks[a:b]).tobytes(),
            )
        )
    return rows


def _tables(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 4]
    for start in range(0, len(rows), 1000):
        parts = zip(*rows[start : start + 1000])
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(parts, kinds)], names=_NAMES)


_NAMES = [part.split()[0] for part in _PACKED.split(", ")]


def _ids(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _probe(buckets: int, window: int, block: int):
    """Packed rolling runs of each batch of (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            ids = _ids(batch.column(0))
            raw, offsets = utf8(batch.column(1))
            for first, _, part, own in row_slices(raw, offsets):
                found, _, _, bounds = words(part, own)
                full = np.diff(bounds) >= window
                runs, edges = grams(found, bounds, block)
                row = np.repeat(np.arange(len(own) - 1), np.diff(edges))
                reference = (np.arange(len(runs)) - edges[row]) % block == 0
                inside = full[row]
                row, runs, reference = row[inside], runs[inside], reference[inside]
                order = np.lexsort((~reference, runs, row))
                row, runs, reference = row[order], runs[order], reference[order]
                once = _first_of_runs(row, runs)
                held.append((ids[first + row[once]], runs[once], reference[once]))
                if sum(len(part[0]) for part in held) >= FLUSH:
                    yield from _tables(_probed(held, buckets))
                    held = []
        if held:
            yield from _tables(_probed(held, buckets))

    return run


def _probed(held: list[tuple], buckets: int) -> list[tuple]:
    """Packed rows of some documents' runs; a run that several of them have is settled."""
    doc, hashed, mark = map(np.concatenate, zip(*held))
    order = np.lexsort((~mark, hashed))
    doc, hashed, mark = doc[order], hashed[order], mark[order]
    leader = _first_of_runs(hashed)
    size = np.diff(np.append(np.flatnonzero(leader), len(hashed)))
    shared = np.repeat(size > 1, size)
    low = (hashed & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    place = ((hashed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    rows = _packed(place[leader], doc[leader], low[leader], mark[leader], False)
    return rows + _packed(doc[shared] % buckets, doc[shared], low[shared], mark[shared], True)


def _opened(rows: pd.DataFrame, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, hashes, marks = [np.zeros(0, np.int64)], [np.zeros(0, kind)], [np.zeros(0, bool)]
    for row in rows.itertuples():
        counts = np.frombuffer(row.counts, np.uint32)
        docs.append(np.repeat(np.frombuffer(row.docs, np.int64), counts))
        hashes.append(np.frombuffer(row.hashes, kind))
        marks.append(np.unpackbits(np.frombuffer(row.marks, np.uint8), count=int(counts.sum())).astype(bool))
    return np.concatenate(docs), np.concatenate(hashes), np.concatenate(marks)


def _by_document(doc: np.ndarray, hashes: np.ndarray) -> pd.DataFrame:
    order = np.argsort(doc, kind="stable")
    doc, hashes = doc[order], hashes[order]
    edges = np.append(np.flatnonzero(_first_of_runs(doc)), len(doc))
    found = [hashes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
    return pd.DataFrame({"key": doc[edges[:-1]], "found": found})


def _to_owners(doc: np.ndarray, hashes: np.ndarray, buckets: int) -> pd.DataFrame:
    """What a bucket tells documents, packed by the bucket of the document."""
    rows = _packed(doc % buckets, doc, hashes, np.zeros(len(doc), bool), True)
    return pd.DataFrame(rows, columns=_NAMES)


def _owned(kind):
    """One row per document with all that the buckets told it."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        doc, hashes, _ = _opened(rows, kind)
        return _by_document(doc, hashes)

    return run


def _anchors(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Runs of a bucket that stand in several places, one of them a reference block."""
    settled_doc, settled, _ = _opened(rows[rows.settled], np.uint32)
    doc, hashes, mark = _opened(rows[~rows.settled], np.uint32)
    order = np.argsort(hashes, kind="stable")
    doc, hashes, mark = doc[order], hashes[order], mark[order]
    start = np.flatnonzero(_first_of_runs(hashes))
    size = np.diff(np.append(start, len(hashes)))
    if len(start):
        anchor = np.repeat((size > 1) & np.logical_or.reduceat(mark, start), size)
        doc, hashes = doc[anchor], hashes[anchor]
    return _to_owners(np.concatenate([settled_doc, doc]), np.concatenate([settled, hashes]), buckets)


def _earlier(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Windows of a bucket that a smaller id also has."""
    settled_doc, settled, _ = _opened(rows[rows.settled], np.uint64)
    doc, hashes, _ = _opened(rows[~rows.settled], np.uint64)
    order = np.lexsort((doc, hashes))
    doc, hashes = doc[order], hashes[order]
    start = np.flatnonzero(_first_of_runs(hashes))
    size = np.diff(np.append(start, len(hashes)))
    later = doc > np.repeat(doc[start], size)
    told = np.concatenate([settled_doc, doc[later]]), np.concatenate([settled, hashes[later]])
    return _to_owners(*told, buckets)


def _extend(buckets: int, window: int, block: int):
    """Packed windows around anchors of each batch of (key, text, found)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            ids = _ids(batch.column(0))
            raw, offsets = utf8(batch.column(1))
            found = batch.column(2)
            for first, end, part, own in row_slices(raw, offsets):
                hashed, _, _, bounds = words(part, own)
                runs, run_edges = grams(hashed, bounds, block)
                wide, wide_edges = grams(hashed, bounds, window)
                low = (runs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                for row in range(end - first):
                    a, b = wide_edges[row], wide_edges[row + 1]
                    if a == b:
                        continue
                    known = np.frombuffer(found[first + row].as_py() or b"", np.uint32)
                    hit = np.isin(low[run_edges[row] : run_edges[row + 1]], known)
                    seen = np.concatenate([[0], np.cumsum(hit)])
                    starts = np.arange(b - a)
                    inside = seen[starts + window - block + 1] > seen[starts]
                    mine = np.unique(wide[a:b][inside])
                    held.append((np.full(len(mine), ids[first + row]), mine))
                if sum(len(part[0]) for part in held) >= FLUSH:
                    yield from _tables(_extended(held, buckets))
                    held = []
        if held:
            yield from _tables(_extended(held, buckets))

    return run


def _extended(held: list[tuple], buckets: int) -> list[tuple]:
    """Packed rows of some documents' windows; all but those of the smallest id are settled."""
    doc, hashed = map(np.concatenate, zip(*held))
    order = np.lexsort((doc, hashed))
    doc, hashed = doc[order], hashed[order]
    once = _first_of_runs(hashed)
    start = np.flatnonzero(once)
    later = doc > np.repeat(doc[start], np.diff(np.append(start, len(hashed))))
    place = ((hashed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    none = np.zeros(len(doc), bool)
    rows = _packed(place[once], doc[once], hashed[once], none[once], False)
    return rows + _packed(doc[later] % buckets, doc[later], hashed[later], none[later], True)


def removed(hashes: np.ndarray, bounds: np.ndarray, window: int, known: list[np.ndarray]) -> np.ndarray:
    """Marks the words of each row that a window which came earlier covers."""
    wide, edges = grams(hashes, bounds, window)
    gone = np.zeros(len(hashes) + 1, np.int64)
    for row, own in enumerate(known):
        part = wide[edges[row] : edges[row + 1]]
        if not len(part):
            continue
        again = np.ones(len(part), bool)
        again[np.unique(part, return_index=True)[1]] = False
        if len(own):
            again |= np.isin(part, own)
        starts = np.flatnonzero(again) + bounds[row]
        np.add.at(gone, starts, 1)
        np.subtract.at(gone, starts + window, 1)
    return np.cumsum(gone)[:-1] > 0


def repeats(documents: DataFrame, window: int = WINDOW, block: int = BLOCK, carry: tuple = ()) -> DataFrame:
    """(key, text, found, carried columns) of every document; ``found`` has the hashes of its earlier windows.

    Key and found get underscores where ``documents`` has such columns.
    """
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block wherever it starts")
    spark = documents.sparkSession
    small_batches(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_name, found_name = free_name(documents, "key"), free_name(documents, "found")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias(key_name)
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = documents.select(key, text)
    # Both joins read the same exchange of the texts.
    by_key = documents.select(key, text, *carry).repartition(buckets, key_name)
    probes = rows.mapInArrow(_probe(buckets, window, block), _PACKED)
    told = lambda f, kind, rows: (
        rows.groupBy("bucket")
        .applyInPandas(lambda part: f(part, buckets), _PACKED)
        .groupBy("bucket")
        .applyInPandas(_owned(kind), "key long, found binary")
        .toDF(key_name, found_name)
    )
    anchors = told(_anchors, np.uint32, probes)
    near = by_key.select(key_name, "text").join(anchors, key_name).select(key_name, "text", found_name)
    windows = near.mapInArrow(_extend(buckets, window, block), _PACKED)
    earlier = told(_earlier, np.uint64, windows)
    return by_key.join(earlier, key_name, "left").select(key_name, "text", found_name, *carry)


def deduplicated(documents: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words: joined as ``kept``, or their SHA-256."""
    name = "kept_sha256" if digest else "kept"
    schema = f"doc_id long, n_words long, n_removed long, {name} string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column(0))
            raw, offsets = utf8(batch.column(1))
            found = batch.column(2)
            totals, lost, kept = [], [], []
            for first, end, part, own in row_slices(raw, offsets):
                hashes, _, _, bounds = words(part, own)
                known = [np.frombuffer(found[i].as_py() or b"", np.uint64) for i in range(first, end)]
                gone = removed(hashes, bounds, window, known)
                for row in range(end - first):
                    cut = gone[bounds[row] : bounds[row + 1]]
                    pieces = part[own[row] : own[row + 1]].tobytes().split()
                    totals.append(len(pieces))
                    lost.append(int(cut.sum()))
                    text = b" ".join(compress(pieces, (~cut).tolist()) if lost[-1] else pieces)
                    kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
            columns = [pa.array(ids, mask=ids == _FIRST), pa.array(totals, pa.int64()), pa.array(lost, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", name])

    return repeats(documents, window).mapInArrow(run, schema)


def rewritten(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with repeats cut out of ``text``, and ``n_chars`` to match.

    Texts that lose nothing stay as they are; documents that lose every word go.
    """
    carry = tuple(name for name in documents.columns if name not in ("doc_id", "text", "n_chars"))
    names = ["doc_id", "text", "n_chars", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column(0))
            raw, offsets = utf8(batch.column(1))
            found, texts = batch.column(2), batch.column(1).to_pylist()
            for first, end, part, own in row_slices(raw, offsets):
                hashes, _, _, bounds = words(part, own)
                known = [np.frombuffer(found[i].as_py() or b"", np.uint64) for i in range(first, end)]
                gone = removed(hashes, bounds, window, known)
                for row in range(end - first):
                    cut = gone[bounds[row] : bounds[row + 1]]
                    if cut.any():
                        pieces = part[own[row] : own[row + 1]].tobytes().split()
                        texts[first + row] = b" ".join(compress(pieces, (~cut).tolist())).decode() or None
            kept = pa.array([text is not None for text in texts])
            sizes = pa.array([None if text is None else len(text) for text in texts], pa.int64())
            columns = [pa.array(ids, mask=ids == _FIRST), pa.array(texts, pa.string()), sizes]
            columns += [batch.column(3 + i) for i in range(len(carry))]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(kept)

    by_name = {field.name: field for field in documents.schema.fields}
    ddl = StructType.fromDDL("doc_id long, text string, n_chars long").fields
    schema = StructType([*ddl, *[by_name[name] for name in carry]])
    return repeats(documents, window, carry=carry).mapInArrow(run, schema).select(*documents.columns)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words that stood earlier in runs of 20."""
    return deduplicated(table(spark, folder, "documents"), digest=True)
