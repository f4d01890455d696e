"""Best-fit packing of documents into sequences, certified by lower bounds.

Rows are dealt into groups of about ``GROUP_ROWS``. Each group is packed best-fit decreasing and
gets a lower bound from dual feasible functions: no packing of its rows has fewer sequences. A
group that meets its bound is certified and keeps its sequences, except the emptiest one. A
group with a gap keeps the sequences that are exactly full. What groups give back is dealt anew
into fewer groups, so groups with gaps exchange rows with each other, and packed again, until
one group has taken the rest or a round wins nothing. Every round is written once to the shared
checkpoint folder; rounds shrink, so the first one is nearly all of the work.

Edge cases. Lengths run from 0 to the capacity; a longer one stops the job, a null one counts
as 0. Equal lengths are placed by row order. Repeated rows are rows of their own. Empty tables
stay empty. Other columns are carried through; clashing names get underscores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskloom.llm.bpe import codec, crc32
from riskloom.llm.common import free_name, table
from riskloom.session import pinned

CAPACITY = 2048
GROUP_ROWS = 20_000
ROUNDS = 6


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and how many bins there are."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0  # bit r of rooms: some bin has room r
    for row, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, used
            used += 1
        bins[row], offsets[row] = chosen, capacity - room
        with_room[room - length].append(chosen)
        rooms |= 1 << (room - length)
    return bins, offsets, used


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of the dual feasible functions that round sizes at a threshold.

    For a threshold k the function takes sizes above capacity - k for whole bins, drops
    those below k, and leaves the rest as they are. Sizes above half the capacity need a bin
    each, which bounds the second part.
    """
    counts = np.bincount(lengths, minlength=capacity + 1)
    total = np.cumsum(counts)
    mass = np.cumsum(counts * np.arange(capacity + 1))
    half = capacity // 2
    k = np.arange(half + 1)
    below = np.maximum(k - 1, 0)
    whole = total[capacity] - total[capacity - k]
    large = total[capacity - k] - total[half]
    room = large * capacity - (mass[capacity - k] - mass[half])
    small = mass[half] - np.where(k > 0, mass[below], 0)
    extra = np.maximum(0, -(-(small - room) // capacity))
    return int((whole + large + extra).max()) if len(lengths) else 0


def _packed(names: list[str], own_names: list[str], length: str, group: str, capacity: int, turn: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows[length].fillna(0).to_numpy(np.int64)
        if len(lengths) and (lengths.min() < 0 or lengths.max() > capacity):
            raise ValueError("a length is not between 0 and the capacity")
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, lengths, minlength=used).astype(np.int64)
        if used == lower_bound(lengths, capacity):
            kept = np.ones(used, bool)
            kept[np.argmin(fill)] = fill.min() == capacity
        else:
            kept = fill == capacity
        own = int(rows[group].iloc[0])
        rows = rows[names].copy()
        for name, values in zip(own_names, ((turn << 56) + (own << 28) + bins, offsets, kept[bins].astype(np.int64))):
            rows[name] = values
        return rows

    return run


def pack(df: DataFrame, length: str, capacity: int = CAPACITY) -> DataFrame:
    """``df`` with ``sequence_id`` and ``offset``; lengths of a sequence sum to ``capacity`` at most."""
    sequence, offset = free_name(df, "sequence_id"), free_name(df, "offset")
    names, group = df.columns, free_name(df, "pack_group")
    own_names = [free_name(df, name) for name in ("_sequence", "_offset", "_kept")]
    extra = [StructField(name, LongType()) for name in own_names]
    schema = StructType([*df.schema.fields, *extra])
    done, rest, last = [], pinned(df), None
    for turn in range(ROUNDS):
        facts = rest.agg(F.count(F.lit(1)), F.sum(length)).first()
        rows, mass = facts[0], facts[1] or 0
        if not rows and turn:
            break
        groups = max(1, -(-rows // GROUP_ROWS))
        final = groups == 1 or turn == ROUNDS - 1 or (last is not None and mass >= 0.9 * last)
        dealt = rest.withColumn(
            group, F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(groups))
        )
        run = _packed(names, own_names, length, group, capacity, turn)
        packed = pinned(dealt.groupBy(group).applyInPandas(run, schema))
        done.append(packed if final else packed.where(F.col(own_names[2]) == 1))
        if final:
            break
        rest, last = packed.where(F.col(own_names[2]) == 0).select(*names), mass
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select(
        *names, F.col(own_names[0]).alias(sequence), F.col(own_names[1]).alias(offset)
    )


def assemble(packed: DataFrame, ids: str) -> DataFrame:
    """sequence_id and its ids, from packed rows that hold arrays of ids."""
    one = F.struct("offset", F.col(ids).alias("ids"))
    ordered = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(one)).alias("parts"))
    joined = F.flatten(F.transform("parts", lambda part: part["ids"])).alias(ids)
    return ordered.select("sequence_id", joined)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first one may be shorter than the capacity."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * (first > 0) + [(s, capacity) for s in range(first, n, capacity)]


def pieces(df: DataFrame, key: str, text: str, vocabulary: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Key, piece, start, length and ids_crc32 of every text, cut where longer than a sequence."""
    fields = StructType.fromDDL("piece int, start long, length long, ids_crc32 long").fields
    schema = StructType([df.schema[key], *fields])
    closing = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            rows = []
            for row, ids in enumerate(own.encode(batch.column(1))):
                ids += closing
                for piece, (start, size) in enumerate(cuts(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + size)]
                    rows.append((row, piece, start, size, crc32(part)))
            found = np.array(rows, np.int64).reshape(-1, 5)
            columns = [batch.column(0).take(pa.array(found[:, 0])), pa.array(found[:, 1], pa.int64()).cast(pa.int32())]
            columns += [pa.array(found[:, i], pa.int64()) for i in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)


def packed_documents(documents: DataFrame) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return pack(pieces(rows, "doc_id", "text", vocabulary, CAPACITY), "length", CAPACITY)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packed_documents(table(spark, folder, "documents"))
