"""What the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import checkpoint_folder


ARROW_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), F.lit(parts))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores behind it until no column of ``df`` is called that."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a whole string column and the n + 1 offsets of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    _, ends, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(ends, kind) if ends is not None else np.zeros(0, kind)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes; a longer row is a run of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of about ARROW_BYTES for the session, so that long texts don't fill a worker.

    By default a batch may hold 64 MB. A session that was given another bound keeps its own.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, str(ARROW_BYTES))


def stored(df: DataFrame, parts: int | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read back.

    Smaller than a checkpoint for wide intermediate tables; deleted when the driver ends.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_folder(spark)}/stored-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    (df.coalesce(parts) if parts else df).write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
