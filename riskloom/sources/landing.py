"""CSV landing files and the processed layer."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalar import without_missing_tokens
from riskloom.schema import LANDING, RAW
from riskloom.sources import files
from riskloom.sources.quoted import read_quoted, with_line_breaks

CORRUPT = "_corrupt"

# ``NA`` is a country code, so the missing-value tokens do not apply to this column.
KEEPS_TOKENS = {"merchant_country"}


def _position() -> Column:
    """Order of a row in its file: the byte offset of its split, then its place in the split."""
    return F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def _column_names(header: tuple[str, ...]) -> list[str]:
    """Tidy names; of a repeated column only the first keeps its name."""
    names: list[str] = []
    for number, cell in enumerate(header):
        name = cell.strip().lower()
        names.append(name if name and name not in names else f"#{number}")
    return names


def _read_unknown(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All lines of files without any known column; each is a row that cannot be read."""
    return spark.read.text(paths).select(
        F.lit(None).cast("string").alias("transaction_id"),
        F.col("value").alias(CORRUPT),
        F.col("_metadata.file_path").alias("source_file"),
        _position().alias("row_pos"),
    )


def _read_group(spark: SparkSession, first_line: str, paths: list[str]) -> DataFrame:
    names = _column_names(tuple(next(csv.reader([first_line.lstrip("\ufeff")]))))
    if not set(names) & set(LANDING.names):
        return _read_unknown(spark, paths)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])
    broken = with_line_breaks(spark, paths)
    place = [F.col("_metadata.file_path").alias("source_file"), _position().alias("row_pos")]
    parts = [read_quoted(spark, broken, schema, CORRUPT)] if broken else []
    whole = sorted(set(paths) - set(broken))
    if whole:
        rows = (
            spark.read.option("header", True)
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .option("columnPruning", False)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .schema(schema)
            .csv(whole)
        )
        parts.append(rows.select(*names, CORRUPT, *place))
    rows = reduce(DataFrame.unionByName, parts)
    kept = [
        F.col(name) if name in KEEPS_TOKENS else without_missing_tokens(F.col(name)).alias(name)
        for name in names
        if name in LANDING.names
    ]
    return rows.select(*kept, CORRUPT, "source_file", "row_pos")


def read_landing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All rows of the CSV files as text, matched to columns *by name*.

    Files are grouped by their header line, which is read on the driver: a caller bounds
    the number of files per batch (the ingest stream does). Each group is one distributed
    scan. Empty files are skipped. A row with too many or too few cells keeps its text in
    ``_corrupt``.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for path in sorted(paths):
        line = files.first_line(spark, path)
        if line and line.strip():
            groups[line].append(path)
    parts = [_read_group(spark, line, group) for line, group in groups.items()]
    if not parts:
        position = "struct<block: bigint, line: bigint>"
        schema = T.StructType(
            [
                *LANDING.fields,
                T.StructField(CORRUPT, T.StringType()),
                T.StructField("source_file", T.StringType()),
            ]
        )
        return spark.createDataFrame([], schema).withColumn(
            "row_pos", F.lit(None).cast(position)
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


PROCESSED = T.StructType([field for field in RAW.fields if field.name != "loaded_at"])


def processed_layer(spark: SparkSession, live: str, archive: str | None = None) -> DataFrame:
    """Processed rows, whether or not a loader has archived them.

    Read with the layer's columns: a folder may hold no row yet, or not exist.
    """
    rows = spark.createDataFrame([], PROCESSED)
    for folder in (live, archive):
        if folder and files.exists(spark, folder):
            rows = rows.unionByName(spark.read.schema(PROCESSED).parquet(folder).select(*PROCESSED.names))
    return rows


def ground_truth(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The optional side table ``(transaction_id, fraud_type)``."""
    if path is None or not files.exists(spark, path):
        return None
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path).select("transaction_id", "fraud_type")
    return spark.read.parquet(path).select("transaction_id", "fraud_type")
