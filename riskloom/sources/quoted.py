"""CSV records that run over several lines, read without giving up splits.

Whether a line begins inside a quoted cell depends on all lines before it. Each line is
therefore a map of two states: where the reader is at its end if it began outside a cell, and
where if it began inside one. Such a map is constant, swaps the states or keeps them, so lines
compose by aggregates: the last constant map counts, and the parity of the swaps after it. Lines
compose within their split, splits within their file (one row each), and no task holds a file.

A quote opens a cell only at its start; elsewhere in a plain cell it is text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources import files

# A record of more lines has an unclosed quote; its lines are not joined, so that no
# group grows with the file.
RECORD_LINES = 1000

_QUOTED = '"[^"]*+(?:""[^"]*+)*+'
# Whole cells with their commas, then a quoted cell without an end.
_OPEN = f'^(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+)?+,)*+{_QUOTED}$'

_FILE, _PLACE = "source_file", ["block", "line"]


def _text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def with_line_breaks(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those files in which a quoted cell may go on in the next line; one scan, one row a file."""
    lines = spark.read.text(list(paths)).where(F.col("value").rlike(_OPEN))
    rows = lines.select("_metadata.file_path").distinct().collect()
    found = {files.place(spark, row[0], encoded=True) for row in rows}
    return [path for path in paths if files.place(spark, path) in found]


def _map(constant: Column, swaps: Column) -> list[Column]:
    """End state (inside?) from outside and from inside: ``swaps`` after the last ``constant`` one, if any."""
    odd = swaps % 2 == 1
    since = (swaps - constant["swaps"]) % 2 == 1
    fixed = constant["state"] != since
    return [
        F.when(constant.isNull(), odd).otherwise(fixed).alias("outside"),
        F.when(constant.isNull(), ~odd).otherwise(fixed).alias("inside"),
    ]


def _composed(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add ``before``: the map of all earlier rows of a key. Rows hold maps (outside, inside)."""
    ordered = Window.partitionBy(*keys).orderBy(order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    swap = F.col("outside") & ~F.col("inside")
    held = F.struct(F.col(order).alias("at"), F.col("outside").alias("state"), "swaps")
    rows = rows.withColumn("swaps", F.sum(swap.cast("int")).over(upto)).withColumn(
        "fixed", F.when(F.col("outside") == F.col("inside"), held)
    )
    constant, swaps = F.max("fixed").over(earlier), F.col("swaps") - swap.cast("int")
    rows = rows.withColumns({"_constant": constant, "_swaps": swaps})
    before = F.struct(*_map(F.col("_constant"), F.col("_swaps")))
    return rows.withColumn("before", before).drop("_constant", "_swaps")


def lines_of_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All lines but blank ones between records, with the number of their record in the file (from 1)."""
    lines = _text(spark, paths).withColumns(
        {
            "outside": F.col("value").rlike(_OPEN),
            "inside": F.concat(F.lit('"'), F.col("value")).rlike(_OPEN),
        }
    )
    split = [_FILE, "block"]
    lines = _composed(lines, split, "line")
    whole = lines.groupBy(*split).agg(F.max("fixed").alias("fixed"), F.max_by("swaps", "line").alias("swaps"))
    whole = whole.select(*split, *_map(F.col("fixed"), F.col("swaps")))
    starts = _composed(whole, [_FILE], "block").select(*split, F.col("before.outside").alias("entered"))
    lines = lines.select(*split, "line", "value", "before").join(starts, split)
    open_cell = F.when(F.col("entered"), F.col("before.inside")).otherwise(F.col("before.outside"))
    lines = lines.withColumn("first", ~open_cell).where("NOT first OR trim(value) <> ''")
    ordered = Window.partitionBy(*split).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("number", F.sum(F.col("first").cast("long")).over(ordered))
    counts = lines.groupBy(*split).agg(F.max("number").alias("records"))
    earlier = Window.partitionBy(_FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*split, F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("offset"))
    record = F.col("offset") + F.col("number")
    return lines.join(offsets, split).select(_FILE, *_PLACE, "value", record.alias("record"))


def read_quoted(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, corrupt: str, record_lines: int = RECORD_LINES
) -> DataFrame:
    """``schema``, source_file and row_pos of the records of CSV files whose cells may hold line breaks.

    The first record is the header. Lines of a record that never ends come one by one, as ``corrupt``.
    """
    lines = lines_of_records(spark, paths).withColumn("row_pos", F.struct(*_PLACE)).drop(*_PLACE)
    key = [_FILE, "record"]
    sizes = lines.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    lines = lines.join(sizes, key).where("record > 1 OR n > 1")
    alone = F.col("n") > record_lines
    # Each line of an endless record is a group of its own.
    lines = lines.withColumn("part", F.when(alone, F.col("row_pos")))
    joined = lines.groupBy(*key, "part").agg(
        F.array_sort(F.collect_list(F.struct("row_pos", "value"))).alias("lines")
    )
    text = F.concat_ws("\n", F.col("lines.value"))
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    ddl = ", ".join(f"`{field.name}` string" for field in schema.fields)
    cells = F.when(F.col("part").isNull(), F.from_csv(text, ddl, options))
    rows = joined.where("record > 1 OR part IS NOT NULL").select(
        cells.alias("cells"),
        F.when(F.col("part").isNotNull(), text).alias("whole"),
        _FILE,
        F.col("lines")[0]["row_pos"].alias("row_pos"),
    )
    named = [F.col("cells")[field.name].alias(field.name) for field in schema.fields if field.name != corrupt]
    return rows.select(*named, F.coalesce(F.col("cells")[corrupt], "whole").alias(corrupt), _FILE, "row_pos")
