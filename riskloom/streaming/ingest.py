"""Incremental ingest: new landing files only, checked, split, normalised and loaded."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.merge import first_per_key
from riskloom.operators.normalise import dropped_rows, loadable, normalise
from riskloom.operators.validate import FILE, annotate, rule_counts
from riskloom.schema import MONEY, TRANSACTION_COLUMNS
from riskloom.session import prepare
from riskloom.sources.landing import CORRUPT, read_landing
from riskloom.sources.tables import KeyedTable, raw_table

# Bounds the headers that one batch reads on the driver.
FILES_PER_BATCH = 500

UNREADABLE = "unreadable_row"
OUT_OF_RANGE = "amount_out_of_range"

# The columns of Spark's binary file source.
FILE_LISTING = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class Layers:
    """Folders of the file layers and tables below one base folder."""

    base: str

    @property
    def landing(self) -> str:
        return f"{self.base}/landing"

    @property
    def checked(self) -> str:
        return f"{self.base}/checked"

    @property
    def processed(self) -> str:
        return f"{self.base}/processed"

    @property
    def archive(self) -> str:
        return f"{self.base}/archive"

    @property
    def raw(self) -> str:
        return f"{self.base}/raw"

    @property
    def scores(self) -> str:
        return f"{self.base}/scores"

    @property
    def feature_store(self) -> str:
        return f"{self.base}/feature_store"

    @property
    def models(self) -> str:
        return f"{self.base}/models"

    @property
    def reports(self) -> str:
        return f"{self.base}/reports"

    @property
    def progress(self) -> str:
        return f"{self.base}/progress"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def check_files(spark: SparkSession, paths: list[str], out: str) -> DataFrame:
    """Validate files into one folder, split by ``is_bad`` (K1); returns the annotated rows.

    A row that could not be split into cells is quarantined with its text. One write holds
    both sides, so the batch is checked once; there is no bad folder if nothing is bad.
    """
    annotated = annotate(read_landing(spark, paths))
    too_large = F.col("amount").isNotNull() & F.col("amount").try_cast(MONEY).isNull()
    reasons = F.concat_ws(
        ";",
        F.nullif(F.col("failure_reason"), F.lit("")),
        F.when(too_large, OUT_OF_RANGE),
        F.when(F.col(CORRUPT).isNotNull(), UNREADABLE),
    )
    rows = annotated.withColumn("failure_reason", reasons).withColumn(
        "is_bad", F.col("failure_reason") != ""
    )
    rows = rows.drop("row_pos")
    rows.write.mode("overwrite").partitionBy("is_bad").parquet(out)
    return written(spark, out, rows.schema)


def written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder that was just written. A partitioned write of no rows leaves no file to infer from."""
    return spark.read.schema(schema).parquet(path)


def valid(checked: DataFrame) -> DataFrame:
    return checked.where("NOT is_bad").select(*TRANSACTION_COLUMNS, FILE)


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where("is_bad").select(*TRANSACTION_COLUMNS, "failure_reason", CORRUPT, FILE)


def batch_processor(
    layers: Layers, table: KeyedTable | None, now: Callable[[], datetime] = utc_now
) -> Callable[[DataFrame, int], int]:
    """Work of one micro-batch. Every output is named by the batch, so a retry overwrites it.

    ``table`` is the raw table to load into, or None to stop at the processed layer; what a load
    inserted, updated and dropped is written to ``reports/load``. The work
    returns the number of files. A batch without a row, or without a valid one, is ordinary.
    """

    def process(batch: DataFrame, batch_id: int) -> int:
        spark = prepare(batch.sparkSession)
        paths = [row["path"] for row in batch.select("path").collect()]  # FILES_PER_BATCH
        if not paths:
            return 0
        name = f"batch_id={batch_id}"
        checked = check_files(spark, paths, f"{layers.checked}/{name}")
        rule_counts(checked).write.mode("overwrite").parquet(f"{layers.reports}/quality/{name}")
        rows = normalise(valid(checked)).withColumn("event_date", F.to_date("event_time"))
        processed = f"{layers.processed}/{name}"
        rows.write.mode("overwrite").partitionBy("event_date").parquet(processed)
        if table is not None:
            counts = load(table, written(spark, processed, rows.schema), f"ingest-{batch_id}", now())
            report = spark.range(1).select(*[F.lit(n).cast("long").alias(k) for k, n in counts.items()])
            report.write.mode("overwrite").parquet(f"{layers.reports}/load/{name}")
        return len(paths)

    return process


def load(table: KeyedTable, rows: DataFrame, run_id: str, loaded_at: datetime) -> dict[str, int]:
    """Merge processed rows into the raw table.

    Files are checked one by one, so the same id may come from two files of a batch; its
    earliest event is kept (equal events: by amount). ``dropped`` counts rows without a time
    or an amount, which the table can't hold.
    """
    unique = first_per_key(loadable(rows), "transaction_id", ["event_time", "amount", "user_id"])
    stamped = unique.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
    dropped = dropped_rows(rows).first()["dropped_rows"]
    return {**table.merge(stamped, run_id), "dropped": dropped}


def ingest_available(
    spark: SparkSession,
    layers: Layers,
    load_raw: bool = True,
    archive: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
    now: Callable[[], datetime] = utc_now,
) -> int:
    """Process the landing files that no earlier run has seen; returns how many.

    The stream's checkpoint remembers finished files; it is committed after the batch's
    outputs are written. Only file names are streamed: the content column of the source
    is pruned, the files themselves are read by name inside the batch.
    """
    prepare(spark)
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option(
            "sourceArchiveDir", f"{layers.archive}/landing"
        )
    table = raw_table(spark, layers.raw) if load_raw else None
    process = batch_processor(layers, table, now)
    taken: list[int] = []  # by batch; the query's own progress list is cut to its latest entries
    query = (
        reader.load(layers.landing)
        .select("path")
        .writeStream.foreachBatch(lambda batch, number: taken.append(process(batch, number)))
        .option("checkpointLocation", f"{layers.progress}/ingest")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(taken)


def affected_rows(raw: DataFrame, batch: DataFrame) -> DataFrame:
    """History of every user with a row in ``batch``.

    A late row changes the features of the user's later rows, so these users are computed
    and scored again. Rows without a user are one group, as they are for the features.
    """
    users = batch.select(F.col("user_id").alias("_user")).distinct()
    return raw.join(users, F.col("user_id").eqNullSafe(F.col("_user")), "left_semi")


def late_rows(raw: DataFrame, days: int = 1) -> DataFrame:
    """Rows that were loaded more than ``days`` after their event."""
    return raw.where(F.col("loaded_at") > F.col("event_time") + F.make_dt_interval(F.lit(days)))
