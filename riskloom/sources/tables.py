"""Keyed Parquet tables with a replayable merge (K4-K8), and the scans on them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalar import parsed_time, truth
from riskloom.operators.merge import check_source, merged
from riskloom.schema import FEATURE_STORE, RAW, SCORES
from riskloom.session import pinned
from riskloom.sources import files, snapshots
from riskloom.sources.snapshots import Snapshot


# The key directory is cut into so many buckets by key hash; it is merged into one run when it
# has more than so many.
KEY_BUCKETS = 32
DIRECTORY_RUNS = 16
BROADCAST_KEYS = 500_000
ATTEMPTS = 10

_NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class KeyedTable:
    """A partitioned Parquet table with one row per key, in snapshots.

    A merge looks its keys up in a directory (key, partition), which is bucketed by key hash and
    of which only the touched buckets are read, rewrites the partitions that receive or hold
    a matched row into a folder of its own run, appends the keys that are new or moved to the
    directory, and publishes a manifest. Until then nobody sees anything of it; a run that
    dies leaves files that nobody uses, which a later merge deletes after a lease. Writers may
    run at the same time: the one that publishes second starts again from the first one's result.
    """

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType
    partition: str
    partition_value: Callable[[], Column] = field(compare=False)
    insert_only: tuple[str, ...] = ()

    def _empty(self) -> DataFrame:
        empty = self.spark.createDataFrame([], self.schema)
        return empty.withColumn(self.partition, self.partition_value())

    def snapshot(self) -> Snapshot:
        return snapshots.current(self.spark, self.path)

    def _rows(self, snapshot: Snapshot, parts: Iterable[str]) -> DataFrame:
        """Rows of some partition folders of a snapshot."""
        empty = self._empty()
        places = [f"{self.path}/data/run={snapshot.data[part]}/{part}" for part in sorted(parts)]
        if not places:
            return empty
        reader = self.spark.read.schema(empty.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*places).select(*empty.columns)

    def read(self) -> DataFrame:
        """Current rows with the partition column; empty before the first merge.

        The files are fixed here: what is published later is not seen, and the files stay until
        ``snapshots.KEPT_VERSIONS`` merges later.
        """
        snapshot = self.snapshot()
        return self._rows(snapshot, snapshot.data)

    def merge(self, source: DataFrame, run_id: str) -> dict[str, int]:
        """Upsert ``source``; returns inserted, updated and total rows.

        Replaying a batch updates its rows in place, so a retried run adds nothing.
        """
        run = f"{run_id}-{uuid.uuid4().hex[:8]}"
        staging = f"{self.path}/staging/run={run}"
        staged = self._staged(source, staging)
        check_source(staged, self.key)
        try:
            for attempt in range(ATTEMPTS):
                try:
                    counts = self._merge_once(staged, f"{run}-{attempt}")
                    break
                except snapshots.Conflict:
                    if attempt == ATTEMPTS - 1:
                        raise
        finally:
            files.delete(self.spark, staging)
        snapshots.clean(self.spark, self.path)
        return counts

    def _merge_once(self, staged: DataFrame, run: str) -> dict[str, int]:
        base = self.snapshot()
        # Numbers of partitions are bounded by calendar days, or a fixed number of buckets.
        facts = staged.groupBy("_folder").agg(
            F.count(F.lit(1)).alias("rows"), F.collect_set("_bucket").alias("buckets")
        ).collect()
        total = sum(row["rows"] for row in facts)
        if not total:
            return {"inserted": 0, "updated": 0, "table_rows": base.rows}
        buckets = sorted({bucket for row in facts for bucket in row["buckets"]})
        holding = pinned(self.located(base, staged.select(self.key), buckets, total))
        held = holding.groupBy("folder").count().collect()
        updated = sum(row["count"] for row in held)
        touched = {row["_folder"] for row in facts} | {row["folder"] for row in held}

        within = self._rows(base, touched & set(base.data))
        result = merged(within, staged.select(*within.columns), self.key, self.insert_only)
        # Rebalancing splits a partition that holds very many of the rows over several tasks.
        folder = f"{self.path}/data/run={run}"
        balanced = result.drop("action").hint("rebalance", self.partition)
        balanced.write.partitionBy(self.partition).parquet(folder)

        changed = staged.select(self.key, "_folder", "_bucket").join(
            holding.select(F.col(self.key), F.col("folder").alias("_folder")), [self.key, "_folder"], "left_anti"
        )
        entries = changed.select(self.key, F.col("_folder").alias("folder"), F.col("_bucket").alias("bucket"))
        self._write_directory(entries, run, base.version + 1)

        written = {name for name in files.children(self.spark, folder) if "=" in name}
        data = {part: old for part, old in base.data.items() if part not in touched}
        inserted = total - updated
        snapshot = Snapshot(
            base.version + 1,
            base.rows + inserted,
            data | {part: run for part in written},
            self._compacted(base, run),
        )
        snapshots.publish(self.spark, self.path, snapshot)
        return {"inserted": inserted, "updated": updated, "table_rows": snapshot.rows}

    def _write_directory(self, entries: DataFrame, run: str, version: int) -> None:
        rows = entries.withColumn("version", F.lit(version).cast("long")).hint("rebalance", "bucket")
        rows.write.partitionBy("bucket").parquet(f"{self.path}/keys/run={run}")

    def _directory(self, runs: Iterable[str]) -> DataFrame:
        rest = T.StructType.fromDDL("folder string, version long, bucket int").fields
        schema = T.StructType([self.schema[self.key], *rest])
        places = [f"{self.path}/keys/run={run}" for run in runs]
        if not places:
            return self.spark.createDataFrame([], schema)
        parts = [self.spark.read.schema(schema).parquet(place) for place in places]
        return reduce(DataFrame.unionByName, parts)

    def _latest(self, entries: DataFrame, *more: str) -> DataFrame:
        last = F.max_by("folder", "version").alias("folder")
        return entries.groupBy(self.key, *more).agg(last)

    def located(self, snapshot: Snapshot, keys: DataFrame, buckets: Sequence[int], count: int) -> DataFrame:
        """(key, folder) of those of ``keys`` that the snapshot holds; they lie in these directory buckets."""
        entries = self._directory(snapshot.keys).where(F.col("bucket").isin(list(buckets)))
        # Few keys filter the directory where it is read, before any exchange of it.
        wanted = F.broadcast(keys) if count <= BROADCAST_KEYS else keys
        return self._latest(entries.join(wanted, self.key, "left_semi"))

    def _compacted(self, base: Snapshot, run: str) -> tuple[str, ...]:
        """Runs of the directory, merged into one if they are many."""
        runs = (*base.keys, run)
        if len(runs) <= DIRECTORY_RUNS:
            return runs
        whole = self._latest(self._directory(runs), "bucket").select(self.key, "folder", "bucket")
        self._write_directory(whole, f"{run}-all", base.version + 1)
        return (f"{run}-all",)

    def _staged(self, source: DataFrame, path: str) -> DataFrame:
        value = F.coalesce(F.col(self.partition).cast("string"), F.lit(_NO_PARTITION))
        rows = source.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        ).withColumn(self.partition, self.partition_value())
        rows = rows.withColumns(
            {
                "_folder": F.concat(F.lit(f"{self.partition}="), value),
                "_bucket": F.pmod(F.xxhash64(self.key), F.lit(KEY_BUCKETS)).cast("int"),
            }
        )
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def _event_date() -> Column:
    return F.to_date("event_time")


def raw_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(
        spark, path, "transaction_id", RAW, "event_date", _event_date, ("loaded_at",)
    )


def score_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, "transaction_id", SCORES, "event_date", _event_date)


USER_BUCKETS = 64


def feature_store(spark: SparkSession, path: str) -> KeyedTable:
    def bucket() -> Column:
        return F.pmod(F.xxhash64("user_id"), F.lit(USER_BUCKETS)).cast("int")

    return KeyedTable(spark, path, "user_id", FEATURE_STORE, "user_bucket", bucket)


def trailing_window(
    raw: DataFrame, span: timedelta, as_of: datetime, columns: tuple[str, ...]
) -> DataFrame:
    """Rows with ``event_time >= as_of - span``.

    The bounds are literals on plain columns, so they reach the scan; the date bound prunes
    the partitions of a table.
    """
    start = as_of - span
    rows = raw.where(F.col("event_time") >= F.lit(start).cast("timestamp_ntz"))
    if "event_date" in raw.columns:
        rows = rows.where(F.col("event_date") >= F.lit(start.date()))
    return rows.select(*columns)


def last_days(raw: DataFrame, days: int, as_of: datetime) -> DataFrame:
    columns = ("transaction_id", "user_id", "event_time", "amount")
    return trailing_window(raw, timedelta(days=days), as_of, columns)


def last_day(raw: DataFrame, as_of: datetime, extra: tuple[str, ...] = ()) -> DataFrame:
    columns = (*extra, "user_id", "event_time", "amount")
    return trailing_window(raw, timedelta(hours=24), as_of, columns)


def since_latest(raw: DataFrame, days: int) -> DataFrame:
    """Rows after ``max(event_time) - days``, the bound excluded."""
    latest = raw.agg(F.max("event_time").alias("_latest"))
    start = F.col("_latest") - F.make_dt_interval(F.lit(days))
    # The broadcast side is one row.
    return raw.crossJoin(F.broadcast(latest)).where(F.col("event_time") > start).drop("_latest")


def clean_scores(scores: DataFrame) -> DataFrame:
    """Scores from a table or a text file with tidy names, times and flags."""
    scores = scores.toDF(*[name.strip().lower() for name in scores.columns])
    parsed = {}
    for name in ("event_time", "scored_at"):
        if isinstance(scores.schema[name].dataType, T.StringType):
            parsed[name] = parsed_time(F.col(name))
    return (
        scores.withColumns({**parsed, "flagged": truth(F.col("flagged"))})
        .withColumn("score", F.col("score").cast("double"))
        .dropna(subset=["event_time"])
    )
