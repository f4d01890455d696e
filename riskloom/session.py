"""Session settings that results depend on, and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8, app: str = "riskloom") -> SparkSession:
    """A session for one machine, as used by the tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Times are UTC wall-clock everywhere; checkpoints need a shared folder."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_folder(spark)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a single-machine session may fall back to a temporary folder: on a cluster
    a machine-local folder is lost together with its executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="riskloom-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, so that every later pass reads the same rows."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
