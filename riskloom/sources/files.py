"""Small file-system calls through the session's Hadoop configuration."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def place(spark: SparkSession, path: str, encoded: bool = False) -> tuple[str, str]:
    """Host and absolute path, the same for every spelling of a file; ``encoded``: as Spark's metadata column has it."""
    fs, target = _fs(spark, path)
    if encoded:
        target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path))
    uri = fs.makeQualified(target).toUri()
    return uri.getAuthority() or "", uri.getPath()


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has committed its output here."""
    return exists(spark, f"{path}/_SUCCESS")


def first_line(spark: SparkSession, path: str) -> str | None:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        jvm = spark._jvm
        text = jvm.java.io.InputStreamReader(stream, "UTF-8")
        return jvm.java.io.BufferedReader(text).readLine()
    finally:
        stream.close()


def text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, content: str) -> None:
    fs, target = _fs(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(content, "utf-8"))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; fails with ``FileAlreadyExistsException`` where ``target`` exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    places = [hadoop.Path(place) for place in (source, target)]
    context = hadoop.FileContext.getFileContext(places[0].toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    context.rename(*places, options)


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch of the last change."""
    fs, target = _fs(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000
