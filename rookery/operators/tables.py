"""Table-write semantics on partitioned Parquet.

Writes are re-runnable: a failed job leaves the target as it was, because Spark
moves finished files into place only after every task has succeeded.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from rookery.session import scratch_path


# --- paths ------------------------------------------------------------------


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    location = hadoop.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location, hadoop.Path


def exists(spark: SparkSession, path: str) -> bool:
    files, location, _ = _filesystem(spark, path)
    return files.exists(location)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it is not there."""
    files, location, _ = _filesystem(spark, path)
    if not files.exists(location):
        return []
    return [status.getPath().getName() for status in files.listStatus(location)]


def folder_batches(spark: SparkSession, path: str, size: int) -> Iterator[list[str]]:
    """Paths of what a folder holds, hidden ones left out, ``size`` at a time."""
    files, location, _ = _filesystem(spark, path)
    if not files.exists(location):
        return
    held = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(location))
    total, java = len(held), spark._jvm.java.lang
    for first in range(0, total, size):
        count = min(size, total - first)
        batch = spark.sparkContext._gateway.new_array(java.Object, count)
        java.System.arraycopy(held, first, batch, 0, count)
        # one call a batch; line breaks in names of units are escaped
        paths = spark._jvm.org.apache.commons.lang3.StringUtils.join(batch, "\n").split("\n")
        seen = [p for p in paths if not p.rpartition("/")[2].startswith(("_", "."))]
        if seen:
            yield seen


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all that a folder holds."""
    files, location, _ = _filesystem(spark, path)
    return files.getContentSummary(location).getLength()


def partition_dates(spark: SparkSession, path: str, column: str) -> list[dt.date]:
    """Dates of the table's first partition level, from its folder names."""
    names = folder_names(spark, path)
    found = [re.fullmatch(rf"{column}=(\d{{4}}-\d{{2}}-\d{{2}})", name) for name in names]
    return sorted(dt.date.fromisoformat(match.group(1)) for match in found if match)


def drop_dates(spark: SparkSession, path: str, column: str, days: list[dt.date]) -> None:
    files, _, make_path = _filesystem(spark, path)
    for day in days:
        files.delete(make_path(f"{path}/{column}={day.isoformat()}"), True)


# --- reading ----------------------------------------------------------------


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table in its declared column order; no rows when nothing is there."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def create_if_missing(
    spark: SparkSession, path: str, schema: StructType, partition: str | None = None
) -> None:
    if not exists(spark, path):
        writer = spark.createDataFrame([], schema).write
        (writer.partitionBy(partition) if partition else writer).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared scratch folder and read it back.

    Used where a result feeds several consumers: it is computed once, its
    lineage is cut, and a lost executor costs no recomputation.
    """
    return _staged(df, name)[0]


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _remove(spark: SparkSession, path: str) -> None:
    files, location, _ = _filesystem(spark, path)
    files.delete(location, True)


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        _remove(spark, path)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; file systems say by their result, not an error, that they did not."""
    files, location, make_path = _filesystem(spark, source)
    if not files.rename(location, make_path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a path that is not there yet, making its parents."""
    files, location, _ = _filesystem(spark, target)
    files.mkdirs(location.getParent())
    _rename(spark, source, target)


# --- writing ----------------------------------------------------------------


def _counted(df: DataFrame, *extra: Column) -> tuple[DataFrame, Observation]:
    seen = Observation(f"written-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen


def _by_partition(df: DataFrame, partition: str | None, cluster: list[str]) -> DataFrame:
    """Bring a partition's rows together, hot partitions split over tasks.

    Without this each task would write one small file per partition; a plain
    repartition would send a hot date to a single task.
    """
    if partition:
        df = df.hint("rebalance", F.col(partition))
    order = [c for c in (partition, *cluster) if c]
    return df.sortWithinPartitions(*order) if order else df


def replace_window(
    df: DataFrame,
    path: str,
    date_column: str,
    start: dt.date,
    end: dt.date,
    cluster: list[str] = (),
) -> int:
    """Replace the inclusive date window of a date-partitioned table.

    Days outside the window stay untouched; days inside it that produced no
    rows are removed. A row outside the window is an error. Returns the number
    of rows written.
    """
    spark = df.sparkSession
    inside = F.col(date_column).between(F.lit(start), F.lit(end))
    guarded = df.withColumn(
        date_column,
        F.when(inside, F.col(date_column)).otherwise(
            F.raise_error(F.lit(f"row outside the window {start}..{end}")).cast("date")
        ),
    )
    arranged = _by_partition(guarded, date_column, list(cluster))
    counted, seen = _counted(arranged, F.collect_set(date_column).alias("days"))
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )
    written = set(seen.get.get("days") or [])
    stale = [
        day
        for day in partition_dates(spark, path, date_column)
        if start <= day <= end and day not in written
    ]
    drop_dates(spark, path, date_column, stale)
    return seen.get.get("rows") or 0


def upsert_window(
    batch: DataFrame,
    path: str,
    key: str,
    date_column: str,
    start: dt.date,
    end: dt.date,
    cluster: list[str] = (),
) -> int:
    """Insert or replace rows by key inside the inclusive date window.

    Only the window's partitions of the target are read and rewritten. The
    batch is staged once because it is needed twice: its keys remove the
    matched target rows, its rows join the remaining ones.
    """
    spark = batch.sparkSession
    staged, path_of_copy = _staged(batch, "upsert")
    target = read_table(spark, path, batch.schema)
    kept = target.filter(F.col(date_column).between(F.lit(start), F.lit(end))).join(
        staged.select(key), key, "left_anti"
    )
    merged = kept.select(*batch.columns).unionByName(staged)
    try:
        replace_window(merged, path, date_column, start, end, cluster)
        return staged.count()
    finally:
        _remove(spark, path_of_copy)


def rebuild(
    df: DataFrame, path: str, partition: str | None = None, cluster: list[str] = ()
) -> int:
    """Replace a whole table: write it next to the old one, then swap folders.

    If the swap fails the old table is put back; it is deleted only once the
    new one is in its place.
    """
    spark = df.sparkSession
    fresh, previous = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    counted, seen = _counted(_by_partition(df, partition, list(cluster)))
    writer = counted.write
    (writer.partitionBy(partition) if partition else writer).parquet(fresh)

    had_previous = exists(spark, path)
    if had_previous:
        _rename(spark, path, previous)
    try:
        _rename(spark, fresh, path)
    except Exception:
        if had_previous:
            _rename(spark, previous, path)
        raise
    if had_previous:
        _remove(spark, previous)
    return seen.get.get("rows") or 0


def append(df: DataFrame, path: str, partition: str | None = None) -> int:
    """Append rows (explicit columns are the caller's ``select``)."""
    counted, seen = _counted(df)
    writer = counted.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return seen.get.get("rows") or 0


def expire(
    spark: SparkSession, path: str, date_column: str, today: dt.date, keep_days: int = 30
) -> list[dt.date]:
    """Drop date partitions older than ``keep_days``; returns the dropped dates."""
    oldest = today - dt.timedelta(days=keep_days)
    old = [day for day in partition_dates(spark, path, date_column) if day < oldest]
    drop_dates(spark, path, date_column, old)
    return old
