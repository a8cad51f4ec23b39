"""A stream's table as numbered batches, each visible once and whole.

``<table>/batch=<number>/event_date=<day>/`` holds one batch. It is written beside the table and
published by one rename of its folder, so a reader, batch or stream, sees all of its files or
none, and a batch that is already there is never written again: a batch that runs again after a
lost driver gives streams that follow the table no new files. Small batches are settled from time
to time: merged by day into ``<table>.settled/batches=<first>-<last>/``, published in the same
way; batch readers take the settled folders and the batches behind them.

The rename has to be atomic, as on HDFS, local and hierarchical stores.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rookery.operators import tables

DATE = "event_date"
_SETTLED_BYTES = 16 << 20  # of files that become one file of a settled day
# Nothing has to be sorted before it is written, and days of one task each stay apart.
_ONE_DAY_A_TASK = {
    "spark.sql.maxConcurrentOutputFileWriters": "4",  # at the limit itself rows are sorted
    "spark.sql.unionOutputPartitioning": "false",
}


def _folders(spark: SparkSession, path: str, pattern: str) -> dict[tuple[int, ...], str]:
    found = {}
    for name in tables.folder_names(spark, path):
        match = re.fullmatch(pattern, name)
        if match:
            found[tuple(int(number) for number in match.groups())] = f"{path}/{name}"
    return dict(sorted(found.items()))


def _open(spark: SparkSession, path: str) -> dict[int, str]:
    return {n: folder for (n,), folder in _folders(spark, path, r"batch=(\d+)").items()}


def _settled(spark: SparkSession, path: str) -> dict[tuple[int, int], str]:
    return _folders(spark, f"{path}.settled", r"batches=(\d+)-(\d+)")


def _last_settled(spark: SparkSession, path: str) -> int:
    return max((last for _, last in _settled(spark, path)), default=-1)


def is_published(spark: SparkSession, path: str, batch: int) -> bool:
    return batch <= _last_settled(spark, path) or batch in _open(spark, path)


def publish(
    df: DataFrame, path: str, batch: int, date_of: str, gather: bool = False
) -> bool:
    """Write a batch, by the day of ``date_of``, unless it is there; returns whether it was not.

    What an attempt that failed has left unpublished is overwritten by the next one. Every task
    writes a file per day it holds; for a batch whose days lie in all of its tasks ``gather``
    brings days together first, those with many rows in several tasks.
    """
    spark = df.sparkSession
    if is_published(spark, path, batch):
        return False
    fresh = f"{path}.writing/batch={batch:012d}"
    dated = df.withColumn(DATE, F.col(date_of).cast("date"))
    if gather:
        dated = dated.hint("rebalance", F.col(DATE))
    dated.write.mode("overwrite").partitionBy(DATE).parquet(fresh)
    tables.move_folder(spark, fresh, f"{path}/batch={batch:012d}")
    return True


def _parts(spark: SparkSession, base: str, folders: list[str], schema: StructType) -> DataFrame:
    """Rows of some batch folders below ``base``, with their day."""
    columns = [*schema.fieldNames(), DATE]
    if not _days(spark, folders):
        return spark.createDataFrame([], StructType([*schema.fields]).add(DATE, "date"))
    return spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*columns)


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All published rows; no rows when nothing is there."""
    settled = _settled(spark, path)
    last = max((end for _, end in settled), default=-1)
    behind = [folder for n, folder in _open(spark, path).items() if n > last]
    rows = _parts(spark, path, behind, schema)
    if settled:
        merged = _parts(spark, f"{path}.settled", list(settled.values()), schema)
        rows = merged.unionByName(rows)
    return rows.select(*schema.fieldNames())


def _merged_days(
    spark: SparkSession, base: str, folders: list[str], schema: StructType
) -> DataFrame:
    """Rows of some batch folders, each day's in a few tasks of its own, without a shuffle.

    A shuffle would put all rows on disk once more, in three times their room in files.
    """
    if not _days(spark, folders):
        return _parts(spark, base, folders, schema)
    of_day: dict[str, list[str]] = {}  # one may hold rows without a day
    for folder in folders:
        for name in tables.folder_names(spark, folder):
            if name.startswith(f"{DATE}="):
                of_day.setdefault(name, []).append(f"{folder}/{name}")
    wider = StructType([*schema.fields]).add(DATE, "date")
    parts = []
    for _, paths in sorted(of_day.items()):
        files = math.ceil(sum(tables.folder_bytes(spark, p) for p in paths) / _SETTLED_BYTES)
        rows = spark.read.schema(wider).option("basePath", base).parquet(*paths)
        parts.append(rows.select(*wider.fieldNames()).coalesce(max(1, files)))
    return reduce(DataFrame.unionByName, parts)


def settle(spark: SparkSession, path: str, schema: StructType, upto: int) -> int:
    """Merge the open batches up to ``upto`` into one folder; returns how many they were.

    ``upto`` has to be a batch that every stream on the table has read. Folders of merged batches
    are removed by the next call only, so that a reader that listed them before can end.
    """
    last = _last_settled(spark, path)
    there = _open(spark, path)
    tables.remove_folders(spark, [folder for n, folder in there.items() if n <= last])
    merged = {n: folder for n, folder in there.items() if last < n <= upto}
    if not merged:
        return 0
    name = f"batches={last + 1:012d}-{max(merged):012d}"
    fresh = f"{path}.writing/{name}"
    days = _merged_days(spark, path, list(merged.values()), schema)
    before = {key: spark.conf.get(key) for key in _ONE_DAY_A_TASK}
    for key, value in _ONE_DAY_A_TASK.items():
        spark.conf.set(key, value)
    try:
        days.write.mode("overwrite").partitionBy(DATE).parquet(fresh)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    tables.move_folder(spark, fresh, f"{path}.settled/{name}")
    return len(merged)


def _days(spark: SparkSession, folders: list[str]) -> set[dt.date]:
    return {day for folder in folders for day in tables.partition_dates(spark, folder, DATE)}


def expire(spark: SparkSession, path: str, today: dt.date, keep_days: int = 30) -> list[dt.date]:
    """Delete days older than ``keep_days`` from all batches; returns them.

    A batch without days stays, empty, as a sign that it was published. Settled folders that have
    become empty go, but for the last one, which says how far the table is settled.
    """
    oldest = today - dt.timedelta(days=keep_days)
    settled = _settled(spark, path)
    folders = [*settled.values(), *_open(spark, path).values()]
    old = {
        folder: [d for d in tables.partition_dates(spark, folder, DATE) if d < oldest]
        for folder in folders
    }
    for folder, days in old.items():
        tables.drop_dates(spark, folder, DATE, days)
    earlier = list(settled.values())[:-1]
    tables.remove_folders(spark, [f for f in earlier if not _days(spark, [f])])
    return sorted({day for days in old.values() for day in days})
