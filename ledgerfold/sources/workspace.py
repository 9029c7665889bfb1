"""Where written intermediate tables live."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Files that a task writes at the same time; each has a row group in memory.
OPEN_FILES = 8


def shared_folder(spark: SparkSession) -> str:
    """The name of a fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Where that setting is missing, as in tests, the folder is below the warehouse,
    which is shared if catalog tables are. By default it is a folder of the driver's
    machine, which will do for local mode alone.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        check_shared(root, spark.sparkContext.master)
    return f"{root.rstrip('/')}/ledgerfold-{uuid.uuid4().hex}"


def check_shared(place: str, master: str) -> None:
    """Fail for a folder of this machine where executors may run on others."""
    if place.startswith(("file:", "/")) and not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"{place} is on the driver's machine: set spark.checkpoint.dir to a folder all executors share")


def written(df: DataFrame, path: str | None = None, *partition_by: str) -> DataFrame:
    """Write ``df`` as parquet to ``path`` (a fresh shared folder) and read it back.

    This cuts the lineage: what is read next outlives lost executors, and ids
    that were made on the way are fixed.
    """
    path = path or shared_folder(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Writes inside keep up to ``OPEN_FILES`` files open per task instead of sorting the rows by folder.

    For rows that are generated folder by folder: Spark does not know their order, and
    would sort, and spill, every one of them. Rows for more folders are still sorted.
    """
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def writing_tasks(tasks: int, places: int) -> int:
    """``tasks``, or as many as ``places`` files in as many folders need with ``OPEN_FILES`` files each."""
    return max(tasks, -(-places // OPEN_FILES))


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, by Spark's file system."""
    files, hadoop = _file_system(spark, path)
    return files.exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table through Spark's file system."""
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)
