"""Reading tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlattice.schemas import TABLES, align_to_schema

# Files of their own that one task writes.
FILES_PER_TASK = 1_000

# Splits of small files that one task reads.
SPLITS_PER_TASK = 32


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_scan(scan: DataFrame, key: str) -> DataFrame:
    """Spread a scan with fewer splits than cores over all cores before costly per-row work.

    Only for a bare table scan. Tables of more splits than cores are returned as they are, so large
    tables are never shuffled for this.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(4 * cores, key)


def read_warehouse(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A warehouse table brought to its declared schema, whatever layout its files have."""
    return align_to_schema(spark.read.option("mergeSchema", "true").parquet(f"{root}/{name}"), TABLES[name])


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int,
              **options: str) -> DataFrame:
    """A database table read in ``parts`` key ranges, so that no single connection reads it whole."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=str(low), upperBound=str(high),
                 numPartitions=str(parts), **options)
        .load()
    )


def write_html_files(pages: DataFrame, key: str, path: str) -> None:
    """Every page (key, html; keys are unique) as a file of its own, in a folder ``key=...`` under ``path``.

    What a file costs does not depend on its size, so pages are dealt by their number: no task writes many more than ``FILES_PER_TASK``,
    whatever the table's size and splits. In a shared folder that is mounted (``file:``) tasks write the files themselves, as Spark's writer
    starts two processes (chmod) per file there.
    """
    cores = pages.sparkSession.sparkContext.defaultParallelism
    tasks = max(4 * cores, -(-pages.count() // FILES_PER_TASK))
    dealt = pages.select(key, "html").repartition(tasks, key)
    if path.startswith("file:/") and isinstance(pages.schema[key].dataType, T.IntegralType):
        write_mounted_files(dealt, key, urlparse(path).path)
    else:
        dealt.write.partitionBy(key).text(path)


def write_mounted_files(pages: DataFrame, key: str, folder: str) -> None:
    """Pages (key, html), dealt by key, as Spark's text writer lays them out under a mounted folder.

    The folder gets its name when all files are there, and a file its own when it is whole, so a task that fails or runs twice does no harm.
    """
    if os.path.exists(folder):
        raise FileExistsError(folder)
    unfinished = f"{folder}-{uuid.uuid4().hex}"
    os.makedirs(unfinished)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, attempt = f"part-{task.partitionId():05d}.txt", f".attempt-{task.taskAttemptId()}"
        rows = ((k, t) for batch in batches for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        written = 0
        for value, texts in groupby(rows, lambda row: row[0]):
            at = f"{unfinished}/{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
            os.makedirs(at, exist_ok=True)
            with open(f"{at}/{attempt}", "wb") as out:
                for _, text in texts:
                    out.write(f"{text or ''}\n".encode())
            os.replace(f"{at}/{attempt}", f"{at}/{name}")
            written += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([written], pa.int64())})

    pages.sortWithinPartitions(key).mapInArrow(run, "files bigint").agg(F.sum("files")).collect()
    os.rename(unfinished, folder)


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """Local or shared HTML files under a folder, one row per file: (url, html). Folders are listed by tasks, not by the driver alone.

    Spark counts opening a file as 4 MB, so a split has a few small files only; a task reads several splits.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    cores = spark.sparkContext.defaultParallelism
    files = files.coalesce(max(4 * cores, -(-files.rdd.getNumPartitions() // SPLITS_PER_TASK)))
    return files.selectExpr("_metadata.file_path AS url", "value AS html")


def publish_view(df: DataFrame, name: str) -> None:
    """Publish a table under a name for SQL users of the session, as the cleaned view is."""
    df.createOrReplaceTempView(name)
