"""Versioned table snapshots: a table is never overwritten while it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlattice.sources.archive import path_exists


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of a table; one whose write did not finish has no success marker."""
    if not path_exists(spark, root):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/version=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest complete version of a table, or the asked one."""
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(root)
    return spark.read.parquet(f"{root}/version={known[-1] if version is None else version}")


def write_snapshot(df: DataFrame, root: str, version: int) -> None:
    """Write a version. Repeating a version replaces it, so a retried run leaves one result."""
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
