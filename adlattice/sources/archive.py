"""JSON archive, idempotent loads and snapshot export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlattice.functions.scalars import non_empty
from adlattice.operators.keyed import first_per_key
from adlattice.schemas import STAGING_ADS


def archive_listings(listings: DataFrame, path: str, run_time: str) -> str:
    """Write one run's raw listings as JSON lines in a folder named after its logical time."""
    target = f"{path}/listings-{run_time.replace(':', '-')}"
    listings.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").option("ignoreNullFields", "false").json(target)
    return target


def read_archive(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    """Archived listings; ``pretty`` reads files that hold one indented JSON array each."""
    raw = T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "ad_id" else f.dataType) for f in STAGING_ADS.fields
    ])
    return spark.read.schema(raw).option("multiLine", pretty).json(path)


def as_json(row: list[Column]) -> Column:
    """Columns as one JSON text with ISO timestamps and NULL fields kept."""
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX", "ignoreNullFields": "false"}
    return F.to_json(F.struct(*row), options)


def typed_listings(listings: DataFrame) -> DataFrame:
    """Listing ids as BIGINT; '' and non-numeric ids become NULL."""
    return listings.withColumn("ad_id", non_empty(F.col("ad_id").cast("string")).try_cast("bigint"))


def loadable_rows(listings: DataFrame, existing: DataFrame | None, order: list[str]) -> DataFrame:
    """Rows an idempotent load inserts: with an id, first per (ad_id, scraped_at), not there yet."""
    keys = ["ad_id", "scraped_at"]
    first = first_per_key(typed_listings(listings).where(F.col("ad_id").isNotNull()), keys, order)
    return first if existing is None else first.join(existing.select(*keys), keys, "left_anti")


def load_staging(listings: DataFrame, path: str, order: list[str]) -> int:
    """Append a run's listings to the staging table and return how many rows were new.

    Running the same load again inserts nothing. Files are laid out by month, and of the stored rows
    only the months of the load are read. A rebalance lets the runtime merge small months into one
    file and split a month that holds most of the load. Rows are counted by the tasks that write them
    (after the last shuffle, so a task that is run again counts once), and written once.
    """
    spark = listings.sparkSession
    month = F.date_format("scraped_at", "yyyy-MM")
    existing = None
    if path_exists(spark, path):
        months = [r[0] for r in listings.select(month).distinct().collect()]  # a text per month of the load
        stored = T.StructType([*STAGING_ADS.fields, T.StructField("month", T.StringType())])
        existing = spark.read.schema(stored).parquet(path).where(F.col("month").isin(months))
    rows = loadable_rows(listings, existing, order).select(*[f.name for f in STAGING_ADS.fields])
    counters = Observation()
    laid_out = rows.withColumn("month", month).hint("rebalance", "month")
    counted = laid_out.observe(counters, F.count(F.lit(1)).alias("inserted"))
    counted.write.mode("append").partitionBy("month").parquet(path)
    return counters.get["inserted"]


def clashing_keys(details: DataFrame, existing: DataFrame) -> DataFrame:
    """Keys of ``details`` that occur twice in it or exist already, with the number of rows."""
    keys = ["ad_id", "scraped_at"]
    new = details.select(*keys, F.lit(1).alias("new"))
    both = new.unionByName(existing.select(*keys, F.lit(0).alias("new")))
    counted = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.max("new").alias("new"))
    return counted.where("rows > 1 AND new = 1").drop("new")


def append_details(details: DataFrame, existing: DataFrame) -> DataFrame:
    """Detail rows to append; a key that occurs twice or exists already is an error of the load."""
    example = clashing_keys(details, existing).first()
    if example is not None:
        raise ValueError(f"duplicate key {example['ad_id']}, {example['scraped_at']}")
    return details


def run_counters(rows: DataFrame, outcome: str) -> DataFrame:
    """Rows per outcome (inserted, skipped, ...) of one run."""
    return rows.groupBy(outcome).agg(F.count(F.lit(1)).alias("rows"))


def export_snapshot(tables: dict[str, DataFrame], root: str, run_time: str) -> str:
    """Full compressed copy of all tables under a folder named after the run time."""
    target = f"{root}/backup-{run_time.replace(':', '-')}"
    for name, table in tables.items():
        table.write.option("compression", "gzip").parquet(f"{target}/{name}")
    return target


def read_json_line_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several runs of the archive as one table."""
    return reduce(DataFrame.unionByName, [read_archive(spark, p) for p in paths])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
