"""The master as a stream: every run is merged with details, price history and deactivation, and only what changed is written.

A store is a folder with a ``base`` table and ``delta`` tables behind it. A run writes one delta: the listings it has seen and those that it
no longer sees. Reading takes a listing from its newest delta, or else from the base. When the deltas have grown to a share
of the base, they are merged into a new base, so a listing is rewritten a number of times that grows with the logarithm of the runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.operators.keyed import latest_per_key
from adlattice.operators.lifecycle import incoming_listings, merge_master, price_history_rows
from adlattice.sources.snapshots import read_snapshot, versions, write_snapshot
from adlattice.streaming.feeds import run_available

# Deltas of this share of the base's size are merged into it.
COMPACT_AT = 0.5

# Runs that one batch may hold; the number of a delta is batch times this plus the run's place in the batch.
RUNS_PER_BATCH = 10_000


def run_rows(staging: DataFrame, details: DataFrame) -> DataFrame:
    """Search snapshots and details, both with a ``run`` number, as rows of one stream."""
    return staging.withColumn("__kind", F.lit("search")).unionByName(
        details.withColumn("__kind", F.lit("detail")), allowMissingColumns=True)


def read_listings(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """All listings after the deltas numbered below ``before`` (all by default), None if there is nothing yet."""
    known = lambda part: [v for v in versions(spark, f"{root}/{part}") if before is None or v < before]
    bases = known("base")
    deltas = [v for v in known("delta") if not bases or v > bases[-1]]
    base = read_snapshot(spark, f"{root}/base", bases[-1]) if bases else None
    if not deltas:
        return base
    rows = spark.read.option("basePath", f"{root}/delta").parquet(*[f"{root}/delta/version={v}" for v in deltas])
    newest = rows.drop("version") if len(deltas) == 1 else latest_per_key(rows, "ad_id", ["version"]).drop("version")
    if base is None:
        return newest
    # Deltas are small beside the base, so their ids can be shipped to its scan and the base itself is not dealt anew.
    return base.join(newest.select("ad_id"), "ad_id", "left_anti").unionByName(newest.select(base.columns))


def merge_run(spark: SparkSession, root: str, staging: DataFrame, details: DataFrame, run: int, number: int) -> None:
    """Merge one run into the store as delta ``number``; doing it again replaces the delta, as it starts from those before.

    Listings of the run are merged as :func:`merge_master` does, and price changes against the state before go to ``history``.
    Listings last seen in an earlier run than the newest become inactive. Snapshots that are not newer than what is known of their listing
    change nothing, so a run that comes late or in parts cannot roll a listing back.
    """
    known = read_listings(spark, root, number)
    if known is None:
        empty = incoming_listings(staging, details).withColumns({"has_embeddings": F.lit(False), "run": F.lit(run).cast("long")})
        known = empty.where(F.lit(False))
    seen = staging.select("ad_id").distinct()
    before = known.join(seen, "ad_id", "left_semi")
    last = before.select("ad_id", F.col("last_seen_at").alias("__last"))
    newer = staging.join(last, "ad_id", "left").where(F.col("__last").isNull() | (F.col("scraped_at") > F.col("__last"))).drop("__last")
    price_history_rows(newer, before).write.mode("overwrite").parquet(f"{root}/history/version={number}")
    merged = merge_master(before.drop("run"), newer, details).join(before.select("ad_id", F.col("run").alias("__run")), "ad_id", "left")
    newest = max(run, known.agg(F.max("run")).first()[0] or run)
    merged = merged.withColumn("run", F.greatest(F.lit(run).cast("long"), "__run")).drop("__run")
    merged = merged.withColumn("active", F.col("active") & (F.col("run") == newest))
    gone = known.where(F.col("active") & (F.col("run") < run)).join(seen, "ad_id", "left_anti").withColumn("active", F.lit(False))
    write_snapshot(merged.select(known.columns).unionByName(gone), f"{root}/delta", number)


def compact(spark: SparkSession, root: str, number: int, share: float = COMPACT_AT) -> bool:
    """Write a new base as of delta ``number`` if the deltas since the last one hold ``share`` of its bytes."""
    bases = [v for v in versions(spark, f"{root}/base") if v < number]
    deltas = [v for v in versions(spark, f"{root}/delta") if v <= number and (not bases or v > bases[-1])]
    size = lambda part, v: _bytes(spark, f"{root}/{part}/version={v}")
    if not deltas or (bases and sum(size("delta", v) for v in deltas) < share * size("base", bases[-1])):
        return False
    write_snapshot(read_listings(spark, root, number + 1), f"{root}/base", number)
    return True


def _bytes(spark: SparkSession, path: str) -> int:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jvm_path).getLength()


def maintain_listings(stream: DataFrame, root: str, checkpoint: str) -> None:
    """Merge the runs of a stream (see :func:`run_rows`) into the store at ``root``, one after the other by number.

    A run should come in one batch: each batch is compared with the prices before it, so of a run in two parts a listing that
    is in both can have two price changes. The master is the same either way.
    """
    staging_columns = ["ad_id", "ad_url", "price", "specs_text", "scraped_at", "snapshot_id"]

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        runs = sorted(r["run"] for r in batch.where("__kind = 'search'").select("run").distinct().collect())
        for place, run in enumerate(runs):
            own = batch.where(F.col("run") == run)
            staging = own.where("__kind = 'search'").select(*[c for c in staging_columns if c in batch.columns])
            details = own.where("__kind = 'detail'").drop("__kind", "run", "ad_url", "price", "specs_text")
            number = batch_id * RUNS_PER_BATCH + place
            merge_run(spark, root, staging, details, run, number)
            compact(spark, root, number)

    run_available(stream.writeStream.foreachBatch(merge), checkpoint)


def history_rows(spark: SparkSession, root: str) -> DataFrame:
    """All price changes of the store: (ad_id, price, changed_at)."""
    return spark.read.parquet(f"{root}/history").drop("version")
