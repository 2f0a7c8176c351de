"""Stream forms of the loads and merges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from adlattice.operators.keyed import first_per_key, latest_per_key
from adlattice.sources.archive import path_exists
from adlattice.sources.snapshots import read_snapshot, versions, write_snapshot
from adlattice.streaming import price_watch


def stream_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder (or glob) of parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything there is and stop; a later run goes on where this one ended."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def earlier_batches(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What the batches before ``batch_id`` have written to ``path``; None if nothing yet.

    One scan of the whole folder, where the batch number is a partition column.
    """
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).where(F.col("batch") < batch_id).drop("batch")


def append_deduplicated(stream: DataFrame, keys: list[str], order: list[str], target: str, checkpoint: str) -> None:
    """Idempotent append as a stream into a parquet folder: the first row of every key, in arrival order.

    Only keys that are stored already are left out, however late a row comes. A batch has its own
    folder, so a repeated batch replaces its rows.
    """

    def insert(batch: DataFrame, batch_id: int) -> None:
        stored = earlier_batches(batch.sparkSession, target, batch_id)
        rows = first_per_key(batch, keys, order)
        if stored is not None:
            rows = rows.join(stored.select(*keys), keys, "left_anti").select(batch.columns)
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    run_available(stream.writeStream.foreachBatch(insert), checkpoint)


def newest_prices(ads: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Next (ad_id, price, scraped_at, snapshot_id) state: the newest snapshot of each listing.

    A late snapshot never rolls a newer state back, as rows compete by scrape time, not arrival. Snapshots equal in listing, time and number
    are one, with the lowest price, as in the price watch.
    """
    order = ["scraped_at", "snapshot_id"]
    both = batch if ads is None else ads.unionByName(latest_per_key(_once(batch), "ad_id", order))
    return latest_per_key(_once(both), "ad_id", order).select(batch.columns)


def _once(rows: DataFrame) -> DataFrame:
    keys = ["ad_id", "scraped_at", "snapshot_id"]
    others = [F.first(c).alias(c) for c in rows.columns if c not in (*keys, "price")]
    return rows.groupBy(*keys).agg(F.min("price").alias("price"), *others)


def versioned_batches(root: str, step: Callable[[DataFrame | None, DataFrame, int], DataFrame]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: ``step(before, batch, batch_id)`` gives the next version of a snapshot table.

    The version is the batch number, so a batch that is run again after a failure rewrites the same
    version from the one before it.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [v for v in versions(spark, root) if v < batch_id]
        before = read_snapshot(spark, root, earlier[-1]) if earlier else None
        write_snapshot(step(before, batch, batch_id), root, batch_id)

    return run


def maintain_master(stream: DataFrame, root: str, checkpoint: str) -> None:
    """Keep the newest snapshot of every listing as a versioned table, fed by a stream."""
    merge = versioned_batches(root, lambda before, batch, _: newest_prices(before, batch))
    run_available(stream.writeStream.foreachBatch(merge), checkpoint)


CHANGE = ["ad_id", "snapshot_id", "changed_at", "old_price", "new_price"]


def price_changes(history: DataFrame) -> DataFrame:
    """The changes that hold after all batches of :func:`watch_prices`."""
    standing = history.groupBy(*CHANGE).agg(F.sum("sign").alias("sign")).where("sign > 0")
    return standing.select("ad_id", "old_price", "new_price", "changed_at")


def watch_prices(stream: DataFrame, history: str, checkpoint: str) -> None:
    """Append every price change of a snapshot stream, in any order, to the files in ``history``.

    Snapshots are kept as keyed state, so a batch looks at no earlier batch. Files of a batch that did not finish are not
    in the folder's log, so a repeated batch adds nothing twice.
    """
    spark = stream.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, price_watch.STATE_STORE)
    try:
        changes = price_watch.price_change_stream(stream)
        run_available(changes.writeStream.outputMode("append").format("parquet").option("path", history), checkpoint)
    finally:
        spark.conf.set(setting, before)


def maintain_cache(stream: DataFrame, root: str, checkpoint: str, lag: str = "1 day") -> None:
    """Keep the result cache from a stream of entries: newest entry per query, long expired ones dropped.

    Time is the newest creation time seen, not the clock, so a replay gives the same cache.
    """

    def step(before: DataFrame | None, batch: DataFrame, _: int) -> DataFrame:
        newest = latest_per_key(batch, "query_hash", ["created_at"])
        merged = newest if before is None else latest_per_key(before.unionByName(newest), "query_hash", ["created_at"])
        # One value, found before the filter, so that the filter can reach the scan.
        now = merged.agg(F.max("created_at")).first()[0]
        return merged.where(F.col("expires_at") >= F.lit(now).cast(merged.schema["created_at"].dataType) - F.expr(f"INTERVAL {lag}"))

    run_available(stream.writeStream.foreachBatch(versioned_batches(root, step)), checkpoint)


def gone_stale(snapshots: DataFrame, age: str = "24 hours", delay: str = "0 seconds") -> DataFrame:
    """Stream of listings that were not seen again within ``age``: (ad_id, last_seen_at, stale_at, snapshots).

    Snapshots of a listing at most ``age`` apart are one session, kept as keyed state by its end only. A session is given out once
    event time has passed the end, and its state leaves then: ``stale_at`` is when the listing became stale, ``snapshots`` how
    often it was seen before. Snapshots may come up to ``delay`` late; a listing seen again afterwards starts a new session.
    """
    rows = snapshots.withColumn("scraped_at", F.col("scraped_at").cast("timestamp")).withWatermark("scraped_at", delay)
    sessions = rows.groupBy("ad_id", F.session_window("scraped_at", age).alias("session")).agg(
        F.max("scraped_at").alias("last_seen_at"), F.count(F.lit(1)).alias("snapshots"))
    return sessions.select("ad_id", "last_seen_at", F.col("session.end").alias("stale_at"), "snapshots")


def watch_stale(stream: DataFrame, target: str, checkpoint: str, age: str = "24 hours", delay: str = "0 seconds") -> None:
    """Append every listing that goes stale to the files in ``target``."""
    writer = gone_stale(stream, age, delay).writeStream.outputMode("append").format("parquet").option("path", target)
    run_available(writer, checkpoint)
