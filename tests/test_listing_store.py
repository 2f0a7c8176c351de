"""The streamed master against the batch run, and stale listings as a stream."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlattice.operators.lifecycle import incoming_listings, snapshot_to_master
from adlattice.session import scratch_path
from adlattice.sources import snapshots
from adlattice.streaming import feeds, listing_store

DAY = datetime.datetime(2024, 1, 1)
STAGING = "ad_id bigint, ad_url string, price int, scraped_at timestamp_ntz, snapshot_id bigint, run bigint"
DETAILS = "ad_id bigint, scraped_at timestamp_ntz, snapshot_id bigint, title string, year int, source_json string, run bigint"


def made_runs(spark, runs, listings=60):
    draw = np.random.default_rng(runs)
    staging, details, number = [], [], 0
    for run in range(runs):
        for ad in range(listings):
            for _ in range(int(draw.integers(0, 3))):
                number += 1
                price = None if draw.random() < 0.1 else int(draw.integers(1, 4))
                staging.append((ad, f"/item/{ad}/{run}", price, DAY + datetime.timedelta(days=run, seconds=number), number, run))
            if draw.random() < 0.5:
                title = None if draw.random() < 0.4 else f"t{run}"
                details.append((ad, DAY + datetime.timedelta(days=run), number, title, None if draw.random() < 0.4 else run, None, run))
    return spark.createDataFrame(staging, STAGING), spark.createDataFrame(details, DETAILS)


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


def batch_runs(staging, details, runs):
    """The same runs one after the other through the batch form."""
    ads = history = None
    for run in range(runs):
        own, items = (df.where(F.col("run") == run).drop("run") for df in (staging, details))
        if ads is None:
            ads = incoming_listings(own, items).withColumn("has_embeddings", F.lit(False)).where(F.lit(False))
        ads, changes = snapshot_to_master(ads, own, items)
        history = changes if history is None else history.unionByName(changes)
        ads, history = ads.checkpoint(), history.checkpoint()
    return ads, history


@pytest.mark.parametrize("share", [0.0, 0.5, 1e9])
def test_every_run_equals_the_batch_form(spark, share):
    """With a base after every run, now and then, and only once."""
    runs = 4
    staging, details = made_runs(spark, runs)
    root = scratch_path(spark, "store")
    for run in range(runs):
        own, items = (df.where(F.col("run") == run).drop("run") for df in (staging, details))
        for _ in range(2):  # done again after a failure
            listing_store.merge_run(spark, root, own, items, run, run)
        listing_store.compact(spark, root, run, share)
    ads, history = batch_runs(staging, details, runs)
    assert rows(listing_store.read_listings(spark, root).drop("run")) == rows(ads)
    assert rows(listing_store.history_rows(spark, root)) == rows(history)
    assert len(snapshots.versions(spark, f"{root}/base")) == {0.0: 4, 1e9: 1}.get(share, len(snapshots.versions(spark, f"{root}/base")))
    assert len(snapshots.versions(spark, f"{root}/delta")) == runs


def test_streamed_runs_in_parts_and_late(spark):
    """A run in two batches and one that comes late leave the same master."""
    staging, details = made_runs(spark, 3)
    root, path, check = (scratch_path(spark, n) for n in ("store", "in", "check"))
    both = listing_store.run_rows(staging, details).cache()
    for part in (F.col("run") == 0, (F.col("run") == 2) & (F.col("ad_id") < 30), (F.col("run") == 2) & (F.col("ad_id") >= 30)):
        both.where(part).coalesce(1).write.mode("append").parquet(path)
    listing_store.maintain_listings(feeds.stream_files(spark, path, both.schema, 1), root, check)
    halved = [df.where("run <> 1").withColumn("run", (F.col("run") / 2).cast("long")) for df in (staging, details)]
    two = batch_runs(*halved, 2)[0]
    assert rows(listing_store.read_listings(spark, root).drop("run")) == rows(two)
    known = {r["ad_id"]: r for r in two.collect()}
    late = both.where("run = 1")
    late.coalesce(1).write.mode("append").parquet(path)
    listing_store.maintain_listings(feeds.stream_files(spark, path, both.schema, 1), root, check)
    seen_last = {r["ad_id"] for r in staging.where("run = 2").select("ad_id").distinct().collect()}
    for r in listing_store.read_listings(spark, root).collect():
        if r["ad_id"] in seen_last:  # nothing rolls back
            assert (r["last_seen_at"], r["latest_price"], r["active"]) == (
                known[r["ad_id"]]["last_seen_at"], known[r["ad_id"]]["latest_price"], True)
        else:
            assert not r["active"] or r["run"] == 2


def test_stale_listings(spark):
    path, target = scratch_path(spark, "in"), scratch_path(spark, "stale")
    schema = "ad_id bigint, scraped_at timestamp_ntz"
    for hours in ([(1, 0), (1, 23), (2, 0), (3, 10)], [(2, 30), (1, 48), (3, 34)], [(4, 80)]):
        spark.createDataFrame([(i, DAY + datetime.timedelta(hours=h)) for i, h in hours], schema).coalesce(1).write.mode("append").parquet(path)
    check = scratch_path(spark, "check")
    feeds.watch_stale(feeds.stream_files(spark, path, spark.read.parquet(path).schema, 1), target, check)
    have = sorted((r["ad_id"], (r["last_seen_at"] - DAY) / datetime.timedelta(hours=1), r["snapshots"]) for r in
                  spark.read.parquet(target).withColumn("last_seen_at", F.col("last_seen_at").cast("timestamp_ntz")).collect())
    assert have == [(1, 23, 2), (1, 48, 1), (2, 0, 1), (2, 30, 1), (3, 34, 2)]
    assert all(r["stale_at"] - r["last_seen_at"] == datetime.timedelta(hours=24) for r in spark.read.parquet(target).collect())
