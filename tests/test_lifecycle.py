import datetime

import pytest
from pyspark.sql import functions as F

from adlattice.operators import lifecycle as life
from adlattice.operators import quality, queues
from adlattice.schemas import ADS, STAGING_ADS, align_to_schema

DAY = datetime.datetime(2024, 1, 1)


def day(n):
    return DAY + datetime.timedelta(days=n)


def staging_of(spark, rows):
    schema = "ad_id bigint, ad_url string, price int, specs_text string, scraped_at timestamp_ntz, snapshot_id bigint"
    return spark.createDataFrame([(i, f"/item/{i}", p, "x", day(t), n) for n, (i, p, t) in enumerate(rows)], schema)


def details_of(spark, rows):
    schema = "ad_id bigint, scraped_at timestamp_ntz, snapshot_id bigint, title string, year int, source_json string"
    return spark.createDataFrame([(i, day(t), n, title, year, None) for n, (i, t, title, year) in enumerate(rows)], schema)


@pytest.fixture
def ads(spark):
    staging = staging_of(spark, [(1, 100, 0), (2, None, 0), (3, 300, 0), (4, -1, 0)])
    details = details_of(spark, [(1, 0, "one", 1990), (3, 0, "three", None)])
    empty = life.incoming_listings(staging, details).withColumn("has_embeddings", F.lit(True))
    return empty.withColumn("active", F.col("ad_id") != 3)


def table(df, *columns):
    return {r["ad_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_merge_policies(spark, ads):
    staging = staging_of(spark, [(1, 100, 5), (2, 50, 5), (5, 10, 5), (5, 20, 6)])
    details = details_of(spark, [(1, 5, None, 1991), (5, 5, "five", None)])
    merged = life.merge_master(ads, staging, details)
    assert table(merged, "title", "year", "latest_price", "first_seen_at", "last_seen_at", "active", "has_embeddings") == {
        1: ("one", 1991, 100, day(0), day(5), True, True),
        2: (None, None, 50, day(0), day(5), True, True),
        3: ("three", None, 300, day(0), day(0), False, True),
        4: (None, None, -1, day(0), day(0), True, True),
        5: ("five", None, 20, day(6), day(6), True, False),
    }
    again = life.merge_master(merged, staging, details)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_price_history(spark, ads):
    staging = staging_of(spark, [(1, 100, 5), (2, 50, 5), (3, None, 5), (4, None, 5), (5, 10, 5)])
    assert table(life.price_history_rows(staging, ads), "price") == {2: (50,)}
    assert table(life.price_history_rows(staging, ads, with_initial=True), "price") == {2: (50,), 5: (10,)}
    latest = life.latest_snapshot(staging)
    assert set(table(life.price_changed(latest, ads), "new_price")) == {2, 3, 4}
    assert set(table(life.price_changed(latest, ads, sentinel=-1), "new_price")) == {2, 3}  # -1 meets NULL
    after = life.merge_master(ads, staging, details_of(spark, []))
    assert life.price_history_rows(staging, after).count() == 0


def test_return_to_the_same_price_is_logged(spark):
    log = staging_of(spark, [(1, 5, 0), (1, None, 1), (1, 5, 2), (1, 5, 3), (1, 6, 4)])
    changes = [(r["old_price"], r["new_price"]) for r in life.price_changes_log(log).orderBy("changed_at").collect()]
    assert changes == [(None, 5), (5, 6)]


def test_candidates_and_deactivation(spark, ads):
    staging = staging_of(spark, [(1, 101, 5), (2, None, 5), (5, 1, 5)])
    due = life.crawl_candidates(staging, ads, F.lit(day(1) - datetime.timedelta(hours=1)).cast("timestamp_ntz"), share=0.0)
    assert {r["ad_id"]: r["reasons"] for r in due.collect()} == {1: ["price"], 5: ["new"]}
    due = life.crawl_candidates(staging, ads, F.lit(day(2)).cast("timestamp_ntz"), share=1.0)
    assert {r["ad_id"]: r["reasons"] for r in due.collect()} == {
        1: ["price", "stale", "sample"], 2: ["stale", "sample"], 4: ["stale", "sample"], 5: ["new"],
    }
    seen = life.seen_listings(staging)
    assert table(life.disappeared_listings(ads, seen), "latest_price") == {4: (-1,)}
    assert table(life.deactivate_disappeared(ads, seen), "active") == {1: (True,), 2: (True,), 3: (False,), 4: (False,)}
    gone = life.deactivate_gone(ads, spark.createDataFrame([(1,), (3,), (1,)], "ad_id bigint"))
    assert table(gone, "active", "newly_inactive") == {1: (False, True), 2: (True, False), 3: (False, False), 4: (True, False)}
    with pytest.raises(ValueError):
        life.seen_listings(staging, "never")


def test_sample_share_is_stable(spark):
    ids = spark.range(20000).select(F.col("id").alias("ad_id"), F.lit(True).alias("active"))
    first = {r["ad_id"] for r in life.sampled_listings(ids).collect()}
    assert first == {r["ad_id"] for r in life.sampled_listings(ids.repartition(7)).collect()}
    assert 850 < len(first) < 1150


def test_alignment(spark):
    old = spark.createDataFrame([("12", "", "x"), ("", "7", "y")], "ad_id string, price string, junk string")
    rows = align_to_schema(old, STAGING_ADS).collect()
    assert [(r["ad_id"], r["price"], r["ad_url"]) for r in rows] == [(12, None, None), (None, 7, None)]
    flags = align_to_schema(spark.createDataFrame([(1, '["a"]')], "ad_id bigint, equipment string"), ADS).first()
    assert (flags["active"], flags["has_embeddings"], flags["equipment"]) == (True, False, ["a"])


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", [1]), (1, "", []), (None, None, None)], "k bigint, s string, a array<int>")
    report = {r["constraint_name"]: r["violations"] for r in quality.key_violations(df, ["k"], ["k", "s"], df.where("k = 2"), "k").collect()}
    assert report == {"unique": 1, "not_null:k": 1, "not_null:s": 1, "foreign_key": 2}
    assert quality.informative_rows(df, ["s", "a"]).count() == 1
    zero = spark.createDataFrame([(0,), (None,)], "price int")
    assert quality.informative_rows(zero).count() == 1  # zero counts as present


def test_chunk_upsert_and_replace(spark):
    schema = "ad_id bigint, chunk_source string, chunk_order int, chunk_text string, chunk_length int, overlap_words int, embedding array<float>"
    stamp = lambda df, t: df.withColumns({"created_at": F.lit(t), "updated_at": F.lit(t)})
    old = stamp(spark.createDataFrame([(1, "description", i, f"old{i}", 1, 0, [1.0]) for i in range(3)] + [(2, "description", 0, "two", 1, 0, [1.0])], schema), "t0")
    new = spark.createDataFrame([(1, "description", 0, "new0", 1, 0, [2.0])], schema)
    upserted = queues.upsert_chunks(old, new, F.lit("t1"))
    assert sorted((r["ad_id"], r["chunk_text"], r["created_at"], r["updated_at"]) for r in upserted.collect()) == [
        (1, "new0", "t0", "t1"), (1, "old1", "t0", "t0"), (1, "old2", "t0", "t0"), (2, "two", "t0", "t0"),
    ]
    replaced = queues.replace_chunks(old, stamp(new, "x"), F.lit("t1"))
    assert sorted((r["ad_id"], r["chunk_text"], r["created_at"], r["updated_at"]) for r in replaced.collect()) == [
        (1, "new0", "t0", "t1"), (2, "two", "t0", "t0"),
    ]


def test_changed_texts(spark):
    ads = spark.createDataFrame([(1, "a", True), (2, "b", True), (3, "c", True), (4, None, True)], "ad_id bigint, description string, active boolean")
    done = ads.where("ad_id < 3").select("ad_id", F.md5(F.lit("a")).alias("text_hash"))
    assert {r["ad_id"] for r in queues.changed_texts(ads, done).collect()} == {2, 3}


def test_backfill_queue_and_overwrite(spark):
    rows = [(1, "/1", None, True, "r1"), (2, "/2", "two", False, "r2"), (3, "/3", "three", True, "r3")]
    ads = spark.createDataFrame(rows, "ad_id bigint, ad_url string, description string, active boolean, source_raw string")
    assert [(r["ad_id"], r["current_desc"]) for r in queues.backfill_queue(ads, limit=5).collect()] == [(1, ""), (3, "three")]
    ids = spark.createDataFrame([(2,), (9,), (2,)], "ad_id bigint")
    assert [r["ad_id"] for r in queues.backfill_queue(ads, ids).collect()] == [2]
    fetched = spark.createDataFrame([(1, "  new one ", None), (3, "new three", "r3b"), (9, "x", None)], "ad_id bigint, description string, source_raw string")
    after = table(queues.overwrite_descriptions(ads, fetched), "description", "source_raw")
    assert after == {1: ("new one", "r1"), 2: ("two", "r2"), 3: ("new three", "r3b")}
