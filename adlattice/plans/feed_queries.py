"""Registered queries: streams, archive, snapshots and export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.operators import lifecycle as life
from adlattice.plans.standins import (
    CUTOFF, DETAILS, DETAILS_CUTOFF, EVENT_SNAPSHOTS, LIFECYCLE, STAGING, details, event_snapshots, moment, prior_ads, staging,
)
from adlattice.session import scratch_path
from adlattice.sources import archive, snapshots
from adlattice.sources.tables import publish_view, read_html_files, read_table, read_warehouse, write_html_files
from adlattice.streaming import feeds, listing_store

_BATCHES = 5
_SNAPSHOT_COLUMNS = ["ad_id", "price", "scraped_at", "snapshot_id"]


def _in_batches(spark: SparkSession, rows: DataFrame, key: str) -> DataFrame:
    """``rows`` as a stream of about ``_BATCHES`` batches, each with rows from all over the table.

    Every task writes its rows by hash into a few files, so nothing is shuffled, and a batch takes its share of the files.
    """
    path = scratch_path(spark, "stream-input")
    rows.withColumn("part", F.pmod(F.xxhash64(key), F.lit(_BATCHES))).write.partitionBy("part").parquet(path)
    written = spark.read.parquet(path)
    files = -(-len(written.inputFiles()) // _BATCHES)
    return feeds.stream_files(spark, path, written.schema, files).drop("part")


def _snapshot_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot log as a stream in which most rows come late."""
    return _in_batches(spark, event_snapshots(spark, sf).select(*_SNAPSHOT_COLUMNS), "snapshot_id")


def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Every event offered twice, out of order, to the idempotent append; each is stored once."""
    target = scratch_path(spark, "stream-dedupe")
    twice = _snapshot_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    feeds.append_deduplicated(twice, ["ad_id", "scraped_at"], ["snapshot_id"], target, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(target).drop("batch")


def stream_master(spark: SparkSession, sf: str) -> DataFrame:
    """Newest snapshot of every listing, merged batch by batch from a stream of files."""
    root = scratch_path(spark, "master")
    feeds.maintain_master(_snapshot_stream(spark, sf), root, scratch_path(spark, "checkpoint"))
    return snapshots.read_snapshot(spark, root)


def stream_price_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Price changes found batch by batch over the whole log, which comes out of order."""
    history = scratch_path(spark, "changes")
    feeds.watch_prices(_snapshot_stream(spark, sf), history, scratch_path(spark, "checkpoint"))
    return feeds.price_changes(spark.read.parquet(history))


def stream_cache(spark: SparkSession, sf: str) -> DataFrame:
    """One cache entry per order by customer, fed as a stream; expired entries leave after 30 days."""
    entries = read_table(spark, sf, "orders").select(
        F.md5(F.col("o_custkey").cast("string")).alias("query_hash"),
        F.array("o_orderkey").alias("result_ad_ids"),
        (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("expires_at"),
        (F.col("o_orderdate") + F.make_interval(secs=F.col("o_orderkey") / 1000000)).alias("created_at"),
    )
    root = scratch_path(spark, "cache")
    feeds.maintain_cache(_in_batches(spark, entries, "created_at"), root, scratch_path(spark, "checkpoint"), "30 days")
    return snapshots.read_snapshot(spark, root).select("query_hash", F.get("result_ad_ids", F.lit(0)).alias("ad_id"), "expires_at")


_FILES_PER_SLICE = 4


def _in_slices(spark: SparkSession, rows: DataFrame, slice_of, slices: int) -> DataFrame:
    """``rows`` as a stream of one batch per slice, in order; each slice is written as ``_FILES_PER_SLICE`` files after the one before."""
    path = scratch_path(spark, "stream-input")
    numbered = rows.withColumn("run", slice_of.cast("long"))
    for number in range(slices):
        numbered.where(F.col("run") == number).repartition(_FILES_PER_SLICE).write.mode("append").parquet(path)
    return feeds.stream_files(spark, path, numbered.schema, _FILES_PER_SLICE)


_STALE_SLICES = 4


def stream_stale(spark: SparkSession, sf: str) -> DataFrame:
    """Listings that were not seen again within 24 hours, from the snapshot log in slices of eight days."""
    target = scratch_path(spark, "stale")
    rows = event_snapshots(spark, sf).select(*_SNAPSHOT_COLUMNS)
    stream = _in_slices(spark, rows, F.floor((F.dayofmonth("scraped_at") - 1) / 8), _STALE_SLICES).drop("run")
    feeds.watch_stale(stream, target, scratch_path(spark, "checkpoint"))
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return spark.read.parquet(target).select("ad_id", ntz("last_seen_at"), ntz("stale_at"), "snapshots")


_RUNS = 4


def _listing_store(spark: SparkSession, sf: str) -> str:
    """A store fed with four runs: two years of search snapshots each, with eight days of details each."""
    root = scratch_path(spark, "listings")
    searches = _in_slices(spark, staging(spark, sf), F.floor((F.year("scraped_at") - 1995) / 2), _RUNS)
    items = _in_slices(spark, details(spark, sf), F.floor((F.dayofmonth("scraped_at") - 1) / 8), _RUNS)
    listing_store.maintain_listings(listing_store.run_rows(searches, items), root, scratch_path(spark, "checkpoint"))
    return root


def stream_listings(spark: SparkSession, sf: str) -> DataFrame:
    """The master after four streamed runs, with details kept over runs and listings not in the last run inactive."""
    rows = listing_store.read_listings(spark, _listing_store(spark, sf))
    return rows.select("ad_id", "ad_url", "latest_price", "first_seen_at", "last_seen_at", "active", "has_embeddings", "run",
                       "title", "year", F.md5("description").alias("text_md5"), F.col("source_raw").isNotNull().alias("has_source"))


def stream_listing_history(spark: SparkSession, sf: str) -> DataFrame:
    """The price changes that the four streamed runs found against the master before each."""
    return listing_store.history_rows(spark, _listing_store(spark, sf))


def archive_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots written to the JSON archive of a run and read back with typed ids."""
    listings = staging(spark, sf).drop("snapshot_id").withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    path = archive.archive_listings(listings, scratch_path(spark, "archive"), "2025-01-01T07:00:00")
    back = archive.typed_listings(archive.read_archive(spark, path))
    return back.withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


def staged_load(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log loaded twice into the staging table; the second load inserts nothing."""
    path = scratch_path(spark, "staging")
    listings = staging(spark, sf).withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    first, second = (archive.load_staging(listings, path, ["snapshot_id"]) for _ in range(2))
    stored = spark.read.parquet(path)
    return stored.groupBy("ad_id").agg(F.count(F.lit(1)).alias("rows"), F.max("price").alias("highest")).withColumns(
        {"first_load": F.lit(first).cast("bigint"), "second_load": F.lit(second).cast("bigint")}
    )


def master_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of the master in a snapshot table; the newest complete one is read."""
    root = scratch_path(spark, "ads")
    before = prior_ads(spark, sf)
    snapshots.write_snapshot(before, root, 1)
    seen = life.seen_listings(staging(spark, sf), "last_run", run_length="30 days")
    snapshots.write_snapshot(life.deactivate_disappeared(snapshots.read_snapshot(spark, root), seen), root, 2)
    return snapshots.read_snapshot(spark, root).select("ad_id", "latest_price", "active")


def snapshot_export(spark: SparkSession, sf: str) -> DataFrame:
    """Full compressed export of two tables, with the row count of each copy."""
    tables = {"ads": prior_ads(spark, sf), "staging_ads": staging(spark, sf)}
    target = archive.export_snapshot(tables, scratch_path(spark, "backup"), "2025-01-01T02:00:00")
    counts = [
        spark.read.parquet(f"{target}/{name}").agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(name))
        for name in tables
    ]
    return counts[0].unionByName(counts[1])


def appended_details(spark: SparkSession, sf: str) -> DataFrame:
    """Detail table after the rows since the cutoff were appended to those before it; no key may occur twice."""
    rows = details(spark, sf)
    old, new = rows.where(F.col("scraped_at") < moment(DETAILS_CUTOFF)), rows.where(F.col("scraped_at") >= moment(DETAILS_CUTOFF))
    stored = scratch_path(spark, "details")
    old.write.parquet(stored)
    archive.append_details(new, spark.read.parquet(stored)).write.mode("append").parquet(stored)
    return spark.read.parquet(stored).select("ad_id", "scraped_at", "title", "year", F.md5("description").alias("text_md5"))


def detail_clashes(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that would fail an append in which times are cut to days: twice in the load, or stored already."""
    rows = details(spark, sf).withColumn("scraped_at", F.date_trunc("day", "scraped_at").cast("timestamp_ntz"))
    early = F.col("snapshot_id") % 2 == 0
    return archive.clashing_keys(rows.where(~early), rows.where(early))


def html_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written as an HTML file of its own and read back whole."""
    path = scratch_path(spark, "html")
    write_html_files(read_table(spark, sf, "pages"), "page_id", path)
    back = read_html_files(spark, path)
    # Spark ends a written text with a line break.
    return back.select(F.regexp_extract("url", "page_id=([0-9]+)", 1).cast("bigint").alias("page_id"),
                       F.md5(F.regexp_replace("html", r"\n\z", "")).alias("html_md5"))


def cleaned_view(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned listings as a view for SQL users: listings and mean price per year of their specs."""
    publish_view(life.cleaned_listings(staging(spark, sf)), "listings_cleaned")
    return spark.sql("""SELECT extracted_year, count(*) AS listings, round(avg(price), 4) AS mean_price
        FROM listings_cleaned GROUP BY extracted_year""")


def warehouse_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two generations of the staging table, the older without prices, read as one table of the declared layout."""
    root = scratch_path(spark, "warehouse")
    rows = staging(spark, sf)
    early = F.col("scraped_at") < moment(CUTOFF)
    rows.where(early).drop("price").write.parquet(f"{root}/staging_ads/part=1")
    rows.where(~early).withColumn("price", F.col("price").cast("bigint")).write.parquet(f"{root}/staging_ads/part=2")
    back = read_warehouse(spark, root, "staging_ads")
    return back.select("ad_id", F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"), "price", "specs_text")


def archived_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The archive files of two runs read as one table, counted per listing."""
    listings = staging(spark, sf).drop("snapshot_id").withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    root = scratch_path(spark, "runs")
    late = F.col("scraped_at") >= moment(CUTOFF).cast("timestamp")
    paths = [archive.archive_listings(part, root, time) for part, time in
             ((listings.where(~late), "2025-01-01T07:00:00"), (listings.where(late), "2025-01-02T07:00:00"))]
    rows = archive.typed_listings(archive.read_json_line_files(spark, paths))
    return rows.groupBy("ad_id").agg(F.count(F.lit(1)).alias("rows"), F.max("price").alias("highest"))


def json_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every order's snapshot as one JSON text, compared by its MD5."""
    row = archive.as_json([F.col("ad_id"), F.col("price"), F.col("specs_text")])
    return staging(spark, sf).select("snapshot_id", F.md5(row).alias("json_md5"))


QUERIES = {
    f.__name__: f
    for f in [
        stream_dedupe, stream_master, stream_price_changes, stream_cache, stream_stale, stream_listings, stream_listing_history,
        archive_roundtrip, staged_load, master_versions,
        snapshot_export, appended_details, detail_clashes, html_files, cleaned_view, warehouse_table, archived_runs, json_rows,
    ]
}

_RUN_LATEST = f"""{STAGING}, {DETAILS}, runs AS (SELECT *, CAST(floor((year(scraped_at) - 1995) / 2) AS BIGINT) AS run FROM staging),
run_latest AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY ad_id, run ORDER BY scraped_at DESC, snapshot_id DESC) = 1)"""

ORACLE = {
    "stream_dedupe": f"WITH {EVENT_SNAPSHOTS} SELECT ad_id, scraped_at, snapshot_id, price FROM event_snapshots",
    "stream_master": f"""WITH {EVENT_SNAPSHOTS} SELECT ad_id, price, scraped_at, snapshot_id FROM event_snapshots
        QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY scraped_at DESC, snapshot_id DESC) = 1""",
    "stream_price_changes": f"""WITH {EVENT_SNAPSHOTS} SELECT ad_id, old_price, price AS new_price, scraped_at AS changed_at
        FROM (SELECT *, lag(price) OVER (PARTITION BY ad_id ORDER BY scraped_at, snapshot_id) AS old_price FROM event_snapshots)
        WHERE old_price IS NOT NULL AND price <> old_price""",
    "stream_cache": """WITH entries AS (SELECT md5(CAST(o_custkey AS VARCHAR)) AS query_hash, o_orderkey AS ad_id,
          o_orderdate + INTERVAL 60 DAY AS expires_at,
          o_orderdate + to_microseconds(o_orderkey) AS created_at FROM orders),
        newest AS (SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY query_hash ORDER BY created_at DESC) = 1)
        SELECT query_hash, ad_id, expires_at FROM newest
        WHERE expires_at >= (SELECT max(created_at) FROM entries) - INTERVAL 30 DAY""",
    "stream_stale": f"""WITH {EVENT_SNAPSHOTS}, gaps AS (SELECT *,
          coalesce(scraped_at > lag(scraped_at) OVER w + INTERVAL 24 HOUR, true) AS starts FROM event_snapshots
          WINDOW w AS (PARTITION BY ad_id ORDER BY scraped_at, snapshot_id)),
        sessions AS (SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY ad_id ORDER BY scraped_at, snapshot_id) AS session FROM gaps)
        SELECT ad_id, max(scraped_at) AS last_seen_at, max(scraped_at) + INTERVAL 24 HOUR AS stale_at, count(*) AS snapshots
        FROM sessions GROUP BY ad_id, session HAVING max(scraped_at) + INTERVAL 24 HOUR <= (SELECT max(scraped_at) FROM event_snapshots)""",
    "stream_listings": f"""WITH {_RUN_LATEST},
        run_details AS (SELECT d.*, run FROM (SELECT *, CAST(floor((day(scraped_at) - 1) / 8) AS BIGINT) AS run FROM details
            QUALIFY row_number() OVER (PARTITION BY ad_id, run ORDER BY scraped_at DESC, snapshot_id DESC) = 1) d
          SEMI JOIN run_latest l ON l.ad_id = d.ad_id AND l.run = d.run),
        kept AS (SELECT ad_id, arg_max(title, run) FILTER (WHERE title IS NOT NULL) AS title,
            arg_max(year, run) FILTER (WHERE year IS NOT NULL) AS year, arg_max(description, run) FILTER (WHERE description IS NOT NULL) AS description,
            bool_or(source_json IS NOT NULL) AS has_source FROM run_details GROUP BY ad_id),
        merged AS (SELECT ad_id, min(scraped_at) AS first_seen_at, max(run) AS run FROM run_latest GROUP BY ad_id)
        SELECT m.ad_id, l.ad_url, l.price AS latest_price, m.first_seen_at, l.scraped_at AS last_seen_at,
          m.run = (SELECT max(run) FROM runs) AS active, false AS has_embeddings, m.run, k.title, k.year, md5(k.description) AS text_md5,
          coalesce(k.has_source, false) AS has_source
        FROM merged m JOIN run_latest l ON l.ad_id = m.ad_id AND l.run = m.run LEFT JOIN kept k ON k.ad_id = m.ad_id""",
    "stream_listing_history": f"""WITH {_RUN_LATEST} SELECT ad_id, price, scraped_at AS changed_at FROM (
          SELECT *, lag(price) OVER w AS old_price, row_number() OVER w AS place FROM run_latest WINDOW w AS (PARTITION BY ad_id ORDER BY run))
        WHERE place > 1 AND price IS NOT NULL AND price IS DISTINCT FROM old_price""",
    "archive_roundtrip": f"WITH {STAGING} SELECT ad_id, ad_url, price, specs_text, scraped_at FROM staging",
    "staged_load": f"""WITH {STAGING}, firsts AS (SELECT * FROM staging
          QUALIFY row_number() OVER (PARTITION BY ad_id, scraped_at ORDER BY snapshot_id) = 1)
        SELECT ad_id, count(*) AS rows, max(price) AS highest, (SELECT count(*) FROM firsts) AS first_load,
          CAST(0 AS BIGINT) AS second_load FROM firsts GROUP BY ad_id""",
    "master_versions": f"""WITH {LIFECYCLE} SELECT ad_id, latest_price, active AND EXISTS (SELECT 1 FROM staging s
          WHERE s.ad_id = a.ad_id AND s.scraped_at >= (SELECT max(scraped_at) - INTERVAL 30 DAY FROM staging)) AS active FROM ads a""",
    "snapshot_export": f"""WITH {LIFECYCLE} SELECT 'ads' AS table_name, count(*) AS rows FROM ads
        UNION ALL SELECT 'staging_ads', count(*) FROM staging""",
    "appended_details": f"""WITH {DETAILS} SELECT ad_id, scraped_at, title, year, md5(description) AS text_md5 FROM details""",
    "detail_clashes": f"""WITH {DETAILS} SELECT ad_id, date_trunc('day', scraped_at) AS scraped_at, count(*) AS rows FROM details
        GROUP BY ALL HAVING count(*) > 1 AND bool_or(snapshot_id % 2 <> 0)""",
    "html_files": "SELECT page_id, md5(html) AS html_md5 FROM pages",
    "cleaned_view": rf"""WITH {STAGING} SELECT regexp_extract(specs_text, '(\d{{4}})', 1) AS extracted_year, count(*) AS listings,
        round(avg(price), 4) AS mean_price FROM staging WHERE price IS NOT NULL AND ad_id IS NOT NULL GROUP BY ALL""",
    "warehouse_table": f"""WITH {STAGING} SELECT ad_id, scraped_at, specs_text,
        CASE WHEN scraped_at >= TIMESTAMP '{CUTOFF}' THEN price END AS price FROM staging""",
    "archived_runs": f"WITH {STAGING} SELECT ad_id, count(*) AS rows, max(price) AS highest FROM staging GROUP BY ad_id",
    "json_rows": f"""WITH {STAGING} SELECT snapshot_id, md5('{{"ad_id":' || ad_id || ',"price":' || coalesce(CAST(price AS VARCHAR), 'null')
        || ',"specs_text":"' || specs_text || '"}}') AS json_md5 FROM staging""",
}
