"""Registered queries: snapshots, master, history and constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.operators import lifecycle as life
from adlattice.operators import quality
from adlattice.operators.keyed import latest_per_key
from adlattice.operators.ranges import range_totals, with_place_of_ranges
from adlattice.plans.standins import (
    AS_OF, CUTOFF, EVENT_SNAPSHOTS, LATEST, LIFECYCLE, RUN_SINCE, STAGING,
    details, event_snapshots, moment, prior_ads, staging,
)
from adlattice.schemas import align_to_schema, STAGING_ADS
from adlattice.sources.archive import loadable_rows, run_counters
from adlattice.sources.tables import read_table

STALE_AGE = "90 days"

MASTER_COLUMNS = [
    "ad_id", "ad_url", "title", "description", "year", "lat", "latest_price", "first_seen_at", "last_seen_at",
    "last_scraped_at", "active", "has_embeddings", "source_raw",
]
MASTER_SQL = f"""merged AS (
  SELECT coalesce(l.ad_id, a.ad_id) AS ad_id,
    CASE WHEN l.ad_id IS NOT NULL THEN l.ad_url ELSE a.ad_url END AS ad_url,
    coalesce(d.title, a.title) AS title, coalesce(d.description, a.description) AS description,
    coalesce(d.year, a.year) AS year, coalesce(d.lat, a.lat) AS lat,
    CASE WHEN l.ad_id IS NOT NULL THEN l.price ELSE a.latest_price END AS latest_price,
    CASE WHEN a.ad_id IS NOT NULL THEN a.first_seen_at ELSE l.scraped_at END AS first_seen_at,
    coalesce(l.scraped_at, a.last_seen_at) AS last_seen_at,
    coalesce(l.scraped_at, a.last_scraped_at) AS last_scraped_at,
    CASE WHEN l.ad_id IS NOT NULL THEN TRUE ELSE a.active END AS active,
    CASE WHEN a.ad_id IS NOT NULL THEN a.has_embeddings ELSE FALSE END AS has_embeddings,
    coalesce(d.source_json, a.source_raw) AS source_raw
  FROM latest l
  LEFT JOIN (SELECT * FROM details
    QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY scraped_at DESC, snapshot_id DESC) = 1) d ON d.ad_id = l.ad_id
  FULL JOIN ads a ON a.ad_id = l.ad_id)"""


def latest_listing(spark: SparkSession, sf: str) -> DataFrame:
    return life.latest_snapshot(event_snapshots(spark, sf))


def cleaned_listings(spark: SparkSession, sf: str) -> DataFrame:
    return life.cleaned_listings(staging(spark, sf))


def new_keys(spark: SparkSession, sf: str) -> DataFrame:
    latest = life.latest_snapshot(staging(spark, sf))
    return life.new_listings(latest, prior_ads(spark, sf)).select("ad_id", "price", "scraped_at")


def price_changed(spark: SparkSession, sf: str) -> DataFrame:
    return life.price_changed(life.latest_snapshot(staging(spark, sf)), prior_ads(spark, sf))


def price_changed_sentinel(spark: SparkSession, sf: str) -> DataFrame:
    return life.price_changed(life.latest_snapshot(staging(spark, sf)), prior_ads(spark, sf), sentinel=-1)


def stale_listings(spark: SparkSession, sf: str) -> DataFrame:
    return life.stale_listings(prior_ads(spark, sf), moment(AS_OF), STALE_AGE).select("ad_id", "last_scraped_at")


def sampled_listings(spark: SparkSession, sf: str) -> DataFrame:
    return life.sampled_listings(prior_ads(spark, sf), 0.05).select("ad_id")


def crawl_candidates(spark: SparkSession, sf: str) -> DataFrame:
    due = life.crawl_candidates(staging(spark, sf), prior_ads(spark, sf), moment(AS_OF), STALE_AGE)
    return due.select("ad_id", F.array_join("reasons", ",").alias("reasons"))


def master_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return life.merge_master(prior_ads(spark, sf), staging(spark, sf), details(spark, sf)).select(*MASTER_COLUMNS)


def price_history(spark: SparkSession, sf: str) -> DataFrame:
    return life.price_history_rows(staging(spark, sf), prior_ads(spark, sf))


def price_history_with_first(spark: SparkSession, sf: str) -> DataFrame:
    return life.price_history_rows(staging(spark, sf), prior_ads(spark, sf), with_initial=True)


def price_changes_log(spark: SparkSession, sf: str) -> DataFrame:
    return life.price_changes_log(event_snapshots(spark, sf))


def price_changes_log_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return life.price_changes_log(staging(spark, sf))


def deactivated(spark: SparkSession, sf: str) -> DataFrame:
    seen = life.seen_listings(staging(spark, sf), "since", moment(RUN_SINCE))
    return life.disappeared_listings(prior_ads(spark, sf), seen).select("ad_id", "last_seen_at")


def deactivated_last_run(spark: SparkSession, sf: str) -> DataFrame:
    seen = life.seen_listings(staging(spark, sf), "last_run", run_length="30 days")
    return life.disappeared_listings(prior_ads(spark, sf), seen).select("ad_id", "last_seen_at")


def snapshot_to_master(spark: SparkSession, sf: str) -> DataFrame:
    master, _ = life.snapshot_to_master(
        prior_ads(spark, sf), staging(spark, sf), details(spark, sf), "since", moment(RUN_SINCE)
    )
    return master.select(*MASTER_COLUMNS)


def gone_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Listings without a price in their newest snapshot are reported as gone."""
    gone = life.latest_snapshot(staging(spark, sf)).where(F.col("price").isNull()).select("ad_id")
    return life.deactivate_gone(prior_ads(spark, sf), gone).select("ad_id", "active", "newly_inactive")


def idempotent_append(spark: SparkSession, sf: str) -> DataFrame:
    rows = staging(spark, sf)
    existing = rows.where(F.col("scraped_at") < moment(CUTOFF)).select("ad_id", "scraped_at").distinct()
    return loadable_rows(rows, existing, ["snapshot_id"])


def load_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome of each snapshot in a load: skipped without price, duplicate of an earlier one, or inserted."""
    rows = staging(spark, sf)
    first = loadable_rows(rows, None, ["snapshot_id"]).select("snapshot_id", F.lit(True).alias("first"))
    marked = rows.join(first, "snapshot_id", "left")
    outcome = F.when(F.col("price").isNull(), "skipped").when(F.col("first").isNull(), "duplicate").otherwise("inserted")
    return run_counters(marked.select(outcome.alias("outcome")), "outcome")


def key_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_violations(
        staging(spark, sf), ["ad_id", "scraped_at"], ["ad_id", "price", "scraped_at"], prior_ads(spark, sf)
    )


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(staging(spark, sf), ["ad_id", "scraped_at"])


def cascade_prune(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots that survive when inactive listings are deleted from the master."""
    kept = prior_ads(spark, sf).where("active")
    return quality.cascade_prune(staging(spark, sf), kept).select("ad_id", "snapshot_id", "price")


def orphaned_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return quality.orphans(staging(spark, sf), prior_ads(spark, sf), "ad_id").select("ad_id", "snapshot_id")


def schema_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """An older layout of the snapshot log: text ids and prices, some of them '', and a missing column."""
    old = staging(spark, sf).select(
        F.col("ad_id").cast("string").alias("ad_id"),
        F.coalesce(F.col("price").cast("string"), F.lit("")).alias("price"),
        "specs_text",
        "scraped_at",
    )
    aligned = align_to_schema(old, STAGING_ADS)
    return aligned.withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


def quarantined_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots a NOT NULL price would reject, and how many pass, per listing status."""
    good, bad = quality.split_not_null(staging(spark, sf), ["price", "ad_id"])
    tagged = good.select("ad_id", F.lit("accepted").alias("outcome")).unionByName(
        bad.select("ad_id", F.lit("quarantined").alias("outcome"))
    )
    return tagged.groupBy("ad_id", "outcome").agg(F.count(F.lit(1)).alias("rows"))


def informative_details(spark: SparkSession, sf: str) -> DataFrame:
    """Detail snapshots with a title or a year; the others carry nothing to store."""
    fields = quality.INFORMATIVE_FOR_LOAD
    rows = details(spark, sf).drop("description", "lat")
    return quality.informative_rows(rows, fields).select("ad_id", "snapshot_id", "title", "year")


def latest_details(spark: SparkSession, sf: str) -> DataFrame:
    newest = latest_per_key(details(spark, sf), "ad_id", life.SNAPSHOT_ORDER)
    return life.latest_snapshot(staging(spark, sf)).select("ad_id", "price").join(
        newest.select("ad_id", "title", "year"), "ad_id", "left"
    )


def places_of_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Places of all snapshots by postal code, from a table of as many overlapping ranges as there are parts."""
    part = read_table(spark, sf, "part")
    low = F.col("p_partkey") * 37 % 9000
    ranges = part.select(
        low.alias("low"), (low + F.col("p_partkey") * F.col("p_size") % 400).alias("high"),
        F.col("p_name").alias("municipality"), F.col("p_brand").alias("county"))
    code = F.lpad((F.col("snapshot_id") * 7 % 10500).cast("string"), 4, "0")
    rows = staging(spark, sf).select(
        "snapshot_id", code.alias("postal_code"),
        F.when(F.col("snapshot_id") % 3 == 0, "known").when(F.col("snapshot_id") % 3 == 1, "0301").alias("municipality"),
        F.lit(None).cast("string").alias("county"))
    return with_place_of_ranges(rows, ranges)


def prices_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """For every price range made from a part, the snapshots inside it and the sum of their prices."""
    low = F.floor(F.col("p_retailprice") * 100).cast("bigint")
    ranges = read_table(spark, sf, "part").select(
        "p_partkey", low.alias("low"), (low + F.col("p_size") * F.col("p_size") - 40).alias("high"))
    return range_totals(staging(spark, sf).select("price"), ranges, "price", "low", "high", "p_partkey", "snapshots", "total")


QUERIES = {
    f.__name__: f
    for f in [
        latest_listing, cleaned_listings, new_keys, price_changed, price_changed_sentinel, stale_listings,
        sampled_listings, crawl_candidates, master_upsert, price_history, price_history_with_first,
        price_changes_log, price_changes_log_nulls, deactivated, deactivated_last_run, snapshot_to_master,
        gone_listings, idempotent_append, load_counters, key_violations, duplicate_keys, cascade_prune,
        orphaned_snapshots, schema_alignment, quarantined_rows, informative_details, latest_details,
        places_of_codes, prices_in_ranges,
    ]
}

_LAG = """SELECT ad_id, old_price, price AS new_price, scraped_at AS changed_at FROM (
  SELECT *, lag(price) OVER w AS old_price, lag(ad_id) OVER w AS has_old FROM {table}
  WINDOW w AS (PARTITION BY ad_id ORDER BY scraped_at, snapshot_id))
WHERE has_old IS NOT NULL AND price IS NOT NULL AND price IS DISTINCT FROM old_price"""

_SAMPLED = "('0x' || substr(md5(CAST(ad_id AS VARCHAR)), 1, 8))::BIGINT < 214748364"

ORACLE = {
    "latest_listing": f"""WITH {EVENT_SNAPSHOTS} SELECT * FROM event_snapshots
        QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY scraped_at DESC, snapshot_id DESC) = 1""",
    "cleaned_listings": rf"""WITH {STAGING} SELECT *, regexp_extract(specs_text, '(\d{{4}})', 1) AS extracted_year
        FROM staging WHERE price IS NOT NULL AND ad_id IS NOT NULL""",
    "new_keys": f"""WITH {LIFECYCLE} SELECT l.ad_id, l.price, l.scraped_at FROM latest l
        LEFT JOIN ads a ON a.ad_id = l.ad_id WHERE a.ad_id IS NULL""",
    "price_changed": f"""WITH {LIFECYCLE} SELECT l.ad_id, l.price AS new_price, l.scraped_at, a.latest_price AS old_price
        FROM latest l JOIN ads a ON a.ad_id = l.ad_id WHERE a.latest_price IS DISTINCT FROM l.price""",
    "price_changed_sentinel": f"""WITH {LIFECYCLE}
        SELECT l.ad_id, l.price AS new_price, l.scraped_at, a.latest_price AS old_price
        FROM latest l JOIN ads a ON a.ad_id = l.ad_id WHERE coalesce(a.latest_price, -1) <> coalesce(l.price, -1)""",
    "stale_listings": f"""WITH {LIFECYCLE} SELECT ad_id, last_scraped_at FROM ads
        WHERE active AND (last_scraped_at IS NULL OR last_scraped_at < TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY)""",
    "sampled_listings": f"WITH {LIFECYCLE} SELECT ad_id FROM ads WHERE active AND {_SAMPLED}",
    "crawl_candidates": f"""WITH {LIFECYCLE}, reasons AS (
          SELECT l.ad_id, 1 AS pos, 'new' AS reason FROM latest l LEFT JOIN ads a ON a.ad_id = l.ad_id WHERE a.ad_id IS NULL
          UNION ALL SELECT l.ad_id, 2, 'price' FROM latest l JOIN ads a ON a.ad_id = l.ad_id
            WHERE coalesce(a.latest_price, -1) <> coalesce(l.price, -1)
          UNION ALL SELECT ad_id, 3, 'stale' FROM ads
            WHERE active AND (last_scraped_at IS NULL OR last_scraped_at < TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY)
          UNION ALL SELECT ad_id, 4, 'sample' FROM ads WHERE active AND {_SAMPLED})
        SELECT ad_id, string_agg(reason, ',' ORDER BY pos) AS reasons FROM reasons GROUP BY ad_id""",
    "master_upsert": f"WITH {LIFECYCLE}, {MASTER_SQL} SELECT * FROM merged",
    "price_history": f"""WITH {LIFECYCLE} SELECT l.ad_id, l.price, l.scraped_at AS changed_at
        FROM latest l JOIN ads a ON a.ad_id = l.ad_id
        WHERE coalesce(a.latest_price, -1) <> coalesce(l.price, -1) AND l.price IS NOT NULL""",
    "price_history_with_first": f"""WITH {LIFECYCLE} SELECT l.ad_id, l.price, l.scraped_at AS changed_at
        FROM latest l LEFT JOIN ads a ON a.ad_id = l.ad_id
        WHERE l.price IS NOT NULL AND (a.ad_id IS NULL OR a.latest_price IS DISTINCT FROM l.price)""",
    "price_changes_log": f"WITH {EVENT_SNAPSHOTS} " + _LAG.format(table="event_snapshots"),
    "price_changes_log_nulls": f"WITH {STAGING} " + _LAG.format(table="staging"),
    "deactivated": f"""WITH {LIFECYCLE} SELECT ad_id, last_seen_at FROM ads a WHERE active AND NOT EXISTS
        (SELECT 1 FROM staging s WHERE s.ad_id = a.ad_id AND s.scraped_at >= TIMESTAMP '{RUN_SINCE}')""",
    "deactivated_last_run": f"""WITH {LIFECYCLE} SELECT ad_id, last_seen_at FROM ads a WHERE active AND NOT EXISTS
        (SELECT 1 FROM staging s WHERE s.ad_id = a.ad_id
         AND s.scraped_at >= (SELECT max(scraped_at) - INTERVAL 30 DAY FROM staging))""",
    "snapshot_to_master": f"""WITH {LIFECYCLE}, {MASTER_SQL} SELECT m.* REPLACE (m.active AND EXISTS
        (SELECT 1 FROM staging s WHERE s.ad_id = m.ad_id AND s.scraped_at >= TIMESTAMP '{RUN_SINCE}') AS active)
        FROM merged m""",
    "gone_listings": f"""WITH {LIFECYCLE} SELECT a.ad_id, a.active AND g.ad_id IS NULL AS active,
        a.active AND g.ad_id IS NOT NULL AS newly_inactive
        FROM ads a LEFT JOIN (SELECT ad_id FROM latest WHERE price IS NULL) g ON g.ad_id = a.ad_id""",
    "idempotent_append": f"""WITH {STAGING} SELECT * FROM staging s WHERE NOT EXISTS (SELECT 1 FROM staging e
          WHERE e.ad_id = s.ad_id AND e.scraped_at = s.scraped_at AND e.scraped_at < TIMESTAMP '{CUTOFF}')
        QUALIFY row_number() OVER (PARTITION BY ad_id, scraped_at ORDER BY snapshot_id) = 1""",
    "load_counters": f"""WITH {STAGING}, ranked AS (SELECT price,
          row_number() OVER (PARTITION BY ad_id, scraped_at ORDER BY snapshot_id) AS rn FROM staging)
        SELECT CASE WHEN price IS NULL THEN 'skipped' WHEN rn > 1 THEN 'duplicate' ELSE 'inserted' END AS outcome,
          count(*) AS rows FROM ranked GROUP BY 1""",
    "key_violations": f"""WITH {LIFECYCLE}
        SELECT 'unique' AS constraint_name,
          CAST(count(*) - count(DISTINCT (ad_id, scraped_at)) AS BIGINT) AS violations FROM staging
        UNION ALL SELECT 'not_null:ad_id', count(*) FILTER (WHERE ad_id IS NULL) FROM staging
        UNION ALL SELECT 'not_null:price', count(*) FILTER (WHERE price IS NULL) FROM staging
        UNION ALL SELECT 'not_null:scraped_at', count(*) FILTER (WHERE scraped_at IS NULL) FROM staging
        UNION ALL SELECT 'foreign_key', count(*) FROM staging s WHERE NOT EXISTS (SELECT 1 FROM ads a WHERE a.ad_id = s.ad_id)""",
    "duplicate_keys": f"""WITH {STAGING} SELECT ad_id, scraped_at, count(*) AS rows FROM staging
        GROUP BY ad_id, scraped_at HAVING count(*) > 1""",
    "cascade_prune": f"""WITH {LIFECYCLE} SELECT ad_id, snapshot_id, price FROM staging
        WHERE ad_id IN (SELECT ad_id FROM ads WHERE active)""",
    "orphaned_snapshots": f"""WITH {LIFECYCLE} SELECT ad_id, snapshot_id FROM staging
        WHERE ad_id NOT IN (SELECT ad_id FROM ads)""",
    "schema_alignment": f"""WITH {STAGING} SELECT ad_id, CAST(NULL AS VARCHAR) AS ad_url, price, specs_text, scraped_at
        FROM staging""",
    "quarantined_rows": f"""WITH {STAGING} SELECT ad_id, CASE WHEN price IS NULL THEN 'quarantined' ELSE 'accepted' END AS outcome,
        count(*) AS rows FROM staging GROUP BY ALL""",
    "informative_details": """SELECT user_id AS ad_id, event_id AS snapshot_id,
        CASE WHEN event_type <> 'error' THEN event_type END AS title,
        CASE WHEN event_type <> 'view' THEN 1990 + CAST(floor(value) AS INTEGER) END AS year FROM events""",
    "latest_details": f"""WITH {STAGING}, {LATEST}, newest AS (SELECT user_id, event_type, value FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
        SELECT l.ad_id, l.price, CASE WHEN event_type <> 'error' THEN event_type END AS title,
          CASE WHEN event_type <> 'view' THEN 1990 + CAST(floor(value) AS INTEGER) END AS year
        FROM latest l LEFT JOIN newest n ON n.user_id = l.ad_id""",
    "places_of_codes": f"""WITH {STAGING}, ranges AS (
          SELECT p_partkey * 37 % 9000 AS low, p_partkey * 37 % 9000 + p_partkey * p_size % 400 AS high, p_name, p_brand FROM part),
        coded AS (SELECT snapshot_id, lpad(CAST(snapshot_id * 7 % 10500 AS VARCHAR),
            greatest(4, length(CAST(snapshot_id * 7 % 10500 AS VARCHAR)))::INTEGER, '0') AS full_code, full_code[1:4] AS postal_code
          FROM staging),
        best AS (SELECT postal_code, p_name, p_brand FROM (SELECT DISTINCT postal_code FROM coded)
          JOIN ranges ON CAST(postal_code AS INTEGER) BETWEEN low AND high
          QUALIFY row_number() OVER (PARTITION BY postal_code ORDER BY high - low, low, p_name, p_brand) = 1)
        SELECT snapshot_id, postal_code, CASE WHEN snapshot_id % 3 = 0 THEN 'known'
          ELSE coalesce(p_name, CASE WHEN snapshot_id % 3 = 1 THEN '0301' END) END AS municipality, p_brand AS county
        FROM coded LEFT JOIN best USING (postal_code)""",
    "prices_in_ranges": f"""WITH {STAGING}, ranges AS (SELECT p_partkey, CAST(floor(p_retailprice * 100) AS BIGINT) AS low,
          CAST(floor(p_retailprice * 100) AS BIGINT) + p_size * p_size - 40 AS high FROM part)
        SELECT p_partkey, count(*) AS snapshots, CAST(sum(price) AS BIGINT) AS total
        FROM staging JOIN ranges ON price BETWEEN low AND high GROUP BY p_partkey""",
}
