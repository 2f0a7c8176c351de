"""The given tables seen as listing tables, once for Spark and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.operators.lifecycle import incoming_listings
from adlattice.sources.tables import read_table, spread_scan

# The master is the state at CUTOFF; a run after it sees the whole log.
CUTOFF = "2001-01-01"
DETAILS_CUTOFF = "2024-01-15"
LISTED_SINCE = "1999-06-01"
AS_OF = "2001-01-01"
RUN_SINCE = "2001-02-01"


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def event_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Search snapshots from ``events``: user as listing, value as price."""
    return read_table(spark, sf, "events").select(
        F.col("user_id").alias("ad_id"),
        F.col("ts").alias("scraped_at"),
        F.col("event_id").alias("snapshot_id"),
        F.col("value").alias("price"),
        F.col("props").alias("specs_text"),
    )


EVENT_SNAPSHOTS = """event_snapshots AS (
  SELECT user_id AS ad_id, ts AS scraped_at, event_id AS snapshot_id, value AS price, props AS specs_text FROM events)"""


def staging(spark: SparkSession, sf: str) -> DataFrame:
    """Search snapshots from ``orders``: customer as listing, order as snapshot; some have no price."""
    price = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.floor("o_totalprice").cast("int"))
    specs = F.concat("o_orderpriority", F.lit(", "), F.year("o_orderdate").cast("string"), F.lit(" model"))
    return read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("ad_id"),
        F.concat(F.lit("/item/"), F.col("o_custkey").cast("string")).alias("ad_url"),
        price.alias("price"),
        specs.alias("specs_text"),
        F.col("o_orderdate").alias("scraped_at"),
        F.col("o_orderkey").alias("snapshot_id"),
    )


STAGING = """staging AS (
  SELECT o_custkey AS ad_id, '/item/' || o_custkey AS ad_url,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(floor(o_totalprice) AS INTEGER) END AS price,
    o_orderpriority || ', ' || year(o_orderdate) || ' model' AS specs_text,
    o_orderdate AS scraped_at, o_orderkey AS snapshot_id
  FROM orders)"""


def details(spark: SparkSession, sf: str) -> DataFrame:
    """Detail snapshots from ``events``; title and year are missing for some event types."""
    kind = F.col("event_type")
    return read_table(spark, sf, "events").select(
        F.col("user_id").alias("ad_id"),
        F.col("ts").alias("scraped_at"),
        F.col("event_id").alias("snapshot_id"),
        F.when(kind != "error", kind).alias("title"),
        F.col("props").alias("description"),
        F.when(kind != "view", F.lit(1990) + F.floor("value").cast("int")).alias("year"),
        F.col("value").alias("lat"),
        F.when(kind == "signup", F.col("props")).alias("source_json"),
    )


DETAILS = """details AS (
  SELECT user_id AS ad_id, ts AS scraped_at, event_id AS snapshot_id,
    CASE WHEN event_type <> 'error' THEN event_type END AS title, props AS description,
    CASE WHEN event_type <> 'view' THEN 1990 + CAST(floor(value) AS INTEGER) END AS year,
    value AS lat, CASE WHEN event_type = 'signup' THEN props END AS source_json
  FROM events)"""


def prior_ads(spark: SparkSession, sf: str) -> DataFrame:
    """The master before the run: built from the log up to the cutoff, long unseen listings inactive."""
    rows = incoming_listings(
        staging(spark, sf).where(F.col("scraped_at") < moment(CUTOFF)),
        details(spark, sf).where(F.col("scraped_at") < moment(DETAILS_CUTOFF)),
    )
    return rows.withColumn("active", F.col("last_seen_at") >= moment(LISTED_SINCE)).withColumn(
        "has_embeddings", F.col("title").isNotNull()
    )


LATEST = """latest AS (
  SELECT * FROM staging QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY scraped_at DESC, snapshot_id DESC) = 1)"""

PRIOR_ADS = f"""prior_latest AS (
  SELECT * FROM staging WHERE scraped_at < TIMESTAMP '{CUTOFF}'
  QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY scraped_at DESC, snapshot_id DESC) = 1),
prior_details AS (
  SELECT * FROM details WHERE scraped_at < TIMESTAMP '{DETAILS_CUTOFF}'
  QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY scraped_at DESC, snapshot_id DESC) = 1),
ads AS (
  SELECT l.ad_id, l.ad_url, l.price AS latest_price, l.scraped_at AS first_seen_at, l.scraped_at AS last_seen_at,
    l.scraped_at AS last_scraped_at, l.scraped_at >= TIMESTAMP '{LISTED_SINCE}' AS active,
    d.title, d.description, d.year, d.lat, d.source_json AS source_raw, d.title IS NOT NULL AS has_embeddings
  FROM prior_latest l LEFT JOIN prior_details d ON d.ad_id = l.ad_id)"""

LIFECYCLE = f"{STAGING}, {DETAILS}, {LATEST}, {PRIOR_ADS}"


def descriptions(spark: SparkSession, sf: str) -> DataFrame:
    """Listings with texts from ``documents``; ``labels`` give their flags (NULL where unlabelled)."""
    flags = read_table(spark, sf, "labels")
    texts = read_table(spark, sf, "documents")
    return texts.join(flags, "doc_id", "left").select(
        F.col("doc_id").alias("ad_id"),
        F.concat(F.lit("/item/"), F.col("doc_id").cast("string")).alias("ad_url"),
        F.concat("source", F.lit(" "), "lang").alias("title"),
        F.col("text").alias("description"),
        (F.coalesce("toxic", F.lit(0)) == 0).alias("active"),
        (F.col("quality") == 1).alias("has_embeddings"),
    )


DESCRIPTIONS = """listings AS (
  SELECT d.doc_id AS ad_id, '/item/' || d.doc_id AS ad_url, source || ' ' || lang AS title, text AS description,
    coalesce(toxic, 0) = 0 AS active, quality = 1 AS has_embeddings
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` spread over all cores, for work that is costly per text."""
    return spread_scan(read_table(spark, sf, "documents"), "doc_id")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread_scan(read_table(spark, sf, "pages"), "page_id")


def vector_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk vectors from ``embeddings``: five consecutive vectors make a listing."""
    five = F.lit(5)
    return read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("chunk_id"),
        F.floor(F.col("vec_id") / five).cast("bigint").alias("ad_id"),
        (F.col("vec_id") % five).cast("int").alias("chunk_order"),
        F.concat(F.lit("chunk "), F.col("vec_id").cast("string")).alias("chunk_text"),
        "embedding",
        "label",
    )


VECTOR_CHUNKS = """chunks AS (
  SELECT vec_id AS chunk_id, CAST(floor(vec_id / 5) AS BIGINT) AS ad_id, CAST(vec_id % 5 AS INTEGER) AS chunk_order,
    'chunk ' || vec_id AS chunk_text, CAST(embedding AS DOUBLE[]) AS embedding, label
  FROM embeddings)"""

CENTROIDS = """parts AS (
  SELECT label, unnest(range(1, 65)) AS i, embedding FROM chunks),
means AS (
  SELECT label, i, avg(embedding[i]) AS x FROM parts GROUP BY label, i),
centroids AS (
  SELECT label, list(x ORDER BY i) AS centroid FROM means GROUP BY label)"""
