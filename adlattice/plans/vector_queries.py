"""Registered queries: vector search, similarity scores, the cell index and the result cache."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.functions.vectors import cosine, unit_rows
from adlattice.operators import cache, cell_index, search
from adlattice.operators.embedding import centroids, with_dimension, wrong_dimension
from adlattice.operators.keyed import top_per_key
from adlattice.operators.scoring import similarity_scores
from adlattice.plans.standins import CENTROIDS, VECTOR_CHUNKS, vector_chunks
from adlattice.sources.tables import read_table

NOW = "2001-06-01"


def aspect_centroids(spark: SparkSession, sf: str) -> DataFrame:
    means = centroids(vector_chunks(spark, sf), "label")
    return means.select("label", F.posexplode("centroid").alias("pos", "x")).select("label", "pos", F.round("x", 6).alias("x"))


def pair_cosines(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine of every vector to its label's centroid."""
    vectors = vector_chunks(spark, sf)
    both = vectors.join(centroids(vectors, "label"), "label")
    return both.select("chunk_id", F.round(cosine("embedding", "centroid"), 6).alias("cos"))


def dimension_check(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors cut short for every label above 7 are quarantined, the others accepted."""
    short = F.when(F.col("label") > 7, F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    vectors = vector_chunks(spark, sf).withColumn("embedding", short)
    good = with_dimension(vectors, 64).select("chunk_id", F.lit(64).alias("found_dimension"), F.lit(True).alias("accepted"))
    bad = wrong_dimension(vectors, 64).select("chunk_id", "found_dimension", F.lit(False).alias("accepted"))
    return good.unionByName(bad)


def _label_queries(vectors: DataFrame) -> DataFrame:
    return centroids(vectors, "label").select(
        F.col("label").cast("bigint").alias("query_id"), F.col("centroid").alias("embedding"), F.lit(0.6).alias("min_score")
    )


def _asked(vectors: DataFrame) -> DataFrame:
    """The label centroids, and the vectors of all chunks whose id is divisible by 100, numbered from 1,000 on."""
    own = vectors.where("chunk_id % 100 = 0").select(
        (F.col("chunk_id") + 1000).alias("query_id"), F.col("embedding").cast("array<double>"), F.lit(0.6).alias("min_score"))
    return _label_queries(vectors).unionByName(own)


def _hit_columns(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "rank", "chunk_id", "ad_id", F.round("distance", 6).alias("distance"))


def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest 20 chunks of every label centroid and of every chunk whose id is divisible by 100."""
    chunks = vector_chunks(spark, sf)
    return _hit_columns(search.nearest_chunks(chunks, _asked(chunks), 20))


def vector_topk_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest 20 listings of the same queries, by their best chunk."""
    chunks = vector_chunks(spark, sf)
    return _hit_columns(search.nearest_chunks(chunks, _asked(chunks), 20, "listing_first"))


def _ads_of(chunks: DataFrame) -> DataFrame:
    """A listing is active unless a chunk of it has label 9, embedded when it has all five chunks."""
    return chunks.groupBy("ad_id").agg((F.max("label") < 9).alias("active"), (F.count(F.lit(1)) == 5).alias("has_embeddings"))


ADS_OF = """ads AS (SELECT ad_id, max(label) < 9 AS active, count(*) = 5 AS has_embeddings FROM chunks GROUP BY ad_id)"""


def vector_topk_active(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest 20 chunks among active, embedded listings only."""
    chunks = vector_chunks(spark, sf)
    live = search.searchable_chunks(chunks, _ads_of(chunks))
    return _hit_columns(search.nearest_chunks(live, _asked(chunks), 20))


def search_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk hits rolled up to listings, filtered and ranked, with the best three chunks."""
    chunks = vector_chunks(spark, sf)
    queries = _asked(chunks)
    hits = search.nearest_chunks(chunks, queries, 40)
    ranked = search.rank_listings(search.group_hits(hits.drop("rank"), chunks), queries)
    return ranked.select(
        "query_id", "rank", "ad_id", F.round("similarity_score", 6).alias("similarity_score"),
        F.array_join("matching_chunks", "|").alias("matching_chunks"),
    )


def grouped_hits(spark: SparkSession, sf: str) -> DataFrame:
    chunks = vector_chunks(spark, sf)
    hits = search.nearest_chunks(chunks, _asked(chunks), 40)
    return search.group_hits(hits.drop("rank"), chunks).select(
        "query_id", "ad_id", F.round("min_distance", 6).alias("min_distance"), F.round("avg_distance", 6).alias("avg_distance"), "hits"
    )


def top_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The three chunks of every listing nearest to their own label's centroid."""
    vectors = vector_chunks(spark, sf)
    near = vectors.join(centroids(vectors, "label"), "label").select(
        "ad_id", "chunk_id", F.round(1.0 - cosine("embedding", "centroid"), 6).alias("distance")
    )
    return top_per_key(near, "ad_id", [F.col("distance").asc(), F.col("chunk_id").asc()], 3)


def _label_cells(chunks: DataFrame) -> np.ndarray:
    """Unit vectors of the label centroids in label order, as fixed cells: one row per label, ten in all."""
    means = centroids(chunks, "label").orderBy("label").collect()
    return unit_rows(np.asarray([r["centroid"] for r in means]))


def similar_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Five listings similar to the first chunk of every listing; all ten cells are probed, so the result is exact."""
    chunks = vector_chunks(spark, sf)
    cells = _label_cells(chunks)
    references = chunks.where("chunk_order = 0").select("ad_id", "embedding")
    nearest = lambda rows, queries, k: cell_index.nearest_in_cells(rows, queries, cells, k, nprobe=len(cells))
    found = search.similar_listings(references, chunks, nearest, 5, 0.55)
    return found.select("query_id", "rank", "ad_id", F.round("similarity_score", 6).alias("similarity_score"))


def embedding_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Similarity score of every listing to the centroids of all labels, read as aspects."""
    chunks = vector_chunks(spark, sf)
    means = centroids(chunks, "label").orderBy("label").collect()  # one row per label, ten in all
    names, matrix = [f"aspect{r['label']}" for r in means], np.asarray([r["centroid"] for r in means])
    scored = similarity_scores(chunks, "ad_id", names, matrix, aspects=[*names, "unknown"])
    return scored.select("ad_id", "aspect", F.round("similarity_score", 6).alias("similarity_score"), "similar_chunks")


def ann_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest 20 chunks of every label centroid and every first chunk; all ten cells are probed, so the result is exact."""
    chunks = vector_chunks(spark, sf)
    first = chunks.where("chunk_order = 0").select((F.col("ad_id") + 1000).alias("query_id"), F.col("embedding").cast("array<double>"))
    queries = _label_queries(chunks).select("query_id", "embedding").unionByName(first)
    cells = _label_cells(chunks)
    return _hit_columns(cell_index.nearest_in_cells(chunks, queries, cells, 20, nprobe=len(cells)))


def ann_topk_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Exact nearest 20 chunks of the queries of ``vector_topk`` through 16 fitted cells, all of which are probed."""
    chunks = vector_chunks(spark, sf)
    cells = cell_index.fit_cells(chunks, 16)
    return _hit_columns(cell_index.nearest_in_cells(chunks, _asked(chunks), cells, 20, nprobe=len(cells)))


def _cache(spark: SparkSession, sf: str) -> DataFrame:
    """Cached results: one entry per customer with their orders as results, best total first."""
    orders = read_table(spark, sf, "orders")
    ranked = top_per_key(orders, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 10)
    results = ranked.select(
        F.col("o_custkey").alias("query_id"), "rank", F.col("o_orderkey").alias("ad_id"),
        (F.col("o_totalprice") / 1e6).alias("similarity_score"),
    )
    queries = orders.groupBy(F.col("o_custkey").alias("query_id")).agg(F.max("o_orderdate").alias("asked_at")).select(
        "query_id", "asked_at", F.md5(F.col("query_id").cast("string")).alias("query_hash"),
        F.col("query_id").cast("string").alias("text"),
    )
    rows = cache.cache_rows(queries, results, F.lit("2000-01-01").cast("timestamp_ntz"))
    asked = queries.select("query_hash", "asked_at")
    return rows.join(asked, "query_hash").withColumns(
        {"expires_at": F.col("asked_at") + F.expr("INTERVAL 60 DAYS"), "created_at": F.col("asked_at")}
    ).drop("asked_at")


CACHE = """ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders QUALIFY rank <= 10),
entries AS (SELECT o_custkey, md5(CAST(o_custkey AS VARCHAR)) AS query_hash, max(o_orderdate) + INTERVAL 60 DAY AS expires_at,
  max(o_orderdate) AS created_at FROM orders GROUP BY o_custkey),
cache AS (SELECT e.*, r.rank - 1 AS position, r.o_orderkey AS ad_id, r.o_totalprice / 1e6 AS similarity_score
  FROM entries e JOIN ranked r ON r.o_custkey = e.o_custkey)"""


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


def cache_live(spark: SparkSession, sf: str) -> DataFrame:
    """Unexpired results in stored order; orders with status F count as inactive listings."""
    ads = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ad_id"), F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("description"), (F.col("o_orderstatus") != "F").alias("active"),
    )
    hits = cache.cached_results(_cache(spark, sf), ads, _now(), limit=5)
    return hits.withColumn("similarity_score", F.round("similarity_score", 6))


def cache_purge(spark: SparkSession, sf: str) -> DataFrame:
    return cache.purge_expired(_cache(spark, sf), _now(), "30 days").select("query_hash", "expires_at", F.size("result_ad_ids").alias("results"))


def cache_purge_count(spark: SparkSession, sf: str) -> DataFrame:
    return cache.purge_count(_cache(spark, sf), _now(), "30 days")


def cache_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Expired entries asked again at NOW: new results (best three) and a new expiry."""
    old = _cache(spark, sf)
    again = old.where(F.col("expires_at") < _now()).withColumns({
        "result_ad_ids": F.slice("result_ad_ids", 1, 3),
        "similarity_scores": F.slice("similarity_scores", 1, 3),
        "expires_at": _now() + F.expr("INTERVAL 1 HOUR"),
        "created_at": _now(),
    })
    merged = cache.merge_cache(old, again)
    return merged.select("query_hash", F.array_join("result_ad_ids", ",").alias("ids"), "expires_at", "created_at")


QUERIES = {
    f.__name__: f
    for f in [
        aspect_centroids, pair_cosines, dimension_check, vector_topk, vector_topk_listings, vector_topk_active,
        search_ranked, grouped_hits, top_chunks, similar_listings, embedding_scores, ann_topk, ann_topk_exact,
        cache_live, cache_purge, cache_purge_count, cache_upsert,
    ]
}

_BASE = f"WITH {VECTOR_CHUNKS}, {CENTROIDS}"


_ASKED = """SELECT CAST(label AS BIGINT) AS query_id, centroid AS q FROM centroids
  UNION ALL SELECT chunk_id + 1000, embedding FROM chunks WHERE chunk_id % 100 = 0"""


def _distances(source: str = "chunks", queries: str = _ASKED) -> str:
    return f"""queries AS ({queries}),
distances AS (SELECT query_id, c.chunk_id, c.ad_id, c.chunk_order, c.chunk_text,
  round(1.0 - list_cosine_similarity(c.embedding, q), 9) AS distance FROM {source} c CROSS JOIN queries)"""


def _top(k: int, source: str = "distances", rank: str = "rank") -> str:
    return f"""(SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS {rank} FROM {source}
  QUALIFY {rank} <= {k})"""


_FIRST_CHUNKS = "SELECT ad_id AS query_id, embedding AS q FROM chunks WHERE chunk_order = 0"


_HITS = "query_id, rank, chunk_id, ad_id, round(distance, 6) AS distance"

ORACLE = {
    "aspect_centroids": f"{_BASE} SELECT label, CAST(i - 1 AS INTEGER) AS pos, round(x, 6) AS x FROM means",
    "pair_cosines": f"""{_BASE} SELECT chunk_id, round(list_cosine_similarity(embedding, centroid), 6) AS cos
        FROM chunks c JOIN centroids z ON z.label = c.label""",
    "dimension_check": """SELECT vec_id AS chunk_id, CASE WHEN label > 7 THEN 32 ELSE 64 END AS found_dimension, label <= 7 AS accepted
        FROM embeddings""",
    "vector_topk": f"{_BASE}, {_distances()} SELECT {_HITS} FROM {_top(20)}",
    "vector_topk_listings": f"""{_BASE}, {_distances()}, best AS (SELECT * FROM distances
          QUALIFY row_number() OVER (PARTITION BY query_id, ad_id ORDER BY distance, chunk_id) = 1)
        SELECT {_HITS} FROM {_top(20, 'best')}""",
    "vector_topk_active": f"""{_BASE}, {ADS_OF}, live AS (SELECT c.* FROM chunks c JOIN ads a ON a.ad_id = c.ad_id
          WHERE active AND has_embeddings), {_distances('live')} SELECT {_HITS} FROM {_top(20)}""",
    "search_ranked": f"""{_BASE}, {_distances()}, hits AS {_top(40, rank='hit')},
        grouped AS (SELECT query_id, ad_id, greatest(0.0, 1.0 - min(distance) / 2.0) AS s,
          array_to_string(list(chunk_text ORDER BY distance, chunk_order)[1:3], '|') AS matching_chunks FROM hits GROUP BY ALL)
        SELECT query_id, ad_id, round(s, 6) AS similarity_score, matching_chunks,
          row_number() OVER (PARTITION BY query_id ORDER BY s DESC, ad_id) AS rank FROM grouped WHERE s >= 0.6""",
    "grouped_hits": f"""{_BASE}, {_distances()}, found AS {_top(40, rank='hit')}
        SELECT query_id, ad_id, round(min(distance), 6) AS min_distance, round(avg(distance), 6) AS avg_distance, count(*) AS hits
        FROM found GROUP BY ALL""",
    "top_chunks": f"""{_BASE}, near AS (SELECT ad_id, chunk_id, round(1.0 - list_cosine_similarity(embedding, centroid), 6) AS distance
          FROM chunks c JOIN centroids z ON z.label = c.label)
        SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY distance, chunk_id) AS rank FROM near QUALIFY rank <= 3""",
    "similar_listings": f"""{_BASE}, {_distances(queries=_FIRST_CHUNKS)}, hits AS {_top(12, rank='hit')},
        grouped AS (SELECT query_id, ad_id, greatest(0.0, 1.0 - min(distance) / 2.0) AS s FROM hits GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, ad_id) AS r FROM grouped WHERE s >= 0.55)
        SELECT query_id, ad_id, round(s, 6) AS similarity_score, row_number() OVER (PARTITION BY query_id ORDER BY r) AS rank
        FROM ranked WHERE r <= 6 AND ad_id <> query_id QUALIFY rank <= 5""",
    "embedding_scores": f"""{_BASE}, cosines AS (SELECT ad_id, 'aspect' || z.label AS aspect,
          list_cosine_similarity(c.embedding, centroid) AS cos FROM chunks c CROSS JOIN centroids z)
        SELECT ad_id, aspect, round((max(cos) * 0.7 + avg(cos) * 0.3 + 1.0) / 2.0, 6) AS similarity_score,
          count(*) FILTER (WHERE cos > 0.6) AS similar_chunks FROM cosines GROUP BY ALL
        UNION ALL SELECT DISTINCT ad_id, 'unknown', 0.5, 0 FROM chunks""",
    "ann_topk": f"""{_BASE}, {_distances(queries=f"""SELECT CAST(label AS BIGINT) AS query_id, centroid AS q FROM centroids
        UNION ALL SELECT query_id + 1000, q FROM ({_FIRST_CHUNKS})""")} SELECT {_HITS} FROM {_top(20)}""",
    "ann_topk_exact": f"{_BASE}, {_distances()} SELECT {_HITS} FROM {_top(20)}",
    "cache_live": f"""WITH {CACHE} SELECT c.query_hash, c.position, c.ad_id, round(c.similarity_score, 6) AS similarity_score,
          o.o_orderpriority AS title, o.o_orderstatus AS description
        FROM cache c JOIN orders o ON o.o_orderkey = c.ad_id
        WHERE expires_at > TIMESTAMP '{NOW}' AND o.o_orderstatus <> 'F'
        QUALIFY row_number() OVER (PARTITION BY c.query_hash ORDER BY c.position) <= 5""",
    "cache_purge": f"""WITH {CACHE} SELECT query_hash, any_value(expires_at) AS expires_at, count(*) AS results FROM cache
        WHERE NOT expires_at < TIMESTAMP '{NOW}' - INTERVAL 30 DAY GROUP BY query_hash""",
    "cache_purge_count": f"""WITH {CACHE} SELECT count(*) FILTER (WHERE expires_at < TIMESTAMP '{NOW}' - INTERVAL 30 DAY) AS purged,
          count(*) FILTER (WHERE NOT expires_at < TIMESTAMP '{NOW}' - INTERVAL 30 DAY) AS kept FROM entries""",
    "cache_upsert": f"""WITH {CACHE}, picked AS (SELECT *, expires_at < TIMESTAMP '{NOW}' AS again FROM cache)
        SELECT query_hash, string_agg(CAST(ad_id AS VARCHAR), ',' ORDER BY position) AS ids,
          CASE WHEN any_value(again) THEN TIMESTAMP '{NOW}' + INTERVAL 1 HOUR ELSE any_value(expires_at) END AS expires_at,
          CASE WHEN any_value(again) THEN TIMESTAMP '{NOW}' ELSE any_value(created_at) END AS created_at
        FROM picked WHERE NOT again OR position < 3 GROUP BY query_hash""",
}
