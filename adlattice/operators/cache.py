"""Stored search results with an expiry time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlattice.operators.embedding import Encoder
from adlattice.operators.lifecycle import merge_by_policy
from adlattice.operators.search import query_fingerprint, search, usable_queries, with_query_defaults
from adlattice.session import materialise


def cache_rows(queries: DataFrame, results: DataFrame, now: Column, ttl: str = "1 hour") -> DataFrame:
    """Cache entries (one per query with results) from (query_hash, text) and ranked results."""
    in_rank = F.sort_array(F.collect_list(F.struct("rank", "ad_id", "similarity_score")))
    lists = results.groupBy("query_id").agg(in_rank.alias("__r"))
    return lists.join(queries.select("query_id", "query_hash", "text"), "query_id").select(
        "query_hash",
        F.col("text").alias("query_text"),
        F.transform("__r", lambda r: r["ad_id"]).alias("result_ad_ids"),
        F.transform("__r", lambda r: r["similarity_score"]).alias("similarity_scores"),
        F.lit("semantic_vector").alias("search_method"),
        (now + F.expr(f"INTERVAL {ttl}")).alias("expires_at"),
        now.alias("created_at"),
    )


def merge_cache(cache: DataFrame, rows: DataFrame) -> DataFrame:
    """Next version of the cache: a repeated query replaces its results and expiry."""
    refreshed = ["result_ad_ids", "similarity_scores", "expires_at", "created_at"]
    return merge_by_policy(cache, rows, ["query_hash"], refreshed)


def is_live(now: Column) -> Column:
    return F.col("expires_at") > now


def cached_results(cache: DataFrame, ads: DataFrame, now: Column, hashes: DataFrame | None = None,
                   limit: int | None = None) -> DataFrame:
    """Results of live entries in their stored order, active listings only.

    Each id keeps its own score: ids and scores are unpacked as pairs, so an inactive listing in
    between cannot shift the scores of those after it.
    """
    live = cache.where(is_live(now))
    if hashes is not None:
        live = live.join(hashes.select("query_hash"), "query_hash", "left_semi")
    pairs = F.arrays_zip(F.col("result_ad_ids").alias("ad_id"), F.col("similarity_scores").alias("similarity_score"))
    hits = live.select("query_hash", F.posexplode(pairs).alias("position", "__hit")).select(
        "query_hash", "position", "__hit.ad_id", "__hit.similarity_score"
    )
    shown = hits.join(ads.where("active").select("ad_id", "title", "description"), "ad_id")
    if limit is None:
        return shown
    # Cut after inactive listings are gone, else later live results would be lost.
    order = Window.partitionBy("query_hash").orderBy("position")
    return shown.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= limit).drop("__rank")


def purge_expired(cache: DataFrame, now: Column, lag: str = "1 day") -> DataFrame:
    """Next version of the cache without entries that expired more than ``lag`` ago."""
    return cache.where(~(F.col("expires_at") < now - F.expr(f"INTERVAL {lag}")))


def purge_count(cache: DataFrame, now: Column, lag: str = "1 day") -> DataFrame:
    """How many entries a purge removes and keeps."""
    old = F.col("expires_at") < now - F.expr(f"INTERVAL {lag}")
    return cache.agg(F.count_if(old).alias("purged"), F.count_if(~old).alias("kept"))


def search_with_cache(queries: DataFrame, cache: DataFrame, chunks: DataFrame, ads: DataFrame,
                      make_encoder: Callable[[], Encoder], now: Column, ttl: str = "1 hour") -> tuple[DataFrame, DataFrame]:
    """Results of a batch of queries and the next cache.

    Queries with a live entry are answered from it (no chunk texts are kept there), cut to the
    query's limit; the others are searched once, stored and added to the cache.
    """
    asked = with_query_defaults(usable_queries(queries))
    asked = asked.withColumn("query_hash", query_fingerprint(asked))
    live = cache.where(is_live(now))
    kept = cached_results(live, ads, now, asked).join(asked.select("query_id", "query_hash", "limit"), "query_hash")
    in_order = Window.partitionBy("query_id").orderBy("position")
    hits = kept.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= F.col("limit"))
    misses = asked.join(live.select("query_hash"), "query_hash", "left_anti")
    fresh = materialise(search(misses, chunks, ads, make_encoder))
    columns = ["query_id", "rank", "ad_id", "title", "description", "similarity_score"]
    results = hits.select(*columns, F.lit(None).cast("array<string>").alias("matching_chunks")).unionByName(
        fresh.select(*columns, "matching_chunks")
    )
    once = misses.dropDuplicates(["query_hash"])
    return results, merge_cache(cache, cache_rows(once, fresh, now, ttl))
