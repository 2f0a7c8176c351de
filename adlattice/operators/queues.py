"""Work queues and the rules that decide what is processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.functions.scalars import strip
from adlattice.operators.lifecycle import merge_by_policy
from adlattice.session import written


def first_by_id(df: DataFrame, limit: int | None, key: str = "ad_id") -> DataFrame:
    """The first ``limit`` rows by id; all rows, unordered, without a limit."""
    return df if limit is None else df.orderBy(key).limit(limit)


def embed_queue(ads: DataFrame, limit: int | None = None, more_than: int = 50) -> DataFrame:
    """Active listings with a real description and no vectors yet."""
    due = ads.where(
        F.col("active")
        & (F.length(F.trim("description")) > more_than)
        & ~F.coalesce("has_embeddings", F.lit(False))
    )
    return first_by_id(due, limit)


def score_queue(ads: DataFrame, scores: DataFrame, limit: int | None = None) -> DataFrame:
    """Active, embedded listings with a description and no scores."""
    due = ads.where(F.col("active") & F.col("has_embeddings") & F.col("description").isNotNull())
    return first_by_id(due.join(scores.select("ad_id"), "ad_id", "left_anti"), limit)


def backfill_queue(ads: DataFrame, ids: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Listings whose description is to be fetched again: the asked ids, or all active ones."""
    chosen = ads.where("active") if ids is None else ads.join(ids.select("ad_id").distinct(), "ad_id", "left_semi")
    return first_by_id(chosen, limit).select("ad_id", "ad_url", F.coalesce("description", F.lit("")).alias("current_desc"))


def backfill_decision(current: Column, new: Column, force: bool = False) -> Column:
    """What to do with a fetched description: already_long, too_short, not_longer or update."""
    have = F.coalesce(F.length(current), F.lit(0))
    length = F.coalesce(F.length(strip(new)), F.lit(0))
    keep = F.lit(not force)
    return (
        F.when(keep & (have > 500), "already_long")
        .when(length < 10, "too_short")
        .when(keep & (have > 0) & (length <= have + 50), "not_longer")
        .otherwise("update")
    )


def overwrite_descriptions(ads: DataFrame, fetched: DataFrame) -> DataFrame:
    """Next master with the fetched descriptions; the raw source is kept where the new one is NULL.

    ``fetched`` has ad_id, description and source_raw, unique by ad_id, for known listings only.
    """
    known = fetched.join(ads.select("ad_id"), "ad_id", "left_semi").withColumn("description", strip("description"))
    return merge_by_policy(ads, known, ["ad_id"], ["description"], ["source_raw"])


def replace_chunks(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Next chunk table: listings in ``new`` have all their chunks of that source replaced.

    A chunk whose (listing, source, order) existed keeps its ``created_at``; leftovers of an earlier,
    longer text disappear. What was processed is a written table of known size, so Spark decides by it whether old chunks must be shuffled.
    """
    keys = ["ad_id", "chunk_source", "chunk_order"]
    processed = written(new.select("ad_id", "chunk_source").distinct(), "processed-listings", "zstd")
    untouched = old.join(processed, ["ad_id", "chunk_source"], "left_anti")
    born = old.select(*keys, F.col("created_at").alias("__born"))
    fresh = (
        new.drop("created_at", "updated_at")
        .join(born, keys, "left")
        .withColumns({"created_at": F.coalesce("__born", now), "updated_at": now})
        .drop("__born")
    )
    return untouched.unionByName(fresh.select(*old.columns))


def upsert_chunks(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Next chunk table by plain upsert: chunks beyond the new text's last one stay."""
    stamped = new.withColumns({"created_at": now, "updated_at": now})
    fields = ["chunk_text", "chunk_length", "overlap_words", "embedding", "updated_at"]
    return merge_by_policy(old, stamped, ["ad_id", "chunk_source", "chunk_order"], fields)


def mark_processed(ads: DataFrame, processed: DataFrame, now: Column) -> DataFrame:
    """Next master with ``has_embeddings`` and the processing time set for processed listings.

    Only flags change and no listing is added, so their ids, a written table of known size, are joined to the master; Spark decides by that size
    whether descriptions must be shuffled.
    """
    done = written(processed.select("ad_id").distinct(), "done-listings", "zstd").withColumn("__done", F.lit(True))
    marked = ads.join(done, "ad_id", "left").withColumns({
        "has_embeddings": F.when(F.col("__done"), F.lit(True)).otherwise(F.col("has_embeddings")),
        "semantic_processed_at": F.when(F.col("__done"), now).otherwise(F.col("semantic_processed_at")),
    })
    return marked.select(ads.columns)


def changed_texts(ads: DataFrame, processed: DataFrame) -> DataFrame:
    """Listings whose description differs from the one last processed (ad_id, text_hash)."""
    now = ads.where("active").select("ad_id", "description", F.md5("description").alias("text_hash"))
    return now.join(processed.select("ad_id", F.col("text_hash").alias("__was")), "ad_id", "left").where(
        F.col("text_hash").isNotNull() & ~F.col("text_hash").eqNullSafe(F.col("__was"))
    ).drop("__was")


def reprocess_queue(ads: DataFrame, processed: DataFrame, limit: int | None = None, more_than: int = 50) -> DataFrame:
    """As ``embed_queue``, and also embedded listings whose description is not the one in ``processed`` (ad_id, text_hash)."""
    was = processed.select("ad_id", F.col("text_hash").alias("__was"))
    changed = ~F.md5("description").eqNullSafe(F.col("__was"))
    due = ads.join(was, "ad_id", "left").where(
        F.col("active") & (F.length(F.trim("description")) > more_than)
        & (~F.coalesce("has_embeddings", F.lit(False)) | changed)
    )
    return first_by_id(due.drop("__was"), limit)


def remember_texts(processed: DataFrame, ads: DataFrame, done: DataFrame) -> DataFrame:
    """Next (ad_id, text_hash): the descriptions of the listings in ``done`` as they were processed now."""
    hashes = ads.select("ad_id", F.md5("description").alias("text_hash")).join(
        done.select("ad_id").distinct(), "ad_id", "left_semi")
    return merge_by_policy(processed, hashes, ["ad_id"], ["text_hash"])


def forget_scores(scores: DataFrame, changed: DataFrame) -> DataFrame:
    """Scores without those of the listings in ``changed``, which are thereby due again."""
    return scores.join(changed.select("ad_id").distinct(), "ad_id", "left_anti")


def upsert_scores(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Next score table: raw score, support and method of scored (listing, aspect) pairs replaced."""
    fields = ["raw_score", "supporting_chunks", "score_method", "created_at"]
    return merge_by_policy(old, new.withColumn("created_at", now), ["ad_id", "aspect"], fields)


def resolve_chunk_ids(support: DataFrame, chunks: DataFrame, source: str = "description") -> DataFrame:
    """Supporting chunk texts (ad_id, aspect, texts) to chunk ids by listing, source and text.

    Texts are compared by their MD5, so a join row has a fixed size and no text is moved for it.
    """
    wanted = support.select("ad_id", "aspect", F.explode(F.transform("texts", F.md5)).alias("__text"))
    known = chunks.where(F.col("chunk_source") == source).select("ad_id", F.md5("chunk_text").alias("__text"), "chunk_id")
    return (
        wanted.join(known, ["ad_id", "__text"])
        .groupBy("ad_id", "aspect")
        .agg(F.sort_array(F.collect_set("chunk_id")).alias("supporting_chunks"))
    )
