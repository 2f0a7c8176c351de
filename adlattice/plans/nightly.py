"""The nightly semantic run: vectors for new texts, aspect scores, normalisation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.functions.scalars import strip
from adlattice.operators.chunking import text_chunks, with_equipment
from adlattice.operators.embedding import Encoder, attach_embeddings, embed_missing, text_key
from adlattice.operators.percentiles import percentile_by_position
from adlattice.operators.queues import embed_queue, mark_processed, replace_chunks, reprocess_queue, score_queue, upsert_scores
from adlattice.operators.scoring import LEXICON, score_chunks
from adlattice.session import written

CHUNK_COLUMNS = ["chunk_id", "ad_id", "chunk_source", "chunk_text", "chunk_order", "chunk_length", "overlap_words", "embedding"]


def due_texts(ads: DataFrame, limit: int | None = None, processed: DataFrame | None = None) -> DataFrame:
    """(ad_id, text) of all listings that need vectors; with ``processed`` also those whose description has changed since."""
    text = with_equipment("description", "equipment") if "equipment" in ads.columns else F.col("description")
    due = embed_queue(ads, limit) if processed is None else reprocess_queue(ads, processed, limit)
    return due.select("ad_id", text.alias("text"))


def cut_texts(texts: DataFrame) -> DataFrame:
    """Chunks of ``texts`` (ad_id, text), cut once and written, as a run reads them several times."""
    return written(text_chunks(texts, "ad_id", "text"), "cut-texts", "zstd")


def embedded_chunks(texts: DataFrame, make_encoder: Callable[[], Encoder], model: str, store: DataFrame | None = None,
                    chunks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Chunks of ``texts`` with vectors, and the next vector store; ``chunks`` are those of :func:`cut_texts`, if at hand.

    The model sees every distinct text the store lacks once; its vectors are written, packed and compressed, before they are
    used. A listing of which any chunk could not be embedded is left out as a whole and stays in the queue; which ones is
    known from the keys of the few texts without a vector, so neither all keys nor texts are shuffled for it. The chunks are not written here:
    vectors are joined where the next chunk table is written, and nowhere else.
    """
    chunks = cut_texts(texts) if chunks is None else chunks
    seen = written(embed_missing(chunks, "chunk_text", make_encoder, model, store, packed=True), "vectors", "zstd")
    fresh, unread = seen.where("error IS NULL"), seen.where("error IS NOT NULL").select("text_key")
    known = fresh if store is None else store.unionByName(fresh)
    if store is not None:
        unread = unread.unionByName(store.where("embedding IS NULL").select("text_key"))
    keyed = chunks.select("ad_id", "chunk_text", text_key("chunk_text", model).alias("text_key"))
    # A blank text is not embedded at all.
    failed = keyed.where(F.length(strip("chunk_text")) == 0).select("ad_id").unionByName(
        keyed.join(written(unread, "unread-texts"), "text_key", "left_semi").select("ad_id"))
    kept = chunks.join(written(failed.distinct(), "failed-listings"), "ad_id", "left_anti")
    return attach_embeddings(kept, "chunk_text", model, known).select(*CHUNK_COLUMNS), known


def emptied_listings(texts: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """Ids of ``texts`` that no longer give any chunk, whose stored chunks and scores must go."""
    chunks = text_chunks(texts, "ad_id", "text") if chunks is None else chunks
    return texts.select("ad_id").distinct().join(chunks.select("ad_id"), "ad_id", "left_anti")


def store_chunks(ads: DataFrame, chunks: DataFrame, new: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Next chunk table and next master after a run.

    ``new`` may be what :func:`embedded_chunks` gives: where only the ids of its listings are wanted, no vectors are joined for them.
    """
    return replace_chunks(chunks, new, now), mark_processed(ads, new, now)


def score_listings(ads: DataFrame, scores: DataFrame, chunks: DataFrame, make_encoder: Callable[[], Encoder], now: Column,
                   limit: int | None = None, lexicon: dict = LEXICON) -> DataFrame:
    """Next score table: all aspects of every embedded listing that has no scores yet, from its stored chunks."""
    # A written table of known size, so Spark decides by it whether vectors must be shuffled.
    due = written(score_queue(ads, scores, limit).select("ad_id"), "due-listings", "zstd")
    scored = score_chunks(chunks.join(due, "ad_id", "left_semi"), "ad_id", make_encoder, lexicon)
    return upsert_scores(scores, scored.select("ad_id", "aspect", "raw_score", "supporting_chunks", "score_method"), now)


def normalise_scores(scores: DataFrame) -> DataFrame:
    """Next score table with every score's position within its aspect; aspects of one listing keep theirs."""
    ranked = percentile_by_position(scores.drop("normalized_score"), "aspect", "raw_score", "ad_id", "normalized_score")
    return ranked.select(*scores.columns)
