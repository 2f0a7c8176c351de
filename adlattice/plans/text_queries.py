"""Registered queries: cleaning, chunks, scores and text search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.functions.scalars import any_contains, shortened
from adlattice.operators import cache, chunking, percentiles, phrase_index, queues, scoring, search
from adlattice.operators.embedding import HashingEncoder, attach_embeddings, embed_missing, embed_texts
from adlattice.plans import nightly
from adlattice.plans.standins import DESCRIPTIONS, descriptions, documents
from adlattice.session import materialise, written
from adlattice.sources.tables import read_table, spread_scan

DIMS = 384

# Added to scores before they are rounded, where exact halves occur.
NUDGE = 1e-8

# A second lexicon with words of the test texts, so that every branch of the formulas is met.
WORD_LEXICON = {
    "sails": {"positive": {"tion": 0.5, "the": 0.2}, "negative": {"under": -0.6, "que": -0.4}},
    "motor": {"positive": {"ment": 0.4}, "negative": {"sch": -0.9, "ung": -0.3, "ment": 0.4}},
    "condition": {"positive": {"ando": 0.9, "la ": 0.3}, "negative": {}},
    "equipment": {"positive": {}, "negative": {"heit": -0.8, "ción": -0.5}},
}


def make_encoder() -> HashingEncoder:
    return HashingEncoder(DIMS)


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", chunking.clean_text("text").alias("cleaned"))


def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", chunking.word_count("text").alias("words"))


def text_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.text_chunks(documents(spark, sf), "doc_id", "text").drop("chunk_id")


def sentence_spans(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.sentence_spans(documents(spark, sf), "doc_id", "text").drop("sentence")


def section_breaks(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.section_breaks(documents(spark, sf), "doc_id", "text")


def aspect_chunks(spark: SparkSession, sf: str) -> DataFrame:
    chunks = chunking.text_chunks(documents(spark, sf), "doc_id", "text")
    return chunking.aspect_chunks(chunks, ["motor", "exterior", "other"]).select("doc_id", "chunk_order", "aspect")


def text_with_equipment(spark: SparkSession, sf: str) -> DataFrame:
    """Document texts with source and language as their equipment list; none for French ones."""
    items = F.when(F.col("lang") != "fr", F.array("source", "lang")).otherwise(F.array().cast("array<string>"))
    return read_table(spark, sf, "documents").select(
        "doc_id",
        F.md5(chunking.with_equipment("text", items)).alias("combined_md5"),
        any_contains(items, "SRC1").alias("has_item"),
    )


def shortened_texts(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents").select("doc_id", shortened("text").alias("preview"))


def embed_queue(spark: SparkSession, sf: str) -> DataFrame:
    return queues.embed_queue(descriptions(spark, sf)).select("ad_id")


def embed_queue_next(spark: SparkSession, sf: str) -> DataFrame:
    """The next 100 listings to embed."""
    return queues.embed_queue(descriptions(spark, sf), 100).select("ad_id")


def score_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Embedded listings without scores; toxic-labelled documents count as scored already."""
    scored = read_table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("ad_id"))
    listings = descriptions(spark, sf).withColumn("active", F.lit(True))
    return queues.score_queue(listings, scored).select("ad_id")


def score_queue_next(spark: SparkSession, sf: str) -> DataFrame:
    """The next 50 listings to score."""
    scored = read_table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("ad_id"))
    return queues.score_queue(descriptions(spark, sf).withColumn("active", F.lit(True)), scored, 50).select("ad_id")


def backfill_queue_next(spark: SparkSession, sf: str) -> DataFrame:
    """The first 20 of the listings asked for, which are those that have labels."""
    asked = read_table(spark, sf, "labels").select(F.col("doc_id").alias("ad_id"))
    return queues.backfill_queue(descriptions(spark, sf), asked, 20).select("ad_id", "ad_url", F.length("current_desc").alias("current_length"))


def backfill_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Active listings with the length of the description they have."""
    listings = descriptions(spark, sf).withColumn("description", F.when(F.col("has_embeddings"), F.col("description")))
    return queues.backfill_queue(listings).select("ad_id", "ad_url", F.length("current_desc").alias("current_length"))


def backfill_decision(spark: SparkSession, sf: str) -> DataFrame:
    """Decision for replacing each document by the next document's text, careful and forced."""
    texts = read_table(spark, sf, "documents").select("doc_id", "text")
    fetched = texts.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("new_text"))
    both = texts.join(fetched, "doc_id", "left")
    return both.select(
        "doc_id",
        queues.backfill_decision(F.col("text"), F.col("new_text")).alias("decision"),
        queues.backfill_decision(F.col("text"), F.col("new_text"), force=True).alias("forced"),
    )


def overwritten_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    """Master after descriptions of English listings were fetched again (as the old text after a prefix)."""
    ads = descriptions(spark, sf).withColumn("source_raw", F.col("title"))
    fetched = ads.where(F.col("title").endswith(" en")).select(
        "ad_id",
        F.concat(F.lit("  New: "), "description").alias("description"),
        F.when(F.col("has_embeddings"), F.lit("new source")).alias("source_raw"),
    )
    return queues.overwrite_descriptions(ads, fetched).select("ad_id", F.md5("description").alias("text_md5"), "source_raw")


def processed_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Master after the embed queue was worked off."""
    ads = descriptions(spark, sf).withColumn("semantic_processed_at", F.lit(None).cast("timestamp_ntz"))
    done = queues.embed_queue(ads)
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    return queues.mark_processed(ads, done, now).select("ad_id", "active", "has_embeddings", "semantic_processed_at")


def replaced_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk table after every English text was replaced by the next document's and chunked again."""
    texts = documents(spark, sf)
    old_time, now = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01", "2024-02-01"))
    columns = ["ad_id", "chunk_source", "chunk_order", "chunk_length"]
    old = chunking.text_chunks(texts.withColumnRenamed("doc_id", "ad_id"), "ad_id", "text").select(
        *columns, old_time.alias("created_at"), old_time.alias("updated_at")
    )
    following = texts.select((F.col("doc_id") - 1).alias("ad_id"), "text")
    swapped = following.join(texts.where(F.col("lang") == "en").select(F.col("doc_id").alias("ad_id")), "ad_id")
    new = chunking.text_chunks(swapped, "ad_id", "text").select(*columns)
    # Both are read twice; without texts they are small, and no text is cut again.
    old, new = written(old, "old-chunks"), written(new, "new-chunks")
    return queues.replace_chunks(old, new, now).drop("chunk_source")


def keyword_scores(spark: SparkSession, sf: str) -> DataFrame:
    chunks = chunking.text_chunks(documents(spark, sf), "doc_id", "text")
    scored = scoring.keyword_scores(chunks, "doc_id")
    return scored.select("doc_id", "aspect", F.round("keyword_score", 6).alias("keyword_score"), "hits", "keyword_chunks")


def keyword_scores_words(spark: SparkSession, sf: str) -> DataFrame:
    chunks = chunking.text_chunks(documents(spark, sf), "doc_id", "text")
    scored = scoring.keyword_scores(chunks, "doc_id", lexicon=WORD_LEXICON)
    return scored.select("doc_id", "aspect", F.round("keyword_score", 6).alias("keyword_score"), "hits", "keyword_chunks")


def benchmark_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon as large as its table: all runs of two to six words of every benchmark text, (aspect, phrase, weight)."""
    words = read_table(spark, sf, "benchmark").select(F.split(F.lower("text"), "[ \n]+").alias("w"))
    runs = words.select("w", F.explode(F.sequence(F.lit(2), F.lit(6))).alias("n")).where(F.size("w") >= F.col("n")).select(
        F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1),
                              lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("phrase"))
    size = F.length("phrase")
    aspect = F.element_at(F.array(*map(F.lit, scoring.ASPECTS)), size % 4 + 1)
    return runs.distinct().select(aspect.alias("aspect"), "phrase", ((size * 7 % 19 - 9) / 10).alias("weight"))


def keyword_scores_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Phrase scores with thousands of phrases made from ``benchmark``, through an index of their rarest grams."""
    chunks = chunking.text_chunks(documents(spark, sf), "doc_id", "text").select("doc_id", "chunk_order", "chunk_text")
    chunks = written(chunks, "phrase-chunks")
    scored = phrase_index.keyword_scores_of_table(chunks, "doc_id", materialise(benchmark_phrases(spark, sf)))
    return scored.withColumn("keyword_score", F.round("keyword_score", 6))


def _scored(spark: SparkSession, sf: str, lexicon: dict) -> DataFrame:
    return scoring.score_texts(documents(spark, sf), "doc_id", "text", make_encoder, lexicon)


def aspect_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _score_columns(_scored(spark, sf, scoring.LEXICON))


def aspect_scores_words(spark: SparkSession, sf: str) -> DataFrame:
    return _score_columns(_scored(spark, sf, WORD_LEXICON))


class FailingEncoder(HashingEncoder):
    """A model that cannot read texts with a certain word, nor the reference texts of one aspect."""

    def __call__(self, texts: list[str]):
        if any("motor" in t or "lorem" in t or "der" in t.split() for t in texts):
            raise ValueError("unreadable")
        return super().__call__(texts)


def named_aspects_failing(spark: SparkSession, sf: str) -> DataFrame:
    """Three named aspects (one unknown name is left out) with a model that fails on some texts and on one aspect's references.

    Scores whose similarity part was lost are neutral there: texts all of whose chunks failed, and the failing aspect.
    """
    scored = scoring.score_texts(documents(spark, sf), "doc_id", "text", lambda: FailingEncoder(DIMS), WORD_LEXICON,
                                 aspects=["sails", "motor", "nothing", "condition"])
    nudged = scored.withColumns({c: F.col(c) + NUDGE for c in ("raw_score", "confidence")})
    return _score_columns(nudged).drop("keywords")


def _score_columns(scored: DataFrame) -> DataFrame:
    return scored.select(
        "doc_id", "aspect", F.round("raw_score", 6).alias("raw_score"), F.round("confidence", 6).alias("confidence"),
        F.size("keywords").alias("keywords"), F.size("supporting_chunks").alias("supporting"), "score_method",
    )


def aspect_scores_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same scores from a chunk table with stored vectors, as the nightly job reads it."""
    chunks = chunking.text_chunks(documents(spark, sf), "doc_id", "text")
    # Cut once for both readers. What is joined and gathered later are phrases and cosines, neither texts nor vectors.
    chunks = written(chunks.select("doc_id", "chunk_source", "chunk_order", "chunk_text"), "scored-chunks")
    store = written(embed_missing(chunks, "chunk_text", make_encoder, f"token-hash-{DIMS}", packed=True), "scored-vectors")
    compared = scoring.reference_cosines(store, make_encoder)
    marked = scoring.chunk_phrases(chunks, WORD_LEXICON)
    embedded = attach_embeddings(marked, "chunk_text", f"token-hash-{DIMS}", compared, ("sims",))
    scored = scoring.score_chunks(embedded, "doc_id", make_encoder, WORD_LEXICON)
    return _score_columns(scored).drop("keywords", "supporting")


def distinct_chunk_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts the embedding store still lacks: each distinct chunk once, though many are shared."""
    chunks = chunking.text_chunks(documents(spark, sf), "doc_id", "text")
    store = embed_missing(chunks, "chunk_text", make_encoder, f"token-hash-{DIMS}")
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    return store.select("text_key", F.length("text").alias("chars"), norm.alias("weight"), F.size("embedding").alias("dims"))


def supporting_chunk_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks that mention an aspect, resolved back from their texts to positions."""
    texts = documents(spark, sf).withColumnRenamed("doc_id", "ad_id")
    chunks = chunking.text_chunks(texts, "ad_id", "text").withColumn("chunk_id", F.col("chunk_order").cast("bigint"))
    # Cut once for both readers. Chunks move with their listing, so a text moves once, whatever number of aspects it has.
    chunks = written(chunks.select("ad_id", "chunk_source", "chunk_text", "chunk_id"), "support-chunks")
    support = chunking.aspect_chunks(chunks.select("ad_id", "chunk_text").repartition("ad_id"), [*chunking.SECTION_KEYWORDS, "other"]).groupBy("ad_id", "aspect").agg(
        F.collect_set("chunk_text").alias("texts")
    )
    found = queues.resolve_chunk_ids(support, chunks)
    return found.select("ad_id", "aspect", F.array_join("supporting_chunks", ",").alias("chunk_ids"))


def search_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark text searched over the chunks of all active documents."""
    return _search(spark, sf, "chunk_first")


def search_texts_listing_first(spark: SparkSession, sf: str) -> DataFrame:
    """As ``search_texts``, with the nearest listings instead of the nearest chunks."""
    return _search(spark, sf, "listing_first")


def _live_chunks(spark: SparkSession, sf: str, cut: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Listings, and the stored vectors (packed) of the chunks of all active ones; ``cut`` are the chunks of all listings, if at hand."""
    ads = descriptions(spark, sf).withColumn("has_embeddings", F.lit(True))
    # Only what can be found is embedded; a chunk's number within its listing is an int, so ids cannot meet.
    live = ads.where("active").select("ad_id")
    if cut is None:
        texts = spread_scan(read_table(spark, sf, "documents"), "doc_id").withColumnRenamed("doc_id", "ad_id")
        chunks = chunking.text_chunks(texts.join(live, "ad_id", "left_semi"), "ad_id", "text")
    else:
        chunks = cut.join(live, "ad_id", "left_semi")
    numbered = chunks.withColumn("chunk_id", F.shiftleft("ad_id", 32) + F.col("chunk_order"))
    embedded = embed_texts(numbered, "chunk_text", make_encoder, 1024, packed=True).drop("error")
    return ads, written(embedded, "text-chunks", "zstd")


def _search(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    ads, embedded = _live_chunks(spark, sf)
    queries = read_table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), "text", F.lit(5).alias("limit"), F.lit(0.55).alias("min_score")
    )
    found = search.search(queries, embedded, ads, make_encoder, mode)
    return found.select("query_id", "rank", "ad_id", F.round("similarity_score", 6).alias("similarity_score"),
                        F.size("matching_chunks").alias("chunks"))


def _cut_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The chunks of all listings, cut once for their vectors and their scores."""
    return written(chunking.text_chunks(documents(spark, sf).withColumnRenamed("doc_id", "ad_id"), "ad_id", "text"), "cut-chunks")


def _stored_scores(chunks: DataFrame) -> DataFrame:
    return scoring.keyword_scores(chunks, "ad_id", lexicon=WORD_LEXICON).withColumnRenamed("keyword_score", "raw_score")


def search_by_aspect(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark text searched inside an aspect, with that aspect's stored scores, as rows for display."""
    cut = _cut_chunks(spark, sf)
    ads, embedded = _live_chunks(spark, sf, cut)
    aspect = F.when(F.col("item_id") % 2 == 0, "sails").otherwise("motor")
    queries = search.queries_by_aspect(read_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text", aspect.alias("aspect")))
    shown = search.result_rows(search.search(queries, embedded, ads, make_encoder, scores=_stored_scores(cut)))
    return shown.select(
        "query_id", "rank", "ad_id", "title", "description", "similarity_score", F.size("matching_chunks").alias("chunks"),
        F.array_join(F.map_keys("aspect_scores"), ",").alias("aspects"), F.round(F.get(F.map_values("aspect_scores"), F.lit(0)), 6).alias("aspect_score"),
    )


def similar_by_description(spark: SparkSession, sf: str) -> DataFrame:
    """Listings similar to every listing whose id is divisible by 100, by its own description, with all aspect scores."""
    cut = _cut_chunks(spark, sf)
    ads, embedded = _live_chunks(spark, sf, cut)
    asked = ads.where("ad_id % 100 = 0").select("ad_id")
    found = search.find_similar(asked, embedded, ads, make_encoder, _stored_scores(cut), 5, 0.6)
    return found.select("query_id", "rank", "ad_id", F.round("similarity_score", 6).alias("similarity_score"),
                        F.size("aspect_scores").alias("aspects"), F.round(F.col("aspect_scores")["motor"], 6).alias("motor"))


def search_cached(spark: SparkSession, sf: str) -> DataFrame:
    """All benchmark texts after those with an even id were searched before: these come from the cache, the others are searched."""
    ads, embedded = _live_chunks(spark, sf)
    now = F.lit("2024-02-01 12:00:00").cast("timestamp_ntz")
    queries = read_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    empty = cache.cache_rows(
        spark.createDataFrame([], "query_id bigint, query_hash string, text string"),
        spark.createDataFrame([], "query_id bigint, rank int, ad_id bigint, similarity_score double"), now,
    )
    _, stored = cache.search_with_cache(queries.where("query_id % 2 = 0"), empty, embedded, ads, make_encoder, now)
    results, _ = cache.search_with_cache(queries, materialise(stored), embedded, ads, make_encoder, now)
    return results.select("query_id", "rank", "ad_id", F.round("similarity_score", 6).alias("similarity_score"),
                          F.col("matching_chunks").isNull().alias("from_cache"))


def query_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    queries = read_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    plain = search.with_query_defaults(queries)
    by_aspect = search.queries_by_aspect(queries.withColumn("aspect", F.lit("motor")))
    return plain.select("query_id", F.lit("plain").alias("kind"), search.query_fingerprint(plain).alias("query_hash")).unionByName(
        by_aspect.select("query_id", F.lit("aspect").alias("kind"), search.query_fingerprint(by_aspect).alias("query_hash"))
    )


def short_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns usable as queries."""
    return search.usable_queries(read_table(spark, sf, "conversations").select("conv_id", "turn", "text"))


def nightly_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The whole nightly run without scores yet, where listings marked as embedded have their chunks and vectors stored."""
    now, model = F.lit("2024-02-01").cast("timestamp_ntz"), f"token-hash-{DIMS}"
    ads = descriptions(spark, sf).withColumn("semantic_processed_at", F.lit(None).cast("timestamp_ntz"))
    stored = ads.where("active AND has_embeddings").select("ad_id", F.col("description").alias("text"))
    old, vectors = nightly.embedded_chunks(stored, make_encoder, model)
    new, _ = nightly.embedded_chunks(nightly.due_texts(ads), make_encoder, model, vectors)
    chunks, marked = nightly.store_chunks(ads, old.withColumns({"created_at": now, "updated_at": now}), new, now)
    empty = spark.createDataFrame([], "ad_id bigint, aspect string, raw_score double, supporting_chunks array<bigint>, "
                                      "score_method string, created_at timestamp_ntz, normalized_score double")
    scores = nightly.score_listings(marked, empty, chunks, make_encoder, now, lexicon=WORD_LEXICON)
    # Written first: the order by ranges samples its input, which would score every listing twice.
    scores = written(scores.withColumn("raw_score", F.round("raw_score", 6)), "scores", "zstd")
    normalised = nightly.normalise_scores(scores)
    return normalised.select("ad_id", "aspect", "raw_score", F.round("normalized_score", 6).alias("normalized_score"))


def nightly_changed(spark: SparkSession, sf: str) -> DataFrame:
    """Two nights: in the first, every fourth listing has another description; in the second, only those are done again."""
    now, model = F.lit("2024-02-01").cast("timestamp_ntz"), f"token-hash-{DIMS}"
    given = descriptions(spark, sf).withColumns({
        "has_embeddings": F.lit(False), "semantic_processed_at": F.lit(None).cast("timestamp_ntz")})
    ads = given.withColumn("description", F.when(F.col("ad_id") % 4 == 0, F.reverse("description")).otherwise(F.col("description")))
    scores = spark.createDataFrame([], "ad_id bigint, aspect string, raw_score double, supporting_chunks array<bigint>, "
                                       "score_method string, created_at timestamp_ntz, normalized_score double")
    processed = spark.createDataFrame([], "ad_id bigint, text_hash string")
    chunks = vectors = None
    for night in (1, 2):
        due = written(nightly.due_texts(ads, processed=processed), "due-texts", "zstd")
        cut = nightly.cut_texts(due)
        emptied = written(nightly.emptied_listings(due, cut), "emptied-listings")
        new, vectors = nightly.embedded_chunks(due, make_encoder, model, vectors, cut)
        done = written(new.select("ad_id").distinct(), "new-listings", "zstd")
        if chunks is None:
            chunks = new.limit(0).withColumns({"created_at": now, "updated_at": now})
        stored, marked = nightly.store_chunks(ads, chunks, new, now)
        chunks = written(stored.join(emptied, "ad_id", "left_anti").select(chunks.columns), "stored-chunks", "zstd")
        marked = written(marked, "marked-listings", "zstd")
        handled = done.unionByName(emptied)
        scores = written(nightly.score_listings(marked, queues.forget_scores(scores, handled), chunks, make_encoder, now,
                                                lexicon=WORD_LEXICON), "scores", "zstd")
        processed = written(queues.remember_texts(processed, marked, handled), "processed-texts", "zstd")
        ads = marked.drop("description").join(given.select("ad_id", "description"), "ad_id")
    redone = done.withColumn("redone", F.lit(True))
    return scores.join(redone, "ad_id", "left").select(
        "ad_id", "aspect", F.round("raw_score", 6).alias("raw_score"), F.coalesce("redone", F.lit(False)).alias("redone"))


def _word_score_table(spark: SparkSession, sf: str) -> DataFrame:
    """A stored score table, as the operators below read their input more than once."""
    chunks = chunking.text_chunks(documents(spark, sf), "doc_id", "text")
    scored = scoring.keyword_scores(chunks, "doc_id", lexicon=WORD_LEXICON)
    return materialise(scored.select("doc_id", "aspect", F.round("keyword_score", 6).alias("raw_score")))


def percentile_by_position(spark: SparkSession, sf: str) -> DataFrame:
    ranked = percentiles.percentile_by_position(_word_score_table(spark, sf), "aspect", "raw_score", "doc_id")
    return ranked.withColumn("normalized_score", F.round("normalized_score", 6))


def percentile_by_share(spark: SparkSession, sf: str) -> DataFrame:
    ranked = percentiles.percentile_by_share(_word_score_table(spark, sf), "aspect", "raw_score")
    return ranked.withColumn("normalized_score", F.round("normalized_score", 6))


def share_in_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of unlabelled documents placed among the labelled ones."""
    scores = _word_score_table(spark, sf)
    labelled = read_table(spark, sf, "labels").select("doc_id")
    dataset, targets = scores.join(labelled, "doc_id", "left_semi"), scores.join(labelled, "doc_id", "left_anti")
    ranked = percentiles.share_in_dataset(targets, dataset, "aspect", "raw_score", "doc_id")
    return ranked.withColumn("normalized_score", F.round("normalized_score", 6))


def top_per_aspect(spark: SparkSession, sf: str) -> DataFrame:
    return percentiles.top_per_aspect(_word_score_table(spark, sf), "aspect", "raw_score", "doc_id", 10)


def score_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Default-lexicon scores of all documents, then word-lexicon scores of English ones merged in."""
    now, before = (F.lit(t).cast("timestamp_ntz") for t in ("2024-02-01", "2024-01-01"))
    texts = documents(spark, sf).withColumnRenamed("doc_id", "ad_id")

    def table(rows: DataFrame, lexicon: dict) -> DataFrame:
        scored = scoring.keyword_scores(chunking.text_chunks(rows, "ad_id", "text"), "ad_id", lexicon=lexicon)
        return scored.select(
            "ad_id", "aspect", F.round("keyword_score", 6).alias("raw_score"),
            F.array().cast("array<bigint>").alias("supporting_chunks"), F.lit("keyword_match").alias("score_method"),
        )

    old = table(texts, scoring.LEXICON).withColumn("created_at", before)
    merged = queues.upsert_scores(old, table(texts.where("lang = 'en'"), WORD_LEXICON), now)
    return merged.select("ad_id", "aspect", "raw_score", "created_at")


QUERIES = {
    f.__name__: f
    for f in [
        clean_text, word_counts, text_chunks, sentence_spans, section_breaks, aspect_chunks, text_with_equipment,
        shortened_texts, embed_queue, embed_queue_next, score_queue, score_queue_next, backfill_queue, backfill_queue_next,
        backfill_decision,
        overwritten_descriptions, processed_listings, replaced_chunks, keyword_scores, keyword_scores_words, keyword_scores_indexed,
        aspect_scores, aspect_scores_words, named_aspects_failing, aspect_scores_stored, distinct_chunk_texts, supporting_chunk_ids,
        search_texts, search_texts_listing_first, search_by_aspect, similar_by_description, search_cached, query_fingerprint, short_queries, nightly_scores, nightly_changed, percentile_by_position,
        percentile_by_share, share_in_dataset, top_per_aspect, score_upsert,
    ]
}

# -- SQL -------------------------------------------------------------------------------------------

_WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^{_WS}+|{_WS}+$', '', 'g')"


def _clean(text: str) -> str:
    return (rf"lower(regexp_replace(regexp_replace({_strip(text)}, '{_WS}+', ' ', 'g'), "
            r"'[^\p{L}\p{N}_ .,!?()-]', '', 'g'))")


def _words(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda x: x <> '')"


def chunks_sql(source: str, key: str = "doc_id", text: str = "text", p: str = "") -> str:
    """CTEs ending in ``{p}chunks`` (key, chunk_order, chunk_text, chunk_length) over a source table."""
    return rf"""{p}cleaned AS (
  SELECT {key}, {_clean(text)} AS clean FROM {source} WHERE length({_strip(text)}) >= 20),
{p}worded AS (SELECT {key}, clean, {_words('clean')} AS words FROM {p}cleaned),
{p}ended AS (
  SELECT {key}, clean, words, unnest(list_filter(list_transform(range(1, len(words) + 1),
    lambda i: CASE WHEN right(words[i], 1) IN ('.', '!', '?') OR i = len(words) THEN i END), lambda i: i IS NOT NULL)) AS z
  FROM {p}worded WHERE len(words) >= 8),
{p}spans AS (SELECT *, lag(z, 1, 0) OVER (PARTITION BY {key} ORDER BY z) AS a FROM {p}ended),
{p}cut AS (
  SELECT *, CAST(greatest(0, ceil((z - a - 25) / 13.0)) AS BIGINT) AS n FROM {p}spans),
{p}windows AS (SELECT *, unnest(range(0, n + 1)) AS k FROM {p}cut),
{p}placed AS (
  SELECT {key}, words, a + 13 * k AS s, CASE WHEN k < n THEN a + 13 * k + 20 ELSE z END AS e FROM {p}windows),
{p}chunks AS (
  SELECT {key}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY s) - 1 AS INTEGER) AS chunk_order,
    array_to_string(words[s + 1:e], ' ') AS chunk_text, CAST(e - s AS INTEGER) AS chunk_length
  FROM {p}placed WHERE e - s >= 8
  UNION ALL
  SELECT {key}, 0, clean, CAST(len(words) AS INTEGER) FROM {p}worded WHERE len(words) < 8)"""


def _text_sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _lexicon_sql(lexicon: dict) -> str:
    rows = ", ".join(
        f"({_text_sql(a)}, {_text_sql(f)}, CAST({w} AS DOUBLE))" for a, _, f, w in scoring.lexicon_rows(lexicon)
    )
    return f"lexicon(aspect, phrase, weight) AS (VALUES {rows})"


_ASPECTS_SQL = "aspects(aspect) AS (VALUES " + ", ".join(f"('{a}')" for a in scoring.ASPECTS) + ")"


BENCHMARK_LEXICON = rf"""words AS (SELECT string_split_regex(lower(text), '[ \n]+') AS w FROM benchmark),
sized AS (SELECT w, unnest(range(2, 7)) AS n FROM words),
runs AS (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized WHERE len(w) >= n),
lexicon AS (SELECT ([{", ".join(f"'{a}'" for a in scoring.ASPECTS)}])[length(phrase) % 4 + 1] AS aspect, phrase,
  (length(phrase) * 7 % 19 - 9) / 10 AS weight FROM (SELECT DISTINCT array_to_string(w[i:i + n - 1], ' ') AS phrase FROM runs))"""


def _keyword_sql(lexicon: dict | str, key: str = "doc_id", p: str = "") -> str:
    """CTEs ending in ``{p}kw`` (key, aspect, keyword_score, hits, keyword_chunks); the lexicon may be CTEs of its own."""
    own = lexicon if isinstance(lexicon, str) else p + _lexicon_sql(lexicon)
    return f"""{own}, {_ASPECTS_SQL if not p else 'unused' + p + ' AS (SELECT 1)'},
{p}hit AS (SELECT c.{key}, c.chunk_order, x.aspect, x.weight FROM {p}chunks c JOIN {p}lexicon x ON contains(c.chunk_text, x.phrase)),
{p}sums AS (SELECT {key}, aspect, sum(CAST(round(weight * 10000) AS BIGINT)) / 10000.0 AS total, count(*) AS hits, count(DISTINCT chunk_order) AS keyword_chunks
  FROM {p}hit GROUP BY ALL),
{p}counts AS (SELECT {key}, count(*) AS n FROM {p}chunks GROUP BY ALL),
{p}kw AS (SELECT n.{key}, a.aspect,
    CASE WHEN a.aspect NOT IN (SELECT aspect FROM {p}lexicon) THEN 0.0
         WHEN s.hits IS NULL THEN 0.5
         ELSE (greatest(-1.0, least(1.0, s.total / n.n)) + 1.0) / 2.0 END AS keyword_score,
    coalesce(s.hits, 0) AS hits, coalesce(s.keyword_chunks, 0) AS keyword_chunks
  FROM {p}counts n CROSS JOIN aspects a LEFT JOIN {p}sums s ON s.{key} = n.{key} AND s.aspect = a.aspect)"""


_SLOT = "('0x' || substr(md5({t}), 1, 8))::BIGINT % 768"


def _sparse_sql(name: str, source: str, keys: str, text: str) -> str:
    """CTE of sparse token-hash vectors (keys, slot, x) and ``{name}_norm``."""
    slot = _SLOT.format(t="token")
    split = rf"list_filter(regexp_split_to_array(lower({text}), '{_WS}+'), lambda x: x <> '')"
    return f"""{name}_tokens AS (SELECT {keys}, unnest({split}) AS token FROM {source}),
{name}_slots AS (SELECT {keys}, {slot} AS h FROM {name}_tokens),
{name} AS (SELECT {keys}, h % 384 AS slot, sum(CASE WHEN h < 384 THEN 1.0 ELSE -1.0 END) AS x FROM {name}_slots GROUP BY ALL),
{name}_norm AS (SELECT {keys}, sqrt(sum(x * x)) AS norm FROM {name} GROUP BY ALL)"""


_REFERENCES_SQL = "ref_texts(aspect, text) AS (VALUES " + ", ".join(
    f"({_text_sql(a)}, {_text_sql(t)})" for a, texts in scoring.REFERENCE_TEXTS.items() for t in texts
) + ")"


_READABLE = rf"""NOT (contains(chunk_text, 'motor') OR contains(chunk_text, 'lorem')
  OR list_contains(regexp_split_to_array(chunk_text, '{_WS}+'), 'der'))"""


def _score_sql(lexicon: dict, readable: str = "TRUE", read_aspects: str = "TRUE", nudge: float = 0.0) -> str:
    """Aspect scores; ``readable`` is a condition on chunk_text, ``read_aspects`` one on the aspect of a reference.

    ``nudge`` is added before rounding, so that a score halfway between two rounded ones goes the same way on both sides.
    """
    return f"""WITH {chunks_sql('documents')}, {_keyword_sql(lexicon)}, {_REFERENCES_SQL},
{_sparse_sql('ref_sum', f'(SELECT * FROM ref_texts WHERE {read_aspects})', 'aspect', 'text')},
ref AS (SELECT aspect, slot, x / 3.0 AS x FROM ref_sum), ref_norm AS (SELECT aspect, sqrt(sum(x * x)) AS norm FROM ref GROUP BY 1),
{_sparse_sql('vec', f'(SELECT * FROM chunks WHERE {readable})', 'doc_id, chunk_order', 'chunk_text')},
dots AS (SELECT v.doc_id, v.chunk_order, r.aspect, sum(v.x * r.x) AS dot FROM vec v JOIN ref r ON r.slot = v.slot GROUP BY ALL),
cosines AS (SELECT n.doc_id, n.chunk_order, r.aspect, coalesce(d.dot, 0.0) / nullif(n.norm * r.norm, 0) AS cos
  FROM vec_norm n CROSS JOIN ref_norm r
  LEFT JOIN dots d ON d.doc_id = n.doc_id AND d.chunk_order = n.chunk_order AND d.aspect = r.aspect),
sim AS (SELECT doc_id, aspect, (max(cos) * 0.7 + avg(cos) * 0.3 + 1.0) / 2.0 AS score FROM cosines GROUP BY ALL),
support AS (SELECT doc_id, aspect, count(DISTINCT chunk_order) AS supporting FROM (
    SELECT doc_id, chunk_order, aspect FROM cosines WHERE cos > 0.6 UNION SELECT doc_id, chunk_order, aspect FROM hit) GROUP BY ALL),
both_parts AS (SELECT k.*, coalesce(s.score, 0.5) AS sim, CASE WHEN k.hits > 0 THEN 0.7 ELSE 0.3 END AS share,
    coalesce(u.supporting, 0) AS supporting
  FROM kw k LEFT JOIN sim s ON s.doc_id = k.doc_id AND s.aspect = k.aspect
  LEFT JOIN support u ON u.doc_id = k.doc_id AND u.aspect = k.aspect)
SELECT doc_id, aspect, round(greatest(0.0, least(1.0, keyword_score * share + sim * (1.0 - share))) + {nudge}, 6) AS raw_score,
  round(greatest(0.0, least(1.0, (1.0 - abs(keyword_score - sim)) * 0.6 + least(hits * 0.1, 0.4)
    + least(keyword_chunks * 0.05, 0.3))) + {nudge}, 6) AS confidence,
  hits AS keywords, supporting, 'hybrid' AS score_method FROM both_parts"""


def _mentions(aspect: str, text: str) -> str:
    words = chunking.SECTION_KEYWORDS.get(aspect)
    return " OR ".join(f"contains({text}, {_text_sql(w)})" for w in words) if words else "TRUE"


def _aspect_chunks_sql(aspects: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id, chunk_order, chunk_text, '{a}' AS aspect FROM chunks WHERE {_mentions(a, 'chunk_text')}" for a in aspects)


_SCORE_TABLE = f"""{chunks_sql('documents')}, {_keyword_sql(WORD_LEXICON)},
scores AS (SELECT doc_id, aspect, round(keyword_score, 6) AS raw_score FROM kw)"""

_KEYWORD_COLUMNS = "doc_id, aspect, round(keyword_score, 6) AS keyword_score, hits, keyword_chunks"


def _found_sql(asked: str, limit: int, least: float, listing_first: bool = False) -> str:
    """CTEs ending in ``found`` (query_id, ad_id, s, chunks, rank): the search of ``asked`` (query_id, text) over active listings."""
    nearest = f"""hits AS (SELECT * FROM distances
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) <= {2 * limit})"""
    if listing_first:
        nearest = f"""best AS (SELECT * FROM distances
  QUALIFY row_number() OVER (PARTITION BY query_id, ad_id ORDER BY distance, chunk_id) = 1),
hits AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) <= {2 * limit})"""
    return f"""{DESCRIPTIONS}, {chunks_sql('documents')},
usable AS (SELECT query_id, text FROM ({asked}) WHERE length({_strip('text')}) >= 3),
{_sparse_sql('q', 'usable', 'query_id', 'text')},
live AS (SELECT c.* FROM chunks c JOIN listings l ON l.ad_id = c.doc_id WHERE l.active),
{_sparse_sql('vec', 'live', 'doc_id, chunk_order', 'chunk_text')},
dots AS (SELECT q.query_id, v.doc_id, v.chunk_order, sum(v.x * q.x) AS dot FROM vec v JOIN q ON q.slot = v.slot GROUP BY ALL),
distances AS (SELECT r.query_id, n.doc_id AS ad_id, n.doc_id * 100000 + n.chunk_order AS chunk_id,
    round(1.0 - coalesce(d.dot, 0.0) / (n.norm * r.norm), 9) AS distance
  FROM vec_norm n CROSS JOIN q_norm r
  LEFT JOIN dots d ON d.query_id = r.query_id AND d.doc_id = n.doc_id AND d.chunk_order = n.chunk_order
  WHERE n.norm * r.norm > 0),
{nearest},
grouped AS (SELECT query_id, ad_id, min(distance) AS d, count(*) AS n FROM hits GROUP BY ALL),
ranked AS (SELECT query_id, ad_id, greatest(0.0, 1.0 - d / 2.0) AS s, least(n, 3) AS chunks FROM grouped),
found AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, ad_id) AS rank FROM ranked WHERE s >= {least}
  QUALIFY rank <= {limit})"""


_BENCHMARK = "SELECT item_id AS query_id, text FROM benchmark"


def _search_sql(listing_first: bool) -> str:
    return f"""WITH {_found_sql(_BENCHMARK, 5, 0.55, listing_first)}
SELECT query_id, rank, ad_id, round(s, 6) AS similarity_score, chunks FROM found"""


ORACLE = {
    "clean_text": f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents",
    "word_counts": f"""SELECT doc_id, len(list_filter(regexp_split_to_array(text, '{_WS}+'), lambda x: x <> '')) AS words
        FROM documents""",
    "text_chunks": f"""WITH {chunks_sql('documents')} SELECT *, 'description' AS chunk_source,
        CASE WHEN chunk_order > 0 THEN least(7, chunk_length) ELSE 0 END AS overlap_words FROM chunks""",
    "sentence_spans": f"""WITH worded AS (SELECT doc_id, {_words(_clean('text'))} AS words FROM documents),
        ended AS (SELECT doc_id, unnest(list_filter(list_transform(range(1, len(words) + 1),
          lambda i: CASE WHEN right(words[i], 1) IN ('.', '!', '?') OR i = len(words) THEN i END), lambda i: i IS NOT NULL)) AS z
          FROM worded)
        SELECT doc_id, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY z) AS from_word, z AS to_word FROM ended""",
    "section_breaks": f"""WITH worded AS (SELECT doc_id, {_words(_clean('text'))} AS words FROM documents),
        placed AS (SELECT doc_id, words, unnest(range(0, len(words))) AS word_index FROM worded),
        picked AS (SELECT doc_id, word_index, words[word_index + 1] AS word FROM placed WHERE word_index > 0)
        SELECT * FROM picked WHERE {' OR '.join(_mentions(a, 'word') for a in chunking.SECTION_KEYWORDS)}""",
    "aspect_chunks": f"""WITH {chunks_sql('documents')}, tagged AS ({_aspect_chunks_sql(['motor', 'exterior', 'other'])})
        SELECT doc_id, chunk_order, aspect FROM tagged""",
    "text_with_equipment": r"""SELECT doc_id, md5(CASE WHEN lang <> 'fr' THEN text || chr(10) || 'Utstyr: ' || source || ', ' || lang
        ELSE text END) AS combined_md5, lang <> 'fr' AND contains(source, 'src1') AS has_item FROM documents""",
    "shortened_texts": """SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview
        FROM documents""",
    "embed_queue": f"""WITH {DESCRIPTIONS} SELECT ad_id FROM listings WHERE active AND description IS NOT NULL
        AND length(trim(description)) > 50 AND (has_embeddings = FALSE OR has_embeddings IS NULL)""",
    "embed_queue_next": f"""WITH {DESCRIPTIONS} SELECT ad_id FROM listings WHERE active AND description IS NOT NULL
        AND length(trim(description)) > 50 AND (has_embeddings = FALSE OR has_embeddings IS NULL) ORDER BY ad_id LIMIT 100""",
    "score_queue": f"""WITH {DESCRIPTIONS} SELECT DISTINCT l.ad_id FROM listings l
        LEFT JOIN (SELECT doc_id FROM labels WHERE toxic = 1) s ON s.doc_id = l.ad_id
        WHERE has_embeddings AND description IS NOT NULL AND s.doc_id IS NULL""",
    "score_queue_next": f"""WITH {DESCRIPTIONS} SELECT ad_id FROM listings WHERE has_embeddings AND description IS NOT NULL
        AND ad_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) ORDER BY ad_id LIMIT 50""",
    "backfill_queue_next": f"""WITH {DESCRIPTIONS} SELECT ad_id, ad_url, length(coalesce(description, '')) AS current_length FROM listings
        WHERE ad_id IN (SELECT doc_id FROM labels) ORDER BY ad_id LIMIT 20""",
    "backfill_queue": f"""WITH {DESCRIPTIONS} SELECT ad_id, ad_url,
        length(coalesce(CASE WHEN has_embeddings THEN description END, '')) AS current_length FROM listings WHERE active""",
    "backfill_decision": f"""WITH pairs AS (SELECT d.doc_id, length(d.text) AS have, coalesce(length({_strip('n.text')}), 0) AS got
          FROM documents d LEFT JOIN documents n ON n.doc_id = d.doc_id + 1)
        SELECT doc_id, CASE WHEN have > 500 THEN 'already_long' WHEN got < 10 THEN 'too_short'
            WHEN have > 0 AND got <= have + 50 THEN 'not_longer' ELSE 'update' END AS decision,
          CASE WHEN got < 10 THEN 'too_short' ELSE 'update' END AS forced FROM pairs""",
    "overwritten_descriptions": f"""WITH {DESCRIPTIONS} SELECT ad_id,
        md5(CASE WHEN title LIKE '% en' THEN {_strip("'New: ' || description")} ELSE description END) AS text_md5,
        CASE WHEN title LIKE '% en' AND has_embeddings THEN 'new source' ELSE title END AS source_raw FROM listings""",
    "processed_listings": f"""WITH {DESCRIPTIONS}, due AS (SELECT *, active AND length(trim(description)) > 50
          AND NOT coalesce(has_embeddings, FALSE) AS done FROM listings)
        SELECT ad_id, active, CASE WHEN done THEN TRUE ELSE has_embeddings END AS has_embeddings,
          CASE WHEN done THEN TIMESTAMP '2024-02-01' END AS semantic_processed_at FROM due""",
    "replaced_chunks": f"""WITH swapped AS (SELECT d.doc_id, n.text FROM documents d JOIN documents n ON n.doc_id = d.doc_id + 1 WHERE d.lang = 'en'),
        {chunks_sql('documents')}, {chunks_sql('swapped', p='s_')}
        SELECT doc_id AS ad_id, chunk_order, chunk_length, TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-01-01' AS updated_at
        FROM chunks WHERE doc_id NOT IN (SELECT doc_id FROM s_chunks)
        UNION ALL SELECT s.doc_id, s.chunk_order, s.chunk_length,
          CASE WHEN o.doc_id IS NULL THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END, TIMESTAMP '2024-02-01'
        FROM s_chunks s LEFT JOIN chunks o ON o.doc_id = s.doc_id AND o.chunk_order = s.chunk_order""",
    "keyword_scores": f"WITH {chunks_sql('documents')}, {_keyword_sql(scoring.LEXICON)} SELECT {_KEYWORD_COLUMNS} FROM kw",
    "keyword_scores_words": f"WITH {chunks_sql('documents')}, {_keyword_sql(WORD_LEXICON)} SELECT {_KEYWORD_COLUMNS} FROM kw",
    "keyword_scores_indexed": f"""WITH {chunks_sql('documents')}, {_keyword_sql(BENCHMARK_LEXICON)} SELECT {_KEYWORD_COLUMNS} FROM kw""",
    "aspect_scores": _score_sql(scoring.LEXICON),
    "aspect_scores_words": _score_sql(WORD_LEXICON),
    "named_aspects_failing": f"""SELECT doc_id, aspect, raw_score, confidence, supporting, score_method
        FROM ({_score_sql(WORD_LEXICON, _READABLE, "aspect <> 'motor'", NUDGE)})
        WHERE aspect IN ('sails', 'motor', 'condition')""",
    "aspect_scores_stored": f"SELECT doc_id, aspect, raw_score, confidence, score_method FROM ({_score_sql(WORD_LEXICON)})",
    "distinct_chunk_texts": f"""WITH {chunks_sql('documents')}, texts AS (SELECT DISTINCT chunk_text FROM chunks
          WHERE length(trim(chunk_text)) > 0), {_sparse_sql('vec', 'texts', 'chunk_text', 'chunk_text')}
        SELECT 'token-hash-384_' || md5(chunk_text) AS text_key, length(chunk_text) AS chars, sum(abs(x)) AS weight, 384 AS dims
        FROM vec GROUP BY chunk_text""",
    "supporting_chunk_ids": f"""WITH {chunks_sql('documents')}, tagged AS ({_aspect_chunks_sql([*chunking.SECTION_KEYWORDS, 'other'])}),
        wanted AS (SELECT DISTINCT doc_id, aspect, chunk_text FROM tagged)
        SELECT w.doc_id AS ad_id, w.aspect, string_agg(CAST(c.chunk_order AS VARCHAR), ',' ORDER BY c.chunk_order) AS chunk_ids
        FROM wanted w JOIN chunks c ON c.doc_id = w.doc_id AND c.chunk_text = w.chunk_text GROUP BY ALL""",
    "search_texts": _search_sql(False),
    "search_texts_listing_first": _search_sql(True),
    "search_by_aspect": f"""WITH {_found_sql("SELECT item_id AS query_id, CASE WHEN item_id % 2 = 0 THEN 'sails: ' ELSE 'motor: ' END || text AS text FROM benchmark", 10, 0.5)},
        {_keyword_sql(WORD_LEXICON)}
        SELECT query_id, rank, f.ad_id, title, CASE WHEN length(description) > 200 THEN substr(description, 1, 200) || '...' ELSE description END
          AS description, round(s, 3) AS similarity_score, chunks, k.aspect AS aspects, round(k.keyword_score, 6) AS aspect_score
        FROM found f JOIN listings l ON l.ad_id = f.ad_id
        LEFT JOIN kw k ON k.doc_id = f.ad_id AND k.aspect = CASE WHEN query_id % 2 = 0 THEN 'sails' ELSE 'motor' END""",
    "similar_by_description": f"""WITH {_found_sql("SELECT ad_id AS query_id, description AS text FROM listings WHERE active AND ad_id % 100 = 0", 6, 0.6)},
        {_keyword_sql(WORD_LEXICON)},
        others AS (SELECT query_id, ad_id, s, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place FROM found WHERE ad_id <> query_id)
        SELECT query_id, place AS rank, ad_id, round(s, 6) AS similarity_score,
          (SELECT CAST(count(*) AS INTEGER) FROM aspects) AS aspects, round(k.keyword_score, 6) AS motor
        FROM others o LEFT JOIN kw k ON k.doc_id = o.ad_id AND k.aspect = 'motor' WHERE place <= 5""",
    "search_cached": f"""WITH {_found_sql(_BENCHMARK, 10, 0.6)}
        SELECT query_id, rank, ad_id, round(s, 6) AS similarity_score, query_id % 2 = 0 AS from_cache FROM found""",
    "query_fingerprint": """SELECT item_id AS query_id, 'plain' AS kind, md5(text || '|None|0.6|10|False') AS query_hash FROM benchmark
        UNION ALL SELECT item_id, 'aspect', md5('motor: ' || text || '|[''motor'']|0.5|10|True') FROM benchmark""",
    "short_queries": f"""SELECT conv_id, turn, text FROM conversations WHERE length({_strip('text')}) >= 3""",
    "nightly_scores": f"""WITH {DESCRIPTIONS}, s AS ({_score_sql(WORD_LEXICON)}),
        kept AS (SELECT doc_id AS ad_id, aspect, raw_score FROM s JOIN listings l ON l.ad_id = s.doc_id
          WHERE l.active AND (coalesce(l.has_embeddings, FALSE) OR length(trim(l.description)) > 50))
        SELECT ad_id, aspect, raw_score, round((row_number() OVER (PARTITION BY aspect ORDER BY raw_score, ad_id) - 1)
          / (count(*) OVER (PARTITION BY aspect) - 1), 6) AS normalized_score FROM kept""",
    "nightly_changed": f"""WITH {DESCRIPTIONS}, s AS ({_score_sql(WORD_LEXICON)})
        SELECT doc_id AS ad_id, aspect, raw_score, doc_id % 4 = 0 AND l.description <> reverse(l.description) AS redone
        FROM s JOIN listings l ON l.ad_id = s.doc_id WHERE l.active AND length(trim(l.description)) > 50""",
    "percentile_by_position": f"""WITH {_SCORE_TABLE} SELECT doc_id, aspect, raw_score, CASE WHEN count(*) OVER g >= 2 THEN
        round((row_number() OVER (PARTITION BY aspect ORDER BY raw_score, doc_id) - 1) / (count(*) OVER g - 1), 6) END
        AS normalized_score FROM scores WINDOW g AS (PARTITION BY aspect)""",
    "percentile_by_share": f"""WITH {_SCORE_TABLE} SELECT doc_id, aspect, raw_score,
        round(cume_dist() OVER (PARTITION BY aspect ORDER BY raw_score), 6) AS normalized_score FROM scores""",
    "share_in_dataset": f"""WITH {_SCORE_TABLE}, known AS (SELECT * FROM scores WHERE doc_id IN (SELECT doc_id FROM labels)),
        per_score AS (SELECT aspect, raw_score, count(*) AS c FROM known GROUP BY ALL),
        sizes AS (SELECT aspect, count(*) AS n FROM known GROUP BY ALL),
        wanted AS (SELECT DISTINCT aspect, raw_score FROM scores WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
        shares AS (SELECT w.aspect, w.raw_score, coalesce(sum(c.c), 0) AS below FROM wanted w
          LEFT JOIN per_score c ON c.aspect = w.aspect AND c.raw_score <= w.raw_score GROUP BY ALL)
        SELECT t.doc_id, t.aspect, t.raw_score, round(s.below / z.n, 6) AS normalized_score
        FROM scores t JOIN shares s ON s.aspect = t.aspect AND s.raw_score = t.raw_score JOIN sizes z ON z.aspect = t.aspect
        WHERE t.doc_id NOT IN (SELECT doc_id FROM labels)""",
    "top_per_aspect": f"""WITH {_SCORE_TABLE} SELECT *, row_number() OVER (PARTITION BY aspect ORDER BY raw_score DESC, doc_id) AS rank
        FROM scores QUALIFY rank <= 10""",
    "score_upsert": f"""WITH {chunks_sql('documents')}, {_keyword_sql(scoring.LEXICON)},
        en AS (SELECT * FROM documents WHERE lang = 'en'), {chunks_sql('en', p='e_')}, {_keyword_sql(WORD_LEXICON, p='e_')}
        SELECT o.doc_id AS ad_id, o.aspect, round(coalesce(e.keyword_score, o.keyword_score), 6) AS raw_score,
          CASE WHEN e.doc_id IS NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END AS created_at
        FROM kw o LEFT JOIN e_kw e ON e.doc_id = o.doc_id AND e.aspect = o.aspect""",
}
