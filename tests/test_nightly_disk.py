"""The nightly run moves and keeps each vector as few times as it can."""

import numpy as np
from pyspark.sql import functions as F

from adlattice.operators import queues, scoring
from adlattice.operators.embedding import HashingEncoder
from adlattice.plans import nightly

SENTENCE = "this boat has {} words in one sentence of its own."


def make():
    return HashingEncoder(16)


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def texts_of(spark, n=6):
    return spark.createDataFrame([(i, " ".join(SENTENCE.format(w) for w in ("eight", i))) for i in range(n)], "ad_id bigint, text string")


def test_vectors_are_packed_and_ids_alone_need_no_vectors(spark):
    new, known = nightly.embedded_chunks(texts_of(spark), make, "m")
    assert known.schema["embedding"].dataType.typeName() == new.schema["embedding"].dataType.typeName() == "binary"
    assert "embedding" not in optimised(new.select("ad_id").distinct())
    row = new.orderBy("ad_id", "chunk_order").first()
    assert np.frombuffer(row["embedding"], "<f4").tolist() == make()([row["chunk_text"]])[0].tolist()
    scored = scoring.score_chunks(new, "ad_id", lambda: HashingEncoder(16))
    assert scored.count() == 6 * len(scoring.ASPECTS)


def test_blank_and_unread_chunks_leave_their_listing_out(spark):
    class Unreadable(HashingEncoder):
        def __call__(self, texts):
            if any("three" in t for t in texts):
                raise ValueError("unreadable")
            return super().__call__(texts)

    texts = spark.createDataFrame([(1, SENTENCE.format("one")), (2, "@" * 30), (3, SENTENCE.format("three"))], "ad_id bigint, text string")
    new, known = nightly.embedded_chunks(texts, lambda: Unreadable(16), "m")
    assert [r["ad_id"] for r in new.collect()] == [1] and known.count() == 1
    # A store that has lost a vector leaves the listings with that text out, too.
    lost = known.withColumn("embedding", F.lit(None).cast("binary"))
    assert nightly.embedded_chunks(texts, lambda: Unreadable(16), "m", lost)[0].count() == 0


def test_master_is_not_shuffled_to_mark_a_few_listings(spark):
    ads = spark.range(1000).select(F.col("id").alias("ad_id"), F.repeat(F.lit("d"), 100).alias("description"), F.lit(False).alias("has_embeddings"),
                                   F.lit(None).cast("timestamp_ntz").alias("semantic_processed_at"))
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    done = spark.createDataFrame([(3,), (3,), (5000,)], "ad_id bigint")
    marked = queues.mark_processed(ads, done, now)
    assert "SortMergeJoin" not in marked._jdf.queryExecution().executedPlan().toString() and marked.columns == ads.columns
    rows = {r["ad_id"]: (r["has_embeddings"], r["semantic_processed_at"] is not None) for r in marked.collect()}
    assert len(rows) == 1000 and {i for i, r in rows.items() if r == (True, True)} == {3} and set(rows.values()) == {(True, True), (False, False)}
