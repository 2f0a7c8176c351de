import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlattice.operators import scoring
from adlattice.operators.chunking import text_chunks
from adlattice.operators.embedding import (
    HashingEncoder, attach_embeddings, embed_missing, embed_texts, missing_embeddings, with_dimension, wrong_dimension,
)

TEXT = ("Veldig fin båt med 3 seil, to nye i fjor og ett gammelt. Motoren har hatt jevnlig vedlikehold og fungerer utmerket "
        "med lave timer. GPS, VHF radio og autopilot er installert i salongen og virker.")


def plain_scores(text_chunks_list, encode):
    """All aspect scores of one chunked text, computed directly."""
    vectors = encode(text_chunks_list)
    out = {}
    for aspect in scoring.ASPECTS:
        total, found, hit_chunks = 0.0, 0, 0
        phrases = scoring.LEXICON.get(aspect, {})
        for chunk in text_chunks_list:
            hits = [w for side in phrases.values() for p, w in side.items() if p in chunk]
            total, found, hit_chunks = total + sum(hits), found + len(hits), hit_chunks + bool(hits)
        keyword = 0.0 if not phrases else 0.5 if not found else (max(-1, min(1, total / len(text_chunks_list))) + 1) / 2
        similarity = 0.5
        if aspect in scoring.REFERENCE_TEXTS:
            ref = np.mean(encode(scoring.REFERENCE_TEXTS[aspect]), axis=0)
            cos = [v @ ref / (np.linalg.norm(v) * np.linalg.norm(ref)) for v in vectors]
            similarity = (max(cos) * 0.7 + np.mean(cos) * 0.3 + 1) / 2
        share = 0.7 if found else 0.3
        raw = max(0, min(1, keyword * share + similarity * (1 - share)))
        sure = (1 - abs(keyword - similarity)) * 0.6 + min(found * 0.1, 0.4) + min(hit_chunks * 0.05, 0.3)
        out[aspect] = (raw, max(0, min(1, sure)))
    return out


def test_scores_equal_direct_computation(spark):
    df = spark.createDataFrame([(1, TEXT), (2, "for kort"), (3, None)], "id bigint, text string")
    rows = scoring.score_texts(df, "id", "text", lambda: HashingEncoder(384)).collect()
    assert {r["id"] for r in rows} == {1}
    chunks = [r["chunk_text"] for r in text_chunks(df, "id", "text").orderBy("chunk_order").collect()]
    expect = plain_scores(chunks, HashingEncoder(384))
    for r in rows:
        assert r["raw_score"] == pytest.approx(expect[r["aspect"]][0], abs=1e-9)
        assert r["confidence"] == pytest.approx(expect[r["aspect"]][1], abs=1e-9)


def test_aspects_without_lexicon_are_constant(spark):
    df = spark.createDataFrame([(1, TEXT)], "id bigint, text string")
    rows = {r["aspect"]: r for r in scoring.score_texts(df, "id", "text", lambda: HashingEncoder(384)).collect()}
    for aspect in ("interior", "exterior"):
        assert rows[aspect]["raw_score"] == pytest.approx(0.35)
        assert rows[aspect]["confidence"] == pytest.approx(0.30)
        assert rows[aspect]["keywords"] == [] and rows[aspect]["supporting_chunks"] == []
    assert "autopilot" in rows["equipment"]["keywords"]
    # one phrase sits in both lists of an aspect and counts twice, once tagged
    assert rows["motor"]["keywords"].count("timer") == 1 and rows["motor"]["keywords"].count("(-) timer") == 1


def test_neutral_without_hits(spark):
    df = spark.createDataFrame([(1, "zzz yyy xxx www vvv uuu ttt sss rrr qqq")], "id bigint, chunk_text string")
    row = scoring.keyword_scores(df, "id").where("aspect = 'sails'").first()
    assert (row["keyword_score"], row["hits"]) == (0.5, 0)


def test_supporting_chunks_are_chunk_ids(spark):
    df = spark.createDataFrame([(1, TEXT)], "id bigint, text string")
    ids = {r["chunk_id"] for r in text_chunks(df, "id", "text").collect()}
    for r in scoring.score_texts(df, "id", "text", lambda: HashingEncoder(384)).collect():
        assert set(r["supporting_chunks"]) <= ids


def test_known_aspects():
    assert scoring.known_aspects(["motor", "nonsense"]) == ["motor"]
    assert scoring.known_aspects(None) == scoring.ASPECTS


class Flaky:
    """Fails on batches that hold a bad text, and on the bad text itself."""

    def __call__(self, texts):
        if "bad" in texts:
            raise RuntimeError("no")
        return np.asarray([[len(t), 1.0] for t in texts])


def test_batch_falls_back_to_single_texts(spark):
    df = spark.createDataFrame([("a",), ("bad",), ("ccc",), (" ",), (None,)], "text string")
    rows = {r["text"]: (r["embedding"], r["error"]) for r in embed_texts(df, "text", Flaky, 32).collect()}
    assert rows["a"] == ([1.0, 1.0], None) and rows["ccc"] == ([3.0, 1.0], None)
    assert rows["bad"] == (None, "no") and rows[" "] == (None, "empty text") and rows[None] == (None, "empty text")


def test_each_text_is_embedded_once_and_joined_back(spark):
    df = spark.createDataFrame([(i, "shared" if i % 3 else f"own {i}") for i in range(300)], "id bigint, text string")
    make = lambda: HashingEncoder(16)
    store = embed_missing(df, "text", make, "m")
    assert store.count() == 101
    assert embed_missing(df, "text", make, "m", store).count() == 0
    joined = attach_embeddings(df, "text", "m", store)
    assert joined.count() == 300 and joined.where("embedding IS NULL").count() == 0


def test_dimension_gate(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [1.0, None])], "id bigint, embedding array<float>")
    assert [r["id"] for r in with_dimension(df, 2).collect()] == [1]
    assert sorted(r["id"] for r in wrong_dimension(df, 2).collect()) == [2, 3, 4]


def test_cosine_of_zero_vector(spark):
    from adlattice.functions.vectors import cosine

    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 1.0])], "a array<double>, b array<double>")
    first, zero, unequal = (r[0] for r in df.select(cosine("a", "b")).collect())
    assert first == pytest.approx(1 / math.sqrt(2)) and math.isnan(zero) and unequal == 0.0
    assert df.select(F.size("a")).count() == 3


class Picky(HashingEncoder):
    """Fails on every batch with a text that names a motor."""

    def __call__(self, texts):
        if any("motor" in t for t in texts):
            raise RuntimeError("no")
        return super().__call__(texts)


def test_failing_texts_leave_neutral_parts(spark):
    df = spark.createDataFrame([(1, TEXT), (2, "Fin motor motor motor uten kjente ord ellers her")], "id bigint, text string")
    rows = {(r["id"], r["aspect"]): r for r in scoring.score_texts(df, "id", "text", lambda: Picky(384)).collect()}
    assert len(rows) == 2 * len(scoring.ASPECTS)
    # No chunk of the second text could be read: keywords neutral or found, similarity neutral.
    assert rows[2, "sails"]["raw_score"] == pytest.approx(0.5) and rows[2, "sails"]["supporting_chunks"] == []


def test_scores_from_stored_chunks_equal_those_from_texts(spark):
    df = spark.createDataFrame([(1, TEXT), (2, TEXT.upper()), (3, "for kort")], "id bigint, text string")
    chunks = embed_texts(text_chunks(df, "id", "text"), "chunk_text", lambda: HashingEncoder(384))
    direct = scoring.score_texts(df, "id", "text", lambda: HashingEncoder(384)).orderBy("id", "aspect").collect()
    stored = scoring.score_chunks(chunks, "id", lambda: HashingEncoder(384)).orderBy("id", "aspect").collect()
    assert len(direct) == len(stored) == 2 * len(scoring.ASPECTS)
    for a, b in zip(direct, stored):
        assert (a["aspect"], a["supporting_chunks"], a["keywords"]) == (b["aspect"], b["supporting_chunks"], b["keywords"])
        assert a["raw_score"] == pytest.approx(b["raw_score"], abs=1e-9) and a["confidence"] == pytest.approx(b["confidence"], abs=1e-9)


def test_a_run_cuts_texts_once_and_leaves_out_failed_listings(spark):
    from adlattice.plans import nightly

    class Unreadable(HashingEncoder):
        def __call__(self, texts):
            if any("motor" in t for t in texts):
                raise ValueError("unreadable")
            return super().__call__(texts)

    sentence = "this boat has eight words in one sentence."
    texts = spark.createDataFrame([(1, f"{sentence} {sentence}"), (2, f"{sentence} the motor of this boat is an old one."), (3, "short"),
                                   (4, None)], "ad_id bigint, text string")
    new, known = nightly.embedded_chunks(texts, lambda: Unreadable(16), "m")
    assert sorted((r["ad_id"], r["chunk_order"]) for r in new.collect()) == [(1, 0), (1, 1)]
    assert "Generate" not in new._jdf.queryExecution().optimizedPlan().toString()
    cut = nightly.cut_texts(texts)
    assert sorted(r[0] for r in nightly.emptied_listings(texts, cut).collect()) == [3, 4]
    again, _ = nightly.embedded_chunks(texts, lambda: Unreadable(16), "m", known, cut)
    assert sorted(map(tuple, again.select("ad_id", "chunk_order").collect())) == [(1, 0), (1, 1)]


def test_cosines_hold_a_bounded_number_of_texts(spark, tmp_path):
    """The model gets at most ``batch_size`` chunks, and results leave the task in slices; rows without chunks stay in place."""
    class Counting(HashingEncoder):
        def __call__(self, texts):
            assert len(texts) <= 16
            return super().__call__(texts)

    counts = [i % 7 for i in range(600)]
    df = spark.createDataFrame([(i, [f"w{j} seil" for j in range(n)]) for i, n in enumerate(counts)], "id bigint, c array<string>")
    cosines = scoring.chunk_cosines(lambda: Counting(64), {"a": ["seil"], "b": ["w1"]}, 16)
    rows = df.coalesce(1).select("id", cosines("c").alias("v")).collect()
    assert [[len(x) for x in r["v"]] for r in rows] == [[counts[r["id"]]] * 2 for r in rows]
    assert scoring.ROWS_TOGETHER < len(rows)


def test_phrases_are_found_in_one_pass(spark):
    phrases = ["god", "god stand", "a.b", "fin(", "å"]
    texts = ["i god stand", "godt", "axb", "a.b fin(", "på", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    have = [r[0] for r in df.select(scoring.phrases_in(phrases)("text")).collect()]
    assert have == [[p for p in phrases if p in (t or "")] for t in texts]


def test_distinct_texts_are_found_without_sorting(spark):
    df = spark.createDataFrame([("a b",), ("a b",), (" ",), (None,), ("c",)], "t string")
    missing = missing_embeddings(df, "t", "m", None)
    assert {r["text"] for r in missing.collect()} == {"a b", "c"}
    assert "SortAggregate" not in missing._jdf.queryExecution().executedPlan().toString()
