"""Scores from stored vectors move cosines and phrases, not vectors and texts."""

import numpy as np

from adlattice.operators import scoring
from adlattice.operators.embedding import HashingEncoder, attach_embeddings, embed_missing, embed_texts
from adlattice.plans import text_queries

FOLDER = "/root/testdata/sf0.001"


def encoder():
    return HashingEncoder(384)


def test_no_vector_and_no_text_goes_through_a_shuffle(spark):
    plan = text_queries.aspect_scores_stored(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
    lines = [line.lstrip(" :+-") for line in plan.splitlines()]
    below_join = lines[next(i for i, line in enumerate(lines) if line.startswith("Join")) + 1 :]
    projects = [line for line in below_join if line.startswith("Project")]
    assert projects[0].count("embedding") == 0 and "chunk_text" not in projects[0].split("md5")[0]
    assert any("sims" in line or "pythonUDF" in line for line in projects)


def test_cosines_and_phrases_of_a_store_give_the_scores_of_vectors_and_texts(spark):
    texts = ["nye seil i god stand og ny motor", "rust og slitt, trenger service", "", "nye seil i god stand og ny motor"]
    chunks = spark.createDataFrame(
        [(i % 2, "description", i, t) for i, t in enumerate(texts)] + [(0, "other", 9, "gps")],
        "id bigint, chunk_source string, chunk_order int, chunk_text string")
    store = embed_missing(chunks.where("chunk_text <> ''"), "chunk_text", encoder, "m")
    packed = embed_missing(chunks.where("chunk_text <> ''"), "chunk_text", encoder, "m", packed=True)
    vectors = attach_embeddings(chunks.where("chunk_text <> ''"), "chunk_text", "m", store)
    marked = scoring.chunk_phrases(chunks, scoring.LEXICON)
    cosines = attach_embeddings(marked, "chunk_text", "m", scoring.reference_cosines(packed, encoder), ("sims",))
    full = scoring.score_chunks(vectors, "id", encoder).orderBy("id", "aspect").collect()
    slim = scoring.score_chunks(cosines.where("chunk_text <> ''"), "id", encoder).orderBy("id", "aspect").collect()
    assert len(full) == 2 * len(scoring.ASPECTS) and full == slim
    # A chunk that the store has no vector for counts as a chunk without a cosine.
    some = scoring.score_chunks(cosines, "id", encoder).where("id = 0 AND aspect = 'exterior'").collect()
    assert some == [r for r in full if r["id"] == 0 and r["aspect"] == "exterior"]


class Half(HashingEncoder):
    """Cannot read one text."""

    def __call__(self, texts):
        if "bad" in texts:
            raise ValueError("unreadable")
        return super().__call__(texts)


def test_packed_vectors_hold_the_same_numbers(spark):
    rows = spark.createDataFrame([("a b",), ("c d e",), ("bad",), ("",)], "text string")
    plain = {r["text"]: r for r in embed_texts(rows, "text", lambda: Half(384)).collect()}
    packed = {r["text"]: r for r in embed_texts(rows, "text", lambda: Half(384), packed=True).collect()}
    for text, row in packed.items():
        assert row["error"] == plain[text]["error"]
        have = row["embedding"] and np.frombuffer(row["embedding"], "<f4").tolist()
        assert have == plain[text]["embedding"]
    assert packed["bad"]["embedding"] is None and packed["a b"]["embedding"]
