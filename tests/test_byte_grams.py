"""Grams are runs of bytes, made for many texts at once; candidates and texts are not shuffled to look for phrases."""

import pyarrow as pa
from pyspark.sql import functions as F

from adlattice.operators import phrase_index
from adlattice.session import shared_dir


def plain(text, sizes):
    data = (text or "").encode()
    return [int.from_bytes(data[i : i + n], "little", signed=n == 8) for n in sizes for i in range(len(data) - n + 1)]


def test_grams_of_many_texts_at_once(spark, monkeypatch):
    texts = ["", "ab", None, "båten 😀 er fin", "abcdefgh", "x" * 3000, "abc\n\x00d", "å"]
    for sizes in ([8], [3], [1, 2, 3, 8], [2, 8]):
        whole = pa.array(texts, pa.string())
        assert phrase_index.byte_grams(whole, sizes).to_pylist() == [plain(t, sizes) for t in texts]
        assert phrase_index.byte_grams(whole.slice(3, 4), sizes).to_pylist() == [plain(t, sizes) for t in texts[3:7]]
        assert phrase_index.byte_grams(whole.slice(2, 0), sizes).to_pylist() == []
    rows = spark.createDataFrame([(i, t * 200 if t else t) for i, t in enumerate(texts * 40)], "i int, t string").coalesce(1)
    have = rows.select("i", phrase_index.grams(F.col("t"), [3, 8]).alias("g")).orderBy("i").collect()
    assert [list(r["g"] or []) for r in have] == [plain(t * 200 if t else t, [3, 8]) for t in texts * 40]


def test_only_hits_leave_the_tasks_of_their_texts(spark):
    shared_dir(spark)
    texts = spark.range(500).select(F.col("id").alias("k"), F.lit(0).alias("n"), F.concat_ws(" ", F.lit("de la de la mar"), F.col("id")).alias("text"))
    phrases = spark.createDataFrame([("la de",), ("la mar 7",), ("e l",)], "phrase string")
    hits = phrase_index.phrase_hits(texts.checkpoint(), ["k", "n"], "text", phrases)
    # A phrase that occurs twice in a text is one hit.
    assert sorted((r["phrase"], r["count"]) for r in hits.groupBy("phrase").count().collect()) == [("e l", 500), ("la de", 500), ("la mar 7", 11)]
    plan = hits._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
