import random

from pyspark.sql import functions as F

from adlattice.operators import scoring
from adlattice.operators.phrase_index import keyword_scores_of_table, phrase_hits
from adlattice.plans.text_queries import WORD_LEXICON
from adlattice.session import shared_dir


def rows_of(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_hits_are_all_contained_phrases(spark):
    source = random.Random(8)
    made = lambda n: "".join(source.choice("abcå \n😀") for _ in range(n))
    texts = [(i, 0, made(source.randint(0, 60))) for i in range(150)] + [(900, 0, None), (901, 0, ""), (902, 0, "Å.*A😀")]
    phrases = [made(source.randint(0, 6)) for _ in range(200)] + [None, "", ".*", "a", "😀", "å.*a😀", "ABC"]
    t = spark.createDataFrame(texts, "k bigint, n int, text string")
    p = spark.createDataFrame([(x,) for x in phrases], "phrase string")
    want = sorted((k, n, x) for k, n, text in texts for x in {(y or "").lower() for y in phrases}
                  if x and x in (text or "").lower())
    assert sorted(map(tuple, phrase_hits(t, ["k", "n"], "text", p).collect())) == want
    assert phrase_hits(t, ["k", "n"], "text", p.limit(0)).count() == 0
    assert phrase_hits(t.limit(0), ["k", "n"], "text", p).count() == 0


def test_scores_equal_those_of_the_literal_lexicon(spark):
    chunks = spark.createDataFrame(
        [(i % 40, i // 40, f"the nation {'heit' * (i % 3)} la ando ment under {'Sch' if i % 5 else 'ung'} {i}") for i in range(200)]
        + [(77, 0, ""), (78, 0, "zzz")], "k bigint, chunk_order int, chunk_text string")
    table = spark.createDataFrame([(a, f, float(w)) for a, _, f, w in scoring.lexicon_rows(WORD_LEXICON)],
                                  "aspect string, phrase string, weight double")
    want = scoring.keyword_scores(chunks, "k", lexicon=WORD_LEXICON)
    have = keyword_scores_of_table(chunks, "k", table)
    assert rows_of(have.select(*want.columns)) == rows_of(want)
    assert rows_of(keyword_scores_of_table(chunks, "k", table.limit(0)).select("keyword_score").distinct()) == [(0.0,)]


def test_grams_of_texts_are_not_shuffled(spark):
    """Each of 2,000 texts has some hundred grams; what is shuffled are the texts and their few rarest grams."""
    shared_dir(spark)
    texts = spark.range(2000).select(F.col("id").alias("k"), F.lit(0).alias("n"), F.concat_ws(" ", *[
        F.md5((F.col("id") + i).cast("string")) for i in range(8)], F.when(F.col("id") % 100 == 0, F.lit("ny motor"))).alias("text"))
    phrases = spark.createDataFrame([("ny motor",), ("gammel motor",)], "phrase string")
    hits = phrase_hits(texts.checkpoint(), ["k", "n"], "text", phrases)
    assert hits.count() == 20
    plan = hits._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "BroadcastHashJoin [gram" in plan and "SortMergeJoin [gram" not in plan
