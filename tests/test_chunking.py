import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlattice.operators import chunking
from adlattice.operators.chunking import ChunkRule


def by_walking(words, target=20, overlap=7, minimum=8, slack=5):
    """Chunks found by walking a text word by word, as (from, to) spans."""
    ends = sorted({i + 1 for i, w in enumerate(words) if w[-1] in ".!?"} | {len(words)})
    spans, at = [], 0
    while True:
        reach = min(at + target, len(words))
        stop = next((e for e in ends if at < e <= reach + slack), reach)
        if stop - at >= minimum:
            spans.append((at, stop))
        step = max(stop - overlap, at + 1)
        if step >= len(words):
            return spans
        at = step


def by_formula(words, rule):
    ends = sorted({i + 1 for i, w in enumerate(words) if w[-1] in ".!?"} | {len(words)})
    spans, a = [], 0
    for z in ends:
        n = max(0, -(-(z - a - rule.target - rule.slack) // rule.step))
        cut = [(a + k * rule.step, a + k * rule.step + rule.target) for k in range(n)] + [(a + n * rule.step, z)]
        spans += [s for s in cut if s[1] - s[0] >= rule.minimum]
        a = z
    return spans


@settings(max_examples=400, deadline=None)
@given(st.lists(st.booleans(), min_size=8, max_size=160), st.integers(0, 10**6))
def test_closed_form_equals_walk(stops, seed):
    keep = random.Random(seed).random()
    words = ["x." if s and random.Random(seed + i).random() < keep else "x" for i, s in enumerate(stops)]
    assert by_formula(words, ChunkRule()) == by_walking(words)


def test_spark_chunks_equal_walk(spark):
    """Random texts of all lengths, among them sentences of exactly the interesting lengths."""
    source = random.Random(1)
    texts = []
    for i in range(400):
        text = []
        for _ in range(source.randint(1, 8)):
            length = source.choice([1, 7, 8, 19, 20, 25, 26, 38, 39, 64, source.randint(1, 120)])
            text += [f"w{source.randint(0, 99)}" for _ in range(length - 1)] + ["end" + source.choice([".", "!", "?", "..", ""])]
        texts.append((i, "  ".join(text)))
    df = spark.createDataFrame(texts, "id bigint, text string")
    have = {}
    for r in chunking.text_chunks(df, "id", "text").orderBy("id", "chunk_order").collect():
        have.setdefault(r["id"], []).append(r["chunk_text"])
    for i, text in texts:
        words = text.split()
        if len(words) >= 8:
            assert have.get(i, []) == [" ".join(words[a:z]) for a, z in by_walking(words)], text


@pytest.mark.parametrize("rule", [ChunkRule(12, 3, 5, 2), ChunkRule(20, 12, 13, 5), ChunkRule(10, 0, 1, 0)])
def test_other_sizes(spark, rule):
    source = random.Random(2)
    texts = [(i, " ".join(f"w{k}" + ("." if source.random() < 0.05 else "") for k in range(source.randint(13, 200)))) for i in range(60)]
    df = spark.createDataFrame(texts, "id bigint, text string")
    have = {}
    for r in chunking.text_chunks(df, "id", "text", rule).orderBy("id", "chunk_order").collect():
        have.setdefault(r["id"], []).append(r["chunk_text"])
    for i, text in texts:
        words = text.split()
        assert have.get(i, []) == [" ".join(words[a:z]) for a, z in by_formula(words, rule)]


def test_refuses_overlap_not_below_minimum():
    with pytest.raises(ValueError):
        ChunkRule(20, 8, 8)


def test_edges(spark):
    rows = [
        (1, "too short"),
        (2, "Seven words only here in this text!"),
        (3, "one two three. four five six. seven eight nine."),
        (4, "a b c d e f g    h § i. Tøff båt, 100% (ny) – kr 5!"),
        (5, None),
        (6, "     ,,,,     " * 3),
    ]
    df = spark.createDataFrame(rows, "id bigint, text string")
    out = chunking.text_chunks(df, "id", "text").collect()
    assert {r["id"] for r in out} == {2, 4, 6}
    two = next(r for r in out if r["id"] == 2)
    assert (two["chunk_text"], two["chunk_length"], two["overlap_words"]) == ("seven words only here in this text!", 7, 0)
    cleaned = df.where("id = 4").select(chunking.clean_text("text")).first()[0]
    assert cleaned == "a b c d e f g h  i. tøff båt, 100 (ny)  kr 5!"


def test_spans_match_texts(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" + ("." if i % 31 == 0 else "") for i in range(200)))], "id bigint, text string")
    spans = sorted((r["from_word"], r["to_word"]) for r in chunking.chunk_spans(df, "id", "text").collect())
    lengths = [r["chunk_length"] for r in chunking.text_chunks(df, "id", "text").orderBy("chunk_order").collect()]
    assert [z - a for a, z in spans] == lengths


def test_aspects_and_equipment(spark):
    df = spark.createDataFrame([("ny motor og gps",), ("fin salong",)], "chunk_text string")
    tagged = chunking.aspect_chunks(df, ["motor", "equipment", "interior"]).collect()
    assert {(r["chunk_text"], r["aspect"]) for r in tagged} == {
        ("ny motor og gps", "motor"), ("ny motor og gps", "equipment"), ("fin salong", "interior"),
    }
    two = spark.createDataFrame([("tekst", ["GPS", "VHF"]), ("tekst", [])], "d string, e array<string>")
    assert [r[0] for r in two.select(chunking.with_equipment("d", "e")).collect()] == ["tekst\nUtstyr: GPS, VHF", "tekst"]
    assert two.select(F.size(chunking.words_of(F.lit("  a  b ")))).first()[0] == 2


def test_long_sentence_is_cut_in_linear_time(spark):
    """Windows of a sentence were counted anew for each window: 200,000 words without a stop took minutes."""
    df = spark.range(1).select(F.lit(1).alias("id"), F.repeat(F.lit("word "), 200_000).alias("text"))
    began = time.monotonic()
    chunks = chunking.text_chunks(df, "id", "text").agg(F.count(F.lit(1)), F.sum("chunk_length")).first()
    windows = -(-(200_000 - 25) // 13)
    assert tuple(chunks) == (windows + 1, windows * 20 + 200_000 - windows * 13)
    assert time.monotonic() - began < 15


@pytest.mark.parametrize("rule", [ChunkRule(overlap=1, slack=0), ChunkRule(overlap=2, slack=1, keep_short=True), ChunkRule(10, 3, 10, 0)])
def test_tails_of_long_sentences_obey_the_rule(spark, rule):
    words = [f"w{i}" + "." * (i % 47 == 46) for i in range(300)]
    df = spark.createDataFrame([(1, " ".join(words))], "id bigint, text string")
    have = [r["chunk_text"] for r in chunking.text_chunks(df, "id", "text", rule).orderBy("chunk_order").collect()]
    spans = chunking.chunk_spans(df, "id", "text", rule).orderBy("from_word").collect()
    assert have == [" ".join(words[r["from_word"] : r["to_word"]]) for r in spans]


def test_blank_runs_become_one_blank(spark):
    texts = ["a b", "a  b", "a\tb", "a   b", "a\n  b  c", "\x1ca\x85\x85b", "a * b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(chunking.clean_text("text")).collect()] == ["a b", "a b", "a b", "a b", "a b c", "a b", "a  b"]


def test_aspect_chunks_agree_with_single_mentions(spark):
    """Keywords in one pass per aspect, also with upper case, characters of patterns and missing texts."""
    groups = {"a": ["SEIL".lower(), "x+y"], "b": ["køy", "a.b"], "none": []}
    rows = [(1, "Storseil og KØY"), (2, "x+y a.b"), (3, "xxy aab"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "id bigint, chunk_text string")
    have = {(r["id"], r["aspect"]) for r in chunking.aspect_chunks(df, ["a", "b", "none", "other"], groups).collect()}
    flags = df.select("id", *[chunking.mentions_aspect("chunk_text", x, groups).alias(x) for x in ("a", "b", "none", "other")])
    assert have == {(r["id"], x) for r in flags.collect() for x in ("a", "b", "none", "other") if r[x]}
