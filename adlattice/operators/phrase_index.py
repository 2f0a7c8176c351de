"""Phrases of a lexicon of any size found in texts through an inverted index of byte grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.operators.scoring import ASPECTS, WEIGHT_UNIT, keyword_score
from adlattice.session import written

# Bytes of the grams under which phrases are filed, and of those for phrases shorter than it.
GRAM = 8
SHORT_GRAM = 3


# Bytes of text whose grams a task makes at once.
TEXT_BYTES = 1 << 20


def gram_size(phrase: Column) -> Column:
    """Bytes of the grams of a phrase: its own length if it is shorter than a short gram."""
    size = F.octet_length(phrase)
    return F.when(size >= GRAM, F.lit(GRAM)).otherwise(F.least(size, F.lit(SHORT_GRAM)))


def byte_grams(texts: pa.Array, sizes: list[int]) -> pa.Array:
    """The runs of each size of the bytes of each text, as numbers; a run that occurs twice is given twice."""
    if len(texts) == 0:
        return pa.array([], pa.list_(pa.int64()))
    texts = texts.cast(pa.string())
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    length = np.diff(ends)
    counts = [np.maximum(length - n + 1, 0) for n in sizes]
    offsets = np.concatenate([[0], np.cumsum(np.sum(counts, axis=0))])
    out, at = np.empty(offsets[-1], np.int64), offsets[:-1].copy()
    for n, count in zip(sizes, counts, strict=True):
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = np.repeat(ends[:-1], count) + nth
        if n == 8 and len(start):
            runs = np.ndarray((len(data) - 7,), "<i8", data, strides=(1,))[start]
        else:
            runs = sum((data[start + j].astype(np.int64) << (8 * j) for j in range(n)), np.zeros(len(start), np.int64))
        out[np.repeat(at, count) + nth] = runs
        at += count
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out))


def grams(text: Column, sizes: list[int]) -> Column:
    """The runs of each size of the UTF-8 bytes of ``text``, at most eight, as numbers (not distinct); nothing for NULL.

    A text that contains a phrase contains its bytes, so no characters are looked at.
    """

    @F.arrow_udf("array<bigint>")
    def runs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)
            # Slices of whole texts, of about so many bytes.
            edges = np.flatnonzero(np.diff(np.cumsum(size) // TEXT_BYTES, prepend=0))
            for a, b in pairwise([0, *edges[edges > 0].tolist(), len(batch)]):
                yield byte_grams(batch.slice(a, b - a), sizes)

    return runs(text)


def phrase_hits(texts: DataFrame, ids: list[str], text: str, phrases: DataFrame) -> DataFrame:
    """(ids, phrase) of every text and every phrase of ``phrases`` it contains, without case; ``ids`` are unique.

    Each phrase is filed under the one of its grams that the fewest texts hold, so a text meets only phrases whose
    rarest gram it has, and only those are looked for. A phrase with a gram that no text has is found nowhere and leaves the join.
    A gram of eight bytes is mostly rarer than any word, so few texts are looked at in vain; shorter phrases have grams of
    three, or of all they have. Empty and null phrases are found nowhere. A text stays with its grams until its phrases are found, so where
    the index is sent to the texts, only hits leave their task.
    """
    lowered = texts.select(*ids, F.lower(text).alias("__text"))
    asked = phrases.select(F.lower("phrase").alias("phrase")).where("phrase <> ''").distinct()
    # One row per length of grams in use: at most four.
    sizes = sorted(r[0] for r in asked.select(gram_size(F.col("phrase"))).distinct().collect())
    if not sizes:
        return texts.select(*ids, F.lit(None).cast("string").alias("phrase")).limit(0)
    size_of = gram_size(F.col("phrase"))
    own_grams = reduce(lambda chain, n: F.when(size_of == n, grams(F.col("phrase"), [n])).otherwise(chain), sizes[1:],
                       grams(F.col("phrase"), sizes[:1]))
    # Written tables, so Spark knows their sizes: the distinct grams of the phrases, eight bytes each, are sent to the texts unless
    # there are too many, and what no phrase has is left out before anything is shuffled.
    filed = written(asked.select("phrase", F.explode(own_grams).alias("gram")), "filed-phrases")
    known = written(filed.select("gram").distinct(), "known-grams")
    runs = lowered.select(*ids, "__text", grams(F.col("__text"), sizes).alias("__grams"))
    # Counted where the texts are, so a task sends each of its grams once. How often a gram occurs is as good as in how many texts.
    held = runs.select(F.explode("__grams").alias("gram")).join(known, "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("texts"))
    counted = filed.join(held, "gram", "left").groupBy("phrase").agg(
        F.min_by("gram", F.struct(F.coalesce("texts", F.lit(0)), "gram")).alias("gram"),
        F.min(F.coalesce("texts", F.lit(0))).alias("texts"))
    rarest = written(counted.where("texts > 0").drop("texts"), "rarest-grams")
    looked_for = written(rarest.select("gram").distinct(), "looked-for-grams")
    met = runs.select(*ids, "__text", F.explode(F.array_distinct("__grams")).alias("gram"))
    candidates = met.join(looked_for, "gram", "left_semi").join(rarest, "gram")
    return candidates.where(F.contains("__text", "phrase")).select(*ids, "phrase")


def keyword_scores_of_table(chunks: DataFrame, key: str, phrases: DataFrame, text: str = "chunk_text",
                            order: str = "chunk_order", aspects: list[str] = ASPECTS) -> DataFrame:
    """As ``scoring.keyword_scores``, with the lexicon as a table (aspect, phrase, weight) of any size.

    ``(key, order)`` is unique. Weights are folded per chunk and aspect, then per key and aspect, both before the shuffle too. A phrase
    listed twice counts twice. Chunks are read three times, so they should be stored.
    """
    lexicon = phrases.select("aspect", F.lower("phrase").alias("phrase"),
                             F.round(F.col("weight") * WEIGHT_UNIT).cast("bigint").alias("weight"))
    found = phrase_hits(chunks, [key, order], text, phrases).join(lexicon, "phrase")
    per_chunk = found.groupBy(key, order, "aspect").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("hits"))
    sums = per_chunk.groupBy(key, "aspect").agg(
        (F.sum("total") / float(WEIGHT_UNIT)).alias("total"), F.sum("hits").alias("hits"),
        F.count(F.lit(1)).alias("keyword_chunks"))
    known = lexicon.select("aspect").distinct().withColumn("__known", F.lit(True))
    every = chunks.groupBy(key).agg(F.count(F.lit(1)).alias("chunks")).withColumn(
        "aspect", F.explode(F.array(*map(F.lit, aspects))))
    hits, in_chunks = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("hits", "keyword_chunks"))
    score = F.when(F.col("__known"), keyword_score(F.col("total"), hits, F.col("chunks"))).otherwise(F.lit(0.0))
    return every.join(sums, [key, "aspect"], "left").join(known, "aspect", "left").select(
        key, "aspect", score.alias("keyword_score"), hits.alias("hits"), in_chunks.alias("keyword_chunks"))
