"""Text cleaning and overlapping chunks, all inside one row: no shuffle, and Python only to look for keywords of aspects."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.functions.scalars import BLANK, as_column, strip

# Words that open a new section, per aspect (fixed values).
SECTION_KEYWORDS = {
    "sails": ["seil", "seil:", "genoa", "fok", "storseil", "spinnaker"],
    "motor": ["motor", "motor:", "maskin", "propell", "diesel", "bensin", "hk", "hp"],
    "condition": ["tilstand", "stand", "vedlikehold", "oppusset", "renovert", "slitasje"],
    "equipment": ["utstyr", "instrumenter", "elektronikk", "gps", "radar", "vhf"],
    "interior": ["interiør", "lugarer", "køy", "toalett", "kjøkken", "salong"],
    "exterior": ["dekk", "skrog", "rigg", "mast", "bom"],
}


@dataclass(frozen=True)
class ChunkRule:
    """Chunk sizes in words. ``slack`` is how far a chunk may run on to meet a sentence end."""

    target: int = 20
    overlap: int = 7
    minimum: int = 8
    slack: int = 5
    min_chars: int = 20
    keep_short: bool = False

    def __post_init__(self):
        if not self.overlap < self.minimum <= self.target:
            raise ValueError("need overlap < minimum <= target")

    @property
    def step(self) -> int:
        return self.target - self.overlap


def clean_text(text: Column | str) -> Column:
    """One blank between words, only letters, digits, '_' and ``.,!?()-`` kept, lower case.

    White space is collapsed before characters are dropped, so a dropped lone symbol leaves two
    blanks behind.
    """
    # A lone plain blank stays as it is, so only the other runs are matches.
    single = F.regexp_replace(strip(text), f" {BLANK}+|[{BLANK}&&[^ ]]{BLANK}*", " ")
    return F.lower(F.regexp_replace(single, r"[^\p{L}\p{N}_ .,!?()-]", ""))


def words_of(cleaned: Column | str) -> Column:
    """Words of a cleaned text; empty array for a blank text."""
    return F.filter(F.split(as_column(cleaned), " +"), lambda w: w != "")


def word_count(text: Column | str) -> Column:
    return F.size(F.filter(F.split(as_column(text), f"{BLANK}+"), lambda w: w != ""))


def single_spaced(cleaned: Column | str) -> Column:
    return F.trim(F.regexp_replace(as_column(cleaned), "  +", " "))


def blanks_plus_one(text: Column) -> Column:
    """Word count of a single-spaced, non-empty text, without splitting it."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "))) + 1


def length_in_words(chunk: str) -> Column:
    """Word count of a chunk; only the chunk of a very short text can hold loose blanks."""
    loose = F.col(chunk).contains("  ") | F.col(chunk).startswith(" ") | F.col(chunk).endswith(" ")
    return F.when(loose, F.size(words_of(chunk))).otherwise(blanks_plus_one(F.col(chunk)))


def sentences_of(spaced: Column | str) -> Column:
    """Sentences of a single-spaced text: a sentence ends with a word ending in ``.!?``."""
    return F.split(as_column(spaced), "(?<=[.!?]) ")


def sentence_chunks(sentence: Column, words: Column, rule: ChunkRule, least: int) -> Column:
    """Chunk texts of at least ``least`` words of one sentence of ``words`` words.

    A sentence of L words gives full windows of ``target`` words every ``step = target - overlap``
    words until at most ``target + slack`` words are left, then those. The sentence is cut into
    blocks of ``step`` words; a window is a run of blocks, so the work is linear in its length.
    """
    limit, step = rule.target + rule.slack, rule.step
    windows = F.ceil((words - limit) / step).cast("int")
    blocks = F.regexp_extract_all(sentence, F.lit(rf"[^ ]+(?: [^ ]+){{0,{step - 1}}}"), F.lit(0))

    def run_of_blocks(parts: Column, first: Column, length: int) -> Column:
        return F.concat_ws(" ", *[F.get(parts, first + j) for j in range(-(-length // step))])

    def cut(bound: Column) -> Column:
        parts, last = bound["parts"], bound["last"]
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.when(k < last, F.substring_index(run_of_blocks(parts, k, rule.target), " ", rule.target))
            .otherwise(run_of_blocks(parts, k, limit)),
        )

    # The one-element outer array binds blocks and windows once for all windows of the sentence.
    bound = F.struct(blocks.alias("parts"), windows.alias("last"))
    long_sentence = F.flatten(F.transform(F.array(bound), cut))
    if limit - step + 1 < least:  # else what is left after the full windows is long enough
        long_sentence = F.filter(long_sentence, lambda c: blanks_plus_one(c) >= least)
    return F.when(words <= limit, F.array(sentence)).otherwise(long_sentence)


def chunk_texts(spaced: Column | str, rule: ChunkRule = ChunkRule()) -> Column:
    """All chunk texts of a single-spaced text in reading order.

    Tails below ``minimum`` words are dropped, unless ``keep_short``. Words are counted once per sentence.
    """
    least = 1 if rule.keep_short else rule.minimum
    counted = F.transform(sentences_of(spaced), lambda s: F.struct(s.alias("text"), blanks_plus_one(s).alias("words")))
    kept = F.filter(counted, lambda s: s["words"] >= least)
    return F.flatten(F.transform(kept, lambda s: sentence_chunks(s["text"], s["words"], rule, least)))


def text_chunks(df: DataFrame, key: str, text: str, rule: ChunkRule = ChunkRule(), source: str = "description",
                keep: list[str] = ()) -> DataFrame:
    """One row per chunk of ``text``; rows with fewer than ``min_chars`` characters give none.

    A text of fewer than ``minimum`` words is one chunk. The chunks of a text are built as an array
    in its own row and then exploded, which also numbers them, so a table of any size is chunked in
    one narrow stage.
    """
    spaced = single_spaced("__clean")
    chunks = F.when(
        (F.col("__spaced") == "") | (blanks_plus_one(F.col("__spaced")) < rule.minimum), F.array("__clean")
    ).otherwise(chunk_texts("__spaced", rule))
    exploded = (
        df.where(F.length(strip(text)) >= rule.min_chars)
        .select(key, *keep, clean_text(text).alias("__clean"))
        .select(key, *keep, "__clean", spaced.alias("__spaced"))
        .select(key, *keep, F.posexplode(chunks).alias("chunk_order", "chunk_text"))
    )
    return exploded.select(
        F.xxhash64(key, F.lit(source), "chunk_order").alias("chunk_id"),
        key,
        *keep,
        F.lit(source).alias("chunk_source"),
        "chunk_order",
        "chunk_text",
        length_in_words("chunk_text").alias("chunk_length"),
    ).withColumn(
        "overlap_words",
        F.when(F.col("chunk_order") > 0, F.least(F.lit(rule.overlap), F.col("chunk_length"))).otherwise(F.lit(0)),
    )


def sentence_spans(df: DataFrame, key: str, text: str) -> DataFrame:
    """Word positions ``[from_word, to_word)`` of every sentence of a text."""
    stop = F.transform("__words", lambda w, i: F.when(F.right(w, F.lit(1)).isin(".", "!", "?"), i + 1))
    ends = F.concat(F.array_compact(stop), F.array(F.size("__words")))
    starts = F.concat(F.array(F.lit(0)), F.col("__ends"))
    return (
        df.select(key, words_of(clean_text(text)).alias("__words"))
        .select(key, ends.alias("__ends"))
        .select(key, F.posexplode(F.arrays_zip(starts.alias("a"), F.col("__ends").alias("z"))).alias("sentence", "__span"))
        .where(F.col("__span.z") > F.col("__span.a"))
        .select(key, "sentence", F.col("__span.a").alias("from_word"), F.col("__span.z").alias("to_word"))
    )


def chunk_spans(df: DataFrame, key: str, text: str, rule: ChunkRule = ChunkRule()) -> DataFrame:
    """Word positions of every chunk, in the order and number that :func:`text_chunks` emits them."""
    limit, step = rule.target + rule.slack, rule.step
    least = 1 if rule.keep_short else rule.minimum
    windows = F.greatest(F.ceil((F.col("to_word") - F.col("from_word") - limit) / step).cast("int"), F.lit(0))
    start = F.col("from_word") + F.col("__k") * step
    cut = (
        sentence_spans(df, key, text)
        .select("*", windows.alias("__n"))
        .select("*", F.explode(F.sequence(F.lit(0), "__n")).alias("__k"))
    )
    return cut.select(
        key,
        start.alias("from_word"),
        F.when(F.col("__k") < F.col("__n"), start + rule.target).otherwise(F.col("to_word")).alias("to_word"),
    ).where(F.col("to_word") - F.col("from_word") >= least)


def any_keyword(groups: dict[str, list[str]]) -> str:
    """Pattern that finds any keyword of any group."""
    return "|".join(re.escape(word) for words in groups.values() for word in words)


def section_breaks(df: DataFrame, key: str, text: str, groups: dict[str, list[str]] = SECTION_KEYWORDS) -> DataFrame:
    """Positions of words (except the first) that contain any section keyword."""
    pattern = any_keyword(groups)
    hits = F.array_compact(
        F.transform(
            "__words",
            lambda w, i: F.when((i > 0) & w.rlike(pattern), F.struct(i.alias("word_index"), w.alias("word"))),
        )
    )
    # Most texts hold no keyword at all; they are dismissed before their words are looked at.
    words = F.when(F.col("__clean").rlike(pattern), words_of("__clean"))
    return (
        df.select(key, clean_text(text).alias("__clean"))
        .select(key, words.alias("__words"))
        .select(key, F.inline(F.when(F.col("__words").isNotNull(), hits)))
    )


def mentions_aspect(text: Column | str, aspect: str, groups: dict[str, list[str]] = SECTION_KEYWORDS) -> Column:
    """Does a chunk mention the aspect? An aspect without keywords matches every chunk."""
    words = groups.get(aspect)
    if not words:
        return F.lit(True)
    hit, lowered = F.lit(False), F.lower(as_column(text))
    for word in words:
        hit = hit | lowered.contains(word)
    return hit


def aspects_mentioned(patterns: list[str | None]):
    """Arrow UDF: does a text in lower case match each pattern? All words of an aspect are looked for in one pass over the text."""

    @F.arrow_udf("array<boolean>")
    def matched(texts: pa.Array) -> pa.Array:
        hits = [
            np.ones(len(texts), bool) if p is None
            else pc.fill_null(pc.match_substring_regex(texts, p), False).to_numpy(zero_copy_only=False)
            for p in patterns
        ]
        flat = np.stack(hits, axis=1).ravel() if hits else np.zeros(0, bool)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * len(patterns), pa.int32()), pa.array(flat))

    return matched


def aspect_chunks(chunks: DataFrame, aspects: list[str], groups: dict[str, list[str]] = SECTION_KEYWORDS) -> DataFrame:
    """Chunks with every aspect they are relevant for (see :func:`mentions_aspect`), one row per pair."""
    patterns = [any_keyword({a: groups[a]}) if groups.get(a) else None for a in aspects]
    hits = chunks.withColumn("__hits", aspects_mentioned(patterns)(F.lower("chunk_text")))
    tags = F.transform("__hits", lambda hit, i: F.when(hit, F.get(F.array(*map(F.lit, aspects)), i)))
    return hits.withColumn("aspect", F.explode(tags)).where(F.col("aspect").isNotNull()).drop("__hits")


def with_equipment(description: Column | str, equipment: Column | str) -> Column:
    """Description followed by the labelled, comma-joined equipment list, if there is one."""
    description, equipment = as_column(description), as_column(equipment)
    return F.when(
        F.coalesce(F.size(equipment), F.lit(0)) > 0,
        F.concat(description, F.lit("\nUtstyr: "), F.array_join(equipment, ", ")),
    ).otherwise(description)
