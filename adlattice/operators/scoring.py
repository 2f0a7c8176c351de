"""Aspect scores of listing texts from weighted phrases and vector similarity."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.functions.scalars import as_column, strip
from adlattice.functions.vectors import cosine_to, unit_rows
from adlattice.operators.chunking import ChunkRule, blanks_plus_one, chunk_texts, clean_text, single_spaced
from adlattice.operators.embedding import Encoder, encode_safely

ASPECTS = ["sails", "motor", "condition", "equipment", "interior", "exterior"]

# Phrase weights per aspect and polarity (fixed values).
LEXICON = {
    "sails": {
        "positive": {
            "nye seil": 0.9, "nytt seil": 0.9, "nye": 0.7, "god stand": 0.8, "utmerket": 0.9, "perfekt": 0.9,
            "service": 0.7, "vedlikehold": 0.6, "oppgradert": 0.8, "genoa": 0.6, "fok": 0.6, "storseil": 0.6,
            "spinnaker": 0.7,
        },
        "negative": {
            "slitt": -0.8, "ødelagt": -0.9, "hull": -0.7, "gammel": -0.5, "dårlig": -0.8, "reparert": -0.3,
            "lappet": -0.4, "defekt": -0.9,
        },
    },
    "motor": {
        "positive": {
            "ny motor": 0.9, "service": 0.7, "vedlikehold": 0.8, "fungerer perfekt": 0.9, "jevnlig service": 0.8,
            "utmerket": 0.9, "god": 0.7, "pålitelig": 0.8, "overhalt": 0.8, "oppgradert": 0.8, "diesel": 0.5,
            "lavt": 0.6, "timer": 0.4,
        },
        "negative": {
            "problemer": -0.8, "defekt": -0.9, "dårlig": -0.8, "lekkasje": -0.7, "støy": -0.5, "rust": -0.6,
            "trenger service": -0.4, "høy": -0.3, "timer": 0.4,
        },
    },
    "condition": {
        "positive": {
            "god stand": 0.8, "utmerket": 0.9, "vedlikeholdt": 0.8, "renovert": 0.9, "oppusset": 0.8, "nylig": 0.7,
            "perfekt": 0.9, "fin": 0.6, "bra": 0.6,
        },
        "negative": {
            "slitasje": -0.6, "skader": -0.8, "rust": -0.7, "hull": -0.8, "dårlig": -0.8, "trenger": -0.4,
            "reparasjon": -0.5, "vedlikehold": -0.3,
        },
    },
    "equipment": {
        "positive": {
            "gps": 0.7, "radar": 0.8, "vhf": 0.6, "autopilot": 0.8, "elektronikk": 0.6, "instrumenter": 0.6,
            "sonar": 0.7, "chartplotter": 0.8, "ais": 0.7, "komplett": 0.8,
        },
        "negative": {"mangler": -0.6, "defekt": -0.8, "gammelt": -0.4, "ikke fungerende": -0.9},
    },
}

# Texts whose mean vector stands for an aspect (fixed values).
REFERENCE_TEXTS = {
    "sails": [
        "tre nye seil i utmerket stand",
        "genoa og storseil nylig service",
        "seilene er i god tilstand",
    ],
    "motor": [
        "motoren har jevnlig vedlikehold og fungerer perfekt",
        "diesel motor med lav timer",
        "pålitelig motor i god drift",
    ],
    "condition": [
        "båten er i utmerket stand og godt vedlikeholdt",
        "renovert og oppgradert",
        "fin tilstand uten skader",
    ],
    "equipment": [
        "komplett med gps radar og vhf",
        "moderne elektronikk og instrumenter",
        "autopilot og chartplotter installert",
    ],
}

SUPPORT_THRESHOLD = 0.6

# Texts whose cosines leave a task together.
ROWS_TOGETHER = 256
NEUTRAL = 0.5

# Weights are summed as whole multiples of this, so a total does not depend on the order of the rows.
WEIGHT_UNIT = 10_000


def lexicon_rows(lexicon: dict = LEXICON) -> list[tuple[str, str, str, float]]:
    """The lexicon as (aspect, polarity, phrase, weight) rows."""
    return [
        (aspect, polarity, phrase, weight)
        for aspect, sides in lexicon.items()
        for polarity, phrases in sides.items()
        for phrase, weight in phrases.items()
    ]


def known_aspects(names: list[str] | None) -> list[str]:
    """Requested aspects that exist; all of them when nothing is requested."""
    return ASPECTS if not names else [n for n in names if n in ASPECTS]


def tagged_phrases(aspect: str, lexicon: dict) -> list[tuple[str, str, int]]:
    """(phrase, tag, weight in units) of one aspect; negative phrases are tagged '(-) '."""
    return [
        (phrase, f"(-) {phrase}" if polarity == "negative" else phrase, round(weight * WEIGHT_UNIT))
        for name, polarity, phrase, weight in lexicon_rows(lexicon)
        if name == aspect
    ]


def phrases_in(phrases: list[str]):
    """Arrow UDF: the phrases that a text contains. One pass dismisses texts without any."""
    # A text that holds a phrase holds the shortest phrases in it.
    shortest = [p for p in phrases if not any(q != p and q in p for q in phrases)]
    pattern = "|".join(re.escape(p) for p in shortest)

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        out = [[] for _ in range(len(texts))]
        any_ = pc.fill_null(pc.match_substring_regex(texts, pattern), False).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(any_).tolist():
            text = texts[i].as_py()
            out[i] = [p for p in phrases if p in text]
        return pa.array(out, pa.list_(pa.string()))

    return found


def reference_matrix(encode: Encoder, texts: dict[str, list[str]] = REFERENCE_TEXTS) -> tuple[list[str], np.ndarray]:
    """Mean vector of each aspect's reference texts; an aspect whose texts the model cannot read is left out."""
    means = {}
    for name, examples in texts.items():
        vectors = [v for v, error in encode_safely(encode, examples) if error is None]
        if len(vectors) == len(examples):
            means[name] = np.mean(np.asarray(vectors, dtype=np.float64), axis=0)
    return list(means), np.stack(list(means.values())) if means else np.zeros((0, 0))


# -- formulas ------------------------------------------------------------------------------------


def keyword_score(total: Column, hits: Column, chunks: Column) -> Column:
    """Summed weights per chunk, clipped to [-1, 1] and moved to [0, 1]; neutral without a hit."""
    mean = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), total / chunks))
    return F.when(hits > 0, (mean + 1.0) / 2.0).otherwise(F.lit(NEUTRAL))


def similarity_score(best: Column, mean: Column) -> Column:
    """Best and mean cosine of the chunks as one score in [0, 1]; neutral when undefined."""
    return F.coalesce((best * 0.7 + mean * 0.3 + 1.0) / 2.0, F.lit(NEUTRAL))


def blended_score(keyword: Column, similarity: Column, hits: Column) -> Column:
    """Keywords weigh 0.7 when any was found, else 0.3."""
    share = F.when(hits > 0, F.lit(0.7)).otherwise(F.lit(0.3))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), keyword * share + similarity * (1.0 - share)))


def score_confidence(keyword: Column, similarity: Column, hits: Column, keyword_chunks: Column) -> Column:
    """Agreement of the two scores plus capped bonuses for keywords and for chunks with keywords."""
    agreement = (1.0 - F.abs(keyword - similarity)) * 0.6
    bonus = F.least(hits * 0.1, F.lit(0.4)) + F.least(keyword_chunks * 0.05, F.lit(0.3))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), agreement + bonus))


# -- over a chunk table ----------------------------------------------------------------------------


def unpivot_aspects(wide: DataFrame, key: str, aspects: list[str], fields: list[str]) -> DataFrame:
    """Columns ``<field>_<aspect number>`` to one row per aspect."""
    rows = [
        F.struct(F.lit(a).alias("aspect"), *[F.col(f"{field}_{i}").alias(field) for field in fields])
        for i, a in enumerate(aspects)
    ]
    return wide.select(key, F.inline(F.array(*rows)))


def keyword_scores(chunks: DataFrame, key: str, text: str = "chunk_text", lexicon: dict = LEXICON,
                   aspects: list[str] = ASPECTS) -> DataFrame:
    """Keyword score per (listing, aspect) from a chunk table, 0.0 for an aspect without phrases.

    All aspects are summed in one hash aggregation whose buffers are plain numbers, so each task
    sends one row per listing to the shuffle.
    """
    phrases = {a: tagged_phrases(a, lexicon) for a in aspects}
    column = {p: f"__p{n}" for n, p in enumerate(sorted({p for rows in phrases.values() for p, _, _ in rows}))}
    lowered = F.lower(F.col(text))
    found = chunks.select(key, *[lowered.contains(p).cast("int").alias(c) for p, c in column.items()])
    sums = [F.count(F.lit(1)).alias("chunks")]
    for i, rows in enumerate(phrases.values()):
        weight = reduce(add, [F.col(column[p]) * w for p, _, w in rows], F.lit(0))
        count = reduce(add, [F.col(column[p]) for p, _, _ in rows], F.lit(0))
        sums += [
            (F.sum(weight) / float(WEIGHT_UNIT)).alias(f"total_{i}"),
            F.sum(count).alias(f"hits_{i}"),
            F.count_if(count > 0).alias(f"keyword_chunks_{i}"),
        ]
    wide = found.groupBy(key).agg(*sums)
    for i, aspect in enumerate(aspects):
        score = keyword_score(F.col(f"total_{i}"), F.col(f"hits_{i}"), F.col("chunks"))
        wide = wide.withColumn(f"keyword_score_{i}", score if aspect in lexicon else F.lit(0.0))
    return unpivot_aspects(wide, key, aspects, ["keyword_score", "hits", "keyword_chunks"])


def similarity_scores(chunks: DataFrame, key: str, names: list[str], vectors: np.ndarray,
                      vector: str = "embedding", aspects: list[str] | None = None) -> DataFrame:
    """Similarity score per (listing, aspect) from a chunk table with vectors."""
    compared = chunks.select(key, cosine_to(vectors)(F.col(vector)).alias("__sims"))
    sums = []
    for i in range(len(names)):
        cos = F.nullif(F.get("__sims", F.lit(i)), F.lit(float("nan")))
        sums += [
            F.max(cos).alias(f"best_{i}"),
            F.avg(cos).alias(f"mean_{i}"),
            F.count_if(cos > SUPPORT_THRESHOLD).alias(f"support_{i}"),
        ]
    wide = compared.groupBy(key).agg(*sums)
    aspects = aspects or names
    columns = {}
    for j, aspect in enumerate(aspects):
        if aspect in names:
            i = names.index(aspect)
            score, support = similarity_score(F.col(f"best_{i}"), F.col(f"mean_{i}")), F.col(f"support_{i}")
        else:
            score, support = F.lit(NEUTRAL), F.lit(0).cast("bigint")
        columns |= {f"similarity_score_{j}": score, f"similar_chunks_{j}": support}
    return unpivot_aspects(wide.select(key, *[c.alias(n) for n, c in columns.items()]), key, aspects,
                           ["similarity_score", "similar_chunks"])


# -- straight from texts ---------------------------------------------------------------------------


def cosines_of(encode: Encoder, texts: list[str], unit: np.ndarray, batch_size: int) -> np.ndarray:
    """Cosine of every text to every row of ``unit``, a batch of texts at a time; NaN where the model failed."""
    values = np.full((len(texts), len(unit)), np.nan)
    for start in range(0, len(texts), batch_size):
        part = texts[start : start + batch_size]
        try:
            read, good = np.asarray(encode(part), dtype=np.float64), list(range(len(part)))
        except Exception:  # a model may raise anything
            one_by_one = [v for v, _ in encode_safely(encode, part)]
            good = [i for i, v in enumerate(one_by_one) if v is not None]
            read = np.asarray([one_by_one[i] for i in good], dtype=np.float64)
        if good and len(unit):
            values[[start + i for i in good]] = unit_rows(read) @ unit.T
    return values


def chunk_cosines(make_encoder: Callable[[], Encoder], references: dict[str, list[str]], batch_size: int = 256):
    """Arrow UDF: array of chunk texts to one array of cosines (chunk by chunk) per row and reference."""

    @F.arrow_udf("array<array<double>>")
    def cosines(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = make_encoder()
        names, means = reference_matrix(encode, references)
        unit = unit_rows(means)
        places = [list(references).index(n) for n in names]
        for batch in batches:
            for start in range(0, max(1, len(batch)), ROWS_TOGETHER):
                yield cosines_of_rows(batch.slice(start, ROWS_TOGETHER), encode, unit, places)

    def cosines_of_rows(rows: pa.Array, encode: Encoder, unit: np.ndarray, places: list[int]) -> pa.Array:
        texts = rows.flatten()
        values = np.full((len(texts), len(references)), np.nan)
        # Strings and vectors of one batch of chunks at a time, however many chunks the rows have.
        for at in range(0, len(texts), batch_size):
            part = texts.slice(at, batch_size).to_pylist()
            values[at : at + len(part), places] = cosines_of(encode, part, unit, batch_size)
        # One list of chunk cosines per row and reference: rows keep their chunk counts.
        counts = np.asarray(rows.value_lengths().fill_null(0), dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(counts)])
        parts = [values[a:z].T.ravel() for a, z in zip(starts[:-1], starts[1:], strict=True)]
        inner = np.concatenate([[0], np.cumsum(np.repeat(counts, len(references)))])
        flat = pa.array(np.concatenate(parts) if parts else np.zeros(0))
        lists = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), flat)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * len(references), pa.int32()), lists)

    return cosines


def score_texts(df: DataFrame, key: str, text: str, make_encoder: Callable[[], Encoder],
                lexicon: dict = LEXICON, references: dict[str, list[str]] = REFERENCE_TEXTS,
                aspects: list[str] | None = None, rule: ChunkRule = ChunkRule(),
                source: str = "description") -> DataFrame:
    """All aspect scores of every text: one row per (listing, aspect).

    A text stays in its row from chunking to scores, so the whole job is one narrow stage without a
    shuffle. Chunk ids follow from key, source and position and need no lookup. Texts without
    chunks give no rows; an aspect without phrases and references gives raw 0.35, confidence 0.30.
    """
    aspects = known_aspects(aspects)
    spaced = single_spaced("__clean")
    chunks = F.when(
        (F.col("__spaced") == "") | (blanks_plus_one(F.col("__spaced")) < rule.minimum), F.array("__clean")
    ).otherwise(chunk_texts("__spaced", rule))
    cut = (
        df.where(F.length(strip(text)) >= rule.min_chars)
        .select(key, clean_text(text).alias("__clean"))
        .select(key, "__clean", spaced.alias("__spaced"))
        .select(key, "__spaced", chunks.alias("__chunks"))
    )
    compared = cut.withColumn("__cos", chunk_cosines(make_encoder, references)(F.col("__chunks")))
    phrases = phrases_of(aspects, lexicon)
    if phrases:
        compared = compared.withColumn("__phrases", phrases_in(phrases)(F.col("__spaced")))
    return scores_of_rows(compared, key, source, aspects, lexicon, list(references), F.contains)


def reference_cosines(vectors: DataFrame, make_encoder: Callable[[], Encoder], references: dict[str, list[str]] = REFERENCE_TEXTS,
                      vector: str = "embedding") -> DataFrame:
    """Rows that have a vector, with its cosines ``sims`` to the reference texts in its place: a few numbers to move on, not hundreds."""
    names, means = reference_matrix(make_encoder(), references)
    known = vectors.where(F.col(vector).isNotNull())
    packed = vectors.schema[vector].dataType.typeName() == "binary"
    return known.withColumn("sims", cosine_to(means, packed)(F.col(vector)) if names else F.array().cast("array<double>")).drop(vector)


def chunk_phrases(chunks: DataFrame, lexicon: dict = LEXICON, aspects: list[str] | None = None, text: str = "chunk_text") -> DataFrame:
    """Chunks with the phrases that they contain, as ``phrases``."""
    phrases = phrases_of(known_aspects(aspects), lexicon)
    return chunks.withColumn("phrases", phrases_in(phrases)(F.col(text)) if phrases else F.array().cast("array<string>"))


def score_chunks(chunks: DataFrame, key: str, make_encoder: Callable[[], Encoder], lexicon: dict = LEXICON,
                 references: dict[str, list[str]] = REFERENCE_TEXTS, aspects: list[str] | None = None,
                 source: str = "description") -> DataFrame:
    """As :func:`score_texts`, from a chunk table with stored vectors: only the references are encoded.

    Vectors (packed or not) become cosines and texts become phrases before the shuffle that brings the chunks of a listing together. A table
    that has ``sims`` (see :func:`reference_cosines`) or ``phrases`` (see :func:`chunk_phrases`) already needs no vectors or texts.
    """
    aspects = known_aspects(aspects)
    names, means = reference_matrix(make_encoder(), references)
    chunks = chunks.where(F.col("chunk_source") == source)
    if "phrases" not in chunks.columns:
        chunks = chunk_phrases(chunks, lexicon, aspects)
    if "sims" not in chunks.columns:
        packed = chunks.schema["embedding"].dataType.typeName() == "binary"
        chunks = chunks.withColumn("sims", cosine_to(means, packed)(F.col("embedding")) if names else F.array().cast("array<double>"))
    gathered = chunks.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("chunk_order", "phrases", "sims"))).alias("__parts"))

    def cosines_to(reference: int) -> Column:
        return F.transform("__parts", lambda p: F.get(p["sims"], F.lit(reference)))

    cosines = [cosines_to(i) for i in range(len(names))]
    compared = gathered.select(
        key, F.transform("__parts", lambda p: p["phrases"]).alias("__chunks"),
        (F.array(*cosines) if names else F.array().cast("array<array<double>>")).alias("__cos"),
    ).withColumn("__phrases", F.array_distinct(F.flatten("__chunks")))
    return scores_of_rows(compared, key, source, aspects, lexicon, names, F.array_contains)


def phrases_of(aspects: list[str], lexicon: dict) -> list[str]:
    return sorted({p for a in aspects for p, _, _ in tagged_phrases(a, lexicon)})


def scores_of_rows(compared: DataFrame, key: str, source: str, aspects: list[str], lexicon: dict, names: list[str],
                   has_phrase: Callable[[Column, Column], Column]) -> DataFrame:
    """Scores of rows with ``__chunks``, their cosines ``__cos`` to the references ``names``, and the ``__phrases`` in any of them.

    ``has_phrase`` tells whether an element of ``__chunks`` has a phrase. A chunk that the model could not read has no cosine;
    without any the similarity part is neutral, so a failing text or aspect never ends the job.
    """
    rows = F.array(*[
        aspect_struct(key, source, a, tagged_phrases(a, lexicon), a in lexicon,
                      F.get("__cos", F.lit(names.index(a))) if a in names else None, has_phrase)
        for a in aspects
    ])
    scored = compared.select(key, F.inline(F.when(F.size("__chunks") > 0, rows)))
    kw, sim, hits = F.col("keyword_score"), F.col("similarity_score"), F.size("keywords")
    return scored.select(
        key,
        "aspect",
        blended_score(kw, sim, hits).alias("raw_score"),
        score_confidence(kw, sim, hits, F.size("keyword_chunks")).alias("confidence"),
        F.sort_array(F.array_union("keyword_chunks", "similar_chunks")).alias("supporting_chunks"),
        "keywords",
        F.lit("hybrid").alias("score_method"),
    )


def aspect_struct(key: str, source: str, aspect: str, phrases: list[tuple[str, str, int]],
                  has_lexicon: bool, cosines: Column | None, has_phrase: Callable[[Column, Column], Column]) -> Column:
    """Keyword and similarity parts of one aspect over the ``__chunks`` array of a row.

    ``__phrases`` has every phrase that any of them has; chunks are runs of words of a text, so they have none that it lacks.
    """
    ids = lambda positions: F.transform(positions, lambda i: F.xxhash64(F.col(key), F.lit(source), i))
    no_ids, no_words = F.array().cast("array<bigint>"), F.array().cast("array<string>")
    if cosines is None:
        similarity, similar_chunks = F.lit(NEUTRAL), no_ids
    else:
        known = F.filter(cosines, lambda x: ~F.isnan(x))
        mean = F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(known), F.lit(0))
        similarity = similarity_score(F.array_max(known), mean)
        similar_chunks = ids(F.array_compact(F.transform(cosines, lambda x, i: F.when(~F.isnan(x) & (x > SUPPORT_THRESHOLD), i))))

    def parts(keyword: Column, keywords: Column, keyword_chunks: Column) -> Column:
        return F.struct(
            F.lit(aspect).alias("aspect"),
            keyword.alias("keyword_score"),
            keywords.alias("keywords"),
            keyword_chunks.alias("keyword_chunks"),
            similarity.alias("similarity_score"),
            similar_chunks.alias("similar_chunks"),
        )

    neutral = parts(F.lit(NEUTRAL if has_lexicon else 0.0), no_words, no_ids)
    if not phrases:
        return neutral
    entries = F.array(*[
        F.struct(F.lit(p).alias("phrase"), F.lit(t).alias("tag"), F.lit(w).alias("weight")) for p, t, w in phrases
    ])

    def of_hits(found: Column) -> Column:
        """From the phrases found in each chunk."""
        total = F.aggregate(F.flatten(found), F.lit(0), lambda s, e: s + e["weight"])
        tags = F.transform(F.flatten(found), lambda e: e["tag"])
        at = F.array_compact(F.transform(found, lambda f, i: F.when(F.size(f) > 0, i)))
        score = keyword_score(total / float(WEIGHT_UNIT), F.size(F.flatten(found)), F.size("__chunks"))
        return parts(score, tags, ids(at))

    def of_phrases(present: Column) -> Column:
        """From the phrases the whole text contains; a text without any skips its chunks."""
        per_chunk = F.transform("__chunks", lambda c: F.filter(present, lambda e: has_phrase(c, e["phrase"])))
        # One-element arrays bind a value once for all its uses.
        return F.when(F.size(present) == 0, neutral).otherwise(F.get(F.transform(F.array(per_chunk), of_hits), F.lit(0)))

    in_text = F.filter(entries, lambda e: F.array_contains("__phrases", e["phrase"]))
    return F.get(F.transform(F.array(in_text), of_phrases), F.lit(0))
