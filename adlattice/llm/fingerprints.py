"""Document fingerprints by consistent weighted sampling.

A document is a set of words with weights 1 + ln(count). For each of ``SAMPLES`` samples every (word, weight) gets, from
the word's hash alone, two gamma variates and a uniform one (Ioffe's scheme); the word with the smallest value and its
quantised weight make the sample. Two documents agree in a sample with a probability equal to the generalised Jaccard
similarity of their weights, so the share of equal samples estimates it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlattice.llm.arrays import BLOCK, block_words, keys, mix

SAMPLES = 64
_LOW = np.uint64(0xFFFFFFFF)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two uniform variates in (0, 1) from the halves of 64 random bits."""
    scale = np.float32(2.0**-32)
    return (((x >> np.uint64(32)).astype(np.float32) + np.float32(0.5)) * scale,
            ((x & _LOW).astype(np.float32) + np.float32(0.5)) * scale)


def term_samples(words: np.ndarray, weights: np.ndarray, seed: np.uint64) -> np.ndarray:
    """One sample of every (word, weight): its value in the upper 32 bits, in order, and its identity in the lower."""
    base = words ^ seed
    one, two = _halves(mix(base + np.uint64(0x632BE59BD9B4E019)))
    three, four = _halves(mix(base + np.uint64(0xC2B2AE3D27D4EB4F)))
    bits = mix(base + np.uint64(0x165667B19E3779F9))
    beta, _ = _halves(bits)
    r, c = -np.log(one * two), -np.log(three * four)  # sums of two exponentials: gamma of shape 2
    step = np.floor(np.log(weights).astype(np.float32) / r + beta)
    value = np.log(c) - r * (step - beta) - r
    raw = value.astype(np.float32).view(np.uint32)
    ordered = np.where(raw >> np.uint32(31), ~raw, raw | np.uint32(1 << 31)).astype(np.uint64)
    identity = mix(bits + step.astype(np.int64).view(np.uint64)) >> np.uint64(32)
    return ordered << np.uint64(32) | identity


def sketch(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """(texts, samples) of 32-bit samples; a text without words has zeros only."""
    owners, words, counts = [], [], []
    for at, end, hashes, first in block_words(pa.array(texts, pa.large_string()), lower=True):
        for i in range(at, end):
            own, n = np.unique(hashes[first[i - at] : first[i - at + 1]], return_counts=True)
            words.append(own)
            counts.append(n)
            owners.append(len(own))
    out = np.zeros((len(texts), samples), np.uint32)
    sizes = np.array(owners)
    full = np.flatnonzero(sizes)
    if not full.size:
        return out
    words, counts = np.concatenate(words), np.concatenate(counts)
    # A (word, count) that many texts share is sampled once.
    ident, position, place = np.unique(mix(words + counts.astype(np.uint64)), return_index=True, return_inverse=True)
    words, weights = words[position], 1 + np.log(counts[position])
    starts = np.concatenate(([0], np.cumsum(sizes)))[full]
    for d, seed in enumerate(keys(samples, 41)):
        best = np.minimum.reduceat(term_samples(words, weights, seed)[place], starts)
        out[full, d] = np.maximum(best & _LOW, np.uint64(1)).astype(np.uint32)
    return out


def likeness(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row. Two texts without words are alike."""
    return (one == two).mean(axis=1)


def as_text(rows: np.ndarray) -> list[str]:
    return [r.astype(">u4").tobytes().hex() for r in rows]


def fingerprint(df: DataFrame, id_col: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint) of every whole text: 8 hexadecimal digits per sample.

    Null and wordless texts have zeros. Equal texts have equal fingerprints. Null ids and repeated rows stay; other
    columns are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                made = as_text(sketch([t or "" for t in batch.column(1).to_pylist()], samples))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fingerprint string")


def edit(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text, of its edit by the next document, and their likeness.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The next document is by
    ascending (id, text), null ids first, and the first follows the last; a lone document follows itself. Documents are
    dealt by id ranges and read in order. A document at a range's begin is also sent, as a neighbour, to the range
    before, so texts move once and no task waits for another. An empty table gives no rows.
    """
    spark = df.sparkSession
    lowest = -(1 << 63)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                     F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("__key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    # One id per range: as many numbers as there are tasks.
    first = rows.agg(F.percentile_approx("__key", shares, 100 * parts).alias("c"), F.min("__key").alias("m")).first()
    low = first["m"] if first["m"] is not None else lowest
    cuts = sorted({c for c in first["c"] or [] if c > low})
    last = len(cuts)

    cut_list = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    part = F.size(F.filter(cut_list, lambda c: c <= F.col("__key")))
    own = F.struct(F.col("__part").alias("part"), F.lit(0).alias("beyond"))
    before = F.struct((F.col("__part") - 1).alias("part"), F.lit(1).alias("beyond"))
    behind = F.struct(F.lit(last).alias("part"), F.lit(1).alias("beyond"))
    dealt = (
        rows.withColumn("__part", part)
        .withColumn("__to", F.explode(
            F.when(F.col("__key") == low, F.array(own, behind))
            .when(F.array_contains(cut_list, F.col("__key")), F.array(own, before))
            .otherwise(F.array(own))))
        .select("doc_id", "text", "__key", "__to.part", "__to.beyond")
        .repartitionById(last + 1, F.col("part"))
        .sortWithinPartitions("part", "beyond", "__key", "text")
        .select("doc_id", "text", "part", "beyond")
    )

    def chunk(held: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, which is their next document."""
        texts = [h[1] for h in held]
        edits = [edit(a, b) for a, b in zip(texts, texts[1:])]
        n = len(edits)
        made = sketch(texts + edits, samples)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([h[0] for h in held[:n]], pa.int64()),
            "n_chars": pa.array([len(t) for t in texts[:n]], pa.int64()),
            "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edits],
            "fingerprint": as_text(made[:n]), "edited_fingerprint": as_text(made[n + 1 :]),
            "near_edited": likeness(made[:n], made[n + 1 :]), "near_next": likeness(made[:n], made[1 : n + 1]),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, done = [], 0, None
        for batch in batches:
            for doc, value, at, beyond in zip(*(c.to_pylist() for c in batch.columns)):
                if done == at:
                    continue  # the range's neighbour has come, further ones are its ties
                held.append((doc, value))
                size += len(value)
                if beyond:
                    done = at
                if beyond or size > BLOCK:
                    if len(held) > 1:
                        yield chunk(held)
                    held = [] if beyond else held[-1:]
                    size = 0

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
