"""Quality rules as a ledger of bits.

One pass over the texts stores, per document, the measurements and one bit for every rule that fails. Policies are
versioned sets of rules; which documents a policy keeps, and what each rule alone would change, follow from the bits
without reading a text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.llm.arrays import blocks, keys, mix, span_hashes, text_buffers, word_bounds

REPEAT_WORDS = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "upper_chars", "n_stutter"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measures; it must not be null for any measured row."""

    bit: int
    name: str
    fails: str


#: Bits are never given to another rule, so that old ledgers stay readable.
RULES = (
    Rule(0, "too_few_words", "n_words < 20"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words AND n_symbols > 10"),
    Rule(3, "repeated_lines", "2 * n_dup_lines > n_lines AND n_dup_lines > 2"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 40 * n_words"),
    Rule(7, "stutter", "2 * n_stutter > n_words"),
    Rule(6, "capitals", "2 * upper_chars > word_chars AND word_chars > 0"),
)
#: Version: names of the rules that reject. Version 1 is the base; later versions add to it.
POLICIES = {
    1: ("too_few_words", "repeated_words"),
    2: ("too_few_words", "repeated_words", "symbols", "short_words", "long_words", "capitals", "stutter"),
}
CURRENT = 2


def policy_mask(version: int) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in POLICIES[version])


def _per_text(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[ends] - sums[starts]


def measure_block(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of the texts that lie one after the other in ``data``."""
    begin, stop, first = word_bounds(data, starts, ends)
    counts = np.diff(first)
    point = (data & 0xC0) != 0x80
    points = np.concatenate(([0], np.cumsum(point)))
    chars = np.concatenate(([0], np.cumsum(points[stop] - points[begin])))

    words = span_hashes(data, begin, stop)
    text = np.repeat(np.arange(len(starts)), counts)
    again = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    stutter = np.bincount(text[1:][again], minlength=len(starts))

    # Words in windows that a text holds twice: windows are ordered by (text, hash), equal neighbours are repeats.
    repeats = np.zeros(len(starts), np.int64)
    if len(begin) >= REPEAT_WORDS:
        n = len(words) - REPEAT_WORDS + 1
        window = np.zeros(n, np.uint64)
        for i, factor in enumerate(keys(REPEAT_WORDS, 21) | np.uint64(1)):
            window += words[i : i + n] * factor
        at = np.flatnonzero(text[:n] == text[REPEAT_WORDS - 1 :])
        ident = mix(window[at] + text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(ident, kind="stable")
        same = ident[order][1:] == ident[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        edges = np.zeros(len(words) + 1, np.int64)
        edges[at[twice]] += 1
        edges[at[twice] + REPEAT_WORDS] -= 1
        repeats = np.bincount(text, np.cumsum(edges[:-1]) > 0, len(starts)).astype(np.int64)

    # Lines with a word: those that span a word's start.
    breaks = np.flatnonzero(data == 10)
    cut = np.unique(np.concatenate((starts, breaks + 1, [len(data)])))
    low, high = cut[:-1], cut[1:]
    high = high - (data[high - 1] == 10) if len(high) else high
    used = np.searchsorted(begin, low) < np.searchsorted(begin, np.maximum(high, low))
    low, high = low[used], high[used]
    text = np.searchsorted(starts, low, "right") - 1
    dup = np.zeros(len(starts), np.int64)
    if len(low):
        ident = mix(span_hashes(data, low, high) + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        _, once = np.unique(ident, return_index=True)
        extra = np.ones(len(ident), bool)
        extra[once] = False
        dup = np.bincount(text[extra], minlength=len(starts))
    return {
        "n_words": counts, "word_chars": chars[first[1:]] - chars[first[:-1]],
        "n_symbols": _per_text(_SYMBOL[data], starts, ends), "n_dup_lines": dup, "n_repeat_words": repeats,
        "n_lines": np.bincount(text, minlength=len(starts)) if len(low) else np.zeros(len(starts), np.int64),
        "upper_chars": _per_text(_UPPER[data], starts, ends),
        "n_stutter": stutter,
    }


def measure(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, measures) of every whole text; null and empty texts have zeros, null ids and repeated rows stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for at, end in blocks(offsets):
                low, high = int(offsets[at]), int(offsets[end])
                found = measure_block(data[low:high], offsets[at:end] - low, offsets[at + 1 : end + 1] - low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), *(pa.array(found[m], pa.int64()) for m in MEASURES)],
                    ["doc_id", *MEASURES],
                )

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def ledger(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` with ``failed``: bit b is set where the rule with that bit fails."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0).cast("long"))
    return measured.withColumn("failed", bits)


def keeps(version: int = CURRENT) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(policy_mask(version))) == 0


def ablations(book: DataFrame, version: int = CURRENT) -> DataFrame:
    """One row per rule of a policy: (rule, n_failed, n_alone), n_alone being the documents only this rule rejects.

    The ledger is folded to one count per bit pattern first; there are at most 2 ** rules of those.
    """
    mask = policy_mask(version)
    patterns = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    used = [r for r in RULES if mask >> r.bit & 1]
    one = patterns.select(
        "n", "bits", F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                                         for r in used])).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return one.groupBy("r.rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_alone"),
    )
