"""Packing token pieces into windows by minimum bin slack.

A document's ids are cut at multiples of the window, so only its last piece is shorter. What has to be packed is then a
count of pieces by length: at most ``window`` numbers, however many documents there are. The longest length left seeds a
window; a subset-sum over bitsets finds the multiset of remaining lengths that comes closest to the capacity, and is
walked back to counts. That pattern is used as often as the counts allow before the next is sought. Pieces are matched
to the patterns by their rank within their length, which Spark computes over all pieces.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlattice.operators.keyed import running_position
from adlattice.session import materialise

WINDOW = 1024
# A run of white space from this length on is left to the tokenizers library: tiktoken fails at about a million.
LONG_RUN = 1000
# Rounds that the windows of a pattern are spread over where pieces have an order.
ROUNDS = 64
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@functools.lru_cache(maxsize=2)
def _coder(path: str):
    import json

    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    vocabulary, added = whole["model"]["vocab"], [t["content"] for t in whole["added_tokens"]]
    # The byte alphabet of byte-level vocabularies: printable Latin-1 stands for itself, the rest from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(map(letters.__getitem__, piece)): i for piece, i in vocabulary.items() if piece not in added}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), added


@functools.lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _has_long_run(text: str) -> bool:
    """Whether ``text`` has ``LONG_RUN`` characters of white space in a row: such a run covers two of the places looked at."""
    return bool(re.search(r"\s\s", text[:: LONG_RUN // 2])) and bool(re.search(rf"(?<!\s)\s{{{LONG_RUN}}}", text))


def byte_bpe(path: str | None = None) -> Callable[[list[str]], list[np.ndarray]]:
    """An encoder for the tokenizer file at ``path`` (default: the public 50k byte-level vocabulary).

    It appends id 0 to each text. The vocabulary is read from the file once per worker and run by tiktoken, which gives
    the ids that the ``tokenizers`` library gives, four times as fast. A text that holds an added token of the file, such
    as ``<|endoftext|>``, is run by ``tokenizers`` itself, which gives that token's id; so is one with a long run of white
    space, at which tiktoken's pattern runs out of stack.
    """
    def encode(texts: list[str]) -> list[np.ndarray]:
        import public_tokenizers

        file, known = path or public_tokenizers.path("byte_bpe_50k.json"), {}
        coder, added = _coder(file)
        for text in texts:
            if text not in known:
                if any(token in text for token in added) or _has_long_run(text):
                    ids = _library(file).encode(text, add_special_tokens=False).ids
                else:
                    ids = coder.encode_ordinary(text)
                known[text] = np.append(np.asarray(ids, np.uint32), np.uint32(0))
        return [known[t] for t in texts]

    return encode


def token_pieces(df: DataFrame, encoder: Callable, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                 with_ids: bool = False, order: str | None = None) -> DataFrame:
    """Pieces of every document: (doc_id, start, length, ids_crc32, doc_tokens[, ids as little-endian bytes][, order]).

    A null or empty text has the end id alone. Null ids stay null and repeated rows repeated; other columns are left out,
    but for ``order``, a whole number that every piece of a row takes over.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows: list[tuple] = []
                places: list[int] = []
                encoded = encoder([t or "" for t in batch.column(1).to_pylist()])
                for at_row, (doc, ids) in enumerate(zip(batch.column(0).to_pylist(), encoded)):
                    raw = memoryview(ids.astype("<u4").tobytes())
                    for start in range(0, len(ids), window):
                        part = raw[4 * start : 4 * (start + window)]
                        rows.append((doc, start, len(part) // 4, zlib.crc32(part), len(ids), *([bytes(part)] * with_ids)))
                        places.append(at_row)
                arrays = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:5]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    arrays, names = [*arrays, pa.array([r[5] for r in rows], pa.binary())], [*names, "ids"]
                if order:
                    arrays, names = [*arrays, batch.column(2).take(pa.array(places, pa.int64()))], [*names, order]
                yield pa.RecordBatch.from_arrays(arrays, names)

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       *([F.col(order).cast("long")] if order else []))
    return narrow.mapInArrow(run, PIECES + ", ids binary" * with_ids + (f", `{order}` long" if order else ""))


@dataclass(frozen=True)
class Pattern:
    """``times`` windows with the same counts by length."""

    counts: dict[int, int]
    times: int


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts of the multiset of available lengths with the largest sum up to ``capacity``.

    Bit s of the set of reachable sums stands for sum s. Each length is added in powers of two of its count, so a length
    costs a logarithm of its count in shifts; the sets before each addition are kept and walked back.
    """
    mask = (1 << (capacity + 1)) - 1
    reach, trail = 1, []
    for length in sorted(counts, reverse=True):
        left, chunk = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(chunk, left)
            trail.append((reach, length, take))
            reach |= reach << (length * take) & mask
            left, chunk = left - take, chunk * 2
        if reach >> capacity & 1:
            break
    total, out = reach.bit_length() - 1, {}
    for before, length, take in reversed(trail):
        if not before >> total & 1:
            out[length] = out.get(length, 0) + take
            total -= length * take
    return out


def fill_windows(counts: dict[int, int], window: int = WINDOW) -> list[Pattern]:
    """Patterns that use up all pieces, found by minimum bin slack seeded with the longest length left."""
    left = {length: n for length, n in counts.items() if n > 0}
    patterns = []
    while left:
        seed = max(left)
        rest = {k: v - (k == seed) for k, v in left.items() if v - (k == seed) > 0 and k <= window - seed}
        chosen = closest_fill(rest, window - seed)
        chosen[seed] = chosen.get(seed, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        for k, n in chosen.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        patterns.append(Pattern(chosen, times))
    return patterns


def in_rounds(patterns: list[Pattern], rounds: int = ROUNDS) -> Iterator[Pattern]:
    """The same windows with every pattern's spread evenly over ``rounds``, so that all lengths are used up at one pace."""
    for r in range(rounds):
        for i, p in enumerate(patterns):
            phase = i * 0.6180339887 % 1  # patterns used a few times do not all fall into the same rounds
            n = int(p.times * (r + 1) / rounds + phase) - int(p.times * r / rounds + phase)
            if n:
                yield Pattern(p.counts, n)


def seat_table(patterns: Iterable[Pattern]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, pieces per window, first sequence id, offset in the window), in rank order."""
    seats: dict[int, array] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern in patterns:
        offset = 0
        for length in sorted(pattern.counts, reverse=True):
            n = pattern.counts[length]
            seats.setdefault(length, array("q")).extend((used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * pattern.times
            offset += n * length
        sequence += pattern.times
    return {length: np.array(rows, np.int64).reshape(-1, 4) for length, rows in seats.items()}


def pack(pieces: DataFrame, window: int = WINDOW, order: str | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: each sequence holds at most ``window`` ids, without gaps.

    ``pieces`` needs (doc_id, start, length, ids_crc32); rows are written once. Pieces of equal length are taken in the
    order of (doc_id, start, ids_crc32). An empty table gives no rows. With ``order``, a column that numbers the documents,
    they are taken in the order of (``order``, start, ids_crc32), all lengths at one pace, and sequences are numbered by
    the mean ``order`` of their ids.
    """
    pieces = materialise(pieces.drop("sequence_id", "offset"))
    # At most ``window`` rows: the counts by length.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns = fill_windows(counts, window)
    seats = seat_table(in_rounds(patterns) if order else patterns)
    begins, total = {}, 0
    for length in sorted(counts):
        begins[length], total = total, total + counts[length]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column("length").to_numpy(), batch.column("__n").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                rank = numbers[at] - begins[length]
                table = seats[length]
                row = table[np.searchsorted(table[:, 0], rank, "right") - 1]
                inside = rank - row[:, 0]
                sequence[at] = row[:, 2] + inside // row[:, 1]
                offset[at] = row[:, 3] + inside % row[:, 1] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    names = pieces.columns
    numbered = running_position(pieces, ["length", order or "doc_id", "start", "ids_crc32"], "__n")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    packed = numbered.select(*names, "__n").mapInArrow(place, f"{schema}, sequence_id long, offset long")
    return _sequences_in_order(packed, order) if order else packed


def _sequences_in_order(packed: DataFrame, order: str) -> DataFrame:
    """``packed`` with its sequences numbered anew by the mean ``order`` of their ids."""
    means = packed.groupBy(F.col("sequence_id").alias("__old")).agg(
        (F.sum(F.col(order) * F.col("length")) / F.sum("length")).alias("__mean"))
    numbers = running_position(means, ["__mean", "__old"], "__new")
    joined = packed.join(numbers, F.col("sequence_id") == F.col("__old"))
    return joined.select(*[F.col("__new").alias(c) if c == "sequence_id" else c for c in packed.columns])


def sequences(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """The windows themselves, (sequence_id, ids, n_tokens), from packed pieces that carry ``ids``.

    A window of a power-of-two length is left as it is, any other is padded with id 0 to ``window``.
    """
    joined = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("__p"), F.sum("length").alias("n_tokens")
    )
    ids = F.aggregate("__p", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    zeros = F.unhex(F.repeat(F.lit("00000000"), (F.lit(window) - F.col("n_tokens")).cast("int")))
    return joined.select("sequence_id", F.when(power, ids).otherwise(F.concat(ids, zeros)).alias("ids"), "n_tokens")
