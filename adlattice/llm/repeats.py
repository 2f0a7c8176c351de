"""Removal of repeated passages by a logarithmic family of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes around it also starts in a document with a smaller id.

Suffixes are sampled by content: of the ``LENGTH - GRAM + 1`` short byte strings within a window of ``LENGTH`` bytes the
one with the smallest hash is the window's anchor, so equal windows have equal anchors wherever they stand. Every window
belongs to exactly one anchor. Three steps narrow down what has to be indexed:

1. Of equal texts only the first is looked at; the others go as a whole.
2. Anchors are dealt by their hash; those of a single document are dropped.
3. Shared anchors are dealt with a hash of all bytes that their windows cover. Where an earlier document has the same
   bytes, all of the anchor's windows are repeats. Where all of a hash's anchors have the same bytes, nothing is left to
   do; else the first holder of each variant goes on.

What is left are edges of repeated passages. They are indexed where they are dealt to: documents come in batches in the
order of their ids. The windows of a batch form a suffix array (ordered by the hash of their ``LENGTH`` bytes; only equality
is asked of the order). It is scanned against the arrays of all levels for strings of an earlier document, then enters the
family as the lowest level, and levels of about equal size are merged, so a family of n suffixes has at most log2(n)
levels and each suffix is merged log2(n) times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlattice.llm.arrays import blocks, mix, span_hashes, text_buffers, window_hashes

LENGTH, GRAM = 50, 16
BATCH_SUFFIXES = 8192
#: Ids of this value stand for null.
NO_ID = -(1 << 63)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Anchors of all windows of the texts in ``data``: (hash, anchor, first window, last window, text).

    The windows of one anchor are consecutive. Equal windows have anchors of the same hash.
    """
    grams = window_hashes(data, gram)
    span = length - gram + 1
    n = len(grams) - span + 1
    none = (np.zeros(0, np.int64),) * 5
    if n < 1:
        return none
    # The smallest of ``span`` hashes in a row by doubling. The last six bits give way to the place, counted from the
    # text's begin, so that a text has the same anchors whatever it is processed with.
    text = np.repeat(np.arange(len(starts)), ends - starts)[: len(grams)]
    here = np.arange(len(grams)) - starts[text]
    packed = grams & ~np.uint64(63) | (here & 63).astype(np.uint64)
    width, least = 1, packed
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:n], least[span - width : span - width + n])
    window = np.flatnonzero(np.arange(n) + length <= ends[text[:n]])
    if not window.size:
        return none
    place = window + (((least[window] & np.uint64(63)).astype(np.int64) - here[window]) & 63)
    text = text[window]
    begin = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))))
    last = np.append(begin[1:], len(window)) - 1
    return grams[place[begin]].view(np.int64), place[begin], window[begin], window[last], text[begin]


class SuffixFamily:
    """Sorted arrays of window hashes with the smallest document number of each, of geometrically growing sizes."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def earliest(self, hashes: np.ndarray) -> np.ndarray:
        """The first document that holds each of the sorted hashes, or the largest number."""
        out = np.full(len(hashes), np.iinfo(np.int64).max)
        for level, docs in self.levels:
            at = np.minimum(np.searchsorted(level, hashes), len(level) - 1)
            hit = level[at] == hashes
            out[hit] = np.minimum(out[hit], docs[at[hit]])
        return out

    def add(self, hashes: np.ndarray, docs: np.ndarray) -> None:
        """Enter a suffix array (sorted, distinct) as the lowest level and merge levels of like size."""
        if not len(hashes):
            return
        self.levels.append((hashes, docs))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (h1, d1), (h2, d2) = self.levels.pop(), self.levels.pop()
            h, d = np.concatenate((h2, h1)), np.concatenate((d2, d1))
            order = np.argsort(h, kind="stable")  # two runs: a merge
            h, d = h[order], d[order]
            new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            self.levels.append((h[new], np.minimum.reduceat(d, new)))

    def scan(self, hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Whether each window stands in an earlier document; the windows are entered afterwards."""
        order = np.lexsort((docs, hashes))
        h, d = hashes[order], docs[order]
        new = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
        first = d[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else d
        known = np.minimum(first, self.earliest(h))
        out = np.zeros(len(h), bool)
        out[order] = known < d
        self.add(h[new], d[new])
        return out


def _home(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, text, tag) without nulls, dealt by id. All uses have the same plan, so they share one exchange of texts."""
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("tag", F.xxhash64("text")).repartition("doc_id")


class Block:
    """Some whole texts of a batch with their anchors."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int, length: int, gram: int) -> None:
        self.data, self.starts, self.at, self.rows = data, starts, at, len(starts)
        self.key, place, self.first, self.last, self.owner = anchors(data, starts, ends, length, gram)
        self.cover = np.zeros(0, np.int64)
        if len(self.key):
            covered = span_hashes(data, self.first, self.last + length)
            self.cover = mix(covered ^ mix((place - self.first).astype(np.uint64))).view(np.int64)

    def among(self, values: np.ndarray, lists: pa.ListArray) -> np.ndarray:
        """Which anchors' values are in the list of their text; ``lists`` is the batch's column, a null list is empty."""
        part = lists.slice(self.at, self.rows)
        sizes = part.value_lengths().fill_null(0).to_numpy()
        wanted = part.flatten().to_numpy().view(np.uint64) ^ mix(np.repeat(np.arange(self.rows, dtype=np.uint64), sizes))
        return np.isin(values.view(np.uint64) ^ mix(self.owner.astype(np.uint64)), wanted)


def _blocks(batch: pa.RecordBatch, length: int, gram: int) -> Iterator[Block]:
    data, offsets = text_buffers(batch.column("text"))
    for at, end in blocks(offsets, 1 << 18):
        low, high = int(offsets[at]), int(offsets[end])
        yield Block(data[low:high], offsets[at:end] - low, offsets[at + 1 : end + 1] - low, at, length, gram)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id) rows of keys with two documents or more, from rows sorted by both. A document's own repeat may count."""
    held: tuple[int, int] | None = None  # a key's only row so far
    shared: int | None = None  # the last key, if it has shown two
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc = batch.column("key").to_numpy(), batch.column("doc_id").to_numpy()
        if held is not None:
            key, doc = np.append(held[0], key), np.append(held[1], doc)
        same = key[1:] == key[:-1]
        keep = np.zeros(len(key), bool)
        keep[1:] |= same
        keep[:-1] |= same
        if shared is not None and key[0] == shared:
            keep[key == shared] = True
        held = None if keep[-1] else (int(key[-1]), int(doc[-1]))
        shared = int(key[-1]) if keep[-1] else None
        yield _batch(key=key[keep], doc_id=doc[keep])


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, cover, open) from (key, cover, doc_id) rows sorted by all three.

    Rows behind the first of a (key, cover) are settled (not open): an earlier document has their bytes. First rows are
    open where the key has several covers, and left out where it has one.
    """
    last: tuple[int, int, int] | None = None  # the last row
    lone: tuple[int, int] | None = None  # first (cover, doc_id) of the last key, while that has one cover
    for batch in batches:
        if not batch.num_rows:
            continue
        key, cover, doc = (batch.column(c).to_numpy() for c in ("key", "cover", "doc_id"))
        again = (key[1:] == key[:-1]) & (cover[1:] == cover[:-1]) & (doc[1:] == doc[:-1])
        fresh = ~np.concatenate(([last == (key[0], cover[0], doc[0])], again))
        if not fresh.any():
            continue
        key, cover, doc = key[fresh], cover[fresh], doc[fresh]
        new_key = np.concatenate(([last is None or key[0] != last[0]], key[1:] != key[:-1]))
        first = new_key | np.concatenate(([last is None or cover[0] != last[1]], cover[1:] != cover[:-1]))
        run = np.cumsum(new_key)  # 0: still the key of the batch before
        covers = np.bincount(run, first, minlength=run[-1] + 1)
        carried = bool(run[0] == 0)
        several = covers > 1
        if carried:
            several[0] = covers[0] > 0 or lone is None
        yield _batch(doc_id=doc[~first], cover=cover[~first], open=np.zeros(int((~first).sum()), bool))
        asked = first & several[run]
        yield _batch(doc_id=doc[asked], cover=cover[asked], open=np.ones(int(asked.sum()), bool))
        if carried and several[0] and lone is not None:
            yield _batch(doc_id=[lone[1]], cover=[lone[0]], open=[True])
        if several[run[-1]]:
            lone = None
        elif not (carried and run[-1] == 0):
            at = int(np.flatnonzero(new_key)[-1])
            lone = (int(cover[at]), int(doc[at]))
        last = (int(key[-1]), int(cover[-1]), int(doc[-1]))


def _index(length: int):
    """Scan of (doc_id, first, bytes) rows in id order against a growing family: (doc_id, first, last) of repeated windows."""
    def flush(held: list[pa.RecordBatch], family: SuffixFamily) -> pa.RecordBatch:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        column = batch.column("bytes").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        counts = np.diff(offsets) - length + 1
        row = np.repeat(np.arange(len(counts)), counts)
        step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        hashes = window_hashes(data, length)[offsets[:-1][row] + step]
        docs, first = batch.column("doc_id").to_numpy(), batch.column("first").to_numpy()
        hit = np.flatnonzero(family.scan(hashes, docs[row]))
        row, start = row[hit], first[row[hit]] + step[hit]
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)))[: len(row)]
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(row))[: len(begin)] - 1
        return _batch(doc_id=docs[row[begin]], tag=batch.column("tag").to_numpy()[row[begin]], first=start[begin], last=start[stop])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, held, rows = SuffixFamily(), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_SUFFIXES):
                held.append(batch.slice(at, BATCH_SUFFIXES))
                rows += held[-1].num_rows
                if rows >= BATCH_SUFFIXES:
                    yield flush(held, family)
                    held, rows = [], 0
        if rows:
            yield flush(held, family)

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): UTF-8 bytes of every text without those that earlier documents hold.

    ``removed`` lists maximal runs (start, end) in bytes, end exclusive, ``kept`` is the remaining bytes as binary. Strings
    are judged on the input. Null texts count as empty. Rows with a null id are left whole and remove nothing; rows with
    the same id do not remove from each other, and equal ones stay repeated. Other columns are left out. ``length`` less
    ``gram`` must be below 64.
    """
    identity = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    firsts = (
        identity.where(F.col("doc_id").isNotNull() & (F.col("doc_id") != NO_ID))
        .groupBy(F.xxhash64("text").alias("tag"), F.crc32(F.col("text").cast("binary")).alias("c"), F.octet_length("text").alias("n"))
        .agg(F.min("doc_id").alias("doc_id"))
        .groupBy("doc_id").agg(F.collect_set("tag").alias("own_tags"))
    )

    def home() -> DataFrame:
        return _home(df, id_col, text)

    def first_texts() -> DataFrame:
        return home().join(firsts, "doc_id").where(F.array_contains("own_tags", F.col("tag"))).drop("own_tags")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for b in _blocks(batch, length, gram):
                order = np.lexsort((b.key, b.owner))
                key, owner = b.key[order], b.owner[order]
                new = np.concatenate(([True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])))[: len(key)]
                yield _batch(key=key[new], doc_id=ids[owner[new] + b.at])

    shared = (
        first_texts().select("doc_id", "text").mapInArrow(find, "key long, doc_id long")
        .repartition("key").sortWithinPartitions("key", "doc_id")
        .mapInArrow(_shared_keys, "key long, doc_id long")
        .groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    )

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("doc_id").to_numpy(), batch.column("keys")
            for b in _blocks(batch, length, gram):
                hit = b.among(b.key, lists)
                yield _batch(key=b.key[hit], cover=b.cover[hit], doc_id=ids[b.owner[hit] + b.at])

    settled = (
        first_texts().join(shared, "doc_id").select("doc_id", "text", "keys")
        .mapInArrow(cover, "key long, cover long, doc_id long")
        .repartition("key").sortWithinPartitions("key", "cover", "doc_id")
        .mapInArrow(_settled, "doc_id long, cover long, open boolean")
        # One column, so that both uses below keep it whole and share its exchange, as they share that of the texts.
        .groupBy("doc_id").agg(F.collect_set(F.struct("open", "cover")).alias("states"))
    )

    def covers(opened: bool):
        return F.transform(F.filter("states", lambda s: s["open"] == F.lit(opened)), lambda s: s["cover"])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags, lists = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy(), batch.column("open")
            for b in _blocks(batch, length, gram):
                hit = np.flatnonzero(b.among(b.cover, lists))
                raw, own = b.data.tobytes(), b.owner[hit]
                pieces = [raw[x : y + length] for x, y in zip(b.first[hit].tolist(), b.last[hit].tolist())]
                yield _batch(key=b.key[hit], doc_id=ids[own + b.at], tag=tags[own + b.at], first=b.first[hit] - b.starts[own],
                             bytes=pa.array(pieces, pa.binary()))

    runs = (
        first_texts().join(settled.where(F.exists("states", lambda s: s["open"])), "doc_id")
        .select("doc_id", "text", "tag", covers(True).alias("open"))
        .mapInArrow(edges, "key long, doc_id long, tag long, first long, bytes binary")
        .repartition("key").sortWithinPartitions("doc_id").select("doc_id", "tag", "first", "bytes")
        .mapInArrow(_index(length), "doc_id long, tag long, first long, last long")
        .groupBy("doc_id").agg(F.collect_set(F.struct("tag", "first", "last")).alias("runs"))
    )
    joined = (
        home().join(firsts, "doc_id", "left").join(settled, "doc_id", "left").join(runs, "doc_id", "left")
        .select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", covers(False).alias("covered"),
                (F.col("own_tags").isNotNull() & ~F.array_contains("own_tags", F.col("tag"))
                 | F.col("own_tags").isNull() & (F.col("doc_id") != NO_ID)).alias("copy"),
                F.filter("runs", lambda r: r["tag"] == F.col("tag")).alias("runs"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, lists, more = batch.column("copy").to_pylist(), batch.column("covered"), batch.column("runs").to_pylist()
            for b in _blocks(batch, length, gram):
                hit = np.flatnonzero(b.among(b.cover, lists))
                ranges: list[list[tuple[int, int]]] = [[] for _ in range(b.rows)]
                for own, first, last in zip(b.owner[hit].tolist(), b.first[hit].tolist(), b.last[hit].tolist()):
                    low = int(b.starts[own])
                    ranges[own].append((first - low, last - low + length))
                ends = [*b.starts[1:].tolist(), len(b.data)]
                sizes, removed, kept = [], [], []
                for i, (low, high) in enumerate(zip(b.starts.tolist(), ends)):
                    raw = b.data[low:high].tobytes()
                    if copies[b.at + i]:
                        found = [(0, len(raw))] if len(raw) >= length else []
                    else:
                        found = ranges[i] + [(r["first"], r["last"] + length) for r in more[b.at + i] or []]
                    merged = join_ranges(found)
                    bounds = [0, *(p for m in merged for p in m), len(raw)]
                    sizes.append(len(raw))
                    removed.append([{"start": x, "end": y} for x, y in merged])
                    kept.append(b"".join(raw[x:y] for x, y in zip(bounds[::2], bounds[1::2])))
                yield _batch(doc_id=batch.column("doc_id").slice(b.at, b.rows), n_bytes=pa.array(sizes, pa.int64()),
                             removed=pa.array(removed, _SPANS), kept=pa.array(kept, pa.binary()))

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, removed array<struct<start long, end long>>, kept binary")


def join_ranges(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(found):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out
