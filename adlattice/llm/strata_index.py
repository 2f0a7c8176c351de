"""Ranked lexical search over an index that is stratified by document length.

A document's score depends on its length only through the normaliser m, so documents of equal m form a stratum. In a
stratum a term's postings are grouped by term frequency, and all postings of a group add the same impact, which is computed once
per frequency. The greatest frequency of a term in a block of a stratum bounds what any document there can get from it; the
bounds order the visits, and an item leaves a task's blocks as soon as the next bound is below its k-th score.

Two passes over the documents: one counts terms and writes the postings, one deals these by (m, id) and writes the index. The
index is read twice: the first time each item scores its few best blocks only, which gives a threshold that
all tasks start with. Items are a stated set: their terms are shipped to the tasks, ``TERMS_PER_PASS`` at most at a time, further items in
further passes. The index holds the terms of the items of its pass, and every document that has one of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlattice.llm.arrays import BLOCK, text_buffers, word_bounds
from adlattice.operators.keyed import top_per_key
from adlattice.session import scratch_path

# Fixed values of the score.
LENGTH_SHARE = 25
LENGTH_FACTOR = 12
IMPACT_SCALE = 1_000_000_000
FREQUENCY_SCALE = 1000
WEIGHT_SCALE = 1000

# Characters between terms: all of ASCII but digits and letters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN = np.array([not chr(b).isalnum() if b < 128 else False for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows (item, term) shipped to the tasks in one pass.
TERMS_PER_PASS = 20_000

# Documents in a block of a stratum, postings in a partition of the index, and blocks that a task orders at once.
DOCS_PER_BLOCK = 4096
POSTINGS_PER_PART = 250_000
BLOCKS_AT_ONCE = 256

# Blocks that each item scores to get its first threshold.
FIRST_BLOCKS = 4

POSTINGS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType())),
])
INDEX = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("m", T.LongType()), T.StructField("docs", T.ArrayType(T.LongType())),
    # Groups of postings in the order of (term, tf); the postings of group i are places in docs, from starts[i] to starts[i + 1].
    T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType())),
    T.StructField("starts", T.ArrayType(T.IntegerType())), T.StructField("places", T.ArrayType(T.IntegerType())),
])
HITS = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType()),
])


# Terms


def item_terms(items: DataFrame) -> DataFrame:
    """The terms of items (item_id, text): (item_id, term, repeats). Rows that share an id are one item; a null text has no terms."""
    lower = F.translate("text", _UPPER, _UPPER.lower())
    terms = items.select("item_id", F.explode(F.regexp_extract_all(lower, F.lit(f"({TERM})"))).alias("term"))
    return terms.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("repeats"))


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(row, start, end) parts of at most ``BLOCK`` bytes that cut no term; only a longer term makes a longer part."""
    for row in range(len(offsets) - 1):
        at, end = int(offsets[row]), int(offsets[row + 1])
        while end - at > BLOCK:
            between = np.flatnonzero(_BETWEEN[data[at : at + BLOCK]])
            if len(between):
                cut = at + int(between[-1]) + 1
            else:
                cut = at + BLOCK
                while cut < end and not _BETWEEN[data[cut]]:
                    cut += 1
            yield row, at, cut
            at = cut
        yield row, at, end


def _batches_of(segments: Iterator[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """Neighbouring parts together, up to ``BLOCK`` bytes or one part."""
    held: list[tuple[int, int, int]] = []
    for part in segments:
        if held and part[2] - held[0][1] > BLOCK:
            yield held
            held = []
        held.append(part)
    if held:
        yield held


def count_terms(column: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (row, vocabulary place, occurrences) of those that ``vocabulary`` (large_string) holds.

    Texts are read in parts of ``BLOCK`` bytes, so memory does not grow with the length of a text.
    """
    data, offsets = text_buffers(column)
    lengths = np.zeros(len(column), np.int64)
    size = max(len(vocabulary), 1)
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for held in _batches_of(_segments(data, offsets)):
        low, high = held[0][1], held[-1][2]
        part = data[low:high]
        rows = np.array([h[0] for h in held])
        begin, end, first = word_bounds(part, np.array([h[1] for h in held]) - low, np.array([h[2] for h in held]) - low, _BETWEEN)
        np.add.at(lengths, rows, np.diff(first))
        if not len(begin):
            continue
        # Terms one after the other, without what stands between them. Texts follow each other, so offsets stay true.
        inside = np.concatenate(([0], np.cumsum(end - begin)))
        letters = _LOWER[part[~_BETWEEN[part]]]
        terms = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(inside), pa.py_buffer(letters))
        place = pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(rows, np.diff(first))
        key, count = np.unique((row * size + place)[place >= 0], return_counts=True)
        keys.append(key)
        counts.append(count)
    # A text of several parts has a term in several of them.
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    tf = np.zeros(len(key), np.int64)
    np.add.at(tf, at, np.concatenate(counts))
    return lengths, key // size, key % size, tf


def document_postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per document with a term: its term count ``n``, the vocabulary places of its terms, rising, and their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(vocabulary, pa.large_string())
        for batch in batches:
            n, row, place, tf = count_terms(batch.column("text"), words)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32))) for x in (place, tf)]
            made = pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n), *lists], names=POSTINGS.names)
            yield made.filter(pa.array(n > 0))

    return docs.select("doc_id", "text").mapInArrow(run, POSTINGS)


# The index


def build_index(postings: DataFrame, documents: int, terms: int, total: int) -> DataFrame:
    """The stratified index of ``postings`` (``total`` in all) as a written table, one row per block of a stratum.

    ``documents`` and ``terms`` are those of the whole corpus. Rows are dealt by ranges of (m, hash, id), so a stratum that holds a large part of
    all documents is spread over several tasks and cut into blocks.
    """
    spark = postings.sparkSession
    parts = max(-(-total // POSTINGS_PER_PART), spark.sparkContext.defaultParallelism)
    m = F.expr(f"{100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * {documents}L) div {max(terms, 1)}L")
    rows = postings.where("size(terms) > 0").select(m.alias("m"), F.xxhash64("doc_id", "n").alias("h"), "doc_id", "terms", "tfs")
    ordered = rows.repartitionByRange(parts, "m", "h", "doc_id").sortWithinPartitions("m", "h", "doc_id").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []  # rows of one stratum that are not written yet
        for batch in batches:
            strata = batch.column("m").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(strata)) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:], strict=False):
                if high == low:
                    continue
                if held and held[0][0] != strata[low]:
                    yield _block(number, held)
                    number, held = number + 1, []
                while low < high:
                    take = min(high - low, DOCS_PER_BLOCK - sum(h[1].num_rows for h in held))
                    held.append((strata[low], batch.slice(low, take)))
                    low += take
                    if sum(h[1].num_rows for h in held) == DOCS_PER_BLOCK:
                        yield _block(number, held)
                        number, held = number + 1, []
        if held:
            yield _block(number, held)

    path = scratch_path(spark, "strata-index")
    ordered.mapInArrow(run, INDEX).write.parquet(path)
    return spark.read.parquet(path)


def _block(number: int, held: list[tuple]) -> pa.RecordBatch:
    rows = pa.Table.from_batches([h[1] for h in held]).combine_chunks()
    lists, tfs = rows.column("terms").combine_chunks(), rows.column("tfs").combine_chunks()
    place = np.repeat(np.arange(rows.num_rows, dtype=np.int32), lists.value_lengths().to_numpy())
    term, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy()
    order = np.lexsort((place, tf, term))
    term, tf, place = term[order], tf[order], place[order]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(term) != 0) | (np.diff(tf) != 0))))
    starts = np.append(first, len(term)).astype(np.int32)
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([held[0][0]], pa.int64()),
        pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())), one(term[first], pa.int32()), one(tf[first], pa.int32()),
        one(starts, pa.int32()), one(place, pa.int32()),
    ], names=INDEX.names)


# Searching


@dataclass(frozen=True)
class Items:
    """Asked items: ids rising, and per item the places and weights (times repeats) of its terms, one item after the other."""

    ids: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    vocabulary: int


class Block:
    """A block of a stratum with the impact of each group of postings."""

    def __init__(self, row: dict, vocabulary: int):
        self.number, self.docs = row["block"], row["docs"]
        self.terms, self.starts, self.places = row["terms"], row["starts"], row["places"]
        tfs, which = np.unique(row["tfs"].astype(np.int64), return_inverse=True)
        # Once per frequency of the stratum.
        self.impacts = (IMPACT_SCALE * tfs // (FREQUENCY_SCALE * tfs + LENGTH_FACTOR * row["m"]))[which]
        last = np.append(np.flatnonzero(np.diff(self.terms)), len(self.terms) - 1)
        # Groups of a term have rising frequencies, so its last one has its greatest impact.
        self.greatest = np.zeros(vocabulary, np.int64)
        self.greatest[self.terms[last]] = self.impacts[last]

    def bounds(self, items: Items) -> np.ndarray:
        """Per item the greatest score that a document here could have."""
        return np.add.reduceat(items.weights * self.greatest[items.terms], items.starts[:-1])

    def scores(self, items: Items, item: int) -> np.ndarray:
        """The score of every document of the block, exact in 64 bits."""
        out = np.zeros(len(self.docs), np.int64)
        asked = slice(items.starts[item], items.starts[item + 1])
        low = np.searchsorted(self.terms, items.terms[asked], "left")
        high = np.searchsorted(self.terms, items.terms[asked], "right")
        for weight, first, end in zip(items.weights[asked].tolist(), low.tolist(), high.tolist(), strict=True):
            if first < end and weight:
                added = np.repeat(weight * self.impacts[first:end], np.diff(self.starts[first : end + 1]))
                # A document has one frequency of a term, so it is in one group only.
                out[self.places[self.starts[first] : self.starts[end]]] += added
        return out


def _blocks_of(batch: pa.RecordBatch, vocabulary: int) -> Iterator[Block]:
    for i in range(batch.num_rows):
        row = {}
        for name in batch.schema.names:
            value = batch.column(name)[i]
            values = getattr(value, "values", None)
            row[name] = value.as_py() if values is None else values if name == "docs" else values.to_numpy()
        yield Block(row, vocabulary)


def _best(ids: pa.Array, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best scores above 0; of equal scores the smaller id, null ids last."""
    found = np.flatnonzero(scores > 0)
    if len(found) > k:
        limit = np.partition(scores[found], len(found) - k)[len(found) - k]
        found = found[scores[found] >= limit]
    known = ids.take(pa.array(found))
    number = pc.fill_null(known, 0).to_numpy(zero_copy_only=False)
    missing = np.asarray(known.is_null())
    return found[np.lexsort((number, missing, -scores[found]))][:k]


def best_blocks(index: DataFrame, items: Items, count: int) -> DataFrame:
    """The ``count`` blocks with the greatest bounds of each item, among those of a task: (item, block, bound)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.zeros((0, len(items.ids)), np.int64)
        numbers = np.zeros(0, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                blocks = list(_blocks_of(batch.slice(low, BLOCKS_AT_ONCE), items.vocabulary))
                bounds = np.concatenate((bounds, [b.bounds(items) for b in blocks]))
                numbers = np.append(numbers, [b.number for b in blocks])
                order = np.argsort(-bounds, axis=0, kind="stable")[:count]
                needed = np.unique(order)
                bounds, numbers = bounds[needed], numbers[needed]
        order = np.argsort(-bounds, axis=0, kind="stable")[:count]
        item = np.tile(np.arange(len(items.ids)), len(order))
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(numbers[order.reshape(-1)]), pa.array(bounds[order.reshape(-1), item])], names=["item", "block", "bound"])

    # Only what the bounds need is read.
    heads = index.select("block", "m", "terms", "tfs", F.expr("array(0)").alias("starts"), F.expr("array(0)").alias("places"),
                         F.expr("array(0L)").alias("docs"))
    found = heads.mapInArrow(run, "item long, block long, bound long").where("bound > 0")
    return top_per_key(found, "item", [F.desc("bound"), F.asc("block")], count).select("item", "block")


def visit(index: DataFrame, items: Items, thresholds: np.ndarray, k: int) -> DataFrame:
    """The best ``k`` documents of each item, per task: (item_id, doc_id, score).

    A task takes its blocks some at a time. Every item visits those in the order of its bounds, and stops at the first
    bound below its threshold, which is the greater of the given one and the task's k-th score so far. A bound equal to the
    threshold is visited, as equal scores are settled by id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = thresholds.copy()
        empty = (pa.array([], pa.int64()), np.zeros(0, np.int64))
        best = [empty] * len(items.ids)
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                blocks = list(_blocks_of(batch.slice(low, BLOCKS_AT_ONCE), items.vocabulary))
                bounds = np.array([b.bounds(items) for b in blocks])
                for item, order in enumerate(np.argsort(-bounds, axis=0, kind="stable").T):
                    for at in order:
                        if bounds[at, item] < limits[item] or bounds[at, item] == 0:
                            break
                        scores = blocks[at].scores(items, item)
                        scores[scores < limits[item]] = 0
                        near = _best(blocks[at].docs, scores, k)
                        if not len(near):
                            continue
                        ids = pa.concat_arrays([best[item][0], blocks[at].docs.take(pa.array(near))])
                        both = np.concatenate((best[item][1], scores[near]))
                        kept = _best(ids, both, k)
                        best[item] = (ids.take(pa.array(kept)), both[kept])
                        if len(kept) == k:
                            limits[item] = max(limits[item], int(both[kept[-1]]))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(items.ids, [len(b[1]) for b in best]), pa.int64()),
            pa.concat_arrays([b[0] for b in best] or [empty[0]]), pa.array(np.concatenate([empty[1], *(b[1] for b in best)])),
        ], names=HITS.names)

    return index.mapInArrow(run, HITS)


def search(index: DataFrame, items: Items, k: int) -> DataFrame:
    """The best ``k`` documents of each item with their rank: (item_id, rank, doc_id, score)."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    chosen = best_blocks(index, items, FIRST_BLOCKS).select("block").distinct()
    thresholds = np.ones(len(items.ids), np.int64)
    first = top_per_key(visit(index.join(chosen, "block", "left_semi"), items, thresholds, k), "item_id", order, k)
    # One number per item of the pass: the k-th score, of items that have k documents already.
    for row in first.where(F.col("rank") == k).select("item_id", "score").collect():
        thresholds[np.searchsorted(items.ids, row["item_id"])] = row["score"]
    return top_per_key(visit(index, items, thresholds, k), "item_id", order, k).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` highest-scoring documents (doc_id, text) of every item (item_id, text): (item_id, rank, doc_id, score).

    Scores above 0 only; of equal scores the smaller doc_id is first, null ids last. A null text has no terms; documents
    without terms count for nothing. Repeated document rows are ranked one by one; item rows that share an id are one item, and
    rows without an id none. Other columns are not looked at, whatever their names. Without documents or items the result is empty.
    """
    spark: SparkSession = docs.sparkSession
    path = scratch_path(spark, "item-terms")
    item_terms(items.where("item_id IS NOT NULL")).write.parquet(path)
    asked = spark.read.parquet(path)
    passes = -(-asked.count() // TERMS_PER_PASS)
    found = spark.createDataFrame([], HITS).select("item_id", F.lit(0).alias("rank"), "doc_id", "score").where("false")
    for number in range(passes):
        part = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number)
        found = found.unionByName(_rank_pass(docs, part, k))
    return found


def _rank_pass(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """:func:`rank_documents` for the terms of some items (about ``TERMS_PER_PASS`` rows)."""
    spark = docs.sparkSession
    rows = sorted((r["item_id"], r["term"], r["repeats"]) for r in asked.collect())
    vocabulary = sorted({r[1] for r in rows})
    place = {term: i for i, term in enumerate(vocabulary)}
    path = scratch_path(spark, "postings")
    document_postings(docs, vocabulary).write.parquet(path)
    postings = spark.read.parquet(path)
    documents, terms = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(max(len(vocabulary), 1), np.int64)
    for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per asked term
        holding[row["term"]] = row["count"]
    weight = [math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding]
    ids, starts = np.unique(np.array([r[0] for r in rows], np.int64), return_index=True)
    items = Items(ids, np.append(starts, len(rows)), np.array([place[r[1]] for r in rows], np.int64),
                  np.array([weight[place[r[1]]] * r[2] for r in rows], np.int64), len(vocabulary))
    return search(build_index(postings, documents, terms, int(holding.sum())), items, k)
