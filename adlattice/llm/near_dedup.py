"""Near duplicates by MinHash with tensored banding and exact verification.

A document's set is its distinct word shingles. Two collections of ``COLLECTION`` short MinHash bands each give, by
combining every band of the one with every band of the other, ``COLLECTION ** 2`` table keys from only
``2 * COLLECTION * BAND`` MinHashes. At likeness 0.75 a pair shares a table with probability
``(1 - (1 - 0.75 ** 3) ** 16) ** 2`` = 0.9997, at 0.8 with 0.99998. Every link is confirmed on the full sets.

Equal sets are one node from the start. Only nodes that share a band of *both* collections with another node can share
a table, so only those are written out under all keys. Each table entry is first verified against one hub, which joins
a group of copies without its pairs. Nodes that still share a table with another component are then compared within the
bands of the first collection, in blocks, by matrix products over their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.llm.arrays import block_words, keys, mix, shingles
from adlattice.llm.components import components
from adlattice.session import materialise

WIDTH, PERCENT = 5, 75
COLLECTION, BAND = 16, 3
#: Bounds of a block of nodes that are compared with each other in one place.
BLOCK_NODES, BLOCK_SHINGLES = 512, 400_000


def node_of(own: np.ndarray) -> bytes:
    """128-bit identity of a set of distinct hashes."""
    return np.array([own.sum(), mix(own ^ np.uint64(0xA5A5A5A5)).sum()], ">u8").tobytes()


def signatures(df: DataFrame, id_col: str, text: str, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, node, u, v) per row: set size, 128-bit identity of the set, bands of both collections."""
    hashes = 2 * COLLECTION * BAND
    factors, shifts, salts = keys(hashes, 31) | np.uint64(1), keys(hashes, 32), keys(BAND, 33) | np.uint64(1)

    def bands(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bands by text, for texts with at least one shingle."""
        out = np.zeros((len(starts), 2 * COLLECTION), np.uint64)
        for j in range(hashes):
            out[:, j // BAND] += np.minimum.reduceat(sets * factors[j] + shifts[j], starts) * salts[j % BAND]
        return mix(out + np.arange(2 * COLLECTION, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, words, first in block_words(batch.column(1), lower=True):
                sets, bounds = shingles(words, first, width)
                sizes = np.zeros(end - at, np.int64)
                nodes: list[bytes | None] = [None] * (end - at)
                u: list = [None] * (end - at)
                v: list = [None] * (end - at)
                full = np.flatnonzero(bounds[1:] > bounds[:-1])
                if full.size:
                    made = bands(sets, bounds[full]).view(np.int64)
                    for row, i in enumerate(full):
                        own = np.unique(sets[bounds[i] : bounds[i + 1]])
                        sizes[i] = len(own)
                        nodes[i] = node_of(own)
                        u[i], v[i] = made[row, :COLLECTION], made[row, COLLECTION:]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, end - at), pa.array(sizes), pa.array(nodes, pa.binary()),
                    pa.array(u, pa.list_(pa.int64())), pa.array(v, pa.list_(pa.int64())),
                ], ["doc_id", "n_shingles", "node", "u", "v"])

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_shingles long, node binary, u array<long>, v array<long>")


def shingle_sets(df: DataFrame, id_col: str, text: str, width: int = WIDTH) -> DataFrame:
    """(doc_id, node, shingles): sorted distinct shingle hashes of every text that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, words, first in block_words(batch.column(1), lower=True):
                sets, bounds = shingles(words, first, width)
                rows = [np.unique(sets[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, end - at), pa.array([node_of(r) for r in rows], pa.binary()),
                    pa.array([r.view(np.int64) for r in rows], pa.list_(pa.int64())),
                ], ["doc_id", "node", "shingles"])

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, node binary, shingles array<long>").where(F.size("shingles") > 0)


def _differing(entries: DataFrame, column: str) -> DataFrame:
    """Keys whose entries do not all agree in ``column``, with its smallest value."""
    return entries.groupBy("key").agg(F.min(column).alias("least"), F.max(column).alias("__most")).where("least < __most").drop("__most")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough. Sets are unique by number."""
    one = sets.select(F.col("num").alias("b"), F.col("shingles").alias("__sb"))
    two = sets.select(F.col("num").alias("a"), F.col("shingles").alias("__sa"))
    joined = pairs.join(one, "b").join(two, "a")
    both = F.size(F.array_intersect("__sa", "__sb"))
    return joined.where(100 * both >= percent * (F.size("__sa") + F.size("__sb") - both)).select("a", "b")


def links_among(sets: list[np.ndarray], labels: np.ndarray, blocks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of positions that are alike enough and join different labels; pairs that join nothing new are left out.

    Intersections of all pairs come from products of 0/1 matrices, a thousand shingles at a time. With two blocks only
    pairs across them are looked at.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    often = counts[column] > 1
    owner, column = owner[often], (np.cumsum(counts > 1) - 1)[column[often]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n), np.float64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 1024):
        part = slice(*np.searchsorted(column, (low, low + 1024)))
        has = np.zeros((n, 1024), np.float32)
        has[owner[part], column[part] - low] = 1
        both += has @ has.T
    alike = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    alike &= np.triu(labels[:, None] != labels[None, :])
    if blocks.min() != blocks.max():
        alike &= blocks[:, None] != blocks[None, :]
    root = {x: x for x in labels.tolist()}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for i, j in np.argwhere(alike).tolist():
        x, y = find(labels[i].item()), find(labels[j].item())
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def _open_links(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes of one key and different labels; ``entries`` has (key, num, n, label).

    A key's nodes are dealt into blocks of a bounded number of nodes and shingles, and every pair of blocks is compared in one
    place, so no task holds a whole group and no pair is written out that is not a link.
    """
    keys_ = entries.groupBy("key").agg(
        F.min("label").alias("__low"), F.max("label").alias("__high"),
        F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_NODES)).cast("int").alias("blocks"),
    ).where("__low < __high").drop("__low", "__high")
    dealt = (
        entries.join(keys_, "key")
        .withColumn("block", F.pmod(F.xxhash64("num"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "num", "label")
        .join(sets, "num")
        .repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
        .select("key", "lo", "hi", "block", "num", "label", "shingles")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def compare() -> list[tuple[int, int]]:
            if len({r[1] for r in rows}) < 2:
                return []
            found = links_among([r[3] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), percent)
            return [(rows[i][0], rows[j][0]) for i, j in found]

        for batch in batches:
            out = []
            shingles_ = batch.column("shingles")
            values, at = shingles_.values.to_numpy(), shingles_.offsets.to_numpy()
            fields = zip(*(batch.column(c).to_pylist() for c in ("key", "lo", "hi", "num", "label", "block")))
            for i, (key, lo, hi, num, label, block) in enumerate(fields):
                if group != (key, lo, hi):
                    out += compare()
                    group, rows = (key, lo, hi), []
                rows.append((num, label, block, values[at[i] : at[i + 1]].copy()))
            yield _pairs_batch(out)
        yield _pairs_batch(compare())

    return dealt.mapInArrow(run, "a long, b long")


def _pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH,
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. Texts with the same component_id are linked, directly or
    through others, by ``100 * intersection >= percent * union``; component_id is the smallest doc_id of the component,
    and ``kept`` marks the rows with that id. Null, empty and wordless texts have an empty set and are linked with
    nothing. A row with a null id takes part like any other; its component_id is null only if no linked row has an id,
    and then it is kept. Repeated rows are equal texts; those with the kept id are all kept. Other columns are left out.
    """
    signed = materialise(signatures(df, id_col, text, width))
    nodes = materialise(
        signed.where("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("low"), F.first("n_shingles").alias("n"), F.first("u").alias("u"), F.first("v").alias("v"),
            F.count(F.lit(1)).alias("copies"))
        .withColumn("num", F.monotonically_increasing_id())
    )

    def active(side: str) -> DataFrame:
        # One exchange serves the count and the join.
        rows = nodes.select("num", F.explode(side).alias("key")).repartition("key")
        return rows.join(_differing(rows, "num"), "key", "left_semi").select("num").distinct()

    # Nodes that share a band of each collection with some node: only these can share a table.
    live = nodes.join(active("u"), "num", "left_semi").join(active("v"), "num", "left_semi").select("num", "u", "v")
    tables = live.select("num", F.explode(F.flatten(F.transform(
        "u", lambda x: F.transform("v", lambda y: F.xxhash64(x, y))))).alias("key")).repartition("key")
    table = materialise(tables.join(_differing(tables, "num"), "key").select("key", "num", F.col("least").alias("hub")))
    sets = materialise(_sets_of(df, id_col, text, width, nodes.join(table.select("num").distinct(), "num", "left_semi")))

    # Star around each table entry's hub: joins a group of copies without looking at its pairs.
    sizes = nodes.select(F.col("num").alias("hub"), F.col("n").alias("hub_n"))
    close = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    star = (
        table.where("num != hub").select("num", "hub").distinct().join(nodes.select("num", "n"), "num").join(sizes, "hub")
        .where(close).select(F.col("hub").alias("a"), F.col("num").alias("b"))
    )
    links = materialise(_verified(star, sets, percent))
    found = components(links).select(F.col("node").alias("num"), "label")

    # Table entries still in different components: their nodes are compared within the bands they share.
    label = F.coalesce("label", "num").alias("label")
    labelled = table.join(found, "num", "left").select("key", "num", label)
    open_nodes = labelled.join(_differing(labelled, "label"), "key", "left_semi").select("num", "label").distinct()
    entries = nodes.select("num", "n", "u").join(open_nodes, "num").select("num", "n", "label", F.explode("u").alias("key"))
    more = _open_links(materialise(entries), sets, percent)
    # Renamed: a union takes over constraints of a checkpoint's plan on columns that the checkpoint no longer has.
    links = links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(more).toDF("a", "b")
    found = materialise(components(links)).select(F.col("node").alias("num"), "label")

    labelled = nodes.select("node", "num", "low", "copies").join(found, "num", "left")
    least = labelled.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("low").alias("component"))
    classes = labelled.join(least, "label", "left").where("copies > 1 OR label IS NOT NULL").select(
        "node", F.coalesce("component", "low").alias("component"))
    component = F.coalesce("component", "doc_id")
    return signed.select("doc_id", "n_shingles", "node").join(classes, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _sets_of(df: DataFrame, id_col: str, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """(num, shingles) of the wanted nodes. One document of each is hashed again, which moves less than keeping all sets."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ids = wanted.select(F.col("low").alias("__id")).distinct()
    texts = rows.join(ids, rows["doc_id"].eqNullSafe(ids["__id"]), "left_semi")
    again = shingle_sets(texts, "doc_id", "text", width).select("node", "shingles")
    return again.join(wanted.select("node", "num"), "node").dropDuplicates(["node"]).select("num", "shingles")
