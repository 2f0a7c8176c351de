"""Exact duplicates by naming blocks: equal blocks get equal integers, then equal pairs of integers do, up to one per text.

A text is cut into blocks of ``BLOCK_BYTES`` bytes, and every block has a number, its place in the table. The blocks are sorted; all
equal ones stand together and are named by their smallest place. Names of neighbouring blocks are then paired, the pairs
sorted and named in the same way, and so on until every text is one name. Names are never hashes: two texts share their last
name (and the level it was given at) only if all their bytes agree.

Text moves through the cluster once, to be sorted; every level above holds half as many rows of a few integers. The keys that
make up a large part of all rows (a group of copies may be a third of the table) are named by an aggregate and broadcast, so their rows
are not dealt to one task; fewer than ``HOT_SHARE`` keys can be that frequent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlattice.session import scratch_path

BLOCK_BYTES = 1024

# A name that stands for more than this part of all rows is hot; there are fewer of them than this number.
HOT_SHARE = 1024

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed; a null is an empty text."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def byte_blocks(data: Column, size: int) -> Column:
    """``data`` cut into blocks of ``size`` bytes, the last one shorter; an empty text is one empty block."""
    last = F.greatest(F.ceil(F.octet_length(data) / F.lit(size)).cast("int"), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def with_names(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` (``total`` of them, ``place`` unique, keys not null) with ``name``: the smallest place of the rows of equal keys.

    So equal keys, and only those, have the same name, whichever task gives it. Rows are dealt and sorted by their keys, but
    for those of hot keys, whose few names are broadcast. A hash only decides which way a row goes.
    """
    address = F.xxhash64(*keys)
    counts = rows.groupBy(address.alias("address")).agg(F.count(F.lit(1)).alias("n"))
    # Fewer than HOT_SHARE numbers, by the rule of the filter.
    hot = [r["address"] for r in counts.where(F.col("n") > total // HOT_SHARE).select("address").collect()]
    sorted_name = F.min("place").over(Window.partitionBy(*keys))
    if not hot:
        return rows.withColumn("name", sorted_name)
    cold, few = rows.where(~address.isin(hot)), rows.where(address.isin(hot))
    names = F.broadcast(few.groupBy(*keys).agg(F.min("place").alias("name")))
    return cold.withColumn("name", sorted_name).unionByName(few.join(names, keys))


def identities(blocks: DataFrame) -> DataFrame:
    """The identity of every text of ``blocks`` (row, left, pos, place, block): (row, level, name).

    ``left`` is the number of blocks of the text, ``pos`` the block's number in it, ``place`` a number of its own in the table. Two rows
    have the same ``level`` and ``name`` if and only if their blocks are the same.
    """
    count, first = F.col("left").cast("long"), F.col("pos") == 0
    # At level k a text of more than 2 ** (k - 1) blocks has its count over 2 ** k, rounded up; an array has fewer than 2 ** 31 items.
    at_level = [F.sum(count), *(F.sum(F.when(count > 1 << k - 1, F.shiftright(count + (1 << k) - 1, k))) for k in range(1, 32))]
    totals = [n for n in blocks.where(first).agg(*at_level).first() if n]
    found = blocks.select("row", F.lit(0).alias("level"), F.lit(0).cast("long").alias("name")).where("false")
    rows, keys = blocks.select("row", "left", "pos", "place", "block"), ["block"]
    for level, total in enumerate(totals):
        names = _written(with_names(rows, keys, total).select("row", "left", "pos", "place", "name"), "block-names")
        found = found.unionByName(names.where("left = 1").select("row", F.lit(level).alias("level"), "name"))
        rows, keys = _pairs(names), ["a", "b"]
    return found


def _pairs(names: DataFrame) -> DataFrame:
    """Neighbouring names of the texts that have more than one left: (row, left, pos, place, a, b)."""
    even = F.col("pos") % 2 == 0
    # No name is -1, so it stands for the missing half where a text has an odd number of names.
    return names.where("left > 1").groupBy("row", F.shiftright("pos", 1).alias("pos")).agg(
        F.shiftright(F.first("left") + 1, 1).alias("left"), F.max(F.when(even, F.col("place"))).alias("place"),
        F.max(F.when(even, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("b"))


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` (``total`` of them) with their row of ``groups``, which has their ``group_size``.

    Groups of more than ``total / HOT_SHARE`` rows are fewer than ``HOT_SHARE``; they come by broadcast, all others by a shuffle join.
    """
    hot = F.broadcast(groups.where(F.col("group_size") > total // HOT_SHARE))
    cold = groups.where(F.col("group_size") <= total // HOT_SHARE)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys))


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Groups of documents whose texts are equal after lower-casing A-Z: one row per row of ``docs`` (doc_id, text).

    Returns doc_id, keep_id (the largest doc_id of the group), group_size (rows), kept (doc_id = keep_id) and text_sha256 (of
    the normalised text). Other columns of ``docs`` are not looked at, whatever their names. A null text is an empty text, and all empty
    texts are one group. A null doc_id never stays if another id is in the group; a group of null ids only keeps them all.
    Rows that repeat an id with the same text are counted one by one and share their verdict. Very long texts are only more
    blocks: none of the steps holds more than one text. An empty table gives an empty result.
    """
    text = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    cut = text.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
                      byte_blocks(F.col("text").cast("binary"), block_bytes).alias("blocks"))
    one = cut.select("row", "doc_id", "text_sha256", F.size("blocks").alias("left"), F.posexplode("blocks").alias("pos", "block"))
    first = F.col("pos") == 0
    # Written once, as rows and places must have the same numbers wherever they are read.
    blocks = _written(one.select(
        "row", "left", "pos", F.monotonically_increasing_id().alias("place"), "block",
        F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("text_sha256")).alias("text_sha256")), "text-blocks")
    rows = blocks.where(first).select("row", "doc_id", "text_sha256")
    named = _written(rows.join(identities(blocks), "row"), "identities")
    groups = named.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return with_group(named, groups, ["level", "name"], named.count()).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
