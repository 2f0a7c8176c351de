"""Per-key operators that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlattice.session import materialise


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The last row of every key by ``order`` (the last order column breaks ties).

    The rank filter is planned as a partial and a final group limit, so each task forwards at most
    one row per key to the shuffle, however many rows a single key has.
    """
    keys = [key] if isinstance(key, str) else key
    latest_first = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("__rank", F.row_number().over(latest_first)).where("__rank = 1").drop("__rank")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key by ``order``; same plan as :func:`latest_per_key`."""
    earliest_first = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order])
    return df.withColumn("__rank", F.row_number().over(earliest_first)).where("__rank = 1").drop("__rank")


def top_per_key(df: DataFrame, key: str | list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every key with their rank, limited before and after the shuffle."""
    keys = [key] if isinstance(key, str) else key
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def previous_per_key(df: DataFrame, key: str, order: str, tiebreak: str, value: str, out: str) -> DataFrame:
    """Add ``out``: ``value`` of the row before this one within ``key`` (ordered by ``order, tiebreak``).

    A plain window sends a whole key to one task. Here rows are range partitioned by (key, order, tiebreak) and written
    once, so that a key of any size is cut over as many segments as it needs. The window runs per key and
    segment; the first row of a segment takes the last row of the segment before, if that has the same key. Only
    one row per segment is handed on. ``tiebreak`` must be unique within (key, order). Nulls come first.
    """
    mask = (1 << 33) - 1
    placed = materialise_sorted(df, [key, order, tiebreak]).withColumns({
        "__segment": F.shiftright("__at", 33), "__row": F.col("__at").bitwiseAND(F.lit(mask))})
    ends = placed.groupBy("__segment").agg(F.max_by(F.struct(F.col(key).alias("k"), F.col(value).alias("v")), "__row").alias("__end"))
    # One row per segment. A segment without rows is absent, so lag over those there are finds the one before.
    handed_on = ends.select(
        F.col("__segment").alias("__to"), F.lag("__end").over(Window.orderBy("__segment")).alias("__end"))
    in_segment = Window.partitionBy("__segment", key).orderBy("__row")
    carried = F.when((F.col("__row") == 0) & F.col("__end.k").eqNullSafe(F.col(key)), F.struct(F.col("__end.v").alias(value)))
    return (
        placed.withColumn("__prev", F.lag(F.struct(value)).over(in_segment))
        .join(F.broadcast(handed_on), F.col("__segment") == F.col("__to"), "left")
        .withColumn(out, F.coalesce("__prev", carried)[value])
        .drop("__segment", "__row", "__at", "__prev", "__to", "__end")
    )


def join_spread(
    rows: DataFrame, lookup: DataFrame, keys: list[str], hot: DataFrame, spread: int = 32
) -> DataFrame:
    """Left join of ``rows`` to a unique-key ``lookup`` when some keys hold a large part of ``rows``.

    ``hot`` is the (small, bounded) part of ``lookup`` for those keys. It is broadcast; rows matched
    by it are spread over ``spread`` salts in the shuffle join, where nothing matches them again. The
    salt is a hash of the row, so a task that is run again sends its rows the same way.
    """
    values = [c for c in lookup.columns if c not in keys]
    hot = hot.select(*keys, F.struct(*values).alias("__hot"))
    hashable = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.lit(1) + F.pmod(F.xxhash64(*hashable), F.lit(spread)).cast("int")
    first = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "__salt", F.when(F.col("__hot").isNull(), F.lit(0)).otherwise(salt)
    )
    cold = lookup.select(*keys, F.struct(*values).alias("__cold"), F.lit(0).alias("__salt"))
    both = first.join(cold, [*keys, "__salt"], "left")
    return both.select(*rows.columns, *[F.coalesce("__hot", "__cold")[v].alias(v) for v in values])


def running_position(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Number rows 0,1,2,... over the whole table in ``order`` without a single-task sort.

    Rows are range partitioned and sorted in their partition, and written once; a row's number is
    then its place in the partition plus the row count of all partitions before it. Only one count
    per partition is broadcast. ``order`` must be unique so that long ties can be cut anywhere.
    """
    laid_out = materialise_sorted(df, order)
    mask = (1 << 33) - 1
    place = laid_out.withColumn("__part", F.shiftright("__at", 33).cast("int")).withColumn(
        "__row", F.col("__at").bitwiseAND(F.lit(mask))
    )
    sizes = place.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select(
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before")
    )
    return (
        place.join(F.broadcast(before), "__part")
        .withColumn(out, F.col("__before") + F.col("__row"))
        .drop("__part", "__row", "__before", "__at")
    )


def materialise_sorted(df: DataFrame, order: list[str]) -> DataFrame:
    """Range partition and sort by ``order``, stamp each row's place as ``__at``, and write it out."""


    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ordered.withColumn("__at", F.monotonically_increasing_id()))
