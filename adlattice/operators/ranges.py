"""Joins of points with intervals, as equality joins on bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bit_length(value: Column) -> Column:
    return F.when(value > 0, F.length(F.bin(value))).otherwise(0)


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str) -> DataFrame:
    """Every pair of a point and an interval with ``low <= point <= high`` (whole numbers, both ends included).

    An interval of up to 2 ** n numbers is put into the bins of that width it touches: at most two, however long it is.
    A point is looked up once per width in use, of which there are at most 63. The join is one of equal (width, bin)
    with the interval itself as the residual test, so no side is compared with all of the other; whether the ranges are
    broadcast is left to their size at run time, and a bin that holds very many points is split as a skewed partition.
    Rows with a null point or end, and intervals that end before they begin, match nothing. Ends must be
    less than 2 ** 62 apart. Column names of the two sides must differ.
    """
    clash = set(points.columns) & set(ranges.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    begin, end = F.col(low).cast("bigint"), F.col(high).cast("bigint")
    shift = lambda value, bits: F.call_function("shiftright", value, bits)
    binned = (
        ranges.where(F.col(low) <= F.col(high))
        .withColumn("__bits", _bit_length(end - begin))
        .withColumn("__bin", F.explode(F.array_distinct(F.array(shift(begin, F.col("__bits")), shift(end, F.col("__bits"))))))
    )
    # One row per width: at most 63.
    widths = sorted(r[0] for r in binned.select("__bits").distinct().collect())
    at = F.col(point).cast("bigint")
    looked_up = points.where(F.col(point).isNotNull()).withColumn(
        "__level", F.explode(F.array(*[F.lit(w) for w in widths]).cast("array<int>"))
    ).withColumn("__at", shift(at, F.col("__level")))
    same_bin = (F.col("__level") == F.col("__bits")) & (F.col("__at") == F.col("__bin"))
    return looked_up.join(binned, same_bin & F.col(point).between(F.col(low), F.col(high))).drop(
        "__level", "__at", "__bits", "__bin"
    )


def range_totals(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, key: str, count: str, total: str) -> DataFrame:
    """Per ``key`` of the ranges: the number of pairs of :func:`range_join` and the sum of their points, without making the pairs.

    Points are folded into every dyadic bin (2 ** n numbers) that holds them, up to the length of the longest range. A range is the
    disjoint union of at most two bins of each width, so it looks up at most twice the logarithm of its length, however many points
    it holds and however many equal ones there are. Sums are decimals until the end, as a bin that no range takes may hold more than
    a bigint. Keys without pairs have no row. Ends must be less than 2 ** 62 apart.
    """
    shift = lambda value, bits: F.call_function("shiftright", value, bits)
    asked = ranges.where(F.col(low) <= F.col(high)).select(
        F.col(key).alias("__key"), F.col(low).cast("bigint").alias("__low"), F.col(high).cast("bigint").alias("__high"))
    length = asked.agg(F.max(F.col("__high") - F.col("__low") + 1)).first()[0] or 0
    levels = F.array(*[F.lit(n) for n in range(int(length).bit_length())]).cast("array<int>")
    folded = points.where(F.col(point).isNotNull()).groupBy(F.col(point).cast("bigint").alias("__point")).agg(
        F.count(F.lit(1)).alias("__count"), F.sum(F.col(point).cast("decimal(20,0)")).alias("__sum"))
    bins = (
        folded.withColumn("__level", F.explode(levels))
        .groupBy("__level", shift(F.col("__point"), F.col("__level")).alias("__bin"))
        .agg(F.sum("__count").alias("__count"), F.sum("__sum").alias("__sum"))
    )
    # At width 2 ** n the bins from ``first`` up to ``end`` lie inside; the outer ones that are no half of a wider bin inside are taken.
    first, end = -shift(-F.col("__low"), F.col("__level")), shift(F.col("__high") + 1, F.col("__level"))
    odd = lambda value: F.pmod(value, F.lit(2)) == 1
    pieces = (
        asked.withColumn("__level", F.explode(levels))
        .select("__key", "__level", first.alias("__first"), end.alias("__end"))
        .where("__first < __end")
        .select("__key", "__level", F.explode(F.array_compact(F.array(
            F.when(odd(F.col("__first")), F.col("__first")), F.when(odd(F.col("__end")), F.col("__end") - 1)))).alias("__bin"))
    )
    return pieces.join(bins, ["__level", "__bin"]).groupBy(F.col("__key").alias(key)).agg(
        F.sum("__count").alias(count), F.sum("__sum").cast("bigint").alias(total))


def with_range_values(df: DataFrame, ranges: DataFrame, code: Column, low: str, high: str, values: list[str]) -> DataFrame:
    """``df`` with ``values`` of the interval that holds ``code``; null where none does.

    Of several intervals the shortest counts, then the one that begins first, then the one with the smallest values.
    Codes are reduced to distinct ones before the range join, so a code that very many rows share is looked up once.
    """
    coded = df.withColumn("__code", code.cast("bigint"))
    codes = coded.select(F.col("__code").alias("__point")).where(F.col("__point").isNotNull()).distinct()
    named = ranges.select(F.col(low).cast("bigint").alias("__low"), F.col(high).cast("bigint").alias("__high"),
                          F.struct(*values).alias("__values"))
    best = F.min_by("__values", F.struct(F.col("__high") - F.col("__low"), "__low", "__values"))
    found = range_join(codes, named, "__point", "__low", "__high").groupBy("__point").agg(best.alias("__best"))
    return coded.join(found, F.col("__code") == F.col("__point"), "left").select(
        *df.columns, *[F.col("__best")[v].alias(v) for v in values]
    )


def with_place_of_ranges(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Municipality and county by four-digit postal code from a table (low, high, municipality, county), where missing
    or only a number."""
    code = F.when(F.col("postal_code").rlike("^[0-9]{4}$"), F.col("postal_code").try_cast("int"))
    places = ranges.select("low", "high", F.col("municipality").alias("__town"), F.col("county").alias("__county"))
    found = with_range_values(df, places, code, "low", "high", ["__town", "__county"])
    unknown = lambda c: F.col(c).isNull() | F.col(c).rlike("^[0-9]+$")
    filled = lambda c, place: F.when(unknown(c), F.coalesce(place, c)).otherwise(F.col(c))
    return found.withColumns({"municipality": filled("municipality", "__town"), "county": filled("county", "__county")}).drop(
        "__town", "__county"
    )
