"""Scores relative to the whole data set. An aspect may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlattice.operators.keyed import join_spread, materialise_sorted, running_position, top_per_key


def percentile_by_position(scores: DataFrame, group: str, score: str, key: str, out: str = "normalized_score") -> DataFrame:
    """``i / (n - 1)`` for the i-th of n rows of a group by (score, key); NULL in a group of one row.

    There are only a few groups, so a window per group would be a few huge tasks. Rows are numbered
    over the whole table instead, by range partitions of (group, score, key); equal scores are cut
    by key like any others. A group's first number is the row count of the groups before it.
    """
    numbered = running_position(scores, [group, score, key], "__place")
    sizes = numbered.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    # One row per group: the ordered window below runs over the group table, not over the scores.
    before = sizes.select(group, "__n", (F.sum("__n").over(Window.orderBy(group)) - F.col("__n")).alias("__first"))
    position = F.col("__place") - F.col("__first")
    return (
        numbered.join(F.broadcast(before), group)
        .withColumn(out, F.when(F.col("__n") >= 2, position / F.nullif(F.col("__n") - 1, F.lit(0))))
        .select(*scores.columns, out)
    )


def score_counts(scores: DataFrame, group: str, score: str) -> DataFrame:
    """Distinct scores of every group with the number of rows at or below, and the share of rows.

    Equal scores are counted before anything is ordered; the running total runs over the distinct
    scores, by range partitions.
    """
    counts = scores.groupBy(group, score).agg(F.count(F.lit(1)).alias("__c"))
    laid_out = materialise_sorted(counts, [group, score]).withColumn("__part", F.shiftright("__at", 33).cast("int"))
    here = F.sum("__c").over(Window.partitionBy("__part", group).orderBy(score))
    per_part = laid_out.groupBy("__part", group).agg(F.sum("__c").alias("__p"))
    # One row per (partition, group), so a number of rows in the order of the partition count.
    before = per_part.select(
        "__part",
        group,
        (F.sum("__p").over(Window.partitionBy(group).orderBy("__part")) - F.col("__p")).alias("__before"),
        F.sum("__p").over(Window.partitionBy(group)).alias("__n"),
    )
    return (
        laid_out.withColumn("__here", here)
        .join(F.broadcast(before), ["__part", group])
        .select(group, score, F.col("__c").alias("rows_at"), (F.col("__before") + F.col("__here")).alias("rows_up_to"),
                F.col("__n").alias("rows_in_group"))
    )


def percentile_by_share(scores: DataFrame, group: str, score: str, out: str = "normalized_score",
                        hot_share: float = 0.01) -> DataFrame:
    """Share of the group's rows with a score at or below the row's own.

    A single score may belong to a large part of the rows; scores above ``hot_share`` of a group
    (at most 1 / ``hot_share`` per group) are joined back by broadcast, the others by shuffle.
    """
    counts = score_counts(scores, group, score)
    lookup = counts.select(group, score, (F.col("rows_up_to") / F.col("rows_in_group")).alias(out))
    hot = counts.where(F.col("rows_at") >= F.col("rows_in_group") * hot_share).select(
        group, score, (F.col("rows_up_to") / F.col("rows_in_group")).alias(out)
    )
    return join_spread(scores, lookup, [group, score], hot)


def share_in_dataset(targets: DataFrame, dataset: DataFrame, group: str, score: str, key: str,
                     out: str = "normalized_score") -> DataFrame:
    """Share of ``dataset`` rows at or below each target's score; targets need not be in the data set.

    Targets and data set are sorted together once, and the number of data set rows before each
    target is its running total. Groups the data set lacks keep NULL.
    """
    both = dataset.select(
        group, score, F.lit(0).alias("__target"), F.lit(None).cast(targets.schema[key].dataType).alias(key),
        F.monotonically_increasing_id().alias("__row"),
    ).unionByName(
        targets.select(group, score, F.lit(1).alias("__target"), key, F.monotonically_increasing_id().alias("__row"))
    )
    laid_out = materialise_sorted(both, [group, score, "__target", "__row"]).withColumn(
        "__part", F.shiftright("__at", 33).cast("int")
    )
    in_data = F.when(F.col("__target") == 0, 1).otherwise(0)
    per_part = laid_out.groupBy("__part", group).agg(F.sum(in_data).alias("__p"))
    before = per_part.select(
        "__part",
        group,
        (F.sum("__p").over(Window.partitionBy(group).orderBy("__part")) - F.col("__p")).alias("__before"),
        F.sum("__p").over(Window.partitionBy(group)).alias("__n"),
    )
    here = F.sum(in_data).over(Window.partitionBy("__part", group).orderBy("__at"))
    return (
        laid_out.withColumn("__here", here)
        .where("__target = 1")
        .join(F.broadcast(before), ["__part", group])
        .select(key, group, score, ((F.col("__before") + F.col("__here")) / F.nullif(F.col("__n"), F.lit(0))).alias(out))
    )


def top_per_aspect(scores: DataFrame, aspect: str, score: str, key: str, k: int) -> DataFrame:
    """The ``k`` best rows of every aspect, ties by key."""
    return top_per_key(scores, aspect, [F.col(score).desc(), F.col(key).asc()], k)
