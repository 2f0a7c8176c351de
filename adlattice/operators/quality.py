"""Constraints and informative-row gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields that make a parsed page worth keeping; the loader also accepts a description.
INFORMATIVE = [
    "title", "price", "year", "make", "model", "engine_make", "engine_type", "engine_effect_hp", "width_cm",
    "depth_cm", "sleepers", "seats", "registration_number", "municipality", "county", "postal_code", "lat", "lng",
]
INFORMATIVE_FOR_LOAD = ["title", "description", *INFORMATIVE[1:]]


def present(df: DataFrame, name: str) -> Column:
    """Neither NULL nor '' nor an empty array; zero counts as present."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        return F.coalesce(value != "", F.lit(False))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(value) > 0, F.lit(False))
    return value.isNotNull()


def informative_rows(df: DataFrame, fields: list[str] = INFORMATIVE) -> DataFrame:
    """Rows with at least one informative field."""
    return df.where(reduce(lambda a, b: a | b, [present(df, f) for f in fields if f in df.columns]))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per NOT NULL column as (column_name, nulls), in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent lacks."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def cascade_prune(child: DataFrame, parent: DataFrame, key: str = "ad_id") -> DataFrame:
    """Child rows that survive when rows are deleted from the parent."""
    return child.join(parent.select(key), key, "left_semi")


def split_not_null(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) rows for NOT NULL columns, so one bad row cannot fail a load."""
    good = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(good), df.where(~good)


def key_violations(df: DataFrame, keys: list[str], not_null: list[str], parent: DataFrame | None = None,
                   parent_key: str = "ad_id") -> DataFrame:
    """Constraint report of a table: (constraint_name, violations)."""
    groups = duplicate_keys(df, keys).agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("violations"))
    report = groups.select(F.lit("unique").alias("constraint_name"), "violations").unionByName(
        null_counts(df, not_null).select(
            F.concat(F.lit("not_null:"), F.col("column_name")).alias("constraint_name"), F.col("nulls").alias("violations")
        )
    )
    if parent is not None:
        missing = orphans(df, parent, parent_key).agg(F.count(F.lit(1)).alias("violations"))
        report = report.unionByName(missing.select(F.lit("foreign_key").alias("constraint_name"), "violations"))
    return report
