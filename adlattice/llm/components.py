"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlattice.session import materialise


def _rows(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """One row (a, b) for each of the column pairs of every row."""
    both = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs])
    return df.select(F.explode(both).alias("__e")).select("__e.a", "__e.b")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller and own) neighbours of every node to the smallest node around it."""
    if large:
        around = _rows(edges, ("a", "b"), ("b", "a"))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("m", "a").alias("m"))
    joined = around.join(least, F.col("a") == F.col("n")).select("a", "b", "m")
    linked = _rows(joined.where(F.col("b") > F.col("a")), ("b", "m")) if large else _rows(joined, ("b", "m"), ("a", "m"))
    return linked.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): label is the smallest node that can be reached.

    Nodes may be of any orderable type; edges with a null end are ignored. Every round is written to the shared folder.
    A node of any degree is only ever aggregated and joined by key, never gathered. The number of rounds grows with the
    logarithm of the longest chain. Without edges there are no rows.
    """
    edges = materialise(
        edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    )
    seen = None
    while True:
        edges = materialise(_star(_star(edges, True), False))
        # Every node but the smallest has one edge to a label once a round changes nothing.
        # In whole numbers: sums of fractions depend on the order of the tasks.
        code = F.xxhash64("a", "b")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(code, F.lit(1 << 31))), F.bit_xor(code)).first()
        if state == seen:
            break
        seen = state
    return _rows(edges, ("a", "b"), ("b", "b")).distinct().toDF("node", "label")
