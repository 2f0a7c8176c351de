"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations alone.

The documents of a source, in id order, form blocks. Block j of a source with weight w may start at slot floor(j / w) and
must be done by slot ceil((j + 1) / w). Weights are whole shares of a period, and one period is scheduled slot by slot:
of the released blocks the one with the earliest deadline runs. As the weights fill the period exactly, every block meets
its deadline, so after any number of slots a source is less than one block away from its target. Later periods repeat
the first. The schedule has one row per slot of the period, whatever the size of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlattice.operators.keyed import running_position

PERIOD = 1000
BLOCK_ROWS = 16


def tempered_weights(sources: DataFrame, temperature: float = 0.5, period: int = PERIOD) -> DataFrame:
    """(source, quota): shares of the period in proportion to rows ** temperature, by largest remainder.

    ``sources`` has (source, rows), one row per source. Every source gets at least one slot; the period must be longer
    than the number of sources.
    """
    everything = Window.partitionBy()
    share = (F.lit(period) - F.count(F.lit(1)).over(everything)) * F.col("__w") / F.sum("__w").over(everything)
    ranked = Window.partitionBy().orderBy(F.desc(F.col("__share") - F.floor("__share")), F.col("source").asc_nulls_first())
    left = F.lit(period) - F.sum(F.floor("__share") + 1).over(everything)
    return (
        sources.withColumn("__w", F.pow(F.col("rows").cast("double"), F.lit(temperature)))
        .withColumn("__share", F.round(share, 9))
        .withColumn("quota", F.floor("__share") + 1 + F.when(F.row_number().over(ranked) <= left, 1).otherwise(0))
        .select("source", F.col("quota").cast("int").alias("quota"))
    )


def schedule(quotas: DataFrame, period: int = PERIOD) -> DataFrame:
    """(source, turn, slot) of one period: the slot of each source's turn-th block.

    ``quotas`` has (source, quota) with quotas that add up to ``period``. Ties between deadlines go to the source that
    sorts first. The fold is one expression over the period; its state is one count per source.
    """
    def deadline(q: Column, done: Column) -> Column:
        return F.ceil((done + 1) * F.lit(period) / q).cast("int")

    def released(q: Column, done: Column, slot: Column) -> Column:
        return (done < q) & (F.floor(done * F.lit(period) / q).cast("int") <= slot)

    def step(state: Column, slot: Column) -> Column:
        waiting = F.transform(
            F.sequence(F.lit(1), F.size("q")),
            lambda i: F.when(
                released(F.element_at(F.col("q"), i), F.element_at(state["done"], i), slot),
                F.struct(deadline(F.element_at(F.col("q"), i), F.element_at(state["done"], i)).alias("due"), i.alias("i")),
            ),
        )
        # A lambda variable holds the pick, so that it is found once per slot and not once per source.
        after = lambda pick: F.struct(
            F.transform(state["done"], lambda d, k: d + F.when(k + 1 == pick, 1).otherwise(0)).alias("done"),
            F.concat(state["run"], F.array(pick)).alias("run"),
        )
        return F.element_at(F.transform(F.array(F.array_min(waiting)["i"]), after), 1)

    start = F.struct(F.transform("q", lambda q: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("run"))
    lists = quotas.agg(F.array_sort(F.collect_list(F.struct("source", "quota"))).alias("s")).select(
        F.col("s.source").alias("sources"), F.col("s.quota").alias("q")
    )
    run = lists.select(
        "sources", F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, step, lambda s: s["run"]).alias("run")
    )
    slots = run.select("sources", F.posexplode("run").alias("slot", "i")).where(F.col("i").isNotNull())
    turns = Window.partitionBy("i").orderBy("slot")
    return slots.select(
        F.element_at("sources", F.col("i")).alias("source"),
        (F.row_number().over(turns) - 1).cast("long").alias("turn"), F.col("slot").cast("long").alias("slot"),
    )


def mix_sources(df: DataFrame, id_col: str = "doc_id", source: str = "source", weights: dict[str, int] | None = None,
                temperature: float = 0.5, period: int = PERIOD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Places of all documents in the mix: (doc_id, source, block, slot, mix_position).

    ``block`` is the document's block within its source, ``slot`` the block's slot in the endless schedule, and
    ``mix_position`` the document's place in the whole mix, 0,1,2,... without gaps. ``weights`` gives shares by source
    in whole slots and must add up to ``period`` and name every source; without it shares are rows ** temperature, and the
    period is at least ten slots per source.
    No document is repeated or dropped: once a source has run out its slots stay empty and the others keep their
    proportions to each other. Rows equal in id and source take one place together, so one row is returned for them.
    A null source is a source of its own, null ids come first. An empty table gives no rows.
    """
    spark: SparkSession = df.sparkSession
    places = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source")).distinct()
    # Numbered over (source, id) in one global order: a source of any size is cut over many tasks.
    numbered = running_position(places, ["source", "doc_id"], "__n")
    sizes = numbered.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.min("__n").alias("__from"))
    if weights is None:
        period = max(period, 10 * sizes.count())
        quotas = tempered_weights(sizes.select("source", "rows"), temperature, period)
    else:
        if sum(weights.values()) != period:
            raise ValueError("weights must add up to the period")
        quotas = spark.createDataFrame(list(weights.items()), "source string, quota int")
    planned = schedule(quotas, period).select(F.col("source").alias("__ps"), F.col("turn").alias("__pt"), F.col("slot").alias("__slot"))
    named = quotas.select(F.col("source").alias("__qs"), "quota")
    by_source = sizes.join(named, F.col("source").eqNullSafe(F.col("__qs"))).select(
        F.col("source").alias("__s"), "__from", "quota")
    # One row per source, and one per slot of the period: both bounded by the period.
    blocks = (
        numbered.join(F.broadcast(by_source), F.col("source").eqNullSafe(F.col("__s")))
        .select("doc_id", "source", "quota", (F.col("__n") - F.col("__from")).alias("__r"),
                F.expr(f"(__n - __from) div {block_rows}").alias("block"))
        .withColumn("__turn", F.col("block") % F.col("quota"))
    )
    slotted = blocks.join(
        F.broadcast(planned), F.col("source").eqNullSafe(F.col("__ps")) & (F.col("__turn") == F.col("__pt"))
    ).select("doc_id", "source", "block", "__r",
             (F.expr("block div quota") * F.lit(period) + F.col("__slot")).alias("slot"))
    return running_position(slotted, ["slot", "__r"], "mix_position").drop("__r")


def in_mix_order(df: DataFrame, places: DataFrame, id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """All rows of ``df`` laid out in mix order: partition after partition, and sorted within each."""
    at = places.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), "mix_position")
    return (
        df.join(at, F.col(id_col).eqNullSafe(F.col("__id")) & F.col(source).eqNullSafe(F.col("__source")))
        .drop("__id", "__source")
        .repartitionByRange("mix_position")
        .sortWithinPartitions("mix_position")
        .drop("mix_position")
    )


def with_file_order(df: DataFrame, out: str) -> DataFrame:
    """Rows of a table read from files numbered 0,1,2,... in ``out``: files in name order, rows in file order."""
    named = df.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = named.groupBy(F.col("__file").alias("__name")).agg(F.count(F.lit(1)).alias("__rows"))
    # One row per file. From part 100000 on names are longer.
    in_order = Window.orderBy(F.length("__name"), "__name")
    before = sizes.select("__name", (F.sum("__rows").over(in_order) - F.col("__rows")).alias("__before"))
    return (
        named.join(F.broadcast(before), F.col("__file") == F.col("__name"))
        .withColumn(out, F.col("__before") + F.col("__row"))
        .drop("__file", "__row", "__name", "__before")
    )
