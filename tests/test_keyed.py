import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adlattice.operators import percentiles
from adlattice.operators.keyed import first_per_key, join_spread, latest_per_key, materialise_sorted, previous_per_key, running_position, top_per_key


def skewed(spark, rows=6000):
    """One key holds a third of the rows; values repeat and are sometimes NULL; times tie."""
    source = random.Random(3)
    data = [
        (1 if source.random() < 0.34 else source.randint(2, 300), source.randint(0, 900), i, source.choice([None, 1.0, 2.0, 3.0]))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "k bigint, t bigint, id bigint, v double")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_previous_across_segments(uncoalesced):
    spark = uncoalesced
    df = skewed(spark).withColumn("s", F.struct("v"))
    df = df.withColumn("t", F.when(F.col("id") % 50 != 0, F.col("t"))).withColumn("k", F.when(F.col("id") % 31 != 0, F.col("k")))
    plain = df.withColumn("before", F.lag("s").over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows_of(previous_per_key(df, "k", "t", "id", "s", "before").select(*plain.columns)) == rows_of(plain)
    assert previous_per_key(df.limit(0), "k", "t", "id", "s", "before").count() == 0


@pytest.fixture
def uncoalesced(spark):
    """Small tables keep all their partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_previous_of_one_key_and_moment(uncoalesced):
    """All rows share key and time; they still are cut over several segments, and none is lost at their borders."""
    spark = uncoalesced
    df = spark.range(5000).select(F.lit(1).alias("k"), F.lit(9).alias("t"), "id", F.struct((F.col("id") % 7).alias("v")).alias("s"))
    assert materialise_sorted(df, ["k", "t", "id"]).select(F.shiftright("__at", 33)).distinct().count() > 1
    have = previous_per_key(df, "k", "t", "id", "s", "before").select("id", F.col("before.v")).orderBy("id").collect()
    assert [r["v"] for r in have] == [None, *[i % 7 for i in range(4999)]]


def test_latest_first_and_top(spark):
    df = skewed(spark)
    expect = df.groupBy("k").agg(F.max_by(F.struct("t", "id"), F.struct("t", "id")).alias("m")).select("k", "m.t", "m.id")
    assert rows_of(latest_per_key(df, "k", ["t", "id"]).select("k", "t", "id")) == rows_of(expect)
    first = df.groupBy("k").agg(F.min_by(F.struct("t", "id"), F.struct("t", "id")).alias("m")).select("k", "m.t", "m.id")
    assert rows_of(first_per_key(df, ["k"], ["t", "id"]).select("k", "t", "id")) == rows_of(first)
    assert top_per_key(df, "k", [F.col("t")], 3).groupBy("k").count().agg(F.max("count")).first()[0] == 3


def test_latest_plan_limits_before_shuffle(spark):
    plan = latest_per_key(skewed(spark), "k", ["t", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_join_spread(spark):
    rows = skewed(spark)
    lookup = rows.groupBy("k").agg(F.sum("id").alias("total")).where("k % 7 <> 0")
    expect = rows.join(lookup, "k", "left")
    for hot in (lookup.where("k = 1"), lookup.where("k < 0")):
        have = join_spread(rows, lookup, ["k"], hot)
        assert rows_of(have.select(*expect.columns)) == rows_of(expect)


def test_running_position(spark):
    df = skewed(spark)
    ids = [r["id"] for r in running_position(df, ["v", "k", "id"], "place").orderBy("place").collect()]
    assert ids == [r["id"] for r in df.orderBy("v", "k", "id").collect()]


def test_percentiles_with_large_ties(spark):
    """Most rows share one score; both definitions still equal the plain windows."""
    source = random.Random(4)
    data = [(source.choice("aab"), 0.35 if source.random() < 0.6 else round(source.random(), 2), i) for i in range(3000)] + [("c", 0.1, 9999)]
    df = spark.createDataFrame(data, "aspect string, score double, id bigint")
    by_aspect = Window.partitionBy("aspect")
    place = F.row_number().over(by_aspect.orderBy("score", "id")) - 1
    n = F.count(F.lit(1)).over(by_aspect)
    expect = df.withColumn("p", F.when(n >= 2, place / F.nullif(n - 1, F.lit(0))))
    assert rows_of(percentiles.percentile_by_position(df, "aspect", "score", "id", "p")) == rows_of(expect)
    share = df.withColumn("p", F.cume_dist().over(by_aspect.orderBy("score")))
    for hot_share in (0.01, 0.9):
        have = percentiles.percentile_by_share(df, "aspect", "score", "p", hot_share)
        assert rows_of(have.select(*share.columns)) == rows_of(share)


def test_share_of_rows_outside_the_dataset(spark):
    data = spark.createDataFrame([("a", s) for s in (0.1, 0.2, 0.2, 0.9)], "aspect string, score double")
    targets = spark.createDataFrame([(1, "a", 0.05), (2, "a", 0.2), (3, "a", 1.0), (4, "b", 0.5)], "id bigint, aspect string, score double")
    have = {r["id"]: r["p"] for r in percentiles.share_in_dataset(targets, data, "aspect", "score", "id", "p").collect()}
    assert have == {1: 0.0, 2: 0.75, 3: 1.0, 4: None}
