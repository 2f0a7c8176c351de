import random

from pyspark.sql import functions as F

from adlattice.operators.items import with_place_of_code
from adlattice.operators.ranges import range_join, range_totals, with_place_of_ranges


def test_range_join_is_the_nested_loop(spark):
    source = random.Random(4)
    points = [(i, source.choice([None, source.randint(-300, 300), 7, 2 ** 61])) for i in range(400)]
    ranges = [(i, *source.choice([(a, a + source.choice([0, 1, 5, 64, 500, -3])) for a in range(-320, 320)])) for i in range(200)]
    ranges += [(900, None, 5), (901, -5, None), (902, -(2 ** 60), 2 ** 60), (903, 7, 7), (904, 2 ** 61, 2 ** 61), (903, 7, 7)]
    p = spark.createDataFrame(points, "id bigint, x bigint")
    r = spark.createDataFrame(ranges, "rid bigint, low bigint, high bigint")
    have = sorted((h["id"], h["rid"]) for h in range_join(p, r, "x", "low", "high").collect())
    assert have == sorted((i, j) for i, x in points for j, a, b in ranges
                          if None not in (x, a, b) and a <= x <= b)
    assert range_join(p, r.limit(0), "x", "low", "high").count() == 0
    assert range_join(p.limit(0), r, "x", "low", "high").count() == 0


def test_range_join_has_no_nested_loop(spark):
    plan = range_join(spark.range(100).select(F.col("id").alias("x")), spark.range(50).select("id", (F.col("id") + 9).alias("high")),
                      "x", "id", "high")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_totals_are_those_of_the_pairs(spark):
    source = random.Random(9)
    points = [(source.choice([None, source.randint(-300, 300), 7, 7, 2 ** 55]),) for _ in range(500)] + [(2 ** 62 - 1,)] * 3
    ranges = [(i % 150, *source.choice([(a, a + source.choice([0, 1, 2, 5, 64, 127, 500, -3])) for a in range(-320, 320)])) for i in range(300)]
    ranges += [(900, None, 5), (901, -5, None), (902, -(2 ** 60), 2 ** 60), (903, 7, 7), (904, 2 ** 55, 2 ** 55), (903, 7, 7), (905, 400, 900)]
    p, r = spark.createDataFrame(points, "x bigint"), spark.createDataFrame(ranges, "rid bigint, low bigint, high bigint")
    pairs = range_join(p, r, "x", "low", "high").groupBy("rid").agg(F.count("x"), F.sum("x"))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(range_totals(p, r, "x", "low", "high", "rid", "n", "total")) == key(pairs)
    assert range_totals(p, r.limit(0), "x", "low", "high", "rid", "n", "total").count() == 0
    assert range_totals(p.limit(0), r, "x", "low", "high", "rid", "n", "total").count() == 0


def test_range_totals_make_no_pairs(spark):
    """20,000 equal points in 20,000 equal ranges are 400,000,000 pairs; the totals come from a row or two per range."""
    p = spark.range(20_000).select(F.lit(5).alias("x"))
    r = spark.range(20_000).select("id", F.lit(0).alias("low"), F.lit(9).alias("high"))
    totals = range_totals(p, r, "x", "low", "high", "id", "n", "total")
    assert totals.selectExpr("min(n)", "max(n)", "min(total)", "max(total)", "count(*)").first()[:] == (20_000, 20_000, 100_000, 100_000, 20_000)
    joined = [line for line in totals._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(joined) == 1 and "<=" not in joined[0]


def test_place_of_ranges_equals_the_literal_lookup(spark):
    listed = [(1, 1299, "Oslo", "Oslo"), (5003, 5268, "Bergen", "Vestland")]
    codes = ["0001", "1299", "1300", "0000", "5100", "51", None, "x", "05100"]
    rows = spark.createDataFrame(
        [(c, m, k) for c in codes for m in (None, "12", "Known") for k in (None, "9", "Kept")],
        "postal_code string, municipality string, county string")
    table = spark.createDataFrame(listed, "low int, high int, municipality string, county string")
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(with_place_of_ranges(rows, table)) == key(with_place_of_code(rows, listed))
