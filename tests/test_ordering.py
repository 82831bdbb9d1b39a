import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.operators.ordering import oversized_groups, rows_before, rows_before_by_sort, with_rank
from basketflow.shared import as_table


def scattered(spark, rows=2000):
    rng = random.Random(5)
    values = [*range(60), *[None] * 5, float("nan"), float("inf")]
    data = [(rng.choice(("a", "a", "a", "b", None)), rng.choice(values), i) for i in range(rows)]
    data = [(g, None if v is None or g == "b" and i % 2 else float(v), i) for g, v, i in data]
    data += [("no value", None, rows + i) for i in range(30)]
    return spark.createDataFrame(data, "g string, v double, id long").repartition(5)


def _same(left, right) -> bool:
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_sorted_positions_equal_window_positions(spark):
    df = scattered(spark).withColumn("k", F.coalesce("g", F.lit("none")))
    order = [F.col("v"), F.desc("id")]
    assert _same(rows_before_by_sort(df, ["k"], order, "before"), rows_before(df, ["k"], order, "before"))


def test_positions_of_copies_are_all_used(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.lit(1).alias("v")).repartition(6)
    found = rows_before_by_sort(df, ["k"], [F.col("v")], "before")
    assert sorted(row.before for row in found.collect()) == list(range(1000))


def test_rank_of_large_groups_equals_rank(spark):
    df = as_table(scattered(spark), "scattered")
    large = with_rank(df, "g", "v", "place", max_group_rows=10)
    usual = df.withColumn("place", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    assert _same(large.select(*usual.columns), usual)
    assert _same(with_rank(df, "g", "v", "place"), usual)


def test_oversized(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 11)], "k string, n long")
    assert [row.k for row in oversized_groups(sizes, ["k"], "n", 10).collect()] == ["b"]
    assert oversized_groups(sizes, ["k"], "n", 11) is None
