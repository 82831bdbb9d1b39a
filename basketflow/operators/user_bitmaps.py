"""Exact distinct users that can be added up: bitmaps over users with dense numbers.

Sets of users that were counted apart (days, batches) are merged by or, which a number of users cannot be. A bitmap covers
32,768 numbers in 4 KB, so the rows of a set grow with the users there are and not with the transactions.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.shared import as_table, exists

# monotonically_increasing_id() keeps the partition number above this bit and the row number below.
_ROW_BITS = 33

NUMBERS = "user_id string, number long"


def extend_numbers(spark: SparkSession, path: str, users: DataFrame) -> DataFrame:
    """Numbers from 1 on, without gaps, for the users (one column) that have none yet. Returns all of them.

    A user keeps its number for good, so this may be repeated. Null is no user.
    """
    known = spark.read.schema(NUMBERS).parquet(path) if exists(spark, path) else spark.createDataFrame([], NUMBERS)
    last = known.agg(F.max("number")).first()[0] or 0
    named = users.toDF("user_id").where("user_id is not null").distinct()
    # ids of rows hold for one run only, so they are stored
    new = as_table(named.join(known, "user_id", "left_anti").withColumn("slot", F.monotonically_increasing_id()), "new_users")
    piece = F.shiftright("slot", _ROW_BITS)
    # one row per task of the step before
    pieces = new.groupBy(piece.alias("piece")).agg(F.min("slot").alias("first"), F.count("*").alias("n"))
    earlier = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("piece", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    number = F.col("offset") + F.col("slot") - F.col("first") + 1 + last
    numbered = new.withColumn("piece", piece).join(F.broadcast(offsets), "piece").select("user_id", number.alias("number"))
    numbered.write.mode("append").parquet(path)
    return spark.read.schema(NUMBERS).parquet(path)


def user_sets(visits: DataFrame, numbers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The users of each group as bitmaps: ``keys``, bucket (of 32,768 numbers) and users.

    ``visits`` has the keys and ``user_id``; rows without a user count for none. A pair of group and user meets the
    numbers once, whatever the rows.
    """
    pairs = visits.where("user_id is not null").select(*keys, "user_id").distinct()
    number = F.col("number")
    return (
        pairs.join(numbers, "user_id")
        .groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("users"))
    )


def merged_sets(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets of fewer keys, or of several batches, as one per group."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def set_sizes(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct users of each group."""
    return merged_sets(sets, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias(name))
