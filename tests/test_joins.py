import pytest
from pyspark.sql import functions as F

from basketflow.operators.joins import broadcast_if_small, lookup
from basketflow.plans.enrichment import with_dimensions
from basketflow.schemas import USER_ATTRIBUTES
from tests import builders
from tests.builders import by_key


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_every_fact_row_stays(spark):
    facts = builders.transactions(
        spark, *({"transaction_id": f"T{i}", "user_id": user} for i, user in enumerate(("U1", "U9", None)))
    )
    dimension = builders.users(spark, {"age": 40}, {"user_id": None, "age": 99})
    joined = lookup(facts, dimension, "user_id", USER_ATTRIBUTES)
    assert by_key(joined, "transaction_id", "user_id", "age") == {
        "T0": ("U1", 40),
        "T1": ("U9", None),
        "T2": (None, None),
    }
    assert joined.columns == facts.columns + [output for _, output in USER_ATTRIBUTES]


def test_names_are_kept_apart(spark):
    """The transaction's category and merchant stay next to the merchant's and product's own."""
    row = with_dimensions(
        builders.transactions(spark, {"category": "Books", "merchant_id": "M2"}),
        builders.users(spark, {}),
        builders.products(spark, {"category": "Home", "merchant_id": "M1", "name": "Lamp"}),
        builders.merchants(spark, {"merchant_id": "M2", "category": "Toys", "name": "Shop"}),
    ).first()
    assert (row.category, row.product_name, row.merchant_name, row.merchant_category) == (
        "Books", "Lamp", "Shop", "Toys",
    )


def test_broadcast_only_when_asked_and_small(spark):
    dimension = builders.users(spark, *({"user_id": f"U{i}"} for i in range(5)))
    assert "ResolvedHint" in plan(broadcast_if_small(dimension, True, max_rows=5))
    assert "ResolvedHint" not in plan(broadcast_if_small(dimension, True, max_rows=4))
    assert "ResolvedHint" not in plan(broadcast_if_small(dimension, False))


def test_broadcast_changes_nothing(spark):
    tables = [
        builders.transactions(spark, {}, {"transaction_id": "T2", "user_id": None, "product_id": "P9"}),
        builders.users(spark, {}),
        builders.products(spark, {}),
        builders.merchants(spark, {}),
    ]
    assert sorted(with_dimensions(*tables).collect()) == sorted(with_dimensions(*tables, broadcast=True).collect())


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts, and partitions count as skewed from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def _facts(spark, hot):
    user = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("U"), (F.col("id") % 500).cast("string")))
    return spark.range(0, 60_000, numPartitions=12).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("transaction_id"), user.alias("user_id")
    )


def test_hot_key_is_split(shuffled_joins):
    """A third of the rows has one key: the adaptive plan reads its partition in pieces."""
    spark = shuffled_joins
    dimension = builders.users(spark, *({"user_id": f"U{i}", "age": 20 + i % 50} for i in range(500)))
    joined = lookup(_facts(spark, "U7"), dimension, "user_id", USER_ATTRIBUTES)
    assert joined.where(F.col("age").isNotNull()).count() == 60_000
    assert "skew=true" in _executed(joined)


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_null_keys_are_spread(shuffled_joins):
    spark = shuffled_joins
    dimension = builders.users(spark, *({"user_id": f"U{i}"} for i in range(500)))
    joined = lookup(_facts(spark, None), dimension, "user_id", USER_ATTRIBUTES)
    assert "skew=true" not in _executed(joined)
    sizes = [row[1] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert joined.count() == 60_000 and max(sizes) < 20_000
