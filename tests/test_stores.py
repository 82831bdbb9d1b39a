"""Partial results of batches against the operators over all rows at once."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from basketflow.functions.calendar import with_transaction_date
from basketflow.operators import cohorts, merchants
from basketflow.operators.cohort_store import CohortStore
from basketflow.operators.merchant_store import MerchantStore
from basketflow.operators.user_bitmaps import extend_numbers, merged_sets, set_sizes, user_sets
from basketflow.shared import as_table, new_path
from basketflow.sinks.batches import BatchTable
from tests import builders


def same(left, right) -> bool:
    left = left.select(*right.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture
def path(spark):
    return new_path(spark, "store")


@pytest.fixture(scope="module")
def enriched(spark):
    """Merchants with many and few users, one with no user at all, rows without date, user, merchant or amount."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        merchant = rng.choice(("M1", "M1", "M2", "M3", "M4", None))
        month = rng.choice(("01", "02", "05"))
        rows.append(
            (
                f"T{i}", None if merchant == "M4" else rng.choice((None, "U1", f"U{rng.randint(1, 80)}")), merchant,
                None if merchant is None else f"name {merchant}", rng.choice(("A", "B")) if merchant == "M2" else "A",
                None if merchant == "M3" else "North", 0.1, rng.choice((None, rng.randint(1, 9000) / 100)),
                rng.choice(("Jeune", "Adulte", None)), rng.choice((0, 0, 1)),
                rng.choice((f"2024{month}{rng.randint(1, 28):02}101500",) * 8 + ("no date",)),
            )
        )
    schema = """transaction_id string, user_id string, merchant_id string, merchant_name string, merchant_category string,
        region string, commission_rate double, amount double, age_group string, is_suspicious int, timestamp string"""
    return as_table(with_transaction_date(spark.createDataFrame(rows, schema)), "enriched")


def parts(df, n):
    return [(f"part-{k}", df.where(F.crc32(F.col("transaction_id").cast("binary")) % n == k)) for k in range(n)]


def test_numbers_are_dense_and_stay(spark, path):
    users = spark.range(500).select(F.concat(F.lit("U"), F.col("id") % 300).alias("who")).repartition(7)
    first = {r.user_id: r.number for r in extend_numbers(spark, path, users.where("who < 'U2'")).collect()}
    assert sorted(first.values()) == list(range(1, len(first) + 1))
    every = {r.user_id: r.number for r in extend_numbers(spark, path, users).collect()}
    assert sorted(every.values()) == list(range(1, 301)) and first.items() <= every.items()
    nobody = users.select(F.lit(None).cast("string"))
    assert {r.user_id: r.number for r in extend_numbers(spark, path, nobody).collect()} == every


def test_sets_over_many_buckets(spark, path):
    """Numbers on both sides of the bounds of buckets."""
    numbers = spark.range(1, 100_001).select(F.concat(F.lit("U"), "id").alias("user_id"), F.col("id").alias("number"))
    visits = spark.createDataFrame(
        [(g, f"U{n}") for g, ns in (("a", (1, 32768, 32769, 65536, 65537, 100000)), ("b", (32769, 5)), ("c", (5, 5))) for n in ns]
        + [("d", None)],
        "g string, user_id string",
    )
    sets = user_sets(visits, numbers, ["g"])
    assert {r.g: r.n for r in set_sizes(sets, ["g"], "n").collect()} == {"a": 6, "b": 2, "c": 1}
    assert merged_sets(sets, []).count() == 4
    assert set_sizes(sets, [], "n").first().n == 7


@pytest.mark.parametrize("n", [1, 3])
def test_merchant_totals_of_batches(spark, path, enriched, n):
    store = MerchantStore(spark, path)
    for batch, rows in parts(enriched, n):
        store.load(batch, rows)
    assert same(store.totals(), merchants.merchant_totals(enriched))
    assert store.totals().schema["nb_clients_uniques"].dataType == merchants.merchant_totals(enriched).schema["nb_clients_uniques"].dataType
    assert same(merchants.with_merchant_ranks(store.totals()), merchants.merchant_kpis(enriched))


def test_merchant_totals_of_some_days(spark, path, enriched):
    store = MerchantStore(spark, path)
    for batch, rows in parts(enriched, 2):
        store.load(batch, rows)
    day = F.to_date("transaction_date")
    first, last = date(2024, 1, 20), date(2024, 2, 10)
    assert same(store.totals(first, last), merchants.merchant_totals(enriched.where((day >= first) & (day <= last))))
    assert same(store.totals(last=last), merchants.merchant_totals(enriched.where(day <= last)))


def test_a_merchant_batch_is_replaced(spark, path, enriched):
    store = MerchantStore(spark, path)
    store.load("x", enriched.where("merchant_id = 'M1'"))
    store.load("x", enriched)
    store.load("empty", enriched.limit(0))
    assert same(store.totals(), merchants.merchant_totals(enriched))


@pytest.mark.parametrize("n", [1, 3])
def test_cohorts_of_batches(spark, path, enriched, n):
    store = CohortStore(spark, path)
    for batch, rows in parts(enriched, n):
        store.load(batch, rows)
    firsts = cohorts.first_purchase(enriched)
    assert same(store.first_purchase(), firsts)
    assert same(store.sizes(), cohorts.cohort_sizes(firsts))
    assert same(store.retention(), cohorts.cohort_retention(enriched))


def test_only_touched_months_are_written(spark, path, enriched):
    store = CohortStore(spark, path)
    month = F.date_format("transaction_date", "yyyy-MM")
    store.load("old", enriched.where(month < "2024-05"))
    store.load("new", enriched.where(month == "2024-05"))
    files = spark.read.parquet(f"{path}/months").select("batch", F.col("active_month").cast("string")).distinct().collect()
    assert sorted(map(tuple, files)) == [("new", "2024-05-01"), ("old", "2024-01-01"), ("old", "2024-02-01")]
    assert same(store.retention(), cohorts.cohort_retention(enriched))


def test_stores_without_rows(spark, path):
    none = with_transaction_date(builders.transactions(spark, {})).limit(0)
    store = CohortStore(spark, path)
    store.load("x", none)
    assert store.retention().isEmpty() and store.sizes().isEmpty() and store.first_purchase().isEmpty()


def test_batch_table_reads_partitions(spark, path):
    table = BatchTable(spark, path, "v int, day date", by="day")
    rows = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)], "v int, day date")
    assert table.of("a").isEmpty()
    table.write("a", rows)
    table.write("2024-01-01", rows.where("v = 1"))
    assert sorted(r.v for r in table.read().collect()) == [1, 1, 2, 3]
    assert [r.v for r in table.read().where("day is null").collect()] == [3]
    text = table.read().where("day = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text
    with pytest.raises(ValueError, match="batch"):
        table.write("a b", rows)
