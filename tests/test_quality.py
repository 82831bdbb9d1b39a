from pyspark.sql import functions as F

from basketflow.operators.joins import duplicate_keys, orphan_counts
from basketflow.operators.quality import count_columns, null_cells, quality_report, reject_rate
from basketflow.shared import as_counted_table
from tests import builders
from tests.builders import by_key


def test_reject_rate(spark):
    df = spark.createDataFrame([(138047, 1890), (0, 0)], "read long, rejected long")
    rates = by_key(df.select("read", reject_rate(F.col("read"), F.col("rejected")).alias("rate")), "read", "rate")
    assert rates == {138047: 1.37, 0: 0.0}


def test_null_cells(spark):
    df = builders.users(spark, {"age": None, "city": None}, {"preferred_categories": None}, {})
    assert df.agg(null_cells(df.columns)).first()[0] == 3
    assert df.limit(0).agg(null_cells(df.columns)).first()[0] == 0


def test_orphans_count_rows_not_keys_and_skip_nulls(spark):
    facts = builders.transactions(
        spark,
        *({"user_id": user, "product_id": "P1"} for user in ("U1", "U9", "U9", None)),
    )
    references = {"user_id": builders.users(spark, {}), "product_id": builders.products(spark, {}, {})}
    assert by_key(orphan_counts(facts, references), "key", "nb_orphelins") == {"user_id": 2, "product_id": 0}


def test_report_uses_raw_references(spark):
    """A reference row that validation rejects still counts as known."""
    report = quality_report(
        builders.transactions(spark, {}, {"merchant_id": "M9"}, {"amount": None}),
        builders.users(spark, {"age": 3}),
        builders.products(spark, {}),
        builders.merchants(spark, {}),
    )
    columns = report.columns[1:]
    assert by_key(report, "dataset", *columns) == {
        "transactions": (3, 2, 1, 33.33, 1, 0, 0, 1),
        "users": (1, 0, 1, 100.0, 0, 0, 0, 0),
        "products": (1, 1, 0, 0.0, 0, 0, 0, 0),
        "merchants": (1, 1, 0, 0.0, 0, 0, 0, 0),
    }


def test_report_from_counts_of_the_write(spark):
    """Counts that the write of a table gives equal those of a scan, and the report scans transactions for keys only."""
    tables = {
        "transactions": builders.transactions(spark, {}, {"merchant_id": "M9"}, {"amount": None}),
        "users": builders.users(spark, {"age": 3}),
        "products": builders.products(spark, {}).limit(0),
        "merchants": builders.merchants(spark, {}),
    }
    stored, known = {}, {}
    for name, df in tables.items():
        stored[name], known[name] = as_counted_table(df, name, count_columns(df.columns, name))
    report = quality_report(**stored, known=known)
    scans = [line for line in report._jdf.queryExecution().executedPlan().toString().splitlines() if "Scan parquet" in line]
    assert len(scans) == 4 and not any("amount" in line for line in scans)
    assert sorted(report.collect()) == sorted(quality_report(**tables).collect())


def test_report_of_empty_tables(spark):
    tables = [getattr(builders, name)(spark, {}).limit(0) for name in ("transactions", "users", "products", "merchants")]
    assert {tuple(row)[1:] for row in quality_report(*tables).collect()} == {(0, 0, 0, 0.0, 0, 0, 0, 0)}


def test_duplicate_keys(spark):
    df = builders.users(spark, {}, {}, {"user_id": "U2"}, {"user_id": None}, {"user_id": None})
    assert by_key(duplicate_keys(df, "user_id"), "user_id", "nb_lignes") == {"U1": 2}
