"""Merchant, cohort, product and revenue reports on rows small enough to check by hand."""

from datetime import datetime

from pyspark.sql import functions as F

from basketflow.operators.cohorts import best_cohort, cohort_retention, cohort_sizes, first_purchase
from basketflow.operators.merchants import KPI_COLUMNS, merchant_kpis
from basketflow.operators.products import top_products
from basketflow.operators.revenue import by_category_and_region, by_payment_and_period
from tests.builders import by_key

WIDE = """user_id string, product_id string, merchant_id string, amount double, transaction_date timestamp,
    payment_method string, category string, age_group string, product_name string, rating double, stock int,
    merchant_name string, merchant_category string, region string, commission_rate double, day_period string,
    is_suspicious int"""


def wide(spark, *rows: dict):
    blank = {
        "user_id": "U1",
        "product_id": "P1",
        "merchant_id": "M1",
        "amount": 10.0,
        "transaction_date": datetime(2024, 1, 31, 12),
        "payment_method": "CARD",
        "category": "Books",
        "age_group": "Adulte",
        "product_name": "Lamp",
        "rating": 4.0,
        "stock": 5,
        "merchant_name": "Shop",
        "merchant_category": "Home",
        "region": "North",
        "commission_rate": 0.1,
        "day_period": "Morning",
        "is_suspicious": 0,
    }
    return spark.createDataFrame([{**blank, **row} for row in rows], WIDE)


def test_merchant_kpis(spark):
    df = wide(
        spark,
        {"amount": 10.0, "user_id": "U1", "age_group": "Jeune"},
        {"amount": 20.0, "user_id": "U1", "age_group": None, "is_suspicious": 1},
        {"amount": 3.33, "user_id": None, "age_group": "Âge Moyen"},
        {"amount": 33.33, "merchant_id": "M2", "merchant_name": "Other", "age_group": "Senior"},
        {"amount": 50.0, "merchant_id": "M3", "merchant_name": "Third", "merchant_category": "Toys"},
        {"amount": 99.0, "merchant_id": "M4", "merchant_name": None},
    )
    result = merchant_kpis(df)
    assert result.columns == KPI_COLUMNS
    found = by_key(result, *[c for c in KPI_COLUMNS if c not in ("merchant_name", "merchant_category", "region")])
    assert found == {
        "M1": (33.33, 3, 1, 11.11, 1, 2, 3.33, 10.0, 0.0, 3.33, 0.0, 33.33),
        "M2": (33.33, 1, 1, 33.33, 1, 2, 3.33, 0.0, 0.0, 0.0, 33.33, 0.0),
        "M3": (50.0, 1, 1, 50.0, 1, 1, 5.0, 0.0, 50.0, 0.0, 0.0, 0.0),
    }


def test_merchant_ranks_of_large_groups(spark):
    df = wide(spark, *({"merchant_id": f"M{i}", "merchant_name": "x", "amount": float(i % 7 + 1)} for i in range(40)))
    usual, large = merchant_kpis(df), merchant_kpis(df, max_group_rows=5)
    assert usual.exceptAll(large).isEmpty() and large.exceptAll(usual).isEmpty()


def months(spark):
    jan, feb, apr = datetime(2024, 1, 31, 23), datetime(2024, 2, 1), datetime(2024, 4, 30)
    return wide(
        spark,
        {"user_id": "A", "transaction_date": jan, "amount": 1.0},
        {"user_id": "A", "transaction_date": apr, "amount": 2.005},
        {"user_id": "A", "transaction_date": apr, "amount": 2.0},
        {"user_id": "B", "transaction_date": jan, "amount": 4.0},
        {"user_id": "C", "transaction_date": feb, "amount": 8.0},
        {"user_id": "C", "transaction_date": datetime(2024, 5, 1), "amount": 16.0},
        {"user_id": None, "transaction_date": jan},
        {"user_id": "D", "transaction_date": None},
    )


def test_cohorts(spark):
    df = months(spark)
    assert by_key(first_purchase(df), "user_id", "cohort_month") == {"A": "2024-01", "B": "2024-01", "C": "2024-02"}
    assert by_key(cohort_sizes(first_purchase(df)), "cohort_month", "taille_cohorte") == {"2024-01": 2, "2024-02": 1}
    retention = cohort_retention(df)
    assert sorted(tuple(row) for row in retention.collect()) == [
        ("2024-01", 0, 2, 2, 100.0, 5.0, 2.5),
        ("2024-01", 3, 2, 1, 50.0, 4.01, 4.01),
        ("2024-02", 0, 1, 1, 100.0, 8.0, 8.0),
        ("2024-02", 3, 1, 1, 100.0, 16.0, 16.0),
    ]
    assert tuple(best_cohort(retention).first()) == ("2024-02", 1, 1, 100.0)


def test_best_cohort_takes_the_earliest_of_equals(spark):
    rows = [("2024-02", 3, 5, 2, 40.0), ("2024-01", 3, 5, 2, 40.0), ("2023-01", 2, 5, 5, 100.0)]
    df = spark.createDataFrame(
        rows, "cohort_month string, period_index int, taille_cohorte long, nb_utilisateurs_actifs long, taux_retention double"
    )
    assert best_cohort(df).first().cohort_month == "2024-01"


def test_top_products(spark):
    df = wide(
        spark,
        *({"product_id": f"P{i:02}", "product_name": f"N{i}", "amount": float(min(i, 12))} for i in range(1, 15)),
        {"product_id": "P99", "product_name": None, "amount": 1000.0},
        {"product_id": "P14", "product_name": "N14", "category": "Art", "amount": 0.5},
    )
    rows = top_products(df).collect()
    assert [row.rang for row in rows] == list(range(1, 11))
    assert [row.product_id for row in rows[:4]] == ["P14", "P12", "P13", "P11"]
    assert (rows[0].category, rows[0].chiffre_affaires, rows[0].nb_transactions) == ("Art", 12.5, 2)


def test_shares(spark):
    df = wide(
        spark,
        {"amount": 1.0},
        {"amount": 2.0, "category": "Toys", "payment_method": "CASH"},
        {"amount": 5.0, "region": "South"},
        {"amount": 7.0, "region": None, "payment_method": None},
    )
    assert {tuple(row) for row in by_category_and_region(df).collect()} == {
        ("North", "Books", 1.0, 1, 33.33),
        ("North", "Toys", 2.0, 1, 66.67),
        ("South", "Books", 5.0, 1, 100.0),
    }
    assert {tuple(row) for row in by_payment_and_period(df).collect()} == {
        ("CARD", "Morning", 6.0, 2, 75.0),
        ("CASH", "Morning", 2.0, 1, 25.0),
    }


def test_no_rows_no_failure(spark):
    df = wide(spark, {}).limit(0)
    assert by_payment_and_period(df).isEmpty() and merchant_kpis(df).isEmpty() and top_products(df).isEmpty()
    assert cohort_retention(df).where(F.lit(True)).isEmpty()
