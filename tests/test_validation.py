import pytest
from pyspark.sql import functions as F

from basketflow.operators.validation import REASON, rejected_rows, tagged_rows, valid_rows
from basketflow.settings import Limits
from tests import builders
from tests.builders import by_key


def test_transactions_one_valid_three_rejected(spark):
    df = builders.transactions(
        spark,
        {"transaction_id": "T1"},
        {"transaction_id": "T2", "amount": -5.0},
        {"transaction_id": "T3", "timestamp": "2024"},
        {"transaction_id": "T4", "amount": 0.0, "timestamp": "2024"},
    )
    assert [row.transaction_id for row in valid_rows(df, "transactions").collect()] == ["T1"]
    assert by_key(rejected_rows(df, "transactions"), "transaction_id", REASON) == {
        "T2": "amount <= 0",
        "T3": "timestamp_invalide",
        "T4": "amount <= 0 | timestamp_invalide",
    }


def test_users_missing_values_are_rejected(spark):
    df = builders.users(
        spark,
        {"user_id": "U1"},
        {"user_id": "U2", "age": 12},
        {"user_id": "U3", "annual_income": -1.0},
        {"user_id": "U4", "age": None, "preferred_categories": None},
    )
    assert [row.user_id for row in valid_rows(df, "users").collect()] == ["U1"]
    assert by_key(rejected_rows(df, "users"), "user_id", REASON) == {
        "U2": "age_hors_intervalle",
        "U3": "income <= 0",
        "U4": "age_hors_intervalle",
    }


def test_missing_values_break_every_rule(spark):
    df = builders.transactions(spark, {"amount": None, "timestamp": None})
    assert rejected_rows(df, "transactions").first()[REASON] == "amount <= 0 | timestamp_invalide"
    assert valid_rows(df, "transactions").isEmpty()


@pytest.mark.parametrize(
    ("table", "column", "accepted", "refused"),
    [
        ("users", "age", [16, 100], [15, 101]),
        ("products", "rating", [1.0, 5.0], [0.99, 5.01]),
        ("products", "price", [0.01], [0.0, -99.99]),
        ("merchants", "commission_rate", [0.0, 1.0], [-0.01, 1.01]),
        ("transactions", "timestamp", ["2024023012000x"], ["202401011200001"]),
    ],
)
def test_bounds_are_inclusive(spark, table, column, accepted, refused):
    build = getattr(builders, table)
    df = build(spark, *({column: value} for value in accepted + refused))
    assert [row[column] for row in valid_rows(df, table).collect()] == accepted
    assert [row[column] for row in rejected_rows(df, table).collect()] == refused


def test_not_a_number(spark):
    nan = float("nan")
    assert valid_rows(builders.transactions(spark, {"amount": nan}), "transactions").count() == 1
    assert valid_rows(builders.products(spark, {"rating": nan}), "products").count() == 0


def test_limits_are_arguments(spark):
    df = builders.users(spark, {"age": 12})
    assert valid_rows(df, "users", Limits(min_age=10)).count() == 1


def test_halves_add_up(spark):
    df = builders.users(spark, *({"user_id": f"U{i}", "age": i} for i in range(0, 120, 7)))
    tagged = tagged_rows(df, "users")
    assert tagged.count() == valid_rows(df, "users").count() + rejected_rows(df, "users").count()
    assert tagged.where(F.col(REASON) == "").count() == valid_rows(df, "users").count()


def test_unknown_table(spark):
    with pytest.raises(ValueError, match="no rules"):
        valid_rows(builders.users(spark, {}), "orders")
