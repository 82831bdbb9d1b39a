"""Transactions and users stored by user: same rows, no shuffle of either by user."""

import re

import pytest

from basketflow.functions.calendar import with_transaction_date
from basketflow.operators import joins
from basketflow.operators.history import with_history
from basketflow.operators.user_layout import UserLayout
from basketflow.operators.validation import valid_rows
from basketflow.plans.enrichment import attributes_of, enriched, store_by_user, wide_of_layout, wide_transactions
from basketflow.settings import Scoring
from basketflow.shared import as_table, exists, new_path
from querybook.fixtures import views
from tests.builders import merchants, products, transactions, users

FOLDER = "/root/testdata/sf0.001"


def sorted_rows(df) -> list:
    """Doubles at nine places, as means that are not rounded yet depend on the order of their sum."""
    rows = df.select(*sorted(df.columns)).collect()
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in rows), key=repr)


def by_user(df) -> list[str]:
    """Shuffles whose keys are of users."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if "user" in x]


@pytest.fixture(scope="module")
def valid(spark):
    raw = views(spark, FOLDER, "transactions", "users", "products", "merchants")
    return {name: as_table(valid_rows(df, name), name) for name, df in raw.items()}


@pytest.fixture
def layout(spark):
    opened = []

    def make(facts, people, **bounds):
        opened.append(store_by_user(spark, new_path(spark, "by_user"), facts, people, **bounds))
        return opened[-1]

    yield make
    for one in opened:
        one.close()


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (False, 0))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quiet_users_are_not_shuffled(valid, layout, no_broadcast):
    stored = layout(valid["transactions"], valid["users"], buckets=5)
    wide = wide_of_layout(stored, valid["products"], valid["merchants"])
    plain = wide_transactions(**valid)
    assert stored.n_busy == 0 and by_user(plain) and not by_user(wide)
    assert sorted_rows(enriched(wide)) == sorted_rows(enriched(plain))


@pytest.mark.parametrize("broadcast", [False, True])
def test_busy_users_and_rows_without_user_are_apart(spark, valid, layout, broadcast):
    facts = valid["transactions"]
    strays = transactions(spark, *({"transaction_id": f"N{i}", "user_id": None, "timestamp": f"2024010{i % 3 + 1}120000"} for i in range(40)))
    facts = facts.unionByName(strays.select(*facts.columns))
    stored = layout(facts, valid["users"], buckets=3, max_user_rows=12)
    assert stored.n_busy >= 40 and stored.quiet.where("user_key = 'none'").isEmpty()
    assert stored.quiet.groupBy("user_key").count().where("count > 12").isEmpty()
    attached = attributes_of(valid["users"])
    plain = with_history(with_transaction_date(facts), Scoring(window_days=3), users=attached)
    assert sorted_rows(stored.history(Scoring(window_days=3), broadcast)) == sorted_rows(plain)


def test_each_bucket_is_one_file(spark, valid):
    path = new_path(spark, "by_user")
    store_by_user(spark, path, valid["transactions"], valid["users"], buckets=4).close()
    assert len(spark.read.parquet(f"{path}/quiet").inputFiles()) == 4
    assert len(spark.read.parquet(f"{path}/users").inputFiles()) == 4


def test_names_are_given_back_and_files_stay(spark, layout):
    path = new_path(spark, "by_user")
    first = store_by_user(spark, path, transactions(spark, {}), users(spark, {}))
    with pytest.raises(FileExistsError):
        store_by_user(spark, path, transactions(spark, {}), users(spark, {}))
    first.close()
    assert not any(spark.catalog.tableExists(name) for name in first.names) and exists(spark, f"{path}/quiet")
    again = UserLayout.open(spark, path)
    assert again.history().count() == 1 and again.n_users == 1
    again.close()


def test_empty_tables(spark, layout):
    none = layout(transactions(spark, {}).limit(0), users(spark, {}).limit(0))
    assert none.history().count() == 0
    alone = layout(transactions(spark, {}, {"transaction_id": "T2", "user_id": None}), users(spark, {}).limit(0))
    wide = wide_of_layout(alone, products(spark, {}), merchants(spark, {}))
    assert sorted((r["transaction_id"], r["age"], r["transaction_rank"]) for r in wide.collect()) == [("T1", None, 1), ("T2", None, 1)]
