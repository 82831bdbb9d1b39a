"""The shape of the physical plans: what is scanned, what is shuffled, and by which keys."""

import re

import pytest

from basketflow.functions.calendar import with_transaction_date
from basketflow.operators import history, joins
from basketflow.operators.history import past_by_day, with_history, with_user_second
from basketflow.operators.revenue import by_category_and_region, by_payment_and_period
from basketflow.operators.validation import valid_rows
from basketflow.plans.enrichment import wide_transactions
from basketflow.shared import as_table
from querybook.fixtures import views
from querybook.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    raw = views(spark, FOLDER, "transactions", "users", "products", "merchants")
    return {name: as_table(df, name) for name, df in raw.items()}


@pytest.fixture(scope="module")
def wide(spark, tables):
    return wide_transactions(**{name: valid_rows(df, name) for name, df in tables.items()})


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_and_no_cross_products(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert node not in text


def test_rules_reach_the_scan(tables):
    text = plan(valid_rows(tables["transactions"], "transactions"))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(amount,0.0\)", text)


def test_busy_users_are_not_windowed_by_user(tables):
    """Only their days are; transactions are windowed by second and seconds by day."""
    dated = with_transaction_date(valid_rows(tables["transactions"], "transactions"))
    text = plan(past_by_day(with_user_second(dated), window_days=7))
    windows = [line for line in text.splitlines() if re.search(r"[-+ ]Window \[", line)]
    by_user_alone = [w for w in windows if re.search(r"\], \[user_key#\d+\](, \[day#\d+L ASC NULLS FIRST\])?$", w)]
    assert (len(windows), len(by_user_alone)) == (5, 2)


def test_transactions_are_shuffled_once_for_their_history(tables):
    dated = with_transaction_date(valid_rows(tables["transactions"], "transactions"))
    assert plan(with_history(dated)).count("Exchange") == 1


def test_shares_of_the_total_aggregate_the_facts_once(wide):
    df = by_payment_and_period(as_table(wide, "wide"))
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_shares_of_a_region_need_one_branch(wide):
    text = plan(by_category_and_region(as_table(wide, "wide")))
    assert text.count("FileScan") == 1 and "Join" not in text


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Dimensions too large to broadcast, by their counted size and by Spark's own measure."""
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (False, 0))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def test_large_users_meet_quiet_ones_where_these_are_windowed(tables, no_broadcast):
    valid = {name: valid_rows(df, name) for name, df in tables.items()}
    text = plan(wide_transactions(**valid))
    by_user = [x for x in exchanges(text) if "user" in x]
    assert len(by_user) == 2 and all(x.startswith("user_key") for x in by_user)  # the facts once, the users once


def test_quiet_users_are_windowed_by_user_beside_many_busy_ones(tables, monkeypatch):
    monkeypatch.setattr(history, "MAX_BROADCAST_ROWS", 1)
    dated = with_transaction_date(valid_rows(tables["transactions"], "transactions"))
    text = plan(with_history(dated, max_user_rows=9))
    assert re.search(r"Window \[.*\], \[user_key#\d+\]", text) and "SortMergeJoin" in text
    quiet = text[: text.index("LeftSemi")] if "LeftSemi" in text else text
    assert "LeftAnti" in quiet


@pytest.mark.parametrize(
    ("name", "joined"),
    [("top10_products", ["product"]), ("revenue_by_category_region", ["merchant"]), ("revenue_by_age_group", ["user", "merchant"])],
)
def test_reports_join_only_what_they_read(spark, name, joined):
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    lookups = set(re.findall(r"__(user|product|merchant)_id#\d+ = __", text))
    assert lookups == set(joined)


def test_merchants_are_broadcast_before_the_facts_move(spark):
    text = plan(QUERIES["revenue_by_category_region"](spark, FOLDER))
    assert not [x for x in exchanges(text) if "__merchant_id" in x]


def test_quiet_users_have_running_frames_only(tables):
    """No frame is gathered or added up anew for each row, whatever it holds."""
    dated = with_transaction_date(valid_rows(tables["transactions"], "transactions"))
    text = plan(with_history(dated))
    assert "collect_set" not in text
    # besides neighbours (lag and lead) every frame begins with the user's first row
    frames = re.findall(r"specifiedwindowframe\(\w+, ([^,]+), ", text)
    assert frames and set(frames) <= {"unboundedpreceding$()", "-1", "1"}
