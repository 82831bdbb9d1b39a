"""A store that is loaded in parts against plain windows over all rows, and what a new day reads."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from basketflow.functions.calendar import with_transaction_date
from basketflow.operators.history import with_history
from basketflow.operators.history_store import HistoryStore, day_number
from basketflow.settings import Scoring
from basketflow.shared import as_table, exists, new_path, remove
from tests import builders
from tests.builders import by_key
from tests.test_history import COLUMNS, by_transaction, plain_windows
from tests.test_history import dirty_transactions as many_days

#: Days in the tables of these tests; each is a folder, so they are few.
DAYS = [f"2024-01-{d:02}" for d in (5, 9, 12, 13, 14, 15, 18, 19, 20, 21)] + [f"2024-02-{d:02}" for d in (3, 9, 10, 20)]


def dirty_transactions(spark, seed):
    day = F.to_date("transaction_date").cast("string")
    return as_table(many_days(spark, seed, rows=1500).where(day.isNull() | day.isin(DAYS)), "dirty")


def by_plain_windows(dated, scoring):
    return by_transaction(plain_windows(dated, scoring))


def columns(history) -> dict:
    return by_key(history, "transaction_id", *COLUMNS)


@pytest.fixture
def path(spark):
    return new_path(spark, "store")


@pytest.mark.parametrize("days", [1, 7])
def test_batches_of_any_rows_equal_one(spark, path, days):
    """Late rows, seconds that are in several batches, rows without date or user."""
    dated = dirty_transactions(spark, seed=40 + days)
    scoring = Scoring(window_days=days, active_days=min(days, 3))
    store = HistoryStore(spark, path, scoring)
    for k in range(2):
        store.load(f"part-{k}", dated.where(F.crc32(F.col("transaction_id").cast("binary")) % 2 == k))
    found = store.history()
    assert found.columns == with_history(dated, scoring).columns
    assert columns(found) == by_plain_windows(dated, scoring)
    assert columns(store.history(max_group_rows=1)) == by_plain_windows(dated, scoring)


@pytest.mark.parametrize("fold", [None, 1, 10])
def test_days_one_after_the_other(spark, path, fold):
    """Whatever days are folded, the days before and after a cut make up the whole."""
    dated = dirty_transactions(spark, seed=50)
    cut = date(2024, 1, 20)
    late = F.coalesce(F.to_date("transaction_date") > cut, F.lit(False))
    store = HistoryStore(spark, path)
    store.load("january", dated.where(~late))
    if fold:
        store.fold(cut - timedelta(days=fold))
    store.load("later", dated.where(late))
    expected = by_plain_windows(dated, Scoring())
    new = columns(store.history(first=cut + timedelta(days=1)))
    old = columns(store.history(last=cut))
    assert not new.keys() & old.keys() and {**new, **old} == expected
    assert columns(store.history(first=date(2024, 1, 5), last=date(2024, 1, 9))).items() <= expected.items()


def test_folds_build_on_each_other_and_late_rows_drop_them(spark, path):
    dated = dirty_transactions(spark, seed=51)
    cut = date(2024, 2, 20)
    late = F.coalesce(F.to_date("transaction_date") == date(2024, 1, 15), F.lit(False))
    store = HistoryStore(spark, path)
    store.load("most", dated.where(~late))
    store.fold(date(2024, 1, 10))
    store.fold(date(2024, 2, 10))
    assert sorted(store._folds()) == [day_number(date(2024, 1, 10)), day_number(date(2024, 2, 10))]
    store.load("late", dated.where(late))
    assert store._folds() == [day_number(date(2024, 1, 10))]
    store.fold(date(2024, 2, 10))
    new = columns(store.history(first=cut))
    assert new and new.items() <= by_plain_windows(dated, Scoring()).items()


def test_a_batch_is_replaced(spark, path):
    dated = dirty_transactions(spark, seed=52)
    store = HistoryStore(spark, path)
    store.load("all", dated.where("amount > 100"))
    store.load("all", dated)
    store.load("none", dated.limit(0))
    assert columns(store.history()) == by_plain_windows(dated, Scoring())


def test_new_days_read_their_rows_and_the_state_only(spark, path):
    """What lies further back may be gone: rows of all earlier days, seconds outside the frames, folded days."""
    dated = dirty_transactions(spark, seed=53)
    cut = date(2024, 2, 10)
    store = HistoryStore(spark, path)
    store.load("old", dated.where(F.coalesce(F.to_date("transaction_date") < cut, F.lit(True))))
    store.fold(cut - timedelta(days=8))
    store.load("new", dated.where(F.to_date("transaction_date") >= cut))
    new = columns(store.history(first=cut))
    expected = {k: v for k, v in by_plain_windows(dated, Scoring()).items() if k in new}
    remove(spark, f"{path}/rows/batch=old")
    for day in range(day_number(date(2024, 1, 1)), day_number(cut) - 7):
        remove(spark, f"{path}/seconds/batch=old/day={day}")
        remove(spark, f"{path}/days/batch=old/day={day}")
    assert expected and columns(store.history(first=cut)) == expected


def test_scans_are_limited_to_partitions(spark, path):
    dated = dirty_transactions(spark, seed=54)
    store = HistoryStore(spark, path)
    store.load("all", dated)
    text = store.history(first=date(2024, 2, 1))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line and "transaction_id" in line]
    assert scans and all("PartitionFilters: [isnotnull(day" in line for line in scans)


def test_copies_missing_amounts_and_nan(spark, path):
    rows = [("A", 1.0), ("A", 1.0), ("B", None), ("C", float("nan"))]
    dated = with_transaction_date(builders.transactions(spark, *({"transaction_id": i, "amount": a} for i, a in rows)))
    store = HistoryStore(spark, path)
    store.load("x", dated)
    found = sorted((r.transaction_id, r.transaction_rank, str(r.montant_cumule_7j), r.total_transactions_user) for r in store.history().collect())
    assert found == [("A", 1, "nan", 4), ("A", 2, "nan", 4), ("B", 3, "nan", 4), ("C", 4, "nan", 4)]


def test_empty_store(spark, path):
    dated = dirty_transactions(spark, seed=55)
    store = HistoryStore(spark, path)
    store.load("nothing", dated.limit(0))
    store.fold(date(2024, 1, 1))
    assert store.history().collect() == [] and store.history(first=date(2024, 1, 1)).collect() == []


def test_names_of_batches(spark, path):
    with pytest.raises(ValueError, match="batch"):
        HistoryStore(spark, path).load("../x", dirty_transactions(spark, seed=1))
    assert not exists(spark, path)
