"""The history columns against plain windows over whole users, which is their definition."""

import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.functions.calendar import with_transaction_date
from basketflow.operators import history
from basketflow.operators.history import with_history
from basketflow.settings import Scoring
from tests import builders
from tests.builders import by_key

COLUMNS = [
    "transaction_rank",
    "total_transactions_user",
    "montant_cumule_7j",
    "is_active_user",
    "jours_depuis_achat_precedent",
    "delay_minutes",
    "user_mean",
]


def plain_windows(dated: DataFrame, scoring: Scoring) -> DataFrame:
    user = Window.partitionBy("user_id")
    ordered = user.orderBy("transaction_date", "transaction_id")
    second = F.unix_seconds("transaction_date")
    frame = user.orderBy(second).rangeBetween(-scoring.window_days * 86400, 0)
    date = F.to_date("transaction_date")
    return dated.select(
        "transaction_id",
        F.row_number().over(ordered).cast("long"),
        F.count("*").over(user),
        F.round(F.sum("amount").over(frame), 2),
        (F.size(F.collect_set(date).over(frame)) >= scoring.active_days).cast("int"),
        F.datediff(date, F.to_date(F.lag("transaction_date").over(ordered))),
        (second - F.lag(second).over(ordered)) / F.lit(60.0),
        F.avg("amount").over(user),
    ).toDF("transaction_id", *COLUMNS)


def dirty_transactions(spark, seed: int, rows: int = 600, odd_amounts: bool = False) -> DataFrame:
    """A user with half of the rows, rows without user, without date, and many equal seconds.

    With odd amounts also missing ones, of some users all of them, and some that are no number.
    """
    rng = random.Random(seed)
    amounts = [k / 100 for k in range(1, 50_000, 7)]
    if odd_amounts:
        amounts = [*amounts[:8], None, None, None, None]
    made = []
    for i in range(rows):
        day, hour, second = rng.randint(1, 28), rng.choice((0, 0, 11, 23)), rng.choice((0, 0, 0, 1, 59))
        stamp = f"2024{rng.randint(1, 2):02}{day:02}{hour:02}00{second:02}"
        made.append(
            {
                "transaction_id": f"T{rng.randint(0, 10**6):07}-{i}",
                "user_id": rng.choice(("U1", "U1", "U1", None, "U2", "U3", f"U{i}")),
                "amount": rng.choice(amounts),
                "timestamp": rng.choice((stamp,) * 9 + ("2024023012000x",)),
            }
        )
    return with_transaction_date(builders.transactions(spark, *made))


def by_transaction(df: DataFrame) -> dict:
    """The columns per transaction; the unrounded mean up to the last bits, which depend on the order of adding."""
    found = by_key(df, "transaction_id", *COLUMNS)
    near = {key: row[-1] if row[-1] is None else pytest.approx(row[-1], rel=1e-12) for key, row in found.items()}
    return {key: (*row[:-1], near[key]) for key, row in found.items()}


def found_columns(dated: DataFrame, scoring: Scoring, **options) -> dict:
    return by_key(with_history(dated, scoring, **options), "transaction_id", *COLUMNS)


# all users as a whole, busy ones by day, all by day
@pytest.mark.parametrize("max_user_rows", [10**6, 50, 0])
@pytest.mark.parametrize("days", [1, 2, 7, 30])
def test_equals_plain_windows(spark, max_user_rows, days):
    dated = dirty_transactions(spark, seed=days)
    scoring = Scoring(window_days=days, active_days=min(days, 3))
    expected = by_transaction(plain_windows(dated, scoring))
    assert found_columns(dated, scoring, max_user_rows=max_user_rows) == expected


@pytest.mark.parametrize("max_user_rows", [10**6, 50, 0])
@pytest.mark.parametrize("days", [1, 7])
def test_missing_amounts(spark, max_user_rows, days):
    dated = dirty_transactions(spark, seed=20 + days, odd_amounts=True)
    none = F.col("user_id").isin("U2") | (F.crc32(F.coalesce("user_id", F.lit("")).cast("binary")) % 3 == 0)
    dated = dated.withColumn("amount", F.when(~none, F.col("amount")))
    scoring = Scoring(window_days=days, active_days=1)
    assert found_columns(dated, scoring, max_user_rows=max_user_rows) == by_transaction(plain_windows(dated, scoring))


@pytest.mark.parametrize("max_user_rows", [100, 0])
def test_amounts_that_are_no_number(spark, max_user_rows):
    rows = [("A", "20240101120000", 1.0), ("B", "20240105120000", float("nan")), ("C", "20240107120000", 2.0), ("D", "20240120120000", 4.0)]
    dated = with_transaction_date(
        builders.transactions(spark, *({"transaction_id": i, "timestamp": t, "amount": a} for i, t, a in rows))
    )
    found = by_key(with_history(dated, max_user_rows=max_user_rows), "transaction_id", "montant_cumule_7j")
    assert {k: str(v) for k, v in found.items()} == {"A": "1.0", "B": "nan", "C": "nan", "D": "4.0"}


def test_window_of_no_days_is_refused():
    with pytest.raises(ValueError, match="window_days"):
        Scoring(window_days=0)


@pytest.mark.parametrize("max_user_rows", [10**6, 50, 0])
def test_users_are_attached_on_the_way(spark, max_user_rows):
    dated = dirty_transactions(spark, seed=11)
    users = spark.createDataFrame([("U1", 30), ("U2", 40), (None, 1), ("other", 2)], "user_id string, age int")
    found = with_history(dated, max_user_rows=max_user_rows, users=users).groupBy("user_id", "age").count().collect()
    plain = dated.join(users, "user_id", "left").groupBy("user_id", "age").count().collect()
    assert sorted(map(str, found)) == sorted(map(str, plain))


def test_too_many_busy_users_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(history, "MAX_BROADCAST_ROWS", 1)
    dated = dirty_transactions(spark, seed=9)
    expected = by_transaction(plain_windows(dated, Scoring()))
    assert found_columns(dated, Scoring(), max_user_rows=5) == expected


@pytest.mark.parametrize("max_group_rows", [1, 5])
def test_crowded_seconds_go_through_the_sort(spark, max_group_rows):
    dated = dirty_transactions(spark, seed=3)
    scoring = Scoring()
    expected = by_transaction(plain_windows(dated, scoring))
    assert found_columns(dated, scoring, max_user_rows=20, max_group_rows=max_group_rows) == expected


def test_one_user_and_second_holds_everything(spark):
    rows = [{"transaction_id": f"T{i:05}", "user_id": None} for i in range(3000)]
    dated = with_transaction_date(builders.transactions(spark, *rows)).repartition(7)
    found = found_columns(dated, Scoring(), max_user_rows=1000, max_group_rows=100)
    assert {key: value[0] for key, value in found.items()} == {f"T{i:05}": i + 1 for i in range(3000)}


def test_copies_get_distinct_ranks(spark):
    dated = with_transaction_date(builders.transactions(spark, *({"transaction_id": "T1"} for _ in range(500))))
    found = with_history(dated, max_user_rows=100, max_group_rows=10)
    assert sorted(row[0] for row in found.select("transaction_rank").collect()) == list(range(1, 501))


@pytest.mark.parametrize("max_user_rows", [100, 0])
def test_frame_edge(spark, max_user_rows):
    """Exactly seven days back is inside, one second more is not."""
    dated = with_transaction_date(
        builders.transactions(
            spark,
            {"transaction_id": "A", "user_id": "U1", "timestamp": "20240101120000", "amount": 1.0},
            {"transaction_id": "B", "user_id": "U1", "timestamp": "20240108120000", "amount": 2.0},
            {"transaction_id": "C", "user_id": "U2", "timestamp": "20240101120000", "amount": 1.0},
            {"transaction_id": "D", "user_id": "U2", "timestamp": "20240108120001", "amount": 2.0},
        )
    )
    found = by_key(
        with_history(dated, max_user_rows=max_user_rows), "transaction_id", "montant_cumule_7j"
    )
    assert found == {"A": 1.0, "B": 3.0, "C": 1.0, "D": 2.0}


@pytest.mark.parametrize("max_user_rows", [100, 0])
def test_active_from_fifth_day_on(spark, max_user_rows):
    stamps = ["20240101120000", "20240102120000", "20240103120000", "20240104120000", "20240108120000"]
    dated = with_transaction_date(
        builders.transactions(spark, *({"transaction_id": f"T{i}", "timestamp": s} for i, s in enumerate(stamps)))
    )
    found = by_key(with_history(dated, max_user_rows=max_user_rows), "transaction_id", "is_active_user")
    assert found == {"T0": 0, "T1": 0, "T2": 0, "T3": 0, "T4": 1}


@pytest.mark.parametrize("max_user_rows", [100, 0])
def test_before_1970(spark, max_user_rows):
    stamps = ["19691231235959", "19700101000000", "19691225000000"]
    dated = with_transaction_date(
        builders.transactions(spark, *({"transaction_id": f"T{i}", "timestamp": s} for i, s in enumerate(stamps)))
    )
    expected = by_transaction(plain_windows(dated, Scoring()))
    assert found_columns(dated, Scoring(), max_user_rows=max_user_rows) == expected
