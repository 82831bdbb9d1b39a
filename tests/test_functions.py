from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketflow.functions.calendar import require_utc, with_calendar
from basketflow.functions.labels import age_group
from basketflow.functions.rounding import two_decimals
from tests import builders
from tests.builders import by_key


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("20240101120000", datetime(2024, 1, 1, 12)),
        ("20240229235959", datetime(2024, 2, 29, 23, 59, 59)),
        ("20240230120000", None),
        ("20240101240000", None),
        ("2024023012000x", None),
        ("00000101120000", None),
        (" 2024010112000", None),
        ("2024", None),
        ("", None),
        (None, None),
    ],
)
def test_parse(spark, text, expected):
    row = with_calendar(builders.transactions(spark, {"timestamp": text})).first()
    assert row.transaction_date == expected
    features = (row.hour, row.day_of_week, row.month, row.is_weekend, row.day_period, row.is_working_hours)
    assert all(value is None for value in features) == (expected is None)


def test_hours(spark):
    df = builders.transactions(spark, *({"timestamp": f"20240103{hour:02}3000"} for hour in range(24)))
    found = by_key(with_calendar(df), "hour", "day_period", "is_working_hours")
    period = ["Night"] * 6 + ["Morning"] * 6 + ["Afternoon"] * 6 + ["Evening"] * 4 + ["Night"] * 2
    assert found == {hour: (period[hour], int(9 <= hour <= 17)) for hour in range(24)}


def test_names_and_weekend(spark):
    df = builders.transactions(spark, *({"timestamp": f"2024{month:02}13000000"} for month in range(1, 13)))
    rows = with_calendar(df).collect()
    for row in rows:
        assert row.month == row.transaction_date.strftime("%B")
        assert row.day_of_week == row.transaction_date.strftime("%A")
        assert row.is_weekend == int(row.transaction_date.weekday() >= 5)


def test_age_groups(spark):
    ages = [16, 24, 25, 44, 45, 64, 65, 100, None]
    df = spark.createDataFrame([(age,) for age in ages], "age int")
    labels = [row[0] for row in df.select(age_group(F.col("age"))).collect()]
    assert labels == ["Jeune"] * 2 + ["Adulte"] * 2 + ["Âge Moyen"] * 2 + ["Senior"] * 2 + [None]


def test_half_cents_go_up_whatever_the_last_bits(spark):
    values = [1.005, 2.675, -1.005, 61.724999999999994, 0.1 + 0.2, 123456789012.345]
    df = spark.createDataFrame([(value,) for value in values], "x double")
    found = [row[0] for row in df.select(two_decimals(F.col("x"))).collect()]
    assert found == [1.01, 2.68, -1.01, 61.73, 0.3, 123456789012.35]


def test_zone_must_be_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
