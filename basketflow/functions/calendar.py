"""Timestamp parsing and calendar features, all as built-in expressions."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.schemas import TIMESTAMP_FORMAT


def require_utc(spark: SparkSession) -> None:
    """Calendar days and epoch seconds only agree everywhere when the session zone has no clock changes."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


def parse_timestamp(text: Column) -> Column:
    """Timestamp of a 14-digit text, null for anything else (impossible dates and year 0 included)."""
    well_formed = text.rlike("^(?!0000)[0-9]{14}$")
    return F.when(well_formed, F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)))


# First hour of each part of the day; night goes on to the first of these.
_PERIOD_STARTS = {6: "Morning", 12: "Afternoon", 18: "Evening", 22: "Night"}


def day_period(hour: Column) -> Column:
    """Part of the day, looked up by hour so that ``hour`` is evaluated once even inside a pushed-down filter."""
    labels, label = [], "Night"
    for h in range(24):
        label = _PERIOD_STARTS.get(h, label)
        labels.append(label)
    return F.get(F.array(*map(F.lit, labels)), hour)


def time_features(moment: Column) -> list[Column]:
    """The six calendar columns; all are null where ``moment`` is null."""
    hour = F.hour(moment)
    return [
        hour.alias("hour"),
        F.date_format(moment, "EEEE").alias("day_of_week"),
        F.date_format(moment, "MMMM").alias("month"),
        (F.weekday(moment) >= 5).cast("int").alias("is_weekend"),
        day_period(hour).alias("day_period"),
        hour.between(9, 17).cast("int").alias("is_working_hours"),
    ]


def with_transaction_date(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("transaction_date", parse_timestamp(F.col("timestamp")))


def with_time_features(dated: DataFrame) -> DataFrame:
    return dated.select("*", *time_features(F.col("transaction_date")))


def with_calendar(transactions: DataFrame) -> DataFrame:
    """Add ``transaction_date`` and the calendar columns."""
    return with_time_features(with_transaction_date(transactions))
