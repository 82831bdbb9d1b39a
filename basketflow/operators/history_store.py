"""Users' history kept up to date: a new day costs its own rows and the state, not all days.

A load adds three tables under the folder of the store, partitioned by batch and day: the transactions, what each user did
in each second, and what each user did on each day. The two latter add up over batches, so late rows are no special case: a
batch may hold rows of any day. Loading a batch again replaces it, which makes a failed load repeatable.

The history of some days needs their transactions, their seconds and those of the days that end in their frames, and the
days of the users that are active in them. Of days long past only a user's totals matter; ``fold`` adds them up.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketflow.operators.history import (
    DAY,
    SECOND,
    UNDATED,
    history_columns,
    placed,
    second_measures,
    user_days,
    user_seconds,
    with_day,
    with_user_second,
)
from basketflow.operators.ordering import MAX_GROUP_ROWS
from basketflow.settings import Scoring
from basketflow.shared import as_table, exists, remove
from basketflow.sinks.batches import BatchTable, named

_EPOCH = date(1970, 1, 1)
_UNDATED_DAY = UNDATED // DAY

_SECONDS = "user_key string, event_sec long, n long, n_amounts long, amount double, day long"
_DAYS = "user_key string, n long, n_amounts long, amount double, last_sec long, day long"


def day_number(day: date) -> int:
    return (day - _EPOCH).days


class HistoryStore:
    """A folder in storage that all executors reach. One writer at a time; readers see whole tables of a batch."""

    def __init__(self, spark: SparkSession, path: str, scoring: Scoring = Scoring()):
        self._spark, self._path, self._scoring = spark, path.rstrip("/"), scoring
        self._seconds = BatchTable(spark, f"{self._path}/seconds", _SECONDS, by="day")
        self._days = BatchTable(spark, f"{self._path}/days", _DAYS, by="day")

    def load(self, batch: str, transactions: DataFrame) -> None:
        """Add transactions that have a ``transaction_date`` (null allowed), or replace those of the batch."""
        named(batch)
        transactions.limit(0).write.mode("overwrite").parquet(f"{self._path}/columns")
        rows = self._rows().write(batch, with_day(with_user_second(transactions)))
        touched = rows.select("day").unionAll(self._days.of(batch).select("day"))  # also days that a batch had before
        earliest = touched.where(F.col("day") != _UNDATED_DAY).agg(F.min("day")).first()[0]
        for upto in self._folds():
            if earliest is not None and earliest <= upto:
                remove(self._spark, f"{self._path}/totals/upto={upto}")
        seconds = self._seconds.write(batch, with_day(user_seconds(rows)))
        self._days.write(batch, user_days(seconds))

    def fold(self, upto: date) -> None:
        """Add up each user's days to ``upto``, from the totals before it if there are any. The days stay.

        Totals are used for days whose frames begin later. A load with rows up to that day drops them; fold again then.
        """
        upto = day_number(upto)
        before = max((x for x in self._folds() if x < upto), default=None)
        days = self._days_from(before).where((F.col("day") != _UNDATED_DAY) & (F.col("day") <= upto))
        totals = days.groupBy("user_key").agg(*_totals())
        totals.write.mode("overwrite").parquet(f"{self._path}/totals/upto={upto}")

    def history(
        self, first: date | None = None, last: date | None = None, max_group_rows: int = MAX_GROUP_ROWS
    ) -> DataFrame:
        """The columns of ``with_history`` for the transactions of the days from ``first`` to ``last``.

        Totals and means of users cover all that is loaded, also later days. Rows without a date come first in a
        user's history and are given where ``first`` is None.
        """
        window = self._scoring.window_days
        low = None if first is None else day_number(first)
        high = None if last is None else day_number(last)
        wanted = _between(low, high)
        rows = self._rows().read().where(wanted).drop("day")
        ending = _between(None if low is None else low - window, None if high is None else high - window)
        seconds = self._seconds.read().where(wanted | ending).groupBy(*SECOND).agg(*_sums())
        seconds = as_table(seconds, "seconds_in_reach")
        fold = None if low is None else max((x for x in self._folds() if x < low - window), default=None)
        days = self._days_from(fold)
        if low is not None or high is not None:
            active = self._days.read().where(wanted).select("user_key").distinct()
            days = days.join(active, "user_key", "left_semi")
        past = placed(rows, seconds, second_measures(seconds, days, window), max_group_rows)
        return history_columns(past, self._own().names, self._scoring)

    def _own(self) -> StructType:
        """The columns of the transactions."""
        return self._spark.read.parquet(f"{self._path}/columns").schema

    def _rows(self) -> BatchTable:
        schema = self._own().add("user_key", "string").add("event_sec", "long").add("day", "long")
        return BatchTable(self._spark, f"{self._path}/rows", schema, by="day")

    def _folds(self) -> list[int]:
        """Days to which totals are there; a few."""
        if not exists(self._spark, f"{self._path}/totals"):
            return []
        totals = self._spark.read.schema("user_key string, upto long").parquet(f"{self._path}/totals")
        return [row.upto for row in totals.select("upto").distinct().collect()]

    def _days_from(self, fold: int | None) -> DataFrame:
        """Users' days, those up to ``fold`` as one."""
        days = self._days.read()
        if fold is not None:
            totals = self._spark.read.schema("user_key string, n long, n_amounts long, amount double, last_sec long")
            folded = totals.parquet(f"{self._path}/totals/upto={fold}").withColumn("day", F.lit(fold).cast("long"))
            days = days.where((F.col("day") > fold) | (F.col("day") == _UNDATED_DAY)).unionByName(folded)
        return days.groupBy("user_key", "day").agg(*_totals())


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("n", "n_amounts", "amount")]


def _totals() -> list[Column]:
    return [*_sums(), F.max("last_sec").alias("last_sec")]


def _between(low: int | None, high: int | None) -> Column:
    """Days from ``low`` to ``high``; the day of rows without a date is before all others."""
    condition = F.lit(True) if low is None else F.col("day") >= low
    return condition if high is None else condition & (F.col("day") <= high)
