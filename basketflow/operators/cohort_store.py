"""Cohorts kept up to date: revenue per user and month, and the users of each month as bitmaps."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.operators.cohorts import MONTH, retention_of, user_months
from basketflow.operators.user_bitmaps import extend_numbers, merged_sets, user_sets
from basketflow.sinks.batches import BatchTable

_MONTHS = "user_id string, amount double, first_date timestamp, active_month date"
_USERS = "bucket long, users binary, active_month date"


class CohortStore:
    """A folder in storage that all executors reach. A load writes the months it has rows of, under its batch.

    Loading a batch again replaces it. Rows of a month may come in any number of batches.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._months = BatchTable(spark, f"{self._path}/months", _MONTHS, by="active_month")
        self._users = BatchTable(spark, f"{self._path}/users", _USERS, by="active_month")

    def load(self, batch: str, transactions: DataFrame) -> None:
        """Add transactions that have a ``transaction_date``; rows without a date or user are in no cohort."""
        months = self._months.write(batch, user_months(transactions))
        numbers = extend_numbers(self._spark, f"{self._path}/numbers", months.select("user_id"))
        self._users.write(batch, user_sets(months, numbers, ["active_month"]))

    def _user_months(self) -> DataFrame:
        sums = F.sum("amount").alias("amount"), F.min("first_date").alias("first_date")
        return self._months.read().groupBy("user_id", "active_month").agg(*sums)

    def first_purchase(self) -> DataFrame:
        """The columns of ``cohorts.first_purchase``, from one row per user and month."""
        firsts = self._months.read().groupBy("user_id").agg(F.min("first_date").alias("first_date"))
        return firsts.withColumn("cohort_month", F.date_format("first_date", MONTH))

    def retention(self) -> DataFrame:
        """The columns of ``cohorts.cohort_retention``."""
        return retention_of(self._user_months())

    def sizes(self) -> DataFrame:
        """The columns of ``cohorts.cohort_sizes`` from the bitmaps alone: users that no earlier month has.

        No user is looked at: a bucket's users up to a month, less those up to the month before, are new in it.
        """
        by_month = Window.partitionBy("bucket").orderBy("active_month")
        so_far = merged_sets(self._users.read(), ["active_month"]).select(
            "bucket", "active_month", F.bitmap_count(F.bitmap_or_agg("users").over(by_month)).alias("n")
        )
        new = so_far.select("active_month", (F.col("n") - F.lag("n", 1, 0).over(by_month)).alias("new"))
        sizes = new.groupBy(F.date_format("active_month", MONTH).alias("cohort_month")).agg(F.sum("new").alias("taille_cohorte"))
        return sizes.where("taille_cohorte > 0")
