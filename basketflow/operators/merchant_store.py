"""Merchants' key figures from daily partial results, which a load adds and which give the figures of any days."""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.functions.rounding import two_decimals
from basketflow.operators.merchants import MERCHANT
from basketflow.operators.user_bitmaps import extend_numbers, set_sizes, user_sets
from basketflow.schemas import AGE_GROUP_REVENUE
from basketflow.sinks.batches import BatchTable

_KEYS = "merchant_id string, merchant_name string, merchant_category string, region string"
_SUMS = ["amount", "commission", *AGE_GROUP_REVENUE.values()]
_COUNTS = ["n", "n_amounts", "suspicious", "n_scored"]
_FIGURES = ", ".join([_KEYS, *(f"{x} double" for x in _SUMS), *(f"{x} long" for x in _COUNTS), "day date"])
_USERS = f"{_KEYS}, bucket long, users binary, day date"


class MerchantStore:
    """A folder in storage that all executors reach: figures per merchant and day, users per merchant and day as bitmaps.

    Loading a batch again replaces it. Transactions without a date have a day of their own.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._figures = BatchTable(spark, f"{self._path}/figures", _FIGURES, by="day")
        self._users = BatchTable(spark, f"{self._path}/users", _USERS, by="day")

    def load(self, batch: str, enriched: DataFrame) -> None:
        """Add enriched transactions. These are read several times: store them first."""
        rows = enriched.where(F.col("merchant_name").isNotNull()).withColumn("day", F.to_date("transaction_date"))
        numbers = extend_numbers(self._spark, f"{self._path}/numbers", rows.select("user_id"))
        self._users.write(batch, user_sets(rows, numbers, [*MERCHANT, "day"]))
        amount = F.col("amount")
        figures = rows.groupBy(*MERCHANT, "day").agg(
            F.sum(amount).alias("amount"),
            F.sum(amount * F.col("commission_rate")).alias("commission"),
            *(F.sum(F.when(F.col("age_group") == label, amount)).alias(name) for label, name in AGE_GROUP_REVENUE.items()),
            F.count("*").alias("n"),
            F.count(amount).alias("n_amounts"),
            F.sum("is_suspicious").alias("suspicious"),
            F.count("is_suspicious").alias("n_scored"),
        )
        self._figures.write(batch, figures)

    def totals(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """The columns of ``merchant_totals`` for the days from ``first`` to ``last``; without bounds for all rows."""
        figures = self._figures.read().where(_between(first, last)).groupBy(*MERCHANT)
        figures = figures.agg(*(F.sum(name).alias(name) for name in (*_SUMS, *_COUNTS)))
        users = set_sizes(self._users.read().where(_between(first, last)), MERCHANT, "nb_clients_uniques")
        same = [figures[name].eqNullSafe(users[name]) for name in MERCHANT]
        return figures.join(users, same, "left").select(
            *(figures[name] for name in MERCHANT),
            two_decimals(F.col("amount")).alias("chiffre_affaires"),
            F.col("n").alias("nb_transactions"),
            F.coalesce("nb_clients_uniques", F.lit(0)).alias("nb_clients_uniques"),
            two_decimals(F.try_divide("amount", "n_amounts")).alias("montant_moyen"),
            two_decimals(F.col("commission")).alias("commission_totale"),
            *(F.coalesce(two_decimals(F.col(name)), F.lit(0.0)).alias(name) for name in AGE_GROUP_REVENUE.values()),
            two_decimals(F.try_divide("suspicious", "n_scored") * 100).alias("taux_suspectes_pct"),
        )


def _between(first: date | None, last: date | None) -> Column:
    day = F.col("day")
    after = F.lit(True) if first is None else day >= F.lit(first)
    return after if last is None else after & (day <= F.lit(last))
