"""Key figures and rankings of merchants."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.rounding import two_decimals
from basketflow.operators.ordering import MAX_GROUP_ROWS, with_ranks
from basketflow.schemas import AGE_GROUP_REVENUE, KPI_COLUMNS
from basketflow.shared import as_table


def revenue() -> list[Column]:
    """Revenue and number of transactions."""
    return [two_decimals(F.sum("amount")).alias("chiffre_affaires"), F.count("*").alias("nb_transactions")]


def age_group_revenue() -> list[Column]:
    """Revenue per age group; transactions without one count in none."""
    return [
        F.coalesce(two_decimals(F.sum(F.when(F.col("age_group") == label, F.col("amount")))), F.lit(0.0)).alias(name)
        for label, name in AGE_GROUP_REVENUE.items()
    ]


MERCHANT = ["merchant_id", "merchant_name", "merchant_category", "region"]


def merchant_totals(enriched: DataFrame) -> DataFrame:
    """One row per known merchant that has transactions, without ranks."""
    return (
        enriched.where(F.col("merchant_name").isNotNull())
        .groupBy(*MERCHANT)
        .agg(
            *revenue(),
            F.count_distinct("user_id").alias("nb_clients_uniques"),
            two_decimals(F.avg("amount")).alias("montant_moyen"),
            two_decimals(F.sum(F.col("amount") * F.col("commission_rate"))).alias("commission_totale"),
            *age_group_revenue(),
            two_decimals(F.avg("is_suspicious") * 100).alias("taux_suspectes_pct"),
        )
    )


def merchant_kpis(enriched: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Totals with the revenue rank inside the merchant's category and inside its region.

    The totals are stored before group sizes are looked at, so calling this runs the aggregation.
    """
    return with_merchant_ranks(merchant_totals(enriched), max_group_rows)


def with_merchant_ranks(totals: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    ranked = as_table(totals, "merchant_totals")
    groups = {"rang_ca_categorie": "merchant_category", "rang_ca_region": "region"}
    return with_ranks(ranked, "chiffre_affaires", groups, max_group_rows).select(*KPI_COLUMNS)
