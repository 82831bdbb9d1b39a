"""Monthly cohorts: users grouped by the month of their first purchase."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.functions.rounding import two_decimals
from basketflow.schemas import RETENTION_COLUMNS

MONTH = "yyyy-MM"


def _attributable(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("user_id").isNotNull() & F.col("transaction_date").isNotNull())


def first_purchase(enriched: DataFrame) -> DataFrame:
    """First purchase of each user, with the cohort it puts the user in."""
    firsts = _attributable(enriched).groupBy("user_id").agg(F.min("transaction_date").alias("first_date"))
    return firsts.withColumn("cohort_month", F.date_format("first_date", MONTH))


def cohort_sizes(firsts: DataFrame) -> DataFrame:
    return firsts.groupBy("cohort_month").agg(F.count("*").alias("taille_cohorte"))


def cohort_retention(enriched: DataFrame) -> DataFrame:
    """Active users, retention and revenue per cohort and months since its start; empty cells are absent.

    Transactions are first added up per user and month, so a user is at most one row per month afterwards.
    """
    return retention_of(user_months(enriched))


def user_months(enriched: DataFrame) -> DataFrame:
    """Revenue per user and month, and the first purchase in it."""
    return (
        _attributable(enriched)
        .groupBy("user_id", F.trunc("transaction_date", "month").alias("active_month"))
        .agg(F.sum("amount").alias("amount"), F.min("transaction_date").alias("first_date"))
    )


def retention_of(user_months: DataFrame) -> DataFrame:
    """The first month of a user is the cohort, and its size is the number of users active in month 0."""
    joined = F.min("active_month").over(Window.partitionBy("user_id"))
    cells = (
        user_months.withColumn("joined_month", joined)
        .groupBy("joined_month", "active_month")
        .agg(F.count("*").alias("nb_utilisateurs_actifs"), two_decimals(F.sum("amount")).alias("chiffre_affaires"))
        .withColumn("period_index", F.months_between("active_month", "joined_month").cast("int"))
    )
    starters = F.when(F.col("period_index") == 0, F.col("nb_utilisateurs_actifs"))
    size = F.max(starters).over(Window.partitionBy("joined_month"))
    active = F.col("nb_utilisateurs_actifs")
    return (
        cells.withColumn("taille_cohorte", size)
        .withColumns(
            {
                "cohort_month": F.date_format("joined_month", MONTH),
                "taux_retention": two_decimals(active / F.col("taille_cohorte") * 100),
                "revenu_moyen_par_utilisateur": two_decimals(F.col("chiffre_affaires") / active),
            }
        )
        .select(*RETENTION_COLUMNS)
    )


def best_cohort(retention: DataFrame, period: int = 3) -> DataFrame:
    """The cohort with the best retention after ``period`` months; the earliest among equals."""
    return (
        retention.where(F.col("period_index") == period)
        .orderBy(F.desc("taux_retention"), "cohort_month")
        .limit(1)
        .select(
            "cohort_month",
            "taille_cohorte",
            F.col("nb_utilisateurs_actifs").alias(f"nb_utilisateurs_actifs_m{period}"),
            F.col("taux_retention").alias(f"taux_retention_m{period}"),
        )
    )
