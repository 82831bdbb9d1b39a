"""Suspicion score of transactions that carry their user's history."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.rounding import two_decimals
from basketflow.schemas import SUSPICIOUS_COLUMNS
from basketflow.settings import Scoring


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def with_score(history: DataFrame, scoring: Scoring = Scoring()) -> DataFrame:
    """Add deviation, the four conditions, their number and the verdict; a null condition is not met.

    The conditions look at exact values, the output columns are rounded.
    """
    deviation = F.try_divide(F.col("amount") - F.col("user_mean"), F.col("user_mean")) * 100
    conditions = {
        "cond_montant": _flag(deviation > scoring.amount_pct),
        "cond_night": _flag(F.col("day_period") == "Night"),
        "cond_delai": _flag(F.col("delay_minutes") < scoring.delay_minutes),
        "cond_crypto": _flag(F.col("payment_method") == "CRYPTO"),
    }
    return (
        history.withColumns(conditions)
        .withColumn("nb_conditions", sum((F.col(name) for name in conditions), F.lit(0)))
        .withColumns(
            {
                "is_suspicious": (F.col("nb_conditions") >= scoring.min_conditions).cast("int"),
                "panier_moyen_user": two_decimals(F.col("user_mean")),
                "ecart_panier_moyen_pct": two_decimals(deviation),
                "delai_precedente_minutes": two_decimals(F.col("delay_minutes")),
            }
        )
        .drop("user_mean", "delay_minutes")
    )


def suspicious_transactions(scored: DataFrame) -> DataFrame:
    """The transactions found suspicious, with the evidence."""
    return scored.where(F.col("is_suspicious") == 1).select(*SUSPICIOUS_COLUMNS)
