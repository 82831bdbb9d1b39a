"""Row rules and the split into valid and rejected rows."""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.settings import Limits

REASON = "rejection_reason"


@dataclass(frozen=True)
class Rule:
    """A condition every valid row meets, and the label given to rows that do not."""

    label: str
    holds: Column

    def violation(self) -> Column:
        # a null condition takes the "otherwise" branch: missing values break the rule
        return F.when(self.holds, F.lit(None)).otherwise(F.lit(self.label))


def rules_for(table: str, limits: Limits = Limits()) -> list[Rule]:
    """Rules of one table, in the order in which their labels are reported."""
    # The rejection labels.
    match table:
        case "transactions":
            return [
                Rule("amount <= 0", F.col("amount") > 0),
                Rule("timestamp_invalide", F.length("timestamp") == limits.timestamp_length),
            ]
        case "users":
            return [
                Rule("age_hors_intervalle", F.col("age").between(limits.min_age, limits.max_age)),
                Rule("income <= 0", F.col("annual_income") > 0),
            ]
        case "products":
            return [
                Rule("price <= 0", F.col("price") > 0),
                Rule("rating_hors_intervalle", F.col("rating").between(limits.min_rating, limits.max_rating)),
            ]
        case "merchants":
            return [
                Rule(
                    "commission_hors_intervalle",
                    F.col("commission_rate").between(limits.min_commission, limits.max_commission),
                )
            ]
        case _:
            raise ValueError(f"no rules for table {table!r}")


def all_hold(rules: list[Rule]) -> Column:
    return reduce(and_, (rule.holds for rule in rules))


def reason(rules: list[Rule]) -> Column:
    """Labels of the broken rules; empty where none is broken."""
    return F.concat_ws(" | ", *(rule.violation() for rule in rules))


def valid_rows(df: DataFrame, table: str, limits: Limits = Limits()) -> DataFrame:
    """Rows that meet every rule. The rules stay separate conjuncts, so scans can skip by them."""
    return df.where(all_hold(rules_for(table, limits)))


def rejected_rows(df: DataFrame, table: str, limits: Limits = Limits()) -> DataFrame:
    """Rows that break a rule, with the reasons in a last column."""
    return tagged_rows(df, table, limits).where(F.col(REASON) != "")


def tagged_rows(df: DataFrame, table: str, limits: Limits = Limits()) -> DataFrame:
    """All rows with their reasons, for uses that need both halves in one pass."""
    return df.withColumn(REASON, reason(rules_for(table, limits)))
