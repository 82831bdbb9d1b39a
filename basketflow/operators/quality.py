"""Counts that describe the state of the raw tables."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.rounding import two_decimals
from basketflow.operators.joins import orphan_counts
from basketflow.operators.validation import all_hold, rules_for
from basketflow.settings import Limits

# Report columns that count orphans, by the key they check.
ORPHAN_COLUMNS = {
    "user_id": "nb_user_id_orphelins",
    "product_id": "nb_product_id_orphelins",
    "merchant_id": "nb_merchant_id_orphelins",
}


def null_cells(columns: list[str]) -> Column:
    """Number of null cells over all ``columns``; 0 for an empty table."""
    per_row = reduce(add, (F.col(f"`{name}`").isNull().cast("long") for name in columns))
    return F.coalesce(F.sum(per_row), F.lit(0))


def reject_rate(read: Column, rejected: Column) -> Column:
    """Rejected rows in percent of those read; 0 for an empty table."""
    return F.coalesce(two_decimals(F.try_divide(rejected * 100, read)), F.lit(0.0))


def count_columns(columns: list[str], table: str, limits: Limits = Limits()) -> list[Column]:
    """Aggregates over a raw table: rows read, rows valid, null cells."""
    return [
        F.count(F.lit(1)).alias("nb_lignes_lues"),
        F.count_if(all_hold(rules_for(table, limits))).alias("nb_lignes_valides"),
        null_cells(columns).alias("nb_valeurs_nulles"),
    ]


def table_counts(raw: DataFrame, table: str, limits: Limits = Limits()) -> DataFrame:
    """One row: rows read, rows valid, null cells; a single pass."""
    return raw.agg(F.lit(table).alias("dataset"), *count_columns(raw.columns, table, limits))


def _counts(raw: DataFrame, table: str, limits: Limits, known: dict[str, int] | None) -> DataFrame:
    if known is None:
        return table_counts(raw, table, limits)
    row = [(table, *(known[name] for name in ("nb_lignes_lues", "nb_lignes_valides", "nb_valeurs_nulles")))]
    schema = "dataset string, nb_lignes_lues long, nb_lignes_valides long, nb_valeurs_nulles long"
    return raw.sparkSession.createDataFrame(row, schema)


def quality_report(
    transactions: DataFrame,
    users: DataFrame,
    products: DataFrame,
    merchants: DataFrame,
    limits: Limits = Limits(),
    known: dict[str, dict[str, int]] | None = None,
) -> DataFrame:
    """Four rows, one per raw table. Orphans are transactions whose key is in no raw reference row.

    ``known`` has the values of ``count_columns`` of tables that were counted when they were written; these are not
    scanned again.
    """
    tables = {"transactions": transactions, "users": users, "products": products, "merchants": merchants}
    counts = reduce(DataFrame.unionByName, (_counts(df, name, limits, (known or {}).get(name)) for name, df in tables.items()))
    references = {"user_id": users, "product_id": products, "merchant_id": merchants}
    orphans = orphan_counts(transactions, references).select(
        F.lit("transactions").alias("dataset"),
        *(F.when(F.col("key") == key, F.col("nb_orphelins")).alias(name) for key, name in ORPHAN_COLUMNS.items()),
    )
    totals = ["nb_lignes_lues", "nb_lignes_valides", "nb_valeurs_nulles", *ORPHAN_COLUMNS.values()]
    report = (
        counts.unionByName(orphans, allowMissingColumns=True)
        .groupBy("dataset")
        .agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in totals))
    )
    rejected = F.col("nb_lignes_lues") - F.col("nb_lignes_valides")
    return report.select(
        "dataset",
        "nb_lignes_lues",
        "nb_lignes_valides",
        rejected.alias("nb_lignes_rejetees"),
        reject_rate(F.col("nb_lignes_lues"), rejected).alias("taux_rejet"),
        "nb_valeurs_nulles",
        *ORPHAN_COLUMNS.values(),
    )
