"""Dimension lookups and reference checks on a fact table with uneven keys."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows up to which a dimension may be broadcast on request; wider ones are joined by shuffle.
MAX_BROADCAST_ROWS = 200_000


def broadcast_if_small(
    df: DataFrame, enabled: bool = False, max_rows: int = MAX_BROADCAST_ROWS, rows: int | None = None
) -> DataFrame:
    """Hint a broadcast when asked to and the table is counted to be small.

    ``rows``, its number of rows or more, spares the count. Without the hint Spark still broadcasts by its own
    measured sizes.
    """
    if not enabled or (df.limit(max_rows + 1).count() if rows is None else rows) > max_rows:
        return df
    return F.broadcast(df)


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[tuple[str, str]],
) -> DataFrame:
    """Left join that adds ``attributes``, given as (dimension column, output column).

    Every fact row stays; one without a match gets nulls. ``key`` must be unique in the dimension.
    A hot key is split by the adaptive skew join, which can act here because the join reads straight from its
    two shuffles. Rows without a key match nothing; they are spread by all they hold instead of meeting in one task.
    """
    match = f"__{key}"
    keyed_dimension = dimension.where(F.col(key).isNotNull()).select(
        F.concat(F.lit("key "), F.col(key)).alias(match),
        *(F.col(source).alias(output) for source, output in attributes),
    )
    hashable = [f.name for f in facts.schema if not f.dataType.simpleString().startswith("map")]
    spread = F.concat(F.lit("null "), F.xxhash64(*hashable).cast("string"))
    keyed_facts = facts.withColumn(match, F.coalesce(F.concat(F.lit("key "), F.col(key)), spread))
    return keyed_facts.join(keyed_dimension, match, "left").drop(match)


def keyed_lookup(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join on a key that is never null in ``facts`` and may be hot there.

    The key is renamed first, so that the join makes its own shuffles, which Spark can split, whatever
    partitioning the facts come with.
    """
    match = f"__{key}"
    return facts.withColumn(match, F.concat(F.lit("of "), F.col(key))).join(
        dimension.select(F.concat(F.lit("of "), F.col(key)).alias(match), *(c for c in dimension.columns if c != key)), match, "left"
    ).drop(match)


def orphan_counts(facts: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """Rows whose non-null key is absent from its reference, one output row per key column.

    One pass over the facts: each row gives one (column, value) pair per key, and pairs are counted before
    they are shuffled, so a hot key reaches the join as a single row.
    """
    pairs = F.explode(
        F.array(*(F.struct(F.lit(key).alias("key"), F.col(key).alias("value")) for key in references))
    )
    used = (
        facts.select(pairs.alias("pair"))
        .select("pair.*")
        .where(F.col("value").isNotNull())
        .groupBy("key", "value")
        .agg(F.count("*").alias("n"))
    )
    known = None
    for key, reference in references.items():
        one = reference.select(F.lit(key).alias("key"), F.col(key).alias("value"))
        known = one if known is None else known.unionByName(one)
    missing = used.join(known, ["key", "value"], "left_anti")
    # one aggregate without grouping always gives a row, also where nothing is missing
    totals = missing.agg(
        *(F.coalesce(F.sum(F.when(F.col("key") == key, F.col("n"))), F.lit(0)).alias(key) for key in references)
    )
    return totals.select(
        F.explode(
            F.array(*(F.struct(F.lit(key).alias("key"), F.col(key).alias("nb_orphelins")) for key in references))
        ).alias("row")
    ).select("row.*")


def duplicate_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once; ``lookup`` expects none."""
    return dimension.groupBy(key).agg(F.count("*").alias("nb_lignes")).where(
        F.col(key).isNotNull() & (F.col("nb_lignes") > 1)
    )
