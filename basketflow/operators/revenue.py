"""Revenue by pairs of attributes, with shares."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.functions.rounding import two_decimals
from basketflow.operators.merchants import revenue
from basketflow.schemas import REGION_COLUMNS


def _cells(enriched: DataFrame, *keys: str) -> DataFrame:
    # one conjunct per key, which a Parquet scan can push down
    known = reduce(and_, (F.col(key).isNotNull() for key in keys))
    return enriched.where(known).groupBy(*keys).agg(*revenue())


def _cell_total() -> Column:
    """Sum of the cells' revenue. It looks at both cell columns, as the cells themselves do: with the same
    columns in use Spark runs the aggregation once and reads its shuffle twice."""
    return F.sum(F.when(F.col("nb_transactions") > 0, F.col("chiffre_affaires")))


def by_category_and_region(enriched: DataFrame) -> DataFrame:
    """Revenue per region and category, with its share of the region's revenue."""
    cells = _cells(enriched, "region", "category")
    # a region has one cell per category, however many transactions
    region = F.sum("chiffre_affaires").over(Window.partitionBy("region"))
    share = two_decimals(F.col("chiffre_affaires") / region * 100)
    return cells.select(*REGION_COLUMNS[:-1], share.alias(REGION_COLUMNS[-1]))


def by_payment_and_period(enriched: DataFrame) -> DataFrame:
    """Revenue per payment method and part of the day, with its share of the total."""
    cells = _cells(enriched, "payment_method", "day_period")
    total = cells.agg(_cell_total()).scalar()
    return cells.withColumn("part_ca_pct", two_decimals(F.col("chiffre_affaires") / total * 100))


def by_period(enriched: DataFrame) -> DataFrame:
    """Revenue per part of the day."""
    return _cells(enriched, "day_period")
