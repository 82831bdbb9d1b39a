"""Best-selling products."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.functions.rounding import two_decimals
from basketflow.schemas import TOP_PRODUCT_COLUMNS


def top_products(enriched: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with the highest revenue, numbered from 1; ties go by product_id.

    The category is the transaction's own and may vary for one product: the first in alphabetical order is shown.
    """
    # Text cannot sit in a hash-aggregation buffer, so the texts are grouping keys in the pass over the
    # transactions, and only the few resulting rows are merged per product.
    per_variant = (
        enriched.where(F.col("product_name").isNotNull())
        .groupBy("product_id", "product_name", "category", "rating", "stock")
        .agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))
    )
    best = (
        per_variant.groupBy("product_id")
        .agg(
            F.min("product_name").alias("product_name"),
            F.min("category").alias("category"),
            two_decimals(F.sum("amount")).alias("chiffre_affaires"),
            F.sum("n").alias("nb_transactions"),
            F.min("rating").alias("rating"),
            F.min("stock").alias("stock"),
        )
        .orderBy(F.desc("chiffre_affaires"), "product_id")
        .limit(k)
    )
    # at most k rows from here on, so one task is enough to number them
    place = F.row_number().over(Window.orderBy(F.desc("chiffre_affaires"), "product_id"))
    return best.withColumn("rang", place).select(*TOP_PRODUCT_COLUMNS)
