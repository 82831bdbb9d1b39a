"""From valid tables to one wide row per valid transaction."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.functions.calendar import require_utc, with_time_features, with_transaction_date
from basketflow.functions.labels import age_group
from basketflow.operators.history import with_history
from basketflow.operators.joins import broadcast_if_small, lookup
from basketflow.operators.suspicion import with_score
from basketflow.operators.user_layout import UserLayout
from basketflow.schemas import ENRICHED_COLUMNS, MERCHANT_ATTRIBUTES, PRODUCT_ATTRIBUTES, USER_ATTRIBUTES
from basketflow.settings import Scoring


def scored_transactions(transactions: DataFrame, scoring: Scoring = Scoring()) -> DataFrame:
    """History, calendar and score; needs no dimension."""
    return with_score(with_time_features(_with_history(transactions, scoring)), scoring)


def _with_history(transactions: DataFrame, scoring: Scoring, users: DataFrame | None = None) -> DataFrame:
    require_utc(transactions.sparkSession)
    return with_history(with_transaction_date(transactions), scoring, users=users)


def with_user(facts: DataFrame, users: DataFrame, broadcast: bool = False) -> DataFrame:
    """Attributes of the user and its age group."""
    wide = lookup(facts, broadcast_if_small(users, broadcast), "user_id", USER_ATTRIBUTES)
    return wide.withColumn("age_group", age_group(F.col("age")))


def with_product(facts: DataFrame, products: DataFrame, rows: int | None = None) -> DataFrame:
    """Attributes of the product. Products are counted unless their ``rows`` are known, and broadcast if there are few."""
    return lookup(facts, broadcast_if_small(products, enabled=True, rows=rows), "product_id", PRODUCT_ATTRIBUTES)


def with_merchant(facts: DataFrame, merchants: DataFrame, rows: int | None = None) -> DataFrame:
    """Attributes of the transaction's own merchant, who are counted unless their ``rows`` are known, as products are."""
    return lookup(facts, broadcast_if_small(merchants, enabled=True, rows=rows), "merchant_id", MERCHANT_ATTRIBUTES)


def with_dimensions(
    facts: DataFrame, users: DataFrame, products: DataFrame, merchants: DataFrame, broadcast: bool = False
) -> DataFrame:
    """Attributes of the user, the product and the transaction's own merchant."""
    return with_merchant(with_product(with_user(facts, users, broadcast), products), merchants)


def wide_transactions(
    transactions: DataFrame,
    users: DataFrame,
    products: DataFrame,
    merchants: DataFrame,
    scoring: Scoring = Scoring(),
    broadcast: bool = False,
    rows: dict[str, int] | None = None,
) -> DataFrame:
    """Enriched columns plus the score evidence. All four inputs hold valid rows only.

    ``rows`` has the number of rows of dimensions where it is known; others are counted before they are broadcast.
    """
    known = rows or {}
    # Shuffles come first and widest last: the history moves the transaction's own columns only, users meet it
    # where it is partitioned by user, and whatever one row can compute by itself (calendar, score) is added after
    # the last join.
    of_user = broadcast_if_small(attributes_of(users), broadcast, rows=known.get("users"))
    return _finished(_with_history(transactions, scoring, of_user), products, merchants, scoring, known)


def attributes_of(users: DataFrame) -> DataFrame:
    """Users' key and attributes under the names of the output."""
    return users.select("user_id", *(F.col(source).alias(output) for source, output in USER_ATTRIBUTES))


def _finished(history: DataFrame, products: DataFrame, merchants: DataFrame, scoring: Scoring, known: dict[str, int]) -> DataFrame:
    facts = with_product(history.withColumn("age_group", age_group(F.col("age"))), products, known.get("products"))
    joined = with_merchant(facts, merchants, known.get("merchants"))
    return with_score(with_time_features(joined), scoring)


def store_by_user(spark: SparkSession, path: str, transactions: DataFrame, users: DataFrame, **bounds: int) -> UserLayout:
    """Store valid transactions and users by user; ``bounds`` are those of :meth:`UserLayout.write`."""
    require_utc(spark)
    return UserLayout.write(spark, path, with_transaction_date(transactions), attributes_of(users), **bounds)


def wide_of_layout(
    layout: UserLayout,
    products: DataFrame,
    merchants: DataFrame,
    scoring: Scoring = Scoring(),
    broadcast: bool = False,
    rows: dict[str, int] | None = None,
) -> DataFrame:
    """The wide rows from transactions and users that :func:`store_by_user` has stored."""
    return _finished(layout.history(scoring, broadcast), products, merchants, scoring, rows or {})


def wide_of_history(
    history: DataFrame,
    users: DataFrame,
    products: DataFrame,
    merchants: DataFrame,
    scoring: Scoring = Scoring(),
    broadcast: bool = False,
) -> DataFrame:
    """The same from transactions that have their history already, for instance those of new days."""
    joined = with_dimensions(history, users, products, merchants, broadcast)
    return with_score(with_time_features(joined), scoring)


def enriched(wide: DataFrame) -> DataFrame:
    return wide.select(*ENRICHED_COLUMNS)
