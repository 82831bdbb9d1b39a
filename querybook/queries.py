"""Every registered query: name -> function of (session, folder of driver tables)."""

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.functions.calendar import with_calendar, with_time_features, with_transaction_date
from basketflow.functions.labels import age_group
from basketflow.operators import cohorts, merchants, products, revenue
from basketflow.operators.cohort_store import CohortStore
from basketflow.operators.history import with_history
from basketflow.operators.history_store import HistoryStore
from basketflow.operators.joins import duplicate_keys, lookup, orphan_counts
from basketflow.operators.merchant_store import MerchantStore
from basketflow.operators.quality import quality_report, table_counts
from basketflow.operators.suspicion import suspicious_transactions, with_score
from basketflow.operators.user_layout import UserLayout
from basketflow.operators.validation import REASON, rejected_rows, tagged_rows, valid_rows
from basketflow.plans.enrichment import (
    enriched,
    scored_transactions,
    store_by_user,
    wide_of_history,
    wide_of_layout,
    wide_transactions,
    with_dimensions,
    with_merchant,
    with_product,
    with_user,
)
from basketflow.plans.pipeline import ORDER, run_pipeline
from basketflow.schemas import MERCHANT_ATTRIBUTES, PRODUCT_ATTRIBUTES, SCORE_COLUMNS, USER_ATTRIBUTES
from basketflow.settings import InputPaths, Limits, Scoring
from basketflow.shared import as_table, new_path
from basketflow.sinks.writers import flatten_arrays, write_csv_and_parquet
from basketflow.sources import readers
from querybook.fixtures import view, views

Query = Callable[[SparkSession, str], DataFrame]

TABLES = ("transactions", "users", "products", "merchants")
KEYS = {"users": "user_id", "products": "product_id", "merchants": "merchant_id"}

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _valid(spark: SparkSession, folder: str, name: str) -> DataFrame:
    table = "transactions" if name == "transactions_long" else name
    return valid_rows(view(spark, folder, name), table)


def _all_valid(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: _valid(spark, folder, name) for name in TABLES}


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    return wide_transactions(**_all_valid(spark, folder))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return scored_transactions(_valid(spark, folder, "transactions"))


def _long(spark: SparkSession, folder: str) -> DataFrame:
    return with_calendar(_valid(spark, folder, "transactions_long"))


# Sources: the view is written in the source format and read back by the library's reader.


@query("read_csv_transactions")
def read_csv_transactions(spark, folder):
    path = new_path(spark, "transactions.csv")
    view(spark, folder, "transactions").write.option("header", True).csv(path)
    return readers.read_transactions(spark, path)


@query("read_json_users")
def read_json_users(spark, folder):
    path = new_path(spark, "users.json")
    view(spark, folder, "users").write.json(path)
    users = readers.read_users(spark, path)
    return flatten_arrays(users.withColumn("nb_categories", F.size("preferred_categories")))


@query("read_parquet_products")
def read_parquet_products(spark, folder):
    """The file has other types than the reader promises."""
    path = new_path(spark, "products.parquet")
    source = view(spark, folder, "products")
    source.withColumns(
        {"stock": F.col("stock").cast("long"), "price": F.col("price").cast("string")}
    ).write.parquet(path)
    return readers.read_products(spark, path)


@query("read_csv_merchants")
def read_csv_merchants(spark, folder):
    path = new_path(spark, "merchants.csv")
    view(spark, folder, "merchants").write.option("header", True).csv(path)
    return readers.read_merchants(spark, path)


# Validation


def _validity_queries(table: str) -> None:
    def valid(spark, folder):
        return flatten_arrays(_valid(spark, folder, table))

    def rejected(spark, folder):
        return flatten_arrays(rejected_rows(view(spark, folder, table), table))

    QUERIES[f"valid_{table}"] = valid
    QUERIES[f"rejected_{table}"] = rejected


for _table in TABLES:
    _validity_queries(_table)


@query("reject_reason_counts")
def reject_reason_counts(spark, folder):
    counts = [
        tagged_rows(view(spark, folder, name), name)
        .groupBy(F.lit(name).alias("dataset"), REASON)
        .agg(F.count("*").alias("nb_lignes"))
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


# Quality


@query("null_cells")
def null_cells(spark, folder):
    rows = [table_counts(view(spark, folder, name), name).select("dataset", "nb_valeurs_nulles") for name in TABLES]
    return reduce(DataFrame.unionByName, rows)


def _orphan_query(table: str, key: str) -> None:
    def orphans(spark, folder):
        return orphan_counts(view(spark, folder, "transactions"), {key: view(spark, folder, table)})

    QUERIES[f"orphans_{key.removesuffix('_id')}"] = orphans


for _table, _key in KEYS.items():
    _orphan_query(_table, _key)


@query("quality_report")
def report(spark, folder):
    return quality_report(**views(spark, folder, *TABLES))


@query("reject_rate")
def reject_rate(spark, folder):
    return quality_report(**views(spark, folder, *TABLES)).select("dataset", "taux_rejet")


@query("duplicate_keys")
def duplicate_key_counts(spark, folder):
    rows = [
        duplicate_keys(view(spark, folder, name), key).agg(
            F.lit(name).alias("dataset"), F.count("*").alias("nb_cles_en_double")
        )
        for name, key in {**KEYS, "transactions": "user_id"}.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# Scalar functions


@query("parse_timestamps")
def parse_timestamps(spark, folder):
    return with_calendar(view(spark, folder, "transactions")).select(
        "transaction_id", "timestamp", "transaction_date"
    )


@query("time_features")
def time_features(spark, folder):
    return with_calendar(view(spark, folder, "transactions")).select(
        "transaction_id", "hour", "day_of_week", "month", "is_weekend", "day_period", "is_working_hours"
    )


@query("age_groups")
def age_groups(spark, folder):
    return view(spark, folder, "users").select("user_id", "age", age_group(F.col("age")).alias("age_group"))


@query("revenue_by_period")
def revenue_by_period(spark, folder):
    return revenue.by_period(with_calendar(_valid(spark, folder, "transactions")))


# Joins


def _join_query(table: str, attributes: list[tuple[str, str]]) -> None:
    def joined(spark, folder):
        facts = _valid(spark, folder, "transactions")
        outputs = [output for _, output in attributes]
        return lookup(facts, _valid(spark, folder, table), KEYS[table], attributes).select(
            "transaction_id", KEYS[table], *outputs
        )

    QUERIES[f"join_{table}"] = joined


_join_query("users", USER_ATTRIBUTES)
_join_query("products", PRODUCT_ATTRIBUTES)
_join_query("merchants", MERCHANT_ATTRIBUTES)


@query("join_broadcast_parity")
def join_broadcast_parity(spark, folder):
    return with_dimensions(**_dimension_arguments(spark, folder), broadcast=True).drop("age_group")


def _dimension_arguments(spark, folder):
    valid = _all_valid(spark, folder)
    return {"facts": valid.pop("transactions"), **valid}


# Per-user windows and scoring


def _history_query(name: str, *columns: str) -> None:
    def history(spark, folder):
        return _scored(spark, folder).select("transaction_id", *columns)

    QUERIES[name] = history


_history_query("transaction_rank", "user_id", "transaction_date", "transaction_rank")
_history_query("user_totals", "user_id", "total_transactions_user")
_history_query("rolling_7d_amount", "montant_cumule_7j")
_history_query("active_users", "is_active_user")
_history_query("days_since_previous", "jours_depuis_achat_precedent")
_history_query("purchase_delay", "delai_precedente_minutes")
_history_query("basket_deviation", "panier_moyen_user", "ecart_panier_moyen_pct")
_history_query("suspicion_flags", *SCORE_COLUMNS, "is_suspicious")
QUERIES["suspicious_transactions"] = lambda spark, folder: suspicious_transactions(_scored(spark, folder))


HISTORY = (
    "transaction_rank",
    "total_transactions_user",
    "montant_cumule_7j",
    "is_active_user",
    "jours_depuis_achat_precedent",
    "delai_precedente_minutes",
    "panier_moyen_user",
)


def _large_scale_query(name: str, **bounds: int) -> None:
    """All history columns, with bounds that send the rows the way of users and seconds too large for one task."""

    def history(spark, folder):
        dated = with_transaction_date(_valid(spark, folder, "transactions"))
        return with_score(with_time_features(with_history(dated, **bounds))).select("transaction_id", *HISTORY)

    QUERIES[name] = history


_large_scale_query("history_by_day", max_user_rows=0)
_large_scale_query("history_mixed", max_user_rows=50, max_group_rows=1)


def _two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions of valid rows with their history, from a store that is loaded in two halves.

    The days of the second half come from the rows of these days and the state; rows without a date are in both halves.
    """
    dated = with_transaction_date(_valid(spark, folder, "transactions"))
    first, last = dated.agg(F.to_date(F.min("transaction_date")), F.to_date(F.max("transaction_date"))).first()
    middle = first + (last - first) // 2
    late = F.coalesce(F.to_date("transaction_date") > middle, F.crc32(F.col("transaction_id").cast("binary")) % 2 == 0)
    store = HistoryStore(spark, new_path(spark, "history"))
    store.load("first", dated.where(~late))
    store.fold(middle - timedelta(days=8))
    store.load("second", dated.where(late))
    return store.history(last=middle).unionByName(store.history(first=middle + timedelta(days=1)))


@query("history_two_loads")
def history_two_loads(spark, folder):
    return with_score(with_time_features(_two_loads(spark, folder))).select("transaction_id", *HISTORY)


@query("enriched_two_loads")
def enriched_two_loads(spark, folder):
    dimensions = {name: _valid(spark, folder, name) for name in KEYS}
    return enriched(wide_of_history(_two_loads(spark, folder), **dimensions))


def _layout(spark: SparkSession, folder: str, **bounds: int) -> UserLayout:
    """Valid transactions and users stored by user, opened anew as a later session would."""
    path = new_path(spark, "by_user")
    store_by_user(spark, path, _valid(spark, folder, "transactions"), _valid(spark, folder, "users"), **bounds).close()
    return UserLayout.open(spark, path)


@query("history_by_layout")
def history_by_layout(spark, folder):
    """With a bound that puts part of the users into the table of busy ones."""
    history = _layout(spark, folder, max_user_rows=50).history()
    return with_score(with_time_features(history)).select("transaction_id", *HISTORY)


@query("enriched_by_layout")
def enriched_by_layout(spark, folder):
    products, merchants = _valid(spark, folder, "products"), _valid(spark, folder, "merchants")
    return enriched(wide_of_layout(_layout(spark, folder), products, merchants))


QUERIES["enriched_transactions"] = lambda spark, folder: enriched(_wide(spark, folder))


# Analytics


@query("merchant_kpis")
def merchant_kpis(spark, folder):
    return merchants.merchant_kpis(_wide(spark, folder))


@query("merchant_ranks")
def merchant_ranks(spark, folder):
    return merchants.merchant_kpis(_wide(spark, folder)).select(
        "merchant_id", "merchant_category", "region", "chiffre_affaires", "rang_ca_categorie", "rang_ca_region"
    )


@query("merchant_kpis_by_sort")
def merchant_kpis_by_sort(spark, folder):
    """Ranks by the way of groups too large for one task."""
    return merchants.merchant_kpis(_wide(spark, folder), max_group_rows=1)


def _halves(transactions: DataFrame) -> list[tuple[str, DataFrame]]:
    """Two batches that share days, merchants and users."""
    half = F.crc32(F.col("transaction_id").cast("binary")) % 2
    return [(f"half-{k}", transactions.where(half == k)) for k in range(2)]


@query("merchant_kpis_two_loads")
def merchant_kpis_two_loads(spark, folder):
    """The same from daily partial results of two batches, distinct users from bitmaps."""
    store = MerchantStore(spark, new_path(spark, "merchants"))
    for batch, rows in _halves(as_table(_wide(spark, folder), "wide")):
        store.load(batch, rows)
    return merchants.with_merchant_ranks(store.totals())


# The reports below need neither history nor score, and each joins only the dimensions it reads.


@query("revenue_by_age_group")
def revenue_by_age_group(spark, folder):
    facts = with_user(_valid(spark, folder, "transactions"), _valid(spark, folder, "users"))
    joined = with_merchant(facts, _valid(spark, folder, "merchants"))
    return joined.groupBy("region").agg(*merchants.age_group_revenue())


@query("top10_products")
def top10_products(spark, folder):
    return products.top_products(
        with_product(_valid(spark, folder, "transactions"), _valid(spark, folder, "products"))
    )


@query("revenue_by_category_region")
def revenue_by_category_region(spark, folder):
    return revenue.by_category_and_region(
        with_merchant(_valid(spark, folder, "transactions"), _valid(spark, folder, "merchants"))
    )


@query("revenue_by_payment_period")
def revenue_by_payment_period(spark, folder):
    return revenue.by_payment_and_period(with_calendar(_valid(spark, folder, "transactions")))


@query("first_purchase")
def first_purchase(spark, folder):
    return cohorts.first_purchase(_long(spark, folder))


@query("cohort_sizes")
def cohort_sizes(spark, folder):
    return cohorts.cohort_sizes(cohorts.first_purchase(_long(spark, folder)))


@query("cohort_retention")
def cohort_retention(spark, folder):
    return cohorts.cohort_retention(_long(spark, folder))


def _cohort_store(spark: SparkSession, folder: str) -> CohortStore:
    store = CohortStore(spark, new_path(spark, "cohorts"))
    for batch, rows in _halves(_long(spark, folder)):
        store.load(batch, rows)
    return store


@query("cohort_retention_two_loads")
def cohort_retention_two_loads(spark, folder):
    return _cohort_store(spark, folder).retention()


@query("cohort_sizes_by_bitmap")
def cohort_sizes_by_bitmap(spark, folder):
    return _cohort_store(spark, folder).sizes()


@query("best_cohort_3m")
def best_cohort_3m(spark, folder):
    return cohorts.best_cohort(cohorts.cohort_retention(_long(spark, folder)))


# Sinks


@query("sink_roundtrip")
def sink_roundtrip(spark, folder):
    """Rejected users, array column included, written in both formats and read back."""
    output = new_path(spark, "output")
    rejected = rejected_rows(view(spark, folder, "users"), "users")
    write_csv_and_parquet(rejected, output, "rejets_users")
    flat = flatten_arrays(rejected)
    from_csv = spark.read.schema(flat.schema).csv(f"{output}/csv/rejets_users", header=True, enforceSchema=False)
    from_parquet = flatten_arrays(spark.read.parquet(f"{output}/parquet/rejets_users"))
    return from_csv.withColumn("format", F.lit("csv")).unionByName(
        from_parquet.withColumn("format", F.lit("parquet"))
    )


# The staged pipeline: the views are written in the four source formats, run through all steps and read back.


def _pipeline_output(spark: SparkSession, folder: str, upto: str = "all", **settings) -> str:
    inputs, output = InputPaths.under(new_path(spark, "inputs")), new_path(spark, "outputs")
    view(spark, folder, "transactions").write.option("header", True).csv(inputs.transactions)
    view(spark, folder, "users").write.json(inputs.users)
    view(spark, folder, "products").write.parquet(inputs.products)
    view(spark, folder, "merchants").write.option("header", True).csv(inputs.merchants)
    run_pipeline(spark, inputs, output, upto, day=date(2026, 1, 31), **settings)
    return output


@query("pipeline_report")
def pipeline_report(spark, folder):
    """The dated report as it was written."""
    path = f"{_pipeline_output(spark, folder, 'ingestion')}/rapport_qualite_20260131"
    schema = quality_report(**views(spark, folder, *TABLES)).schema
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


@query("pipeline_enriched")
def pipeline_enriched(spark, folder):
    path = f"{_pipeline_output(spark, folder, 'transformation')}/parquet/transactions_enrichies"
    return spark.read.parquet(path)


@query("pipeline_kpis")
def pipeline_kpis(spark, folder):
    return spark.read.parquet(f"{_pipeline_output(spark, folder)}/parquet/kpi_marchands")


OTHER_LIMITS = Limits(min_age=21, max_age=60, min_rating=2.0, max_rating=4.5, max_commission=0.5)
OTHER_SCORING = Scoring(window_days=3, active_days=2, amount_pct=150.0, delay_minutes=600.0, min_conditions=1)


@query("pipeline_other_thresholds")
def pipeline_other_thresholds(spark, folder):
    """The enriched rows under thresholds that are all off their defaults."""
    output = _pipeline_output(spark, folder, "transformation", limits=OTHER_LIMITS, scoring=OTHER_SCORING)
    return spark.read.parquet(f"{output}/parquet/transactions_enrichies")


@query("written_order")
def written_order(spark, folder):
    """A report as one CSV file, with the number of the line that each row is on."""
    output = new_path(spark, "output")
    cells = cohorts.cohort_retention(_long(spark, folder))
    write_csv_and_parquet(cells, output, "cohortes_retention", ORDER["cohortes_retention"], single_file=True)
    # whole files are read by one task here, so ids follow the lines; the report is small whatever the input
    lines = spark.read.text(f"{output}/csv/cohortes_retention").select(
        F.monotonically_increasing_id().alias("at"), F.split("value", ",").alias("cells")
    )
    line = F.row_number().over(Window.orderBy("at")).cast("long") - 1
    return (
        lines.withColumn("line", line)
        .where("line > 0")
        .select("line", F.col("cells")[0].alias("cohort_month"), F.col("cells")[1].cast("int").alias("period_index"))
    )
