"""Table layouts and fixed output values shared by all operators."""

from pyspark.sql import types as T

# Column names, order and types of the four input tables.
TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)
USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("annual_income", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("preferred_categories", T.ArrayType(T.StringType())),
        T.StructField("registration_date", T.StringType()),
    ]
)
PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("stock", T.IntegerType()),
    ]
)
MERCHANTS = T.StructType(
    [
        T.StructField("merchant_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("commission_rate", T.DoubleType()),
        T.StructField("establishment_date", T.StringType()),
    ]
)

# Attributes each dimension gives to a transaction, as (source column, output column).
USER_ATTRIBUTES = [
    ("age", "age"),
    ("annual_income", "annual_income"),
    ("city", "city"),
    ("customer_segment", "customer_segment"),
]
PRODUCT_ATTRIBUTES = [
    ("name", "product_name"),
    ("price", "product_price"),
    ("rating", "rating"),
    ("stock", "stock"),
]
MERCHANT_ATTRIBUTES = [
    ("name", "merchant_name"),
    ("category", "merchant_category"),
    ("region", "region"),
    ("commission_rate", "commission_rate"),
]

# The enriched output and the suspicious listing, in column order.
ENRICHED_COLUMNS = [
    "transaction_id",
    "user_id",
    "product_id",
    "merchant_id",
    "amount",
    "timestamp",
    "transaction_date",
    "location",
    "payment_method",
    "category",
    "age",
    "annual_income",
    "city",
    "customer_segment",
    "age_group",
    "product_name",
    "product_price",
    "rating",
    "stock",
    "merchant_name",
    "merchant_category",
    "region",
    "commission_rate",
    "hour",
    "day_of_week",
    "month",
    "is_weekend",
    "day_period",
    "is_working_hours",
    "transaction_rank",
    "total_transactions_user",
    "montant_cumule_7j",
    "is_active_user",
    "jours_depuis_achat_precedent",
    "ecart_panier_moyen_pct",
    "is_suspicious",
]
SCORE_COLUMNS = ["cond_montant", "cond_night", "cond_delai", "cond_crypto", "nb_conditions"]
SUSPICIOUS_COLUMNS = [
    "transaction_id",
    "user_id",
    "merchant_id",
    "transaction_date",
    "amount",
    "panier_moyen_user",
    "ecart_panier_moyen_pct",
    "day_period",
    "delai_precedente_minutes",
    "payment_method",
    *SCORE_COLUMNS,
    "is_suspicious",
]

# Age-group labels with the KPI column each one feeds.
YOUNG = "Jeune"
ADULT = "Adulte"
MIDDLE_AGED = "Âge Moyen"
SENIOR = "Senior"
AGE_GROUP_REVENUE = {YOUNG: "ca_jeune", ADULT: "ca_adulte", MIDDLE_AGED: "ca_age_moyen", SENIOR: "ca_senior"}

# Columns of the reports, in order.
KPI_COLUMNS = [
    "merchant_id",
    "merchant_name",
    "merchant_category",
    "region",
    "chiffre_affaires",
    "nb_transactions",
    "nb_clients_uniques",
    "montant_moyen",
    "rang_ca_categorie",
    "rang_ca_region",
    "commission_totale",
    *AGE_GROUP_REVENUE.values(),
    "taux_suspectes_pct",
]
TOP_PRODUCT_COLUMNS = [
    "rang",
    "product_id",
    "product_name",
    "category",
    "chiffre_affaires",
    "nb_transactions",
    "rating",
    "stock",
]
RETENTION_COLUMNS = [
    "cohort_month",
    "period_index",
    "taille_cohorte",
    "nb_utilisateurs_actifs",
    "taux_retention",
    "chiffre_affaires",
    "revenu_moyen_par_utilisateur",
]
REGION_COLUMNS = ["region", "category", "chiffre_affaires", "nb_transactions", "part_ca_region_pct"]

# Fixed value: text layout of the transaction timestamp.
TIMESTAMP_FORMAT = "yyyyMMddHHmmss"
