from basketflow.plans.enrichment import enriched, scored_transactions, wide_transactions
from basketflow.operators.suspicion import suspicious_transactions
from basketflow.schemas import ENRICHED_COLUMNS, SCORE_COLUMNS, SUSPICIOUS_COLUMNS
from basketflow.settings import Scoring
from tests import builders
from tests.builders import by_key


def scored(spark, *rows, scoring=Scoring()):
    named = [{"transaction_id": f"T{i}", **row} for i, row in enumerate(rows)]
    return scored_transactions(builders.transactions(spark, *named), scoring)


def test_delay_below_five_minutes(spark):
    df = scored(
        spark,
        {"timestamp": "20240101120000"},
        {"timestamp": "20240101120500"},
        {"timestamp": "20240101120959"},
        {"timestamp": "20240101120959"},
    )
    assert by_key(df, "transaction_id", "delai_precedente_minutes", "cond_delai") == {
        "T0": (None, 0),
        "T1": (5.0, 0),
        "T2": (4.98, 1),
        "T3": (0.0, 1),
    }


def test_exactly_300_percent_is_not_above(spark):
    # sum 20 over 5 rows: the mean is 4 and 16 deviates by exactly 300 %
    df = scored(spark, *({"amount": a} for a in (1.0, 1.0, 1.0, 1.0, 16.0)))
    assert by_key(df, "transaction_id", "ecart_panier_moyen_pct", "cond_montant")["T4"] == (300.0, 0)
    more = scored(spark, *({"amount": a} for a in (1.0, 1.0, 1.0, 1.0, 17.0)))
    assert by_key(more, "transaction_id", "cond_montant")["T4"] == 1


def test_mean_looks_ahead(spark):
    df = scored(spark, {"amount": 10.0}, {"amount": 30.0, "timestamp": "20250101120000"})
    assert set(by_key(df, "transaction_id", "panier_moyen_user").values()) == {20.0}


def test_two_conditions_make_suspicious(spark):
    df = scored(
        spark,
        {"timestamp": "20240101230000", "user_id": "U1"},
        {"timestamp": "20240101230000", "user_id": "U2", "payment_method": "CRYPTO"},
        {"timestamp": "2024010123000x", "user_id": "U3", "payment_method": "CRYPTO"},
        {"user_id": "U4", "payment_method": None},
    )
    assert by_key(df, "transaction_id", *SCORE_COLUMNS, "is_suspicious") == {
        "T0": (0, 1, 0, 0, 1, 0),
        "T1": (0, 1, 0, 1, 2, 1),
        "T2": (0, 0, 0, 1, 1, 0),
        "T3": (0, 0, 0, 0, 0, 0),
    }
    listing = suspicious_transactions(df)
    assert listing.columns == SUSPICIOUS_COLUMNS
    assert [row.transaction_id for row in listing.collect()] == ["T1"]


def test_thresholds_are_arguments(spark):
    df = scored(spark, {"payment_method": "CRYPTO"}, scoring=Scoring(min_conditions=1))
    assert df.first().is_suspicious == 1


def test_enriched_layout_and_row_count(spark):
    facts = builders.transactions(spark, {}, {"transaction_id": "T2", "user_id": None, "merchant_id": "M9"})
    wide = wide_transactions(
        facts, builders.users(spark, {}), builders.products(spark, {}), builders.merchants(spark, {})
    )
    result = enriched(wide)
    assert result.columns == ENRICHED_COLUMNS and len(result.columns) == 36
    assert result.count() == facts.count()
