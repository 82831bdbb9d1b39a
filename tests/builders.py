"""Small hand-written rows for unit tests."""

from basketflow.schemas import MERCHANTS, PRODUCTS, TRANSACTIONS, USERS


def transactions(spark, *rows: dict):
    blank = {
        "transaction_id": "T1",
        "user_id": "U1",
        "product_id": "P1",
        "merchant_id": "M1",
        "amount": 10.0,
        "timestamp": "20240101120000",
        "location": "Paris",
        "payment_method": "CARD",
        "category": "Books",
    }
    return spark.createDataFrame([{**blank, **row} for row in rows], TRANSACTIONS)


def users(spark, *rows: dict):
    blank = {
        "user_id": "U1",
        "age": 30,
        "annual_income": 1000.0,
        "city": "Paris",
        "customer_segment": "Standard",
        "preferred_categories": ["Books"],
        "registration_date": "20230101",
    }
    return spark.createDataFrame([{**blank, **row} for row in rows], USERS)


def products(spark, *rows: dict):
    blank = {
        "product_id": "P1",
        "name": "Lamp",
        "category": "Home",
        "price": 20.0,
        "merchant_id": "M1",
        "rating": 4.0,
        "stock": 5,
    }
    return spark.createDataFrame([{**blank, **row} for row in rows], PRODUCTS)


def merchants(spark, *rows: dict):
    blank = {
        "merchant_id": "M1",
        "name": "Shop",
        "category": "Home",
        "region": "North",
        "commission_rate": 0.1,
        "establishment_date": "20150101",
    }
    return spark.createDataFrame([{**blank, **row} for row in rows], MERCHANTS)


def by_key(df, key: str, *columns: str) -> dict:
    """Key -> value of one column, or tuple of several."""
    rows = df.select(key, *columns).collect()
    return {row[0]: row[1] if len(columns) == 1 else tuple(row)[1:] for row in rows}
