import json
from datetime import date

import pytest

from basketflow.operators.validation import rejected_rows
from basketflow.sinks.writers import flatten_arrays, write_csv_and_parquet, write_dated_report
from basketflow.sources import readers
from tests import builders

HEADER = "transaction_id,user_id,product_id,merchant_id,amount,timestamp,location,payment_method,category"


def test_csv_cells_that_do_not_fit_become_null(spark, tmp_path):
    file = tmp_path / "transactions.csv"
    file.write_text(f"{HEADER}\nT1,U1,P1,M1,abc,00240101120000,Paris,CARD,Books\nT2,,P1,M1,2.5,2024,Paris,,Books\n")
    first, second = readers.read_transactions(spark, str(file)).orderBy("transaction_id").collect()
    assert (first.amount, first.timestamp) == (None, "00240101120000")
    assert (second.user_id, second.amount, second.payment_method) == (None, 2.5, None)


def test_unreadable_rows_on_request(spark, tmp_path):
    """The line of a row with a cell that does not fit; the other columns are as without it."""
    file = tmp_path / "transactions.csv"
    bad = "T1,U1,P1,M1,abc,00240101120000,Paris,CARD,Books"
    file.write_text(f"{HEADER}\n{bad}\nT2,,P1,M1,2.5,2024,Paris,,Books\nT3,U1\n")
    plain = readers.read_transactions(spark, str(file)).orderBy("transaction_id")
    wider = readers.read_transactions(spark, str(file), "line").orderBy("transaction_id")
    assert wider.columns == [*plain.columns, "line"]
    assert wider.drop("line").collect() == plain.collect()
    assert [row.line for row in wider.collect()] == [bad, None, "T3,U1"]
    rejected = rejected_rows(wider, "transactions").where("transaction_id = 'T1'").first()
    assert (rejected.line, rejected.rejection_reason) == (bad, "amount <= 0")


def test_unreadable_users_on_request(spark, tmp_path):
    file = tmp_path / "users.json"
    file.write_text('{"user_id": "U1", "age": 30}\nnot json\n{"user_id": "U2", "age": "old"}\n')
    rows = readers.read_users(spark, str(file), "line").select("user_id", "age", "line").collect()
    assert sorted((str(r.user_id), r.age, r.line) for r in rows) == [
        ("None", None, "not json"),
        ("U1", 30, None),
        ("U2", None, '{"user_id": "U2", "age": "old"}'),
    ]


def test_shuffled_columns_are_refused_also_with_lines(spark, tmp_path):
    file = tmp_path / "transactions.csv"
    names = HEADER.split(",")
    file.write_text(",".join([names[1], names[0], *names[2:]]) + "\nU1,T1,P1,M1,1.0,2024,Paris,CARD,Books\n")
    with pytest.raises(Exception, match="header"):
        readers.read_transactions(spark, str(file), "line").collect()


def test_csv_with_shuffled_columns_is_refused(spark, tmp_path):
    file = tmp_path / "transactions.csv"
    names = HEADER.split(",")
    file.write_text(",".join([names[1], names[0], *names[2:]]) + "\nU1,T1,P1,M1,1.0,2024,Paris,CARD,Books\n")
    with pytest.raises(Exception, match="header"):
        readers.read_transactions(spark, str(file)).collect()


def test_merchant_dates_keep_leading_zeros(spark, tmp_path):
    file = tmp_path / "merchants.csv"
    file.write_text(
        "merchant_id,name,category,region,commission_rate,establishment_date\nM1,Shop,Toys,North,0.1,00120125\n"
    )
    assert readers.read_merchants(spark, str(file)).first().establishment_date == "00120125"


def test_json_lines(spark, tmp_path):
    file = tmp_path / "users.json"
    rows = [
        {"user_id": "U1", "age": 30, "preferred_categories": ["a", "b"]},
        {"user_id": "U2", "age": 30.5, "preferred_categories": None},
    ]
    file.write_text("\n".join(map(json.dumps, rows)) + "\nnot json\n")
    found = {row.user_id: (row.age, row.preferred_categories) for row in readers.read_users(spark, str(file)).collect()}
    assert found == {"U1": (30, ["a", "b"]), "U2": (None, None), None: (None, None)}


def test_parquet_types_are_brought_in_line(spark, tmp_path):
    path = str(tmp_path / "products.parquet")
    spark.sql(
        "select 7 as product_id, 'Lamp' as name, 'Home' as category, 'dear' as price, 'M1' as merchant_id, "
        "'4.5' as rating, 12L as stock, 1 as extra"
    ).write.parquet(path)
    df = readers.read_products(spark, path)
    assert df.schema.simpleString() == builders.products(spark, {}).schema.simpleString()
    assert tuple(df.first()) == ("7", "Lamp", "Home", None, "M1", 4.5, 12)


@pytest.mark.parametrize("label", ["transactions", "users", "products", "merchants"])
def test_missing_source_is_named(spark, tmp_path, label):
    path = str(tmp_path / "absent")
    with pytest.raises(readers.SourceError, match=f"cannot read {label} from .*absent") as caught:
        getattr(readers, f"read_{label}")(spark, path)
    assert caught.value.__cause__ is not None


def test_arrays_are_flattened(spark):
    df = builders.users(spark, {"preferred_categories": ["a", "b"]}, {"preferred_categories": None})
    assert [row.preferred_categories for row in flatten_arrays(df).collect()] == ["a,b", ""]


def test_both_formats_and_overwrite(spark, tmp_path):
    for count in (5, 3):
        df = builders.users(spark, *({"user_id": f"U{i}"} for i in range(count))).repartition(3)
        write_csv_and_parquet(df, str(tmp_path), "u", order=["user_id"], single_file=True)
    assert spark.read.parquet(f"{tmp_path}/parquet/u").count() == 3
    (part,) = (tmp_path / "csv" / "u").glob("part-*.csv")
    lines = part.read_text().splitlines()
    assert lines[0].startswith("user_id,age") and [line[:2] for line in lines[1:]] == ["U0", "U1", "U2"]


def test_large_outputs_keep_their_partitions(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=4)
    write_csv_and_parquet(df, str(tmp_path), "r")
    assert len(list((tmp_path / "parquet" / "r").glob("part-*"))) == 4


def test_dated_report(spark, tmp_path):
    write_dated_report(spark.range(3).toDF("n"), str(tmp_path), "rapport_qualite", date(2026, 10, 9))
    assert len(list((tmp_path / "rapport_qualite_20261009").glob("part-*.csv"))) == 1
