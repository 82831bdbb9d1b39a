"""The four inputs: CSV, JSON lines and Parquet with explicit schemas."""

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from basketflow.schemas import MERCHANTS, PRODUCTS, TRANSACTIONS, USERS


class SourceError(RuntimeError):
    """A source could not be opened; the message names it and its path."""


def _open(label: str, path: str, reader: Callable[[], DataFrame]) -> DataFrame:
    try:
        return reader()
    except Exception as error:
        raise SourceError(f"cannot read {label} from {path}: {error}") from error


# The readers of text formats take a name for a last column with the whole text of a row of which a cell does not fit;
# it is null in all other rows.


def _text(spark: SparkSession, schema: StructType, unreadable: str | None) -> DataFrameReader:
    """A cell that does not fit its type becomes null."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if unreadable is None:
        return reader.schema(schema)
    wider = StructType([*schema.fields, StructField(unreadable, StringType())])
    return reader.schema(wider).option("columnNameOfCorruptRecord", unreadable)


def _csv(spark: SparkSession, schema: StructType, path: str, unreadable: str | None) -> DataFrame:
    # enforceSchema=false compares the header with the schema, so shuffled columns fail instead of
    # landing under the wrong names
    return _text(spark, schema, unreadable).options(header=True, enforceSchema=False).csv(path)


def read_transactions(spark: SparkSession, path: str, unreadable: str | None = None) -> DataFrame:
    return _open("transactions", path, lambda: _csv(spark, TRANSACTIONS, path, unreadable))


def read_users(spark: SparkSession, path: str, unreadable: str | None = None) -> DataFrame:
    """JSON lines; a line that is not JSON becomes a row of nulls, which validation then rejects."""
    return _open("users", path, lambda: _text(spark, USERS, unreadable).json(path))


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Parquet in whatever types the file has, brought to the expected ones; misfits become null."""
    return _open(
        "products",
        path,
        lambda: spark.read.parquet(path).select(
            *(F.col(field.name).try_cast(field.dataType).alias(field.name) for field in PRODUCTS)
        ),
    )


def read_merchants(spark: SparkSession, path: str, unreadable: str | None = None) -> DataFrame:
    """CSV without type inference: no extra pass, and dates keep their leading zeros."""
    return _open("merchants", path, lambda: _csv(spark, MERCHANTS, path, unreadable))
