"""CSV and Parquet outputs."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def flatten_arrays(df: DataFrame) -> DataFrame:
    """Arrays as comma-separated text, which CSV can hold; a null array becomes empty text."""
    return df.select(
        *(
            F.concat_ws(",", F.col(f.name)).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name)
            for f in df.schema
        )
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for small reports only: one task writes everything."""
    flat = flatten_arrays(df)
    (flat.coalesce(1) if single_file else flat).write.mode("overwrite").option("header", True).csv(path)


def write_csv_and_parquet(
    df: DataFrame, output: str, name: str, order: Sequence[Column | str] = (), single_file: bool = False
) -> None:
    """``<output>/parquet/<name>`` and ``<output>/csv/<name>``. The query runs once: the CSV is made from the Parquet."""
    root = output.rstrip("/")
    ordered = df.orderBy(*order) if order else df
    ordered.write.mode("overwrite").parquet(f"{root}/parquet/{name}")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{root}/parquet/{name}")
    write_csv(stored.orderBy(*order) if order else stored, f"{root}/csv/{name}", single_file)


def write_dated_report(report: DataFrame, output: str, name: str, day: date) -> None:
    """A small report as one CSV file in a folder that carries the day."""
    write_csv(report, f"{output.rstrip('/')}/{name}_{day:%Y%m%d}", single_file=True)
