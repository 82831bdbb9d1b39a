"""Partial results that arrive in batches and are added up when they are read."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketflow.shared import exists

BATCH = "batch"


def named(batch: str) -> str:
    """The name, which becomes part of a path."""
    if not re.fullmatch(r"[\w-]+", batch, re.ASCII):
        raise ValueError("a batch is named by letters, digits, _ and -")
    return batch


class BatchTable:
    """A folder of Parquet files by batch and by one column of the rows, which a load writes and a read is pruned by.

    A batch is written as a whole and replaces what it wrote before, so a failed load is repeated as it is. Partitions of
    other batches are neither read nor written. One writer at a time; readers see a batch when its job is done.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, by: str):
        self._spark, self._path, self._by = spark, path, by
        self._schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def write(self, batch: str, df: DataFrame) -> DataFrame:
        """The rows of the batch as they were stored."""
        own = df.select(*self._schema.names)
        # a partition in few files, a large one in several
        own.hint("rebalance", F.col(self._by)).write.mode("overwrite").partitionBy(self._by).parquet(self._folder(batch))
        return self.of(batch)

    def _folder(self, batch: str) -> str:
        return f"{self._path}/{BATCH}={named(batch)}"

    def of(self, batch: str) -> DataFrame:
        """The rows of one batch, none if it is not there."""
        if not exists(self._spark, self._folder(batch)):
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(self._folder(batch)).select(*self._schema.names)

    def read(self) -> DataFrame:
        """The rows of all batches."""
        schema = StructType([*self._schema.fields]).add(BATCH, "string")
        return self._spark.read.schema(schema).parquet(self._path).select(*self._schema.names)
