"""Small helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketflow.shared import as_table

#: Texts that a Python worker handles at a time, in characters and rows.
SLICE_CHARS, SLICE_ROWS = 1_000_000, 1_000


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()).resolve() / f"{top.name}.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for source in sorted(top.rglob("*.py")):
            packed.write(source, source.relative_to(top.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of crc32 over the id's decimal text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def slices(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece holds few characters; a longer text stands alone."""
    for batch in batches:
        begin, chars = 0, 0
        for i, value in enumerate(batch.column(text)):
            size = len(value.as_buffer()) if value.is_valid else 0
            if i > begin and (chars + size > SLICE_CHARS or i - begin >= SLICE_ROWS):
                yield batch.slice(begin, i - begin)
                begin, chars = i, 0
            chars += size
        if batch.num_rows > begin:
            yield batch.slice(begin)


def texts_of(batch: pa.RecordBatch, text: int = 1) -> list[str]:
    """The texts; null counts as empty."""
    return [value or "" for value in batch.column(text).to_pylist()]


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The columns an operator reads, under its own names, so that other columns cannot clash."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more
    )


def map_texts(
    frame: DataFrame, function: Callable[[pa.RecordBatch, list[str]], dict], schema: str
) -> DataFrame:
    """Apply ``function(piece, texts) -> columns`` to pieces of bounded size; columns follow ``schema``."""
    ship(frame.sparkSession)
    arrow_schema = arrow_types(schema)

    def run(batches):
        for piece in slices(batches):
            columns = function(piece, texts_of(piece))
            yield pa.RecordBatch.from_arrays(
                [
                    x if isinstance(x, pa.Array) else pa.array(x, type=field.type)
                    for field, x in ((field, columns[field.name]) for field in arrow_schema)
                ],
                schema=arrow_schema,
            )

    return frame.mapInArrow(run, schema)


def extend_texts(
    docs: DataFrame, function: Callable[[list[str]], dict], added: str, text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs`` with further columns from its texts, row by row and without a shuffle.

    ``function(texts) -> columns`` follows ``added``, whose names must not be columns of ``docs`` already.
    """
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)
    more = arrow_types(added)
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(added).fields])

    def run(batches):
        for piece in slices(batches, place):
            columns = function(texts_of(piece, place))
            extra = [pa.array(columns[field.name], type=field.type) for field in more]
            yield pa.RecordBatch.from_arrays([*piece.columns, *extra], names=[*piece.schema.names, *more.names])

    return docs.mapInArrow(run, schema)


def free_name(docs: DataFrame, name: str) -> str:
    """The name, longer if ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def told_apart(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` and the name of a column that tells its rows apart: the id, or where ids repeat or are missing, a further
    column with a hash of id and text. Rows that agree in both are one."""
    repeated = docs.groupBy(id_col).agg(F.count("*").alias("n")).where(F.col(id_col).isNull() | (F.col("n") > 1))
    if repeated.isEmpty():
        return docs, id_col
    key = free_name(docs, "row")
    return docs.withColumn(key, F.xxhash64(id_col, text_col)), key


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", broadcast_rows: int = 2_000_000) -> DataFrame:
    """``docs`` but the rows whose id is in the one column of ``ids``; null ids stay.

    The ids are counted: up to ``broadcast_rows`` they are broadcast, and more are joined by a shuffle.
    """
    gone = free_name(docs, "gone")
    ids = as_table(ids.toDF(gone).where(f"{gone} is not null").distinct(), "ids")
    aside = F.broadcast(ids) if ids.count() <= broadcast_rows else ids
    return docs.join(aside, docs[id_col] == aside[gone], "left_anti")


def stretch(text: str, chars: int, place: Column) -> Column:
    """A text of up to ``chars`` characters as it is; of a longer one so many, from where the hash ``place`` says."""
    last = F.greatest(F.length(text) - chars, F.lit(0))
    return F.substring(text, (F.pmod(place, last + 1) + 1).cast("int"), F.lit(chars))


def arrow_types(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))
