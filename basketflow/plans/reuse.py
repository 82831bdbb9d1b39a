"""Keeping a frame for several uses, and letting go of it."""

from collections.abc import Sequence
from contextlib import AbstractContextManager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame

from basketflow.shared import as_counted_table, as_table


class Reuse(AbstractContextManager):
    """How frames with several readers are kept: ``table``, ``persist`` or ``none``.

    ``table`` writes Parquet to the shared folder: it survives lost executors, and later reads skip columns
    and row groups. ``persist`` suits data that fits the executors; it is released on exit. Some operators write
    small tables of their own in every mode (sizes, totals, sorted pieces); ``run_folder`` removes all tables.
    """

    MODES = ("table", "persist", "none")

    def __init__(self, mode: str = "table"):
        if mode not in self.MODES:
            raise ValueError(f"reuse must be one of {', '.join(self.MODES)}")
        self.mode = mode
        self._persisted: list[DataFrame] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        if self.mode == "table":
            return as_table(df, name)
        if self.mode == "persist":
            self._persisted.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def keep_counted(self, df: DataFrame, name: str, counts: Sequence[Column]) -> tuple[DataFrame, dict | None]:
        """Also aggregates over all rows where the frame is written, None where it is not."""
        return as_counted_table(df, name, counts) if self.mode == "table" else (self.keep(df, name), None)

    def __exit__(self, *exc_info) -> None:
        while self._persisted:
            self._persisted.pop().unpersist()
