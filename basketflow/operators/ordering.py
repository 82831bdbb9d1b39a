"""Positions inside ordered groups, also for groups far too large for one task."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.shared import as_table

# A window task sorts one whole group. Above this size the group is sorted by all tasks together.
MAX_GROUP_ROWS = 1_000_000

# Parts of the range of values that large groups are ranked by; beyond it parts grow.
MAX_PIECES = 1_000

# monotonically_increasing_id() keeps the partition number above this bit and the row number below.
_ROW_BITS = 33


def oversized_groups(
    sizes: DataFrame, keys: Sequence[str], size: str, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame | None:
    """Keys of the groups above the bound, or None if there is none.

    At most (rows / bound) groups can exceed it; count them before a broadcast. ``sizes`` should be
    a stored table, as it is read here and again by the caller.
    """
    big = sizes.where(F.col(size) > max_group_rows).select(*keys)
    return None if big.isEmpty() else big


def rows_before(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Add the number of rows that precede each row of its group, one window task per group."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(ordered).cast("long") - 1)


def rows_before_by_sort(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """The same numbers from a total sort, which cuts large groups into even pieces.

    Rows with equal keys and order (copies) are cut too, by a running row id as the last sort key; so that a
    repeated task gives the same ids, ``df`` should be a scan with row-wise steps only, or have no copies. The
    sorted rows are stored, because piece numbers hold only for one run of the sort.
    """
    copies, slot, piece = f"__{name}_copy", f"__{name}_slot", f"__{name}_piece"
    first, size, offset = f"__{name}_first", f"__{name}_size", f"__{name}_offset"
    ordered = (
        df.withColumn(copies, F.monotonically_increasing_id())
        .orderBy(*keys, *order, copies)
        .withColumn(slot, F.monotonically_increasing_id())
        .drop(copies)
    )
    stored = as_table(ordered, name).withColumn(piece, F.shiftright(slot, _ROW_BITS))
    # One row per group and piece: no more than groups plus pieces in all.
    pieces = stored.groupBy(*keys, piece).agg(F.min(slot).alias(first), F.count("*").alias(size))
    earlier = Window.partitionBy(*keys).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(*keys, piece, first, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(offset))
    position = F.col(offset) + F.col(slot) - F.col(first)
    return stored.join(offsets, [*keys, piece]).select(*df.columns, position.alias(name))


def with_rank(
    df: DataFrame, group: str, value: str, name: str, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Add the rank by falling ``value`` inside ``group``; equal values share a rank."""
    return with_ranks(df, value, {name: group}, max_group_rows)


def with_ranks(df: DataFrame, value: str, ranks: dict[str, str], max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Add ranks by falling ``value`` (a double), each inside a group: rank column -> group column.

    Equal values share a rank; missing values come last. ``df`` should be a stored table: group sizes are looked at before
    the plan is chosen. Groups above the bound are ranked piece by piece of the range of values. One sketch of the
    values cuts them for all ranks, into pieces that hold even parts of all rows and so at most as many of any group.
    """
    sizes = [df.groupBy(group).agg(F.count("*").alias("n")).agg(F.max("n").alias("n"), F.sum("n").alias("rows")) for group in ranks.values()]
    found = reduce(DataFrame.unionAll, (x.select(F.lit(k).alias("k"), "n", "rows") for k, x in enumerate(sizes))).collect()
    largest = {row.k: row.n or 0 for row in found}
    splitters, ranked = None, df
    for k, (name, group) in enumerate(ranks.items()):
        if largest[k] <= max_group_rows:
            ranked = ranked.withColumn(name, F.rank().over(Window.partitionBy(group).orderBy(F.desc(value))))
            continue
        if splitters is None:
            splitters = _splitters(df, value, -(-found[0].rows // max_group_rows))
        ranked = _join_ranks(ranked, _ranks_by_piece(df, group, value, name, splitters), group, value, name)
    return ranked.select(*df.columns, *ranks)


def _splitters(df: DataFrame, value: str, pieces: int) -> list[float]:
    """Falling values that cut the rows into ``pieces`` or ``MAX_PIECES`` about even parts."""
    pieces = min(pieces, MAX_PIECES)
    shares = [k / pieces for k in range(1, pieces)]
    return sorted(set(df.approxQuantile(value, shares, 0.5 / pieces)), reverse=True) if shares else []


def _piece(value: Column, splitters: list[float]) -> Column:
    """How many splitters are above the value, by halving; missing values are in a piece after all others."""
    steps = [1 << k for k in reversed(range(len(splitters).bit_length()))]
    padded = F.array(*map(F.lit, [*splitters, *[float("-inf")] * (2 * (steps[0] if steps else 0))]))
    above = F.lit(0)
    if steps:
        above = F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda below, step: below + F.when(F.element_at(padded, below + step) > value, step).otherwise(0),
        )
    return F.when(value.isNull(), len(splitters) + 1).otherwise(above)


def _ranks_by_piece(df: DataFrame, group: str, value: str, name: str, splitters: list[float]) -> DataFrame:
    """group, value and rank: rows with larger values in the same piece, and all rows of the pieces above."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("n")).withColumn("piece", _piece(F.col(value), splitters))
    above = Window.partitionBy(group, "piece").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(group, value, "piece", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"))
    higher = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # no more rows than groups times pieces
    offsets = counts.groupBy(F.col(group).alias("of"), F.col("piece").alias("part")).agg(F.sum("n").alias("n"))
    offsets = offsets.select("of", "part", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("offset"))
    same = F.col(group).eqNullSafe(F.col("of")) & (F.col("piece") == F.col("part"))
    return before.join(offsets, same).select(group, value, (F.col("before") + F.col("offset") + 1).cast("int").alias(name))


def _join_ranks(df: DataFrame, ranks: DataFrame, group: str, value: str, name: str) -> DataFrame:
    keyed = ranks.select(F.col(group).alias("__of"), F.col(value).alias("__at"), name)
    same = F.col(group).eqNullSafe(F.col("__of")) & F.col(value).eqNullSafe(F.col("__at"))
    return df.join(keyed, same).drop("__of", "__at")
