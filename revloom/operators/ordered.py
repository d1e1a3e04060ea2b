"""Ordered work within groups of any size.

A window puts a whole group into one task. That is fine for ordinary groups, so
they are windowed directly. When a count shows a group above ``block_rows``, rows
are sorted by range over group and order, so each partition holds consecutive rows;
totals per partition and group are added up, and with them every row knows its
place in its group. Rows are then cut into blocks of consecutive rows, each block
also gets the few rows before it as context, and the window runs per block.

Every row gets a number of its own when it comes in. It is the last order column
and the only key by which rows are joined, so rows with null or repeated keys are
neither lost nor multiplied, and rows that tie keep the order they came in, however
large their group is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revloom.session import written

BLOCK_ROWS = 1_000_000

ROW, _BLOCK, _CONTEXT, _RANK, _PART = "_row", "_block", "_context", "_rank", "_part"


@dataclass(frozen=True)
class Blocks:
    """Rows laid out so that windows over ``keys`` ordered by ``order`` see every
    row they need; ``close`` removes the context rows and the row number again."""

    df: DataFrame
    keys: list[str]
    order: list[str]

    def window(self):
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def close(self, df: DataFrame) -> DataFrame:
        return df.where(self.rows()).drop(_CONTEXT, _BLOCK, ROW)

    def rows(self) -> Column:
        """Condition that keeps the real rows, for use before an aggregation."""
        return ~F.col(_CONTEXT) if _CONTEXT in self.df.columns else F.lit(True)


def has_hot_group(df: DataFrame, group: list[str], block_rows: int) -> bool:
    """Whether some group holds more than ``block_rows`` rows (reads only the keys).

    Counts are combined per task first, so a hot group is no burden here. This
    runs a job while the query is built.
    """
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return not counts.where(F.col("n") > block_rows).isEmpty()


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW, F.monotonically_increasing_id())


def blocks(
    df: DataFrame,
    group: list[str],
    order: list[str],
    overlap: int = 1,
    block_rows: int = BLOCK_ROWS,
    max_group_rows: int | None = None,
) -> Blocks:
    """Lay rows out for windows that look at most ``overlap`` rows back.

    ``max_group_rows`` states a bound that holds by construction and saves the
    count. Hot groups cost one copy of the rows in the shared folder and one more
    shuffle of them.
    """
    rows = _numbered(df)
    ordered = [*order, ROW]
    known_small = max_group_rows is not None and max_group_rows <= block_rows
    if known_small or not has_hot_group(df, group, block_rows):
        return Blocks(rows, list(group), ordered)
    rows = written(rows, "numbered")
    size = max(block_rows, overlap)
    ranks = _totals(rows.select(*dict.fromkeys([*group, *ordered])), group, ordered, F.lit(1), _RANK)
    at = F.col(_RANK) - 1
    own = F.floor(at / size)
    copies = F.when(
        at % size >= size - overlap,
        F.array(
            F.struct(own.alias(_BLOCK), F.lit(False).alias(_CONTEXT)),
            F.struct((own + 1).alias(_BLOCK), F.lit(True).alias(_CONTEXT)),
        ),
    ).otherwise(F.array(F.struct(own.alias(_BLOCK), F.lit(False).alias(_CONTEXT))))
    placed = ranks.select(ROW, F.inline(copies))
    return Blocks(rows.join(placed, ROW), [*group, _BLOCK], ordered)


def rank(
    df: DataFrame,
    group: list[str],
    order: list[str],
    name: str,
    block_rows: int = BLOCK_ROWS,
    narrow: bool = False,
) -> DataFrame:
    """Add the 1-based position of each row in its group (``group=[]``: overall)."""
    return running_total(df, group, order, F.lit(1), name, block_rows, narrow)


def running_total(
    df: DataFrame,
    group: list[str],
    order: list[str],
    value: Column,
    name: str,
    block_rows: int = BLOCK_ROWS,
    narrow: bool = False,
) -> DataFrame:
    """Add the sum of a whole-number value up to and including each row.

    With hot groups the rows are written; only group, order and value are sorted
    by range, and other columns are joined back by the number of the row. ``narrow``
    rows are sorted whole, which saves writing them and the join.
    """
    if not has_hot_group(df, group, block_rows):
        total = F.sum(value.cast("long")).over(_upto(group, [*order, ROW]))
        return _numbered(df).withColumn(name, total).drop(ROW)
    ordered = [*order, ROW]
    keys = list(dict.fromkeys([*group, *ordered]))
    if narrow or set(df.columns) <= set(keys):
        return _totals(_numbered(df), group, ordered, value, name).drop(ROW)
    rows = written(_numbered(df), "numbered")
    thin = rows.select(*keys, value.alias("_value"))
    totals = _totals(thin, group, ordered, F.col("_value"), name)
    return rows.join(totals.select(ROW, name), ROW).drop(ROW)


def _upto(group, order, last=Window.currentRow):
    window = Window.partitionBy(*group).orderBy(*order)
    return window.rowsBetween(Window.unboundedPreceding, last)


def _totals(df: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with the running total of ``value`` as ``name``; ``order`` ends with ``ROW``.

    Two passes: one to sort by range and write, one to add up. What is windowed
    over whole groups has one row per partition and group.
    """
    placed = written(
        df.withColumn("_add", value.cast("long"))
        .repartitionByRange(*group, *order)
        .withColumn(_PART, F.spark_partition_id()),
        "ranking",
    )
    sums = placed.groupBy(*group, _PART).agg(F.sum("_add").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(_upto(group, [_PART], -1)), F.lit(0))
    offsets = sums.select(
        *[F.col(c).alias(f"_of_{c}") for c in group], F.col(_PART).alias("_of"), before.alias("_offset")
    )
    match = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]
    inside = F.sum("_add").over(_upto([*group, _PART], order))
    return (
        placed.withColumn("_inside", inside)
        .join(offsets, reduce(Column.__and__, match, F.col(_PART) == F.col("_of")))
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .select(*df.columns, name)
    )
