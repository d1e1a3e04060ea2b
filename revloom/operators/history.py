"""Operators along the history of a page or user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revloom.operators import ordered

# Revisions carry whole texts, so their blocks are smaller than those of ids.
TEXT_BLOCK_ROWS = 10_000


def previous(
    df: DataFrame,
    group: list[str],
    order: list[str],
    columns: dict[str, str],
    block_rows: int = TEXT_BLOCK_ROWS,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Add columns of the previous row of the group: ``{new name: column}``.

    The oldest row of a group gets nulls. ``order`` runs from old to new.
    """
    laid = ordered.blocks(df, group, order, 1, block_rows, max_group_rows)
    window = laid.window()
    return laid.close(
        laid.df.withColumns(
            {new: F.lag(column).over(window) for new, column in columns.items()}
        )
    )


def chronological(df: DataFrame, group: list[str], newest_first: str, name: str) -> DataFrame:
    """Turn a newest-first position into a key that sorts from old to new."""
    return df.withColumn(name, -F.col(newest_first))


def micros(ts: str) -> Column:
    """Microseconds since the epoch, of either timestamp type; the session's time
    zone is UTC, so times without a zone are taken as UTC."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def time_gaps(
    df: DataFrame,
    group: list[str],
    ts: str,
    tie: str,
    name: str = "gap_seconds",
    block_rows: int = ordered.BLOCK_ROWS,
) -> DataFrame:
    """Seconds since the next-older row of the group; the oldest row, which has
    no gap, is left out."""
    stamped = df.withColumn("_us", micros(ts))
    with_gap = previous(stamped, group, ["_us", tie], {"_before": "_us"}, block_rows)
    return (
        with_gap.where(F.col("_before").isNotNull())
        .withColumn(name, (F.col("_us") - F.col("_before")) / F.lit(1e6))
        .drop("_us", "_before")
    )


def moving_average_gap(
    df: DataFrame,
    group: list[str],
    ts: str,
    tie: str,
    sizes: dict[str, int],
    block_rows: int = ordered.BLOCK_ROWS,
) -> DataFrame:
    """Average seconds between rows over the last N gaps: ``{name: N}``.

    The first row of a group is the start of the clock. After it, row k averages
    over min(k, N) gaps, which is the distance to the row N back (or to the
    start) divided by that number.
    """
    laid = ordered.blocks(
        df.withColumn("_us", micros(ts)), group, ["_us", tie], max(sizes.values()), block_rows
    )
    window = laid.window()
    gaps = F.row_number().over(window) - 1
    rows = laid.df.withColumn("_gaps", gaps)
    for name, size in sizes.items():
        start = F.first("_us").over(window.rowsBetween(-size, Window.currentRow))
        rows = rows.withColumn(name, F.col("_us") - start)
    rows = laid.close(rows).where(F.col("_gaps") > 0)
    for name, size in sizes.items():
        count = F.least(F.col("_gaps"), F.lit(size))
        rows = rows.withColumn(name, F.col(name) / count / F.lit(1e6))
    return rows.drop("_us", "_gaps")
