"""Titles from a stored index page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.functions.text import each

# The list's markers and link form on the wiki's index page.
START, END = "Architecture and archaeology", "Cleanup listing"
TITLE_LINK = '<a href="/wiki/(?:.*?)" title="(.*?)">'


def between(text: Column, start: str, end: str) -> Column:
    """The part from the first ``start`` up to the first ``end``; null when a
    marker is missing, empty when they stand in the other order."""
    first, last = F.locate(start, text), F.locate(end, text)
    length = F.greatest(last - first, F.lit(0))
    return F.when((first > 0) & (last > 0), F.substr(text, first, length))


def extract_titles(
    df: DataFrame,
    html: str,
    keys: list[str],
    start: str = START,
    end: str = END,
    pattern: str = TITLE_LINK,
) -> DataFrame:
    """(keys, pos, title) in page order, duplicates kept, entities as they are."""
    found = F.regexp_extract_all(between(F.col(html), start, end), F.lit(pattern), F.lit(1))
    return each(df, keys, found, "title", "pos")


def pages_without_list(df: DataFrame, html: str, start: str = START, end: str = END) -> DataFrame:
    """One row: how many pages lack a marker and so give no titles."""
    missing = between(F.col(html), start, end).isNull()
    return df.agg(F.count_if(missing).alias("pages_without_list"))
