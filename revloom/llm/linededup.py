"""Removal of lines that stand on many sites.

A line is told by two hashes of its trimmed text. Per line, a HyperLogLog sketch of
the sites it stands on is aggregated; sketches merge, so this combines before the
shuffle. A line whose estimate is clearly above or below the threshold is decided
by it; in between, by an exact distinct count of its sites. Boilerplate is removed
everywhere but at its first place, so that no passage is lost altogether.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm.common import fingerprint, free_name, table

# Distinct sites from which on a line is boilerplate.
MIN_SITES = 5
# Sketch of 2^12 registers: relative standard error of 1.04 / 2^6.
LG_REGISTERS = 12
# Estimates within so many standard errors (and 2 sites) of the threshold are counted exactly.
ERRORS = 6


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _plain(text: Column) -> Column:
    """``text`` with tabs and the like as spaces; only a text that has any is rewritten."""
    marks = "\t\r\f\u000b"
    some = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in marks])
    return F.when(some, F.translate(text, marks, " " * len(marks))).otherwise(text)


def exploded(keyed: DataFrame, text: str, site: str) -> DataFrame:
    """(row keys, line_no, l1, l2, site) of every line that is not blank."""
    return (
        keyed.select("k0", "k1", "k2", F.col(site).cast("string").alias("site"), F.posexplode(_lines(_plain(F.col(text)))).alias("line_no", "line"))
        .withColumn("line", F.trim("line"))
        .where("line != ''")
        .select("k0", "k1", "k2", "line_no", "site", *[h.alias(f"l{i}") for i, h in enumerate(fingerprint(F.col("line")), 1)])
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(l1, l2) of lines on at least ``min_sites`` distinct sites; a null site is none."""
    error = ERRORS * 1.04 / 2 ** (LG_REGISTERS / 2) * min_sites
    low, high = min_sites - max(2.0, error), min_sites + max(2.0, error)
    spread = (
        lines.groupBy("l1", "l2")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_REGISTERS))).alias("sites"))
        .where(F.col("sites") >= max(1.0, low))
    )
    near = spread.where(F.col("sites") <= high).select("l1", "l2")
    exact = (
        lines.join(near, ["l1", "l2"], "left_semi")
        .select("l1", "l2", "site")
        .where("site is not null")
        .distinct()
        .groupBy("l1", "l2")
        .count()
        .where(F.col("count") >= min_sites)
        .select("l1", "l2")
    )
    return spread.where(F.col("sites") > high).select("l1", "l2").union(exact)


def remove(df: DataFrame, text: str = "text", site: str = "source", key: str = "doc_id", min_sites: int = MIN_SITES) -> DataFrame:
    """``df`` with boilerplate lines cut out of ``text``; adds ``n_lines`` and ``n_removed``.

    ``n_lines`` counts the lines that are not blank. The first place of a line, by
    key (nulls last), hashes of the text, then line number, stays. Rows that are
    equal in key and text are treated alike. A null text has no lines and stays
    null; a text without a removed line stays as it is, byte for byte.
    """
    n_lines, n_removed = free_name(df, "n_lines"), free_name(df, "n_removed")
    first, second = fingerprint(F.col(text))
    keyed = df.select("*", F.col(key).alias("k0"), first.alias("k1"), second.alias("k2"))
    keys = ["k0", "k1", "k2"]
    lines = exploded(keyed, text, site)
    order = F.struct(F.col("k0").isNull().alias("n"), *keys, "line_no").alias("place")
    # Only lines of the result of the sketches are looked at from here on.
    hits = lines.select(*keys, "line_no", "l1", "l2").join(boilerplate(lines, min_sites), ["l1", "l2"])
    kept = hits.groupBy("l1", "l2").agg(F.min(order).alias("kept"))
    gone = (
        hits.join(kept, ["l1", "l2"])
        .where(order != F.col("kept"))
        .groupBy(*keys)
        .agg(F.collect_set("line_no").alias("gone"))
        .select(*[F.col(k).alias(f"g_{k}") for k in keys], "gone")
    )
    match = [F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in keys]
    parts = _lines(F.col(text))
    left = F.array_join(F.filter(parts, lambda line, i: ~F.array_contains("gone", i)), "\n")
    count = F.size(F.filter(_lines(_plain(F.col(text))), lambda line: F.trim(line) != ""))
    names = [c for c in df.columns]
    return (
        keyed.join(gone, match[0] & match[1] & match[2], "left")
        .withColumn(n_lines, F.coalesce(F.when(F.col(text).isNull(), 0).otherwise(count), F.lit(0)).cast("long"))
        .withColumn(n_removed, F.coalesce(F.size("gone"), F.lit(0)).cast("long"))
        .withColumn(text, F.when(F.col("gone").isNull(), F.col(text)).otherwise(left))
        .select(*names, n_lines, n_removed)
    )


def op5_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cross-site boilerplate removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return remove(docs).select("doc_id", "n_lines", "n_removed", "text")


_SQL_TRIM = r"trim(translate(line, chr(9) || chr(13) || chr(12) || chr(11), '    '), ' ')"

OP5_SQL = f"""
WITH raw AS (
  SELECT doc_id, source, i, parts[i] AS line
  FROM (SELECT *, unnest(generate_series(1, len(parts))) AS i
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents))
), l AS (SELECT *, {_SQL_TRIM} AS t FROM raw),
b AS (SELECT t FROM l WHERE t <> '' GROUP BY t HAVING count(DISTINCT source) >= {MIN_SITES}),
m AS (
  SELECT l.*, b.t IS NOT NULL AND row_number() OVER (PARTITION BY l.t ORDER BY doc_id, i) > 1 AS gone
  FROM l LEFT JOIN b ON l.t = b.t
), r AS (
  SELECT doc_id, count(*) FILTER (t <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
         string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS left_over
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.left_over, '') END AS text
FROM documents d LEFT JOIN r USING (doc_id)
"""

QUERIES = {"op5_linededup": op5_linededup}
ORACLE = {"op5_linededup": OP5_SQL}
