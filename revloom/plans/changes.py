"""Queries over revision changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.markup import plain_text
from revloom.operators import diff
from revloom.plans import views
from revloom.plans.markup_sql import plain_text_sql

# A chain has exactly four revisions, so no page needs a size check.
CHAIN_LENGTH = 4
GROUP, ORDER = ["page"], ["rev"]


def revision_diff(spark, sf):
    chain = views.chain(spark, sf)
    return diff.segment_changes(chain, GROUP, ORDER, "content", max_group_rows=CHAIN_LENGTH)


def plaintext_diff(spark, sf):
    plain = views.html_chain(spark, sf).withColumn("content", plain_text(F.col("content")))
    return diff.segment_changes(plain, GROUP, ORDER, "content", max_group_rows=CHAIN_LENGTH)


def diff_text(spark, sf):
    chain = views.chain(spark, sf)
    texts = {"diff_text": "content"}
    return diff.diff_text(chain, GROUP, ORDER, texts, max_group_rows=CHAIN_LENGTH)


def ordered_diff(spark, sf):
    """Changes that respect the order, in histories that move segments about."""
    return diff.ordered_diff(views.moves(spark, sf), GROUP, ORDER, "content", max_group_rows=CHAIN_LENGTH)


def diff_summary(spark, sf):
    histories = {
        "chain": (views.chain(spark, sf), CHAIN_LENGTH),
        "rev": (views.rev(spark, sf), None),
        "conv": (views.conv(spark, sf), None),
    }
    parts = [
        diff.change_summary(df, GROUP, ORDER, "content", max_group_rows=bound).select(
            F.lit(name).alias("history"),
            F.col("page").cast("string").alias("page"),
            "rev",
            "added",
            "removed",
            "kept",
        )
        for name, (df, bound) in histories.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- SQL -------------------------------------------------------------------------


def _segments_cte(view: str) -> str:
    return f"""{view}_seg AS (
  SELECT page, rev, unnest(s) AS segment, unnest(range(len(s))) AS pos
  FROM (SELECT page, rev, {views.segments_sql('content')} AS s FROM {view})),
{view}_order AS (
  SELECT page, rev, lag(rev) OVER (PARTITION BY page ORDER BY rev) AS prev FROM {view})"""


def _changes_cte(view: str) -> str:
    return f"""{_segments_cte(view)},
{view}_n AS (SELECT page, rev, segment, count(*) AS n FROM {view}_seg GROUP BY ALL),
{view}_now AS (
  SELECT c.* FROM {view}_n c JOIN {view}_order o USING (page, rev) WHERE o.prev IS NOT NULL),
{view}_was AS (
  SELECT o.page, o.rev, c.segment, c.n
  FROM {view}_order o JOIN {view}_n c ON c.page = o.page AND c.rev = o.prev),
{view}_changes AS (
  SELECT page, rev, segment,
         greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS added,
         greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS removed,
         least(coalesce(a.n, 0), coalesce(b.n, 0)) AS kept
  FROM {view}_now a FULL JOIN {view}_was b USING (page, rev, segment))"""


def diff_text_cte(view: str) -> str:
    return f"""{_segments_cte(view)},
{view}_dup AS (
  SELECT *, row_number() OVER (PARTITION BY page, rev, segment ORDER BY pos) AS dup
  FROM {view}_seg),
{view}_a AS (
  SELECT d.* FROM {view}_dup d JOIN {view}_order o USING (page, rev) WHERE o.prev IS NOT NULL),
{view}_b AS (
  SELECT o.page, o.rev, d.segment, d.pos, d.dup
  FROM {view}_order o JOIN {view}_dup d ON d.page = o.page AND d.rev = o.prev),
{view}_lines AS (
  SELECT page, rev, pos, 1 AS side, '+' || segment AS line FROM {view}_a
  ANTI JOIN {view}_b USING (page, rev, segment, dup)
  UNION ALL
  SELECT page, rev, pos, 0 AS side, '-' || segment AS line FROM {view}_b
  ANTI JOIN {view}_a USING (page, rev, segment, dup)),
{view}_text AS (
  SELECT page, rev, string_agg(line || chr(10), '' ORDER BY pos, side) AS t
  FROM {view}_lines GROUP BY page, rev),
{view}_diff AS (
  SELECT o.page, o.rev, coalesce(t.t, '') AS diff_text
  FROM {view}_order o LEFT JOIN {view}_text t USING (page, rev))"""


def _summary_sql(view: str) -> str:
    return f"""SELECT '{view}' AS history, CAST(o.page AS VARCHAR) AS page, o.rev,
  CAST(coalesce(sum(added), 0) AS BIGINT) AS added,
  CAST(coalesce(sum(removed), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(kept), 0) AS BIGINT) AS kept
FROM {view}_order o LEFT JOIN {view}_changes c USING (page, rev) GROUP BY ALL"""


# Pairs of copies, runs of them, and for each run in turn the best chain that ends with
# it; the chain is carried as a list of its runs.
ORDERED_SQL = """pairs AS (
  SELECT a.page, a.rev, b.pos AS b, a.pos AS a FROM moves_a a JOIN moves_b b USING (page, rev, segment, dup)),
marked AS (
  SELECT *, b - a AS d, coalesce(b - 1 <> lag(b) OVER w OR a - 1 <> lag(a) OVER w, true) AS starts
  FROM pairs WINDOW w AS (PARTITION BY page, rev ORDER BY b)),
numbered AS (
  SELECT *, sum(starts::INT) OVER (PARTITION BY page, rev ORDER BY b ROWS UNBOUNDED PRECEDING) AS run FROM marked),
runs AS (
  SELECT page, rev, list({'a': a, 'n': n} ORDER BY run) AS runs
  FROM (SELECT page, rev, run, min(a) AS a, count(*) AS n FROM numbered GROUP BY page, rev, run) GROUP BY page, rev),
dp AS (
  SELECT page, rev, runs, 0 AS i, CAST([] AS STRUCT(a BIGINT, n BIGINT, path BIGINT[])[]) AS ends FROM runs
  UNION ALL
  SELECT page, rev, runs, i + 1, list_append(ends, {
    'a': runs[i + 1].a,
    'n': runs[i + 1].n + coalesce(best.n, 0),
    'path': list_append(coalesce(best.path, CAST([] AS BIGINT[])), CAST(i + 1 AS BIGINT))})
  FROM (SELECT *, list_reduce(list_filter(ends, lambda x: x.a < runs[i + 1].a),
      lambda x, y: CASE WHEN x IS NULL OR y.n > x.n OR (y.n = x.n AND y.a < x.a) THEN y ELSE x END,
      CAST(NULL AS STRUCT(a BIGINT, n BIGINT, path BIGINT[]))) AS best
    FROM dp WHERE i < len(runs))),
chain_of AS (
  SELECT page, rev, unnest(list_reduce(ends, lambda x, y:
    CASE WHEN y.n > x.n OR (y.n = x.n AND y.a < x.a) THEN y ELSE x END).path) AS run
  FROM dp WHERE i = len(runs)),
stay AS (SELECT page, rev, n.b, n.a FROM numbered n JOIN chain_of USING (page, rev, run)),
olds AS (
  SELECT s.page, s.rev, s.pos, s.segment,
    s.pos - row_number() OVER (PARTITION BY s.page, s.rev ORDER BY s.pos) + 1 AS after
  FROM moves_b s ANTI JOIN stay k ON k.page = s.page AND k.rev = s.rev AND k.b = s.pos),
news AS (
  SELECT s.page, s.rev, s.pos, s.segment,
    s.pos - row_number() OVER (PARTITION BY s.page, s.rev ORDER BY s.pos) + 1 AS after
  FROM moves_a s ANTI JOIN stay k ON k.page = s.page AND k.rev = s.rev AND k.a = s.pos),
changed AS (
  SELECT page, rev, string_agg(line || chr(10), '' ORDER BY after, side, pos) AS t,
    count(*) FILTER (side = 1) AS added, count(*) FILTER (side = 0) AS removed
  FROM (SELECT page, rev, after, 0 AS side, pos, '-' || segment AS line FROM olds
    UNION ALL SELECT page, rev, after, 1, pos, '+' || segment FROM news) GROUP BY page, rev)
SELECT o.page, o.rev, coalesce(t, '') AS diff_text, coalesce(added, 0) AS added,
  coalesce(removed, 0) AS removed, coalesce(k.kept, 0) AS kept
FROM moves_order o LEFT JOIN changed USING (page, rev)
LEFT JOIN (SELECT page, rev, count(*) AS kept FROM stay GROUP BY page, rev) k USING (page, rev)"""

_PLAIN_CHAIN = (
    "plain AS (SELECT page, rev, " + plain_text_sql("content") + " AS content FROM html_chain)"
)

QUERIES = {
    "revision_diff": revision_diff,
    "plaintext_diff": plaintext_diff,
    "diff_text": diff_text,
    "ordered_diff": ordered_diff,
    "diff_summary": diff_summary,
}

ORACLE = {
    "revision_diff": views.with_sql(views.CHAIN_SQL, _changes_cte("chain"))
    + "SELECT * FROM chain_changes",
    "plaintext_diff": views.with_sql(views.HTML_CHAIN_SQL, _PLAIN_CHAIN, _changes_cte("plain"))
    + "SELECT * FROM plain_changes",
    "diff_text": views.with_sql(views.CHAIN_SQL, diff_text_cte("chain"))
    + "SELECT * FROM chain_diff",
    "ordered_diff": views.with_sql(views.MOVES_SQL, diff_text_cte("moves")).replace("WITH ", "WITH RECURSIVE ", 1)
    + ", "
    + ORDERED_SQL,
    "diff_summary": views.with_sql(
        views.CHAIN_SQL,
        views.REV_SQL,
        views.CONV_SQL,
        *[_changes_cte(v) for v in ("chain", "rev", "conv")],
    )
    + "\nUNION ALL\n".join(_summary_sql(v) for v in ("chain", "rev", "conv")),
}
