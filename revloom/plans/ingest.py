"""Queries over sources, intake and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from revloom.functions.text import segments
from revloom.operators import cleaning
from revloom.plans import corpus, views
from revloom.plans.changes import diff_text_cte
from revloom.plans.markup_sql import plain_text_sql
from revloom.session import scratch_path, short_lived, written
from revloom.sources import ledger, links, pages, responses, store
from revloom.streaming.intake import read_prepared, run_intake

FIRST_N = 5
# Revisions of a stored piece and files of a delivery, for the incremental intake.
PIECE_ROWS, FILES = 20, 4


def _nested(spark, sf, per_row=pages.REVISIONS_PER_ROW):
    """The documents as nested pages, newest revision first."""
    stored = corpus.as_revisions(views.rev_tagged(spark, sf))
    newest_first = stored.withColumn("_newest", -F.col("rev")).drop("rev")
    return pages.nest_pages(newest_first, ["_newest"], per_row)


def _stored_pages(spark, sf):
    """The nested pages, written as JSON lines and read back."""
    path = scratch_path(spark, "pages")
    store.write_pages(_nested(spark, sf), path)
    return pages.read_pages(spark, path, one_page_per_file=False)


def page_scan(spark, sf):
    chars = F.aggregate(
        F.transform("revisions", lambda r: F.length(r["slots"]["main"]["content"])),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return (
        _stored_pages(spark, sf)
        .groupBy("title")
        .agg(
            F.sum(F.size("revisions")).alias("revisions"),
            F.sum(chars).alias("chars"),
            F.max(F.unix_seconds(F.col("revisions")[0]["timestamp"])).alias("newest"),
        )
    )


def revision_scan(spark, sf):
    rows = pages.with_doc_index(pages.read_revisions(_stored_pages(spark, sf)), "title")
    return cleaning.flatten(rows).select(
        "doc_index",
        "title",
        "pos",
        "size",
        F.md5("content").alias("content_md5"),
        F.coalesce(F.array_size("tags"), F.lit(0)).cast("long").alias("n_tags"),
    )


def size_guard(spark, sf):
    docs = views.table(spark, sf, "documents")
    # The mean size, so some pages are above the limit at every scale.
    total = pages.page_sizes(docs, "source", "text").agg(F.expr("sum(page_bytes) div count(*)"))
    kept = pages.within_size(docs, "source", "text", total.scalar())
    return kept.select(F.col("source").alias("page"), F.col("doc_id").alias("rev"), "page_bytes")


def intake_counts(spark, sf):
    """Stored pages of which some are broken and some have no revisions."""
    number = F.substring("title", 4, 9).cast("int") % 4
    stored = F.to_json(F.struct("title", "offset", "revisions"))
    line = (
        F.when(number == 0, F.substring(stored, 1, 60))
        .when(number == 1, F.to_json(F.struct("title", "offset")))
        .otherwise(stored)
    )
    path = scratch_path(spark, "mixed")
    _nested(spark, sf).select(line).write.text(path)
    return pages.intake_counts(spark, path, one_page_per_file=False)


def file_guard(spark, sf):
    """Files on both sides of a limit: whole pages of documents, each file larger than
    the texts of the smallest page, and files of one short benchmark item each."""
    path = scratch_path(spark, "guarded")
    store.write_pages(_nested(spark, sf).repartition("title"), path)
    items = views.table(spark, sf, "benchmark").select(
        F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("page"),
        F.lit(1).cast("long").alias("rev"),
        F.col("text").alias("content"),
        F.array().cast("array<string>").alias("tags"),
    )
    nested = pages.nest_pages(corpus.as_revisions(items), ["rev"])
    nested.write.mode("append").option("maxRecordsPerFile", 1).json(path)
    docs = views.table(spark, sf, "documents")
    limit = pages.page_sizes(docs, "source", "text").agg(F.min("page_bytes")).first()[0]
    counts = pages.intake_counts(spark, path, limit or 0, one_page_per_file=False)
    read = pages.read_pages(spark, path, limit or 0, one_page_per_file=False)
    rows = pages.read_revisions(read).agg(
        F.count(F.lit(1)).alias("revisions"), F.count_if(F.startswith("title", F.lit("item "))).alias("items")
    )
    return counts.select("*", *[rows.select(c).scalar().alias(c) for c in rows.columns])


def first_n_pages(spark, sf):
    return pages.first_files(views.rev(spark, sf), FIRST_N, "page").select(
        "page", "rev", F.length("content").cast("long").alias("chars")
    )


def incremental_skip(spark, sf):
    docs = views.table(spark, sf, "documents").select("doc_id", "source")
    return ledger.unseen(docs, views.table(spark, sf, "labels"), "doc_id")


def _prepared_columns(df):
    return df.select(
        "title", "pos", F.col("reverted").cast("int").alias("reverted"), *corpus.PROCESSED[3:]
    )


def incremental_stream(spark, sf):
    """Pages in pieces of few revisions, dealt out to the files of two deliveries; then
    a run that finds nothing new."""
    source, target, checkpoint = (
        scratch_path(spark, n) for n in ("arriving", "prepared", "offsets")
    )
    with short_lived(spark):
        nested = written(_nested(spark, sf, PIECE_ROWS), "pieces")
        early = F.crc32(F.concat_ws(" ", "title", "offset")) % 2 == 0
        for delivery in (nested.where(early), nested.where(~early)):
            store.write_pages(delivery.repartition(FILES, "title", "offset"), source)
            run_intake(spark, source, target, checkpoint, one_page_per_file=False)
    run_intake(spark, source, target, checkpoint, one_page_per_file=False)
    return _prepared_columns(read_prepared(spark, target))


def processed_revisions(spark, sf):
    """The whole corpus preparation on four growing revisions of every web page."""
    rev = F.col("rev")
    histories = views.html_chain(spark, sf).withColumn(
        "tags",
        F.when(rev == 2, F.array(F.lit("mw-reverted"), F.lit("mw-undo"))).when(
            rev == 3, F.array(F.lit("Reverted"))
        ),
    )
    comment = F.when(rev != 1, F.concat(F.lit("<b>edit</b> "), rev.cast("string")))
    rows = corpus.as_revisions(histories, comment).withColumn("pos", 4 - rev).drop("rev")
    return _prepared_columns(corpus.prepare(rows, max_group_rows=4))


def ledger_first_wins(spark, sf):
    """Two intakes into one ledger: French pages first, then all."""
    titles = views.table(spark, sf, "pages").select(
        F.col("page_id").alias("position"),
        F.regexp_extract("url", "^https?://([^/]+)/", 1).alias("title"),
        "url",
    )
    path = scratch_path(spark, "ledger")
    nothing = spark.createDataFrame([], ledger.LEDGER)
    first = titles.where(F.col("url").contains("/fr/"))
    ledger.append_ledger(ledger.new_entries(first, nothing), path)
    ledger.append_ledger(
        ledger.new_entries(titles, ledger.read_ledger(spark, path)), path
    )
    return ledger.read_ledger(spark, path)


def _batches(spark, sf):
    """Response bodies in four shapes, made from conversation turns."""
    talk = views.table(spark, sf, "conversations")
    system, assistant = F.col("role") == "system", F.col("role") == "assistant"
    odd = F.col("turn") % 2 == 1

    def revision(content):
        return F.struct(
            F.col("role").alias("comment"),
            F.struct(F.struct(content.alias("content")).alias("main")).alias("slots"),
        )

    found = F.transform(segments(F.col("text")), revision)
    page = F.struct(
        F.lit("t").alias("title"), F.when(~assistant | odd, found).alias("revisions")
    )
    last = F.col("turn") >= 5
    body = F.struct(
        F.when(system, F.struct(F.lit("maxlag").alias("code"))).alias("error"),
        F.when(assistant & odd, F.lit("deprecated")).alias("warning"),
        F.when(~last, F.struct(F.lit("next").alias("rvcontinue"))).alias("continue"),
        F.struct(F.array(page).alias("pages")).alias("query"),
    )
    return talk.select(
        F.col("conv_id").alias("title"), F.col("turn").alias("batch_no"), F.to_json(body).alias("body")
    )


def response_status(spark, sf):
    return responses.classify(_batches(spark, sf)).select(
        "title",
        "batch_no",
        "status",
        F.coalesce(F.array_size("revisions"), F.lit(0)).cast("long").alias("n_revisions"),
        F.col("more").cast("int").alias("more"),
    )


def assemble_history(spark, sf):
    return responses.assemble(_batches(spark, sf)).select(
        "title",
        "pos",
        F.col("revision.comment").alias("comment"),
        F.col("revision.slots.main.content").alias("content"),
    )


def time_range(spark, sf):
    events = views.table(spark, sf, "events")
    chosen = responses.in_time_range(
        events, "ts", "2024-01-10 00:00:00", "2024-01-19 23:59:59"
    )
    return chosen.select("event_id", "user_id", F.col("ts").cast("string").alias("ts"))


_NAV = dict(start="<nav>", end="</nav>", pattern='<a href="(?:.*?)">(.*?)</a>')


def link_extract(spark, sf):
    html = views.texts(spark, sf, "pages", "page_id", "html")
    return links.extract_titles(html, "html", ["page_id"], **_NAV)


def titles_stored(spark, sf):
    """Distinct titles of all index pages, written and read back."""
    path = scratch_path(spark, "titles")
    store.write_titles(link_extract(spark, sf).select("title").distinct(), path)
    return spark.read.schema("title string").json(path)


def pages_without_list(spark, sf):
    html = views.table(spark, sf, "pages").select(
        F.when(F.col("page_id") % 3 == 0, F.replace("html", F.lit("</nav>"), F.lit("")))
        .otherwise(F.col("html"))
        .alias("html")
    )
    return links.pages_without_list(html, "html", _NAV["start"], _NAV["end"])


def revisions_by_shard(spark, sf):
    """Revisions written to a folder per shard and read back."""
    path = scratch_path(spark, "revisions")
    rows = views.rev(spark, sf).withColumn("shard", F.col("rev") % 2)
    store.write_revisions(rows, path, "shard")
    return (
        spark.read.parquet(path)
        .groupBy(F.col("shard").cast("long").alias("shard"))
        .agg(
            F.count(F.lit(1)).alias("revisions"),
            F.sum(F.length("content")).alias("chars"),
            F.max("rev").alias("newest"),
        )
    )


QUERIES = {
    "page_scan": page_scan,
    "revision_scan": revision_scan,
    "size_guard": size_guard,
    "intake_counts": intake_counts,
    "file_guard": file_guard,
    "first_n_pages": first_n_pages,
    "incremental_skip": incremental_skip,
    "incremental_stream": incremental_stream,
    "processed_revisions": processed_revisions,
    "ledger_first_wins": ledger_first_wins,
    "response_status": response_status,
    "assemble_history": assemble_history,
    "time_range": time_range,
    "link_extract": link_extract,
    "titles_stored": titles_stored,
    "pages_without_list": pages_without_list,
    "revisions_by_shard": revisions_by_shard,
}

# --- SQL -------------------------------------------------------------------------

_STATUS_SQL = f"""shaped AS (
  SELECT conv_id AS title, turn AS batch_no, role, turn < 5 AS more,
    role = 'assistant' AND turn % 2 = 0 AS bare, {views.segments_sql('text')} AS s
  FROM conversations),
judged AS (
  SELECT *, CASE WHEN role = 'system' THEN 'error' WHEN bare THEN 'malformed'
              WHEN role = 'assistant' THEN 'warning' ELSE 'ok' END AS status
  FROM shaped)"""


def _processed_sql(view: str, base: str, newest: str) -> str:
    """Join both diffs of a view to its texts; ``base`` gives the other columns."""
    plain = f"{view}_plain"
    return (
        f"{plain} AS (SELECT page, rev, {plain_text_sql('content')} AS content FROM {view}),\n"
        + diff_text_cte(view)
        + ",\n"
        + diff_text_cte(plain)
        + f""",
processed AS (
  SELECT CAST(v.page AS VARCHAR) AS title, {newest} AS pos, {base},
    v.content, d.diff_text AS content_diff,
    p.content AS content_plaintext, e.diff_text AS content_plaintext_diff
  FROM {view} v JOIN {plain} p USING (page, rev)
  JOIN {view}_diff d USING (page, rev) JOIN {plain}_diff e USING (page, rev))"""
    )


_LINKS_SQL = """SELECT page_id, unnest(range(len(t))) AS pos, unnest(t) AS title
FROM (SELECT page_id, regexp_extract_all(
    substr(html, strpos(html, '<nav>'), strpos(html, '</nav>') - strpos(html, '<nav>')),
    '<a href="(?:.*?)">(.*?)</a>', 1) AS t
  FROM pages WHERE contains(html, '<nav>') AND contains(html, '</nav>'))"""

ORACLE = {
    "titles_stored": f"SELECT DISTINCT title FROM ({_LINKS_SQL})",
    "pages_without_list": """SELECT count(*) FILTER (page_id % 3 = 0 OR NOT contains(html, '<nav>')
  OR NOT contains(html, '</nav>')) AS pages_without_list FROM pages""",
    "revisions_by_shard": """SELECT doc_id % 2 AS shard, count(*) AS revisions,
  CAST(sum(length(text)) AS BIGINT) AS chars, max(doc_id) AS newest FROM documents GROUP BY ALL""",
    "page_scan": """SELECT source AS title, count(*) AS revisions,
  CAST(sum(length(text)) AS BIGINT) AS chars, 1600000000 + max(doc_id) * 60 AS newest
FROM documents GROUP BY source""",
    "revision_scan": views.with_sql(views.TAGS_SQL)
    + """SELECT dense_rank() OVER (ORDER BY source) - 1 AS doc_index, source AS title,
  row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) - 1 AS pos,
  CAST(strlen(text) AS BIGINT) AS size, md5(text) AS content_md5,
  CAST(coalesce(len(tags), 0) AS BIGINT) AS n_tags
FROM documents LEFT JOIN tags USING (doc_id)""",
    "size_guard": """SELECT source AS page, doc_id AS rev, page_bytes FROM documents
JOIN (SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS page_bytes
      FROM documents GROUP BY source) USING (source)
WHERE page_bytes <= (SELECT sum(strlen(text)) // count(DISTINCT source) FROM documents)""",
    "intake_counts": f"""SELECT count(*) AS stored, count(*) FILTER (k > 1) AS kept,
  0 AS too_large, count(*) FILTER (k = 0) AS corrupt, count(*) FILTER (k = 1) AS without_revisions
FROM (SELECT source, CAST(substr(source, 4) AS INTEGER) % 4 AS k,
    unnest(range((count(*) + {pages.REVISIONS_PER_ROW - 1}) // {pages.REVISIONS_PER_ROW})) AS row
  FROM documents GROUP BY source)""",
    "file_guard": f"""SELECT rows + items AS stored, items AS kept, rows AS too_large,
  0 AS corrupt, 0 AS without_revisions, items AS revisions, items
FROM (SELECT count(*) AS items FROM benchmark), (
  SELECT CAST(sum((n + {pages.REVISIONS_PER_ROW - 1}) // {pages.REVISIONS_PER_ROW}) AS BIGINT) AS rows
  FROM (SELECT count(*) AS n FROM documents GROUP BY source))""",
    "first_n_pages": f"""SELECT source AS page, doc_id AS rev, length(text) AS chars FROM documents
WHERE source IN (SELECT DISTINCT source FROM documents ORDER BY source LIMIT {FIRST_N})""",
    "incremental_skip": """SELECT doc_id, source FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "incremental_stream": views.with_sql(
        views.TAGS_SQL,
        views.REV_SQL,
        "newest AS (SELECT page, rev, row_number() OVER (PARTITION BY page ORDER BY rev DESC) - 1"
        " AS pos FROM rev)",
        _processed_sql(
            "rev",
            "coalesce(CAST(list_contains((SELECT tags FROM tags t WHERE t.doc_id = v.rev),"
            " 'mw-reverted') AS INTEGER), 0) AS reverted, '' AS comment_plaintext",
            "(SELECT pos FROM newest n WHERE n.page = v.page AND n.rev = v.rev)",
        ),
    )
    + "SELECT * FROM processed",
    "processed_revisions": views.with_sql(
        views.HTML_CHAIN_SQL,
        _processed_sql(
            "html_chain",
            "CAST(v.rev = 2 AS INTEGER) AS reverted,"
            " CASE WHEN v.rev = 1 THEN '' ELSE 'edit ' || v.rev END AS comment_plaintext",
            "4 - v.rev",
        ),
    )
    + "SELECT * FROM processed",
    "ledger_first_wins": """SELECT title, coalesce(min(page_id) FILTER (contains(url, '/fr/')),
    min(page_id)) || '.json' AS file_name
FROM (SELECT page_id, url, regexp_extract(url, '^https?://([^/]+)/', 1) AS title FROM pages)
GROUP BY title""",
    "response_status": views.with_sql(_STATUS_SQL)
    + """SELECT title, batch_no, status, CAST(CASE WHEN bare THEN 0 ELSE len(s) END AS BIGINT)
  AS n_revisions, CAST(more AS INTEGER) AS more FROM judged""",
    "assemble_history": views.with_sql(_STATUS_SQL)
    + """, ends AS (
  SELECT title, min(batch_no) FILTER (NOT more) AS last FROM judged GROUP BY title),
used AS (
  SELECT j.*, bool_and(status IN ('ok', 'warning')) OVER (PARTITION BY title) AS whole
  FROM judged j JOIN ends USING (title) WHERE batch_no <= last),
flat AS (
  SELECT title, batch_no, role AS comment, unnest(s) AS content, unnest(range(len(s))) AS i
  FROM used WHERE whole)
SELECT title, row_number() OVER (PARTITION BY title ORDER BY batch_no, i) - 1 AS pos,
  comment, content FROM flat""",
    "time_range": """SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') ||
  CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE
    rtrim('.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0'), '0') END AS ts
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-19 23:59:59'""",
    "link_extract": _LINKS_SQL,
}
