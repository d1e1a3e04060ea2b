"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Windows of ``WIDTH`` words of the benchmark are hashed into sorted arrays, which
are broadcast. Documents are scanned once per array: their words become ids of the
benchmark's vocabulary, windows of ids are hashed, looked up, and every hit is
verified against the words themselves. An array never holds more than
``max_windows`` windows; a larger benchmark is cut into several and the scans
repeat, so the broadcast is bounded and no window is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm.common import free_name, release, table, windows
from revloom.session import written

WIDTH = 10
# Windows in one broadcast: with their words at most some 200 MB.
MAX_WINDOWS = 1_000_000

# Fixed value: ASCII that separates words (everything but digits and letters).
SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_FOLD = bytes(32 if b in SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of a text; null has none."""
    return (text or "").encode().translate(_FOLD).split()


@dataclass
class Grams:
    """Windows of one slice of the benchmark, ready to be looked up."""

    ids: dict[bytes, int]  # word -> number, 0 for words of no window
    sizes: list[int]  # lengths of windows that occur, in words
    hashes: dict[int, np.ndarray]  # by length: sorted hashes of windows
    places: dict[tuple[int, ...], tuple]  # word numbers of a window -> its items


def _gather(windowed: list[tuple]) -> Grams:
    ids: dict[bytes, int] = {}
    places: dict[tuple[int, ...], set] = {}
    for item, gram in windowed:
        key = tuple(ids.setdefault(w, len(ids) + 1) for w in gram.encode().split(b" "))
        places.setdefault(key, set()).add(item)
    by_size: dict[int, list[int]] = {}
    for key in places:
        by_size.setdefault(len(key), []).append(int(windows(_numbers(list(key)), len(key))[0]))
    hashes = {n: np.unique(np.array(h, dtype=np.uint64)) for n, h in by_size.items()}
    return Grams(ids, sorted(by_size), hashes, {k: tuple(v) for k, v in places.items()})


def _numbers(ids: list[int]) -> np.ndarray:
    return np.array(ids, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)


def item_windows(items: DataFrame, item: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(item, gram): distinct windows of each item, words joined by one blank.

    An item with fewer than ``width`` words, but not none, is one window.
    """

    def run(frames):
        for frame in frames:
            found = []
            for i, t in zip(frame["item"], frame["text"], strict=True):
                w = words(t)
                starts = range(max(1, len(w) - width + 1)) if w else ()
                found += [(i, b" ".join(w[s : s + width]).decode()) for s in starts]
            yield pd.DataFrame(found, columns=["item", "gram"])

    # Items are told apart by their id as text; a null id is an item like any other.
    named = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return named.mapInPandas(run, "item string, gram string").distinct()


def scan(text: str | None, grams: Grams) -> tuple[int, np.ndarray, set]:
    """(number of words, numbers of the words that are hit, items with a window here)."""
    found = words(text)
    n = len(found)
    numbers = np.fromiter(map(grams.ids.get, found, [0] * n), dtype=np.int64, count=n)
    hit, items = np.zeros(n + 1, dtype=np.int64), set()
    if not numbers.any():
        return n, np.zeros(0, dtype=np.int32), items
    # Unknown words so far: a window without any has equal counts at both ends.
    unknown = np.concatenate(([0], np.cumsum(numbers == 0)))
    keys = _numbers(numbers.tolist()) if n else None
    for size in grams.sizes:
        if size > n:
            break
        possible = np.flatnonzero(unknown[size:] == unknown[: n - size + 1])
        if not len(possible):
            continue
        hashes, wanted = windows(keys, size)[possible], grams.hashes[size]
        at = np.searchsorted(wanted, hashes)
        at[at == len(wanted)] = 0
        for start in possible[wanted[at] == hashes].tolist():
            where = grams.places.get(tuple(numbers[start : start + size].tolist()))
            if where:
                items.update(where)
                hit[start] += 1
                hit[start + size] -= 1
    return n, np.flatnonzero(np.cumsum(hit[:-1]) > 0).astype(np.int32), items


def find(df: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
         width: int = WIDTH, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Add ``n_words``, ``hit_words`` (numbers of hit words, ascending) and ``hit_items``.

    Null texts have no words. An empty benchmark hits nothing. Other columns are
    kept; a taken name gets underscores added, so call this on the columns needed.
    """
    spark = df.sparkSession
    grams = written(item_windows(items, item, item_text, width), "benchmark-windows")
    pieces = -(-grams.count() // max_windows)
    n_words, hit_words, hit_items = (free_name(df, c) for c in ("n_words", "hit_words", "hit_items"))
    out = df.select(
        "*",
        F.lit(0).cast("long").alias(n_words),
        F.array().cast("array<int>").alias(hit_words),
        F.array().cast("array<string>").alias(hit_items),
    )
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    for piece in range(max(1, pieces)):
        own = grams.where(F.pmod(F.xxhash64("gram"), F.lit(pieces)) == piece) if pieces > 1 else grams
        shared = spark.sparkContext.broadcast(_gather([tuple(r) for r in own.toLocalIterator()]))

        def run(frames, shared=shared):
            for frame in frames:
                found = [scan(t, shared.value) for t in frame[text]]
                yield frame.assign(
                    **{
                        n_words: [n for n, _, _ in found],
                        hit_words: [
                            np.union1d(old, new) if len(old) else new
                            for old, (_, new, _) in zip(frame[hit_words], found, strict=True)
                        ],
                        hit_items: [
                            sorted({*old, *new}) for old, (_, _, new) in zip(frame[hit_items], found, strict=True)
                        ],
                    }
                )

            release()

        out = out.mapInPandas(run, columns)
    return out


def remove_spans(text: str | None, hits) -> str | None:
    """The text without its hit words; a run of them becomes one blank."""
    if text is None or not len(hits):
        return text
    raw, hits = text.encode(), set(int(h) for h in hits)
    mask = np.frombuffer(raw.translate(_FOLD), dtype=np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    first, last = edge[0::2].tolist(), edge[1::2].tolist()
    out, kept_to, k = [], 0, 0
    while k < len(first):
        if k in hits:
            start = first[k]
            while k + 1 in hits:
                k += 1
            out += [raw[kept_to:start].rstrip(b" "), b" "]
            kept_to = last[k]
        k += 1
    out.append(raw[kept_to:].lstrip(b" "))
    return b"".join(out).decode()


def clean(df: DataFrame, items: DataFrame, text: str = "text", drop_above: float = 0.5, **options) -> DataFrame:
    """``df`` with contaminated spans cut out of ``text``.

    A document of which more than ``drop_above`` of the words are hit goes as a
    whole: what is left of it is the frame of a test item. Documents without hits
    pass unchanged.
    """
    found = find(df, items, text, **options)
    n_words, hit_words, _ = found.columns[-3:]

    @F.pandas_udf("string")
    def cut(texts: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([remove_spans(t, h) for t, h in zip(texts, hits, strict=True)], dtype=object)

    kept = found.where(F.size(hit_words) <= F.col(n_words) * drop_above)
    # Only texts with hits go to Python again.
    return kept.withColumn(
        text, F.when(F.size(hit_words) == 0, F.col(text)).otherwise(cut(F.col(text), F.col(hit_words)))
    ).select(*df.columns)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and benchmark items of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, table(spark, sf_dir, "benchmark")).drop("text")
    items = F.coalesce(F.array_join("hit_items", ","), F.lit(""))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


SQL_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"

OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({SQL_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, coalesce({SQL_WORDS}, []) AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + 9], ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM g),
p AS (
  SELECT doc_id, s.size, i, array_to_string(w[i:i + s.size - 1], ' ') AS gram
  FROM sizes s, (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d) x
  WHERE i + s.size - 1 <= len(w)
),
h AS (SELECT p.doc_id, p.size, p.i, g.item_id FROM p JOIN g USING (size, gram)),
n_hit AS (
  SELECT doc_id, count(DISTINCT k) AS n
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS k FROM h) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.list, '')) AS items_sha256, coalesce(n_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

QUERIES = {"op8_decontamination": op8_decontamination}
ORACLE = {"op8_decontamination": OP8_SQL}
