"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols, so a word becomes a reduced word. One edit of a
word is at most one edit of its reduced word; therefore every near word is found by
generating all reduced words at most one edit away (a few hundred for an ordinary
word) and joining them with the reduced vocabulary. Pairs that meet are verified on
the words themselves. A reduced word is carried as a 64-bit polynomial hash: each
edit changes the hash of the whole by a few products of prefix sums, so long words
cost a number per edit and no copies. Collisions only add pairs to verify.

Words that share a reduced word are dealt out in blocks where there are many of
them, so no task gets an unbounded bucket.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm.common import mix, release, table
from revloom.llm.jaccard import bit_filter, passes
from revloom.session import written

# Fixed values of the contract.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
DAMAGE = 199

# Symbols of the reduced alphabet.
SYMBOLS = 16
# Words of one reduced word that are joined together in one block.
BUCKET = 256
# Hashes that are generated at once in a task.
PIECE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word): every word of at least ``LEAST_LENGTH`` letters, one row per occurrence.

    A run whose checksum with the key (a null key counts as "") is divisible by
    ``DAMAGE`` lacks one letter. Shorter runs cannot give a word and are not cut out.
    """
    pattern = f"[{LETTERS}]{{{LEAST_LENGTH},}}"
    runs = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(pattern), F.lit(0))
    cut = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.explode(runs).alias("run"))
    checksum = F.crc32(F.concat_ws(":", "k", "run").cast("binary"))
    marked = cut.withColumn("h", checksum)
    at = (F.col("h") % F.char_length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = marked.select(F.when(F.col("h") % DAMAGE == 0, damaged).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= LEAST_LENGTH)


def _reduced(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all words in order, where each word begins; one more at the end)."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
    return (points % SYMBOLS + 1).astype(np.uint64), starts


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _BASE, dtype=np.uint64)
    powers[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(powers)


def _key(sums: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Key of a reduced word from its polynomial and its length."""
    with np.errstate(over="ignore"):
        return mix(sums + mix(length.astype(np.uint64) + np.uint64(1)))


def reduced_keys(words: list[str]) -> np.ndarray:
    """Key of the reduced word of every word."""
    symbols, starts = _reduced(words)
    sizes = np.diff(starts)
    powers = _powers(int(sizes.max(initial=0)) + 1)
    with np.errstate(over="ignore"):
        place = np.arange(len(symbols)) - np.repeat(starts[:-1], sizes)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(symbols * powers[place], dtype=np.uint64)))
        return _key(sums[starts[1:]] - sums[starts[:-1]], sizes)


def neighbourhoods(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, key): all reduced words at most one edit from the word's
    own, the own one included, each once.

    Words of one length are handled together, as a table with a row per word.
    """
    owners, found = [], []
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(sizes):
        mine = np.flatnonzero(sizes == length)
        powers = _powers(int(length) + 2)
        step = max(1, PIECE // (2 * SYMBOLS * (int(length) + 1)))
        for at in range(0, len(mine), step):
            rows = mine[at : at + step]
            symbols, _ = _reduced([words[i] for i in rows])
            keys = _one_edit(symbols.reshape(len(rows), length), powers)
            keys.sort(axis=1)
            new = np.ones(keys.shape, dtype=bool)
            new[:, 1:] = keys[:, 1:] != keys[:, :-1]
            row, _ = np.nonzero(new)
            owners.append(rows[row])
            found.append(keys[new])
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(found)


def _one_edit(symbols: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Keys of the full neighbourhood: a row per word, repeated ones included."""
    count, length = symbols.shape
    every = np.arange(1, SYMBOLS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        before = np.zeros((count, length + 1), dtype=np.uint64)
        np.cumsum(symbols * powers[:length], axis=1, out=before[:, 1:])
        whole = before[:, -1:]
        deleted = before[:, :-1] + (whole - before[:, 1:]) * _BACK
        change = every[None, None, :] - symbols[:, :, None]
        replaced = whole[:, :, None] + change * powers[None, :length, None]
        shifted = before + (whole - before) * _BASE
        inserted = shifted[:, :, None] + every * powers[None, : length + 1, None]
    parts = [(deleted, length - 1), (replaced.reshape(count, -1), length), (inserted.reshape(count, -1), length + 1)]
    # Replacing a symbol by itself gives the reduced word itself.
    return np.concatenate([_key(sums, np.full(1, size)) for sums, size in parts], axis=1)


def near_pairs(vocabulary: DataFrame, word: str = "word", count: str = "n") -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words exactly one edit apart.

    ``vocabulary`` has each word once; it is read more than once.
    """

    def keyed(frames):
        for frame in frames:
            yield frame.assign(key=reduced_keys(frame["word"].tolist()).view(np.int64))

    words = vocabulary.select(F.col(word).alias("word"), F.col(count).alias("n"))
    words = written(words.mapInPandas(keyed, "word string, n long, key long"), "spelling-reduced")
    known = bit_filter(words, "key")

    def generate(frames):
        for frame in frames:
            owner, keys = neighbourhoods(frame["word"].tolist())
            keys = keys.view(np.int64)
            meet = passes(known.value, keys)
            picked = frame.iloc[owner[meet]]
            yield pd.DataFrame({"word": picked["word"].to_numpy(), "n": picked["n"].to_numpy(), "key": keys[meet]})
        release()

    probes = words.select("word", "n").mapInPandas(generate, "word string, n long, key long")
    large = words.groupBy("key").count().where(F.col("count") > BUCKET)
    large = written(large.select("key", F.ceil(F.col("count") / BUCKET).cast("int").alias("blocks")), "spelling-large")
    blocks: Column = F.coalesce("blocks", F.lit(1))
    probes = probes.join(large, "key", "left").select(
        "word", "n", "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")
    )
    kept = words.join(large, "key", "left").select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), "key", F.pmod(F.xxhash64("word"), blocks).cast("int").alias("block")
    )
    met = probes.join(kept, ["key", "block"])
    return met.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: the last word along the forms.

    A form has at least ``RATIO`` times the count, so there are no cycles; each round
    doubles the distance looked ahead.
    """
    ahead = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = ahead.join(onward, "root", "left")
        new = written(
            stepped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        ahead = new.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``.

    Words are lower-cased runs of letters, of at least ``LEAST_LENGTH`` letters and
    ``LEAST_COUNT`` occurrences. Null and empty texts, and empty tables, have none;
    repeated rows count again; a null key counts as the empty text in the checksum.
    Other columns are not looked at. Of several near words with the largest count the
    smallest in code-point order is the form.
    """
    counted = occurrences(docs, key, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = written(counted.where(F.col("n") >= LEAST_COUNT), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    met = near_pairs(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    likely = -F.col("best.less") >= RATIO * F.col("n")
    judged = written(
        vocabulary.join(met, "word", "left").select(
            "word",
            F.when(likely, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(likely, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    last = roots(judged.where("form is not null"))
    return judged.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with their near words, forms and roots."""
    return variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


# The checksum is taken byte by byte through a table made by its rule; in UTF-8 the
# letters beyond ASCII have the two bytes C3 and 80 to BF. Words one edit
# apart become equal when both lose the letter at one place, or one of them loses one.
OP12_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, i::UBIGINT AS c, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
),
crc AS MATERIALIZED (SELECT list(c ORDER BY byte) AS t FROM bits WHERE step = 8),
runs AS MATERIALIZED (
  SELECT k, run, count(*) AS times FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS k,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{6,}')) AS run
    FROM documents
  ) GROUP BY k, run
),
summed AS (
  SELECT run, times, xor(4294967295::UBIGINT, list_reduce(
    flatten([CASE WHEN ord(c) < 128 THEN [ord(c)::UBIGINT] ELSE [195::UBIGINT, (ord(c) - 64)::UBIGINT] END FOR c IN string_split(k || ':' || run, '')]),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT)) AS h
  FROM runs, crc
),
w AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0
      THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM summed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
),
less AS (
  SELECT word, n, 0 AS i, word AS part FROM w
  UNION ALL
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS part
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
),
near AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.part = b.part
  WHERE a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)
),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top_n FROM near GROUP BY word
),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(best.n_near, 0) AS n_near,
    CASE WHEN top_n >= 5 * w.n THEN top_n END AS form_n,
    CASE WHEN top_n >= 5 * w.n THEN (SELECT min(near) FROM near WHERE near.word = w.word AND near.near_n = best.top_n) END AS form
  FROM w LEFT JOIN best ON best.word = w.word
),
r AS (
  SELECT word, word AS root FROM f
  UNION ALL
  SELECT r.word, f.form FROM r JOIN f ON f.word = r.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM f JOIN r ON r.word = f.word JOIN f AS e ON e.word = r.root AND e.form IS NULL
"""

QUERIES = {"op12_spelling": op12_spelling}
ORACLE = {"op12_spelling": OP12_SQL}
