"""Similarity join on word shingles with several global token orders.

A token is the hash of a run of words. Two sets with a Jaccard similarity of at
least t must share a token among the first few tokens of each (its prefix) under
*every* global order of tokens. One order finds candidates by an index over
prefixes; they are kept only if the prefixes under the other orders meet as well;
what is left is verified on the words themselves.

All orders put rare tokens first. They use the counts of a sketch of fixed size
(rows of a count-min sketch, another hash and another row per order), so an order
costs no shuffle of tokens and a few MB to broadcast, however many tokens there are.
An order need not be exact: any order gives the right result.

Documents with equal sets are one node from the start. Only connected groups are
asked for, so no list of the index is expanded into all its pairs: first every
member is compared with one member of its list; what is then in one group needs no
further comparison, and only pairs across groups that the length and position
filters leave are looked at, in blocks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.llm.common import WordHasher, batches, components, free_name, mix, release, table, windows
from revloom.session import written

# Fixed values of the contract: words per shingle, percent of similarity.
WIDTH = 4
PERCENT = 85
WHITE = b" \t\n\r\x0b\x0c"

# Columns of the frequency sketch per order: 1 MB each.
SKETCH = 1 << 18
ORDERS = 3
# Members of one block of an index list.
BLOCK = 256
# Bits that hold the parity of a set's tokens: sets differ in at least as many tokens
# as their parities differ in bits. A set of n tokens has about n bits, 64 at least and
# so many at most: enough to tell sets apart that share little.
PARITY_BITS = 2048
# Bits of a filter that keeps rows from being shuffled: 4 MB.
FILTER_BITS = 1 << 25


def most_missing(size, percent: int = PERCENT):
    """Tokens a set of ``size`` may lack in a partner that is similar enough."""
    return size - (percent * size + 99) // 100


def shingles(text: str | None, width: int = WIDTH) -> frozenset:
    """The set of a text by its words: runs of ``width``, or all words if fewer."""
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


@lru_cache(maxsize=8)
def _unpacked(text: bytes, width: int) -> frozenset:
    return shingles(zstandard.ZstdDecompressor().decompress(text).decode(), width)


class Tokens:
    """Shingle hashes of batches of texts."""

    def __init__(self, width: int):
        self.width, self.hasher = width, WordHasher(WHITE)

    def __call__(self, texts: list[str | None]):
        """One array of token hashes per text, repeated tokens included."""
        hashes, starts = self.hasher(texts)
        runs = windows(hashes, self.width)
        for first, end in zip(starts[:-1], starts[1:], strict=True):
            n = end - first
            if n >= self.width:
                yield runs[first : end - self.width + 1]
            elif n:
                yield windows(hashes[first:end], n) + np.uint64(n)
            else:
                yield np.zeros(0, dtype=np.uint64)


def _columns(tokens: np.ndarray, order: int) -> np.ndarray:
    """Column of each token in the sketch row of an order."""
    with np.errstate(over="ignore"):
        return (mix(tokens + np.uint64(order + 1)) >> np.uint64(44)).astype(np.int64) % SKETCH


def tree_merged(rows, merge, empty: np.ndarray) -> np.ndarray:
    """Arrays of one size, one per row as bytes, merged in a tree of tasks."""

    def both(x, y):
        return y if x is None else x if y is None else merge(x, y)

    kind = empty.dtype
    merged = rows.map(lambda r: np.frombuffer(r[0], dtype=kind)).treeAggregate(None, both, both, depth=3)
    return empty if merged is None else merged


def survey(docs: DataFrame, width: int) -> DataFrame:
    """(id, missing, n, s1, s2) of every row and, in rows of their own, ``counts``.

    ``n``, ``s1``, ``s2``: size and two hashes of the set. Each task adds up how many
    of its sets have a token, in ``ORDERS`` rows of ``SKETCH`` columns.
    """

    def run(frames):
        tokens, counts = Tokens(width), np.zeros((ORDERS, SKETCH), dtype=np.float32)
        for frame in frames:
            for piece in batches([frame], "text"):
                sets = [np.unique(t) for t in tokens(piece["text"].tolist())]
                found = np.concatenate([*sets, np.zeros(0, dtype=np.uint64)])
                for order in range(ORDERS):
                    counts[order] += np.bincount(_columns(found, order), minlength=SKETCH)
                with np.errstate(over="ignore"):
                    yield pd.DataFrame(
                        {
                            "id": piece["id"].to_numpy(),
                            "missing": piece["missing"].to_numpy(),
                            "n": [len(own) for own in sets],
                            "s1": np.array([mix(own).sum() for own in sets], dtype=np.uint64).view(np.int64),
                            "s2": np.array([mix(own ^ np.uint64(0x5555)).sum() for own in sets], dtype=np.uint64).view(np.int64),
                            "counts": None,
                        }
                    )
        yield pd.DataFrame({"id": [0], "missing": [True], "n": [0], "s1": [0], "s2": [0], "counts": [counts.tobytes()]})
        release()

    schema = "id long, missing boolean, n long, s1 long, s2 long, counts binary"
    return docs.select("id", "missing", "text").mapInPandas(run, schema)


def frequency_sketch(counts: DataFrame) -> np.ndarray:
    """Sum of the tasks' counts, added in a tree: the driver and every task hold a
    few arrays of a fixed size."""
    empty = np.zeros(ORDERS * SKETCH, dtype=np.float32)
    return tree_merged(counts.rdd, np.add, empty).reshape(ORDERS, SKETCH)


def prefixes(docs: DataFrame, sketch, copies, width: int, percent: int) -> DataFrame:
    """(id, n, tokens, others, parity, copy) of rows with a key and a word.

    ``tokens``: the prefix under the first order, in order. ``others``: short hashes
    of the prefixes under the other orders, one array per order. ``parity``: how
    many tokens fall to each of up to ``PARITY_BITS`` places, modulo 2, as bits.
    ``copy``: whether the bit filter ``copies`` has the id.
    """

    def row(key, found, copy):
        counts, own = sketch.value, np.unique(found)
        length, kept = most_missing(len(own), percent) + 1, []
        for order in range(ORDERS):
            count = np.minimum(counts[order][_columns(own, order)], 2.0**23).astype(np.uint64)
            rank = count << np.uint64(40) | mix(own + np.uint64(91 + order)) >> np.uint64(24)
            first = np.argpartition(rank, length - 1)[:length]
            kept.append(own[first[np.argsort(rank[first])]])
        short = [np.unique((k >> np.uint64(48)).astype(np.uint16).view(np.int16)) for k in kept[1:]]
        bits = min(PARITY_BITS, max(64, 1 << (len(own) - 1).bit_length()))
        odd = np.bincount((own % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        return key, len(own), kept[0].view(np.int64), short, np.packbits(odd.astype(bool)).view(np.int64), copy

    def run(frames):
        tokens = Tokens(width)
        for frame in frames:
            for piece in batches([frame], "text"):
                known = passes(copies.value, piece["id"].to_numpy())
                found = zip(piece["id"].tolist(), tokens(piece["text"].tolist()), known.tolist(), strict=True)
                rows = [row(*x) for x in found if len(x[1])]
                yield pd.DataFrame(rows, columns=["id", "n", "tokens", "others", "parity", "copy"])
        release()

    schema = (
        "id long, n long, tokens array<long>, others array<array<short>>, parity array<long>, copy boolean"
    )
    return docs.where("not missing").select("id", "text").mapInPandas(run, schema)


def bit_filter(df: DataFrame, column: str, bits: int = FILTER_BITS):
    """Broadcast bit array of the values of a long column, of a fixed size.

    It only saves work: what it lets through is joined exactly afterwards.
    """

    def run(frames):
        seen = np.zeros(bits, dtype=bool)
        for frame in frames:
            seen[_bit(frame[column].to_numpy(), bits)] = True
        yield pd.DataFrame({"bits": [np.packbits(seen).tobytes()]})

    rows = df.select(column).mapInPandas(run, "bits binary").rdd
    merged = tree_merged(rows, np.bitwise_or, np.zeros(bits // 8, dtype=np.uint8))
    return df.sparkSession.sparkContext.broadcast(merged)


def _filter_bits(values: DataFrame) -> int:
    """Sixteen bits for each value: few others pass, and none is lost. 16 MB at most."""
    return 1 << min(27, max(20, (16 * values.count()).bit_length()))


def _bit(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.astype(np.int64).view(np.uint64)) % np.uint64(bits)).astype(np.int64)


def passes(packed: np.ndarray, values: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    at = _bit(values, bits)
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def index(sets: DataFrame) -> DataFrame:
    """(token, count, id, n, place): prefix tokens that at least two sets have.

    Only token counts are shuffled for all prefixes; the rows themselves are
    filtered by the tokens that repeat before they are.
    """
    repeated = sets.select(F.explode("tokens").alias("token")).groupBy("token").count().where("count > 1")
    repeated = written(repeated, "jaccard-tokens")
    known = bit_filter(repeated, "token")

    def run(frames):
        for frame in frames:
            sizes = frame["tokens"].map(len).to_numpy(dtype=np.int64)
            if not sizes.sum():
                continue
            token = np.concatenate(frame["tokens"].to_list())
            place = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = passes(known.value, token)
            yield pd.DataFrame(
                {
                    "token": token[keep],
                    "id": np.repeat(frame["id"].to_numpy(), sizes)[keep],
                    "n": np.repeat(frame["n"].to_numpy(), sizes)[keep],
                    "place": place[keep],
                }
            )

    rows = sets.select("id", "n", "tokens").mapInPandas(run, "token long, id long, n long, place long")
    return written(rows.join(repeated, "token"), "jaccard-index")


def possible(n1, p1, n2, p2, percent: int = PERCENT):
    """Whether two sets can be similar enough, by sizes and by the places of their
    first common token; works on columns and on arrays."""
    need = percent * (n1 + n2)
    both = 100 + percent
    near = (100 * n1 >= percent * n2) & (100 * n2 >= percent * n1)
    return near & (both * (n1 - p1) >= need) & (both * (n2 - p2) >= need)


def star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): each member of a list with the member whose place is the first."""
    hub = members.groupBy("token").agg(F.min(F.struct("place", "n", "id")).alias("hub"))
    side = [F.col("n"), F.col("place"), F.col("hub.n"), F.col("hub.place")]
    paired = members.join(hub, "token").where(F.col("id") != F.col("hub.id")).where(possible(*side, percent))
    return paired.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()


def other_pairs(members: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of a list that are still in different groups.

    Lists whose members are all in one group are done. The others are cut into
    blocks; pairs of blocks are compared inside tasks.
    """
    placed = members.join(groups, members["id"] == groups["node"], "left").select(
        members["*"], F.coalesce("component", "id").alias("own")
    )
    placed = written(placed, "jaccard-placed")
    apart = placed.groupBy("token").agg(F.min("own").alias("low"), F.max("own").alias("high"), F.count("*").alias("c"))
    apart = apart.where("low < high and c > 2").select("token")
    block = F.pmod(F.xxhash64("id"), F.ceil(F.col("count") / BLOCK))
    blocks = (
        placed.join(apart, "token", "left_semi")
        .groupBy("token", block.alias("block"))
        .agg(F.collect_list(F.struct("id", "n", "place", "own")).alias("m"))
        .select("token", "block", *[F.col(f"m.{c}").alias(c) for c in ("id", "n", "place", "own")])
    )
    blocks = written(blocks, "jaccard-blocks")
    right = blocks.select("token", *[F.col(c).alias(f"{c}_") for c in ("block", "id", "n", "place", "own")])

    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                left, over = row.block, row.block_
                near = possible(row.n[:, None], row.place[:, None], row.n_[None, :], row.place_[None, :], percent)
                near &= row.own[:, None] != row.own_[None, :]
                i, j = np.nonzero(np.triu(near, 1) if left == over else near)
                x, y = row.id[i], row.id_[j]
                yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    pairs = blocks.join(right, "token").where("block <= block_")
    # Every pair of blocks is a row; they are dealt out evenly before they are compared.
    dealt = pairs.repartition(F.col("token"), F.col("block"), F.col("block_"))
    return dealt.mapInPandas(run, "a long, b long").distinct()


def _folded(parity: Column, words: Column) -> Column:
    """A parity of twice as many words, or four times, on so many words."""

    def half(x: Column) -> Column:
        n = F.floor(F.size(x) / 2).cast("int")
        low, high = F.slice(x, F.lit(1), n), F.slice(x, n + 1, n)
        return F.when(F.size(x) > words, F.zip_with(low, high, lambda a, b: a.bitwiseXOR(b))).otherwise(x)

    return half(half(parity))


def _attached(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with columns of both their sets, as ``<column>_a`` and ``<column>_b``.
    A bit filter keeps rows of documents in no pair from being shuffled."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    paired = bit_filter(ids, "id")

    def only_paired(frames):
        for frame in frames:
            yield frame.filter(pa.array(passes(paired.value, frame.column(0).to_numpy())))

    own = sets.select("id", *columns)
    own = own.mapInArrow(only_paired, own.schema)
    a, b = (own.select(F.col("id").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in columns]) for k in "ab")
    return pairs.join(a, "a").join(b, "b")


def verify(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) of ``pairs`` whose prefixes meet under every order and whose sets are
    similar enough, compared word by word.

    Pairs go first whose parities alone show too large a difference: parities are short,
    and few other pairs are left to which prefixes and texts must travel.
    """
    pairs = written(pairs, "jaccard-pairs")
    light = _attached(pairs, sets, ["n", "parity"])
    words = F.least(F.size("parity_a"), F.size("parity_b"))
    both = [_folded(F.col(f"parity_{k}"), words) for k in "ab"]
    unlike = F.zip_with(*both, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(unlike, F.lit(0), lambda total, x: total + x)
    alike = light.where(differ * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
    alike = written(alike.select("a", "b"), "jaccard-alike")
    crossed = _attached(alike, sets, ["others"])
    for i in range(ORDERS - 1):
        crossed = crossed.where(F.arrays_overlap(F.col("others_a")[i], F.col("others_b")[i]))
    crossed = written(crossed.select("a", "b"), "jaccard-crossed")
    wanted = crossed.select(F.col("a").alias("id")).union(crossed.select("b")).distinct()
    bits = _filter_bits(wanted)
    known = bit_filter(wanted, "id", bits)

    def only_known(frames):
        codec = zstandard.ZstdCompressor(level=3)
        for frame in frames:
            own = frame[passes(known.value, frame["id"].to_numpy(), bits)]
            yield own.assign(text=[codec.compress((t or "").encode()) for t in own["text"]])
        release()

    # Compressed texts: they travel once per pair.
    texts = docs.where("not missing").select("id", "text").mapInPandas(only_known, "id long, text binary")
    texts = written(texts, "jaccard-texts")
    a, b = (texts.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")

    def run(frames):
        for frame in frames:
            keep = []
            for left, right in zip(frame["text_a"], frame["text_b"], strict=True):
                x, y = _unpacked(bytes(left), width), _unpacked(bytes(right), width)
                common = len(x & y)
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield frame.loc[keep, ["a", "b"]]
        _unpacked.cache_clear()
        release()

    return crossed.join(a, "a").join(b, "b").mapInPandas(run, "a long, b long")


def link(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``df``.

    ``component_id`` is the smallest key reachable over links, the own one included.
    A text without words, or null, has no shingles and no links. A row without a key
    has no component (null). Rows with one key are one document with several texts.
    """
    spark = df.sparkSession
    docs = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"),
        F.col(key).isNull().alias("missing"),
        F.col(text).alias("text"),
    )
    surveyed = written(survey(docs, width), "jaccard-survey")
    sketch = spark.sparkContext.broadcast(frequency_sketch(surveyed.where("counts is not null").select("counts")))
    found = surveyed.where("counts is null").drop("counts")
    with_words = found.where("n > 0 and not missing")
    # Equal sets are one node, that of the smallest key.
    first = with_words.groupBy("s1", "s2").agg(F.min("id").alias("first"))
    copies = with_words.select("id", "s1", "s2").join(first, ["s1", "s2"]).where("id != first").select("id", "first")
    copies = written(copies.distinct(), "jaccard-copies")
    # A key with several texts may be a copy by one and the first by another.
    only_copies = copies.select("id").join(first.select(F.col("first").alias("id")), "id", "left_anti")
    only_copies = written(only_copies, "jaccard-only-copies")
    # Only rows that the filter takes for copies are shuffled to make sure.
    marked = written(prefixes(docs, sketch, bit_filter(only_copies, "id"), width, percent), "jaccard-sets")
    unsure = marked.where("copy").join(only_copies, "id", "left_anti")
    sets = marked.where("not copy").unionByName(unsure).drop("copy")
    members = index(sets)
    links = written(verify(star_pairs(members, percent), docs, sets, width, percent), "jaccard-links")
    groups = components(links, "jaccard-stars")
    rest = other_pairs(members, groups, percent).join(links, ["a", "b"], "left_anti")
    more = verify(rest, docs, sets, width, percent)
    every = links.union(more).union(copies.select(F.col("first").alias("a"), F.col("id").alias("b")))
    final = components(every, "jaccard-all")
    own = F.when(~F.col("missing"), F.col("id"))
    return found.join(final, found["id"] == final["node"], "left").select(
        own.alias(key),
        F.col("n").alias("n_shingles"),
        F.when(~F.col("missing"), F.coalesce("component", "id")).alias("component_id"),
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with the document of the smallest key of each group, and all rows
    without a key. Of rows that repeat a key and a text, one stays; different texts
    under one key all do."""
    linked = written(link(df, key, text, **options), "jaccard-linked").where(F.col(key).isNotNull())
    mine = free_name(df, "kept_key")
    gone = linked.where(F.col(key) != F.col("component_id")).select(F.col(key).cast("long").alias(mine)).distinct()
    gone = written(gone, "jaccard-gone")
    bits = _filter_bits(gone)
    known = bit_filter(gone, mine, bits)

    def listed(keys: pd.Series) -> pd.Series:
        return pd.Series(passes(known.value, keys.to_numpy(), bits))

    # Only texts that the filter takes for dropped ones are shuffled to make sure.
    with_key = df.where(F.col(key).isNotNull())
    unsure = F.pandas_udf(listed, T.BooleanType())(F.col(key).cast("long"))
    kept = with_key.where(~unsure).union(
        with_key.where(unsure).join(gone, F.col(key).cast("long") == F.col(mine), "left_anti")
    )
    repeated = linked.groupBy(key).count().where("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([key, text])
    return kept.union(df.where(F.col(key).isNull()))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are linked by similar sets of shingles."""
    return link(table(spark, sf_dir, "documents").select("doc_id", "text"))


_SQL_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{20}\x{9}-\x{D}]+')"

OP9_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
),
r AS (SELECT doc_id AS node, doc_id AS label FROM d UNION SELECT l.b, r.label FROM r JOIN l ON l.a = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT node, min(label) AS component_id FROM r GROUP BY node) c ON c.node = d.doc_id
"""

QUERIES = {"op9_jaccard": op9_jaccard}
ORACLE = {"op9_jaccard": OP9_SQL}
