"""Near duplicates by 64-bit fingerprints and vantage-point trees.

Fingerprints link at a few differing bits. A node of a tree has a vantage point and a
radius: fingerprints at most that far from it lie inside, the others outside. By the
triangle inequality a link that crosses the border joins a fingerprint inside with one
at most ``reach`` beyond the radius; these are copied inside, so every link lies whole
in some leaf and all other branches are pruned.

Distances between random fingerprints are much alike, so a reach of three bits copies
much. Two fingerprints that differ in three bits differ in at most one in one of their
halves: there is a tree for either half, with a reach of one. Where it lies in a leaf,
a pair is compared in full.

The upper trees are fitted on a bounded sample; every fingerprint is dealt to the
leaves, which are the shards. A leaf that is large all the same is cut into blocks and
every two blocks meet in a task. A task divides its fingerprints further by the same
rule and only returns a spanning forest of the links, never all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm.common import batches, components, look_up, release, table
from revloom.session import written

# Fixed values of the contract: words per shingle, seed of the hash, differing bits.
WIDTH = 3
SEED = 42
REACH = 3

# Parts of a fingerprint that have a tree each: masks of 32 bits, and what two linked
# fingerprints differ by at most in one of them.
PARTS = [0x00000000FFFFFFFF, 0xFFFFFFFF00000000]
PART_REACH = REACH // len(PARTS)

# Sampled fingerprints that fit the upper trees: so many at most, and one in so many.
SAMPLE, SAMPLE_SHARE = 1 << 16, 16
# Fingerprints of a leaf that is not divided further; of a block of a larger one.
LEAF = 4096
BLOCK = 1 << 14
# Sampled fingerprints a node must have to be divided, and points tried as vantage.
LEAST_SAMPLED, TRIED = 32, 8
# Compared with all others at once: rows of a task's table of distances.
ROWS = 256
# Keys with more than one in SHARE of all rows (so fewer than SHARE) are broadcast.
SHARE = 1000


def fingerprint(text: str | None) -> int:
    """64 bits, each set if it is set in over half of the hashes of the shingles.

    Repeated shingles count again; fewer words than a shingle are one shingle as a
    whole; null, and a text without words, give zero.
    """
    joined = b" ".join((text or "").encode().lower().split())
    if not joined:
        return 0
    spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    width = min(WIDTH, len(spaces) + 1)
    starts = np.concatenate(([0], spaces + 1)).tolist()
    ends = np.concatenate((spaces, [len(joined)])).tolist()[width - 1 :]
    n, counts = len(ends), np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 14):
        pairs = zip(starts[at : min(at + (1 << 14), n)], ends[at : at + (1 << 14)], strict=True)
        hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in pairs]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(id, missing, fp) of every row of ``docs`` (id, missing, text)."""

    def run(frames):
        for frame in frames:
            for piece in batches([frame], "text"):
                found = np.array([fingerprint(t) for t in piece["text"]], dtype=np.uint64)
                yield pd.DataFrame({"id": piece["id"].to_numpy(), "missing": piece["missing"].to_numpy(), "fp": found.view(np.int64)})
        release()

    return docs.select("id", "missing", "text").mapInPandas(run, "id long, missing boolean, fp long")


@dataclass(frozen=True)
class Split:
    """A node of a tree: inside and outside are further nodes, or numbers of leaves."""

    vantage: np.uint64
    radius: int
    inside: Split | int
    outside: Split | int


def best_split(points: np.ndarray, reach: int) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that leave the fewest comparisons, or None if no
    split saves a tenth of them."""
    picked = points[:: max(1, len(points) // TRIED)][:TRIED]
    best, least = None, 0.9 * float(len(points)) ** 2
    for vantage in picked:
        upto = np.cumsum(np.bincount(np.bitwise_count(points ^ vantage), minlength=65 + reach))
        inside = upto[reach:].astype(float)  # at most the radius and the reach away
        outside = (len(points) - upto[: len(inside)]).astype(float)
        cost = inside**2 + outside**2
        radius = int(np.argmin(cost))
        if cost[radius] < least:
            best, least = (vantage, radius), cost[radius]
    return best


def build(points: np.ndarray, reach: int, enough: int, numbers) -> Split | int:
    """Tree over points until at most ``enough`` are in a leaf or no split helps."""
    split = best_split(points, reach) if len(points) > enough else None
    if split is None:
        return next(numbers)
    distance = np.bitwise_count(points ^ split[0])
    inside = build(points[distance <= split[1] + reach], reach, enough, numbers)
    return Split(*split, inside, build(points[distance > split[1]], reach, enough, numbers))


def route(node: Split | int, points: np.ndarray, at: np.ndarray, reach: int):
    """(leaf, positions of its points) for all leaves that points ``at`` belong to."""
    if not isinstance(node, Split):
        yield node, at
        return
    distance = np.bitwise_count(points[at] ^ node.vantage)
    for branch, own in ((node.inside, at[distance <= node.radius + reach]), (node.outside, at[distance > node.radius])):
        if len(own):
            yield from route(branch, points, own, reach)


def _table_of_links(points: np.ndarray):
    """(i, j) of a spanning forest of the links of a few points, by comparing all."""
    linked = np.zeros(len(points), dtype=bool)
    for at in range(0, len(points), ROWS):
        near = np.bitwise_count(points[at : at + ROWS, None] ^ points[None, :]) <= REACH
        linked[at : at + ROWS] = near.sum(axis=1) > 1  # one is the point itself
    left = np.flatnonzero(linked)
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            now, front = front[:ROWS], front[ROWS:]
            near = np.bitwise_count(points[now, None] ^ points[None, left]) <= REACH
            hit = near.any(axis=0)
            if hit.any():
                yield now[near.argmax(axis=0)[hit]], left[hit]
                front, left = np.concatenate((front, left[hit])), left[~hit]


def links(points: np.ndarray, part: int):
    """(i, j) of forests that span all links of distinct points, divided as a tree."""
    mask = np.uint64(PARTS[part])
    masked = points & mask
    numbers = iter(range(len(points) + 1 << 20))
    tree = build(masked, PART_REACH, LEAF // 4, numbers)
    for _, at in route(tree, masked, np.arange(len(points)), PART_REACH):
        for i, j in _table_of_links(points[at]):
            yield at[i], at[j]


def shards(distinct: DataFrame, total: int) -> DataFrame:
    """(part, leaf, fp, first): every fingerprint in each leaf it belongs to.

    The upper trees are fitted on at most ``SAMPLE`` fingerprints, and on no more than
    one in ``SAMPLE_SHARE``, picked by a hash.
    """
    share = min(1 / SAMPLE_SHARE, SAMPLE / max(total, 1))
    scale = 1 << 30
    picked = distinct.where(F.pmod(F.xxhash64(F.lit("sample"), "fp"), F.lit(scale)) < int(share * scale))
    sample = np.array([r.fp for r in picked.select("fp").orderBy("fp").toLocalIterator()], dtype=np.int64).view(np.uint64)
    enough = max(LEAST_SAMPLED, int(LEAF * share))
    trees = []
    for part in PARTS:
        numbers = iter(range(4 * SAMPLE * 64))
        mixed = np.random.default_rng(SEED).permutation(sample) & np.uint64(part)
        trees.append(build(mixed, PART_REACH, enough, numbers))
    shared = distinct.sparkSession.sparkContext.broadcast(trees)

    def run(frames):
        for frame in frames:
            fp, first = frame["fp"].to_numpy(), frame["first"].to_numpy()
            for part, tree in enumerate(shared.value):
                masked = fp.view(np.uint64) & np.uint64(PARTS[part])
                for leaf, at in route(tree, masked, np.arange(len(fp)), PART_REACH):
                    yield pd.DataFrame({"part": part, "leaf": leaf, "fp": fp[at], "first": first[at]})

    return distinct.select("fp", "first").mapInPandas(_together(run), "part int, leaf int, fp long, first long")


def _together(work, rows: int = 1 << 15):
    """Few large frames instead of many small ones, on the way in and out."""

    def gathered(frames):
        held, size = [], 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            if size >= rows:
                yield pd.concat(held)
                held, size = [], 0
        if size:
            yield pd.concat(held)

    return lambda frames: gathered(work(gathered(frames)))


def near(distinct: DataFrame, total: int) -> DataFrame:
    """(a, b): links between the ``first`` ids of fingerprints, enough to connect all
    that are linked."""
    routed = written(shards(distinct, total), "simhash-shards")
    # One row per leaf at most, and the sample bounds the number of leaves.
    sizes = routed.groupBy("part", "leaf").count().where(F.col("count") > BLOCK)
    large = written(sizes.select("part", "leaf", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "simhash-large")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    others = F.filter(F.sequence(F.lit(0), blocks - 1), lambda x: (blocks == 1) | (x != F.col("own")))
    cells = (
        routed.join(F.broadcast(large), ["part", "leaf"], "left")
        .withColumn("own", own)
        .withColumn("other", F.explode(others))
        .select("part", "leaf", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp", "first")
    )

    def run(frame):
        points, first = frame["fp"].to_numpy().view(np.uint64), frame["first"].to_numpy()
        found = [(first[i], first[j]) for i, j in links(points, int(frame["part"].iloc[0]))]
        a, b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in zip(*found, strict=True)) if found else ([], [])
        return pd.DataFrame({"a": a, "b": b})

    return cells.groupBy("part", "leaf", "low", "high").applyInPandas(run, "a long, b long")


def link(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) of every row of ``df``.

    ``component_id`` is the smallest key reachable over links, the own one included.
    A null text counts as empty; texts without words have the fingerprint zero and are
    linked like any other. A row without a key has no component (null) and links
    nothing. Rows with one key are one document with several texts. Other columns are
    not looked at; an empty table gives no rows.
    """
    docs = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"), F.col(key).isNull().alias("missing"), F.col(text).alias("text")
    )
    prints = written(fingerprints(docs), "simhash-prints")
    keyed = prints.where("not missing")
    distinct = written(keyed.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    size = distinct.agg(F.count(F.lit(1)), F.sum("n")).first()
    links_found = written(near(distinct, size[0]), "simhash-links")
    # A key with several texts joins their fingerprints.
    several = keyed.groupBy("id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("id")
    also = keyed.join(several, "id").select("id", "fp").distinct().join(distinct, "fp").select(F.col("first").alias("a"), F.col("id").alias("b"))
    groups = components(links_found.union(also), "simhash")
    grouped = distinct.join(groups, F.col("first") == F.col("node"), "left")
    labels = grouped.select("fp", F.coalesce("component", "first").alias("component"), "n", "first")
    labels = written(labels.where("n > 1 or component <> first").select("fp", "component", "n"), "simhash-labels")
    hot = labels.where(F.col("n") * SHARE > (size[1] or 0))
    found = look_up(prints, labels.drop("n"), ["fp"], hot, "simhash-hot")
    return found.select(
        F.when(~F.col("missing"), F.col("id")).alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(~F.col("missing"), F.coalesce("component", "id")).alias("component_id"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints are at most three bits apart."""
    return link(table(spark, sf_dir, "documents").select("doc_id", "text"))


# SQL has no XXH64.
QUERIES = {"op11_simhash": op11_simhash}
ORACLE: dict[str, str] = {}
