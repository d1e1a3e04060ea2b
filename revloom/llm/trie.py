"""Prefix trie of rebuilt conversations from composable fingerprints.

A sequence of turns has the fingerprint sum(v_i * B^i) modulo a prime, v_i being the
hash of the turn at place i. Fingerprints form a monoid: a sequence followed by
another has the sum of the first and of the second shifted by a power of B. So the
prefix sums of the stored turns are enough: the fingerprint of a rebuilt conversation
(head of its base, then a suffix of its own) is an affine map of its own prefix sum,
and no rebuilt text is ever put together. Three bases make up 93 bits.

Prefixes with one depth and fingerprint are a node. They are verified by the stored
turns they refer to: where a node has more than one, their roles and texts are
compared, and so are the parents; if two differ, everything is done again with other
bases. Sums over subtrees need no walk over the tree: each childless node counts once
for the members of a node, through its smallest member, and the weights of nodes are
added up along the conversation that is their smallest member.

Rows are sorted by range over conversation and turn, so a conversation of any length
is spread over tasks; per-conversation values of very long ones are broadcast.
"""

from __future__ import annotations

import hashlib
from itertools import count as attempts

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revloom.llm.common import look_up, table
from revloom.operators import ordered
from revloom.session import written

# Fixed values of the contract: conversations per base, heads shorter than this.
FAMILY, HEADS = 5, 9

PRIME = (1 << 31) - 1
SUMS = 3
# Keys with more than one in SHARE of all rows (so fewer than SHARE) are broadcast.
SHARE = 1000
# Ids of one piece of a list that is digested.
PIECE = 4096
# Powers come from tables: digits of six bits, six of them.
DIGIT, DIGITS = 6, 6

KEY = ["depth", "k1", "k2"]


def bases(attempt: int) -> list[int]:
    """The bases of one attempt: numbers from a digest, two at least."""
    digest = hashlib.sha256(f"base {attempt}".encode()).digest()
    return [2 + int.from_bytes(digest[8 * i : 8 * i + 8]) % (PRIME - 2) for i in range(SUMS)]


def _power(base: int, exponent: Column) -> Column:
    """base ** exponent modulo the prime, for exponents below 2 ** 36."""
    result: Column = F.lit(1).cast("long")
    for k in range(DIGITS):
        powers = [pow(base, j << (DIGIT * k), PRIME) for j in range(1 << DIGIT)]
        digit = F.shiftright(exponent, DIGIT * k).bitwiseAND((1 << DIGIT) - 1).cast("int")
        result = result * F.element_at(F.lit(powers).cast("array<long>"), digit + 1) % PRIME
    return result


def _modulo(value: Column) -> Column:
    return F.pmod(value, F.lit(PRIME))


def _packed(sums: list[Column]) -> list[Column]:
    """Three numbers below 2 ** 31 as the two parts of a key."""
    return [F.shiftleft(sums[0].cast("long"), 31) + sums[1], sums[2]]


def stored_turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, row): turns with a conversation, each with a number."""
    return df.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )


def prefix_products(store: DataFrame, base: list[int]) -> DataFrame:
    """(conv_id, pos, s1.., p1.., bytes, row): for every turn its place from 1, the
    fingerprint of the turns up to it and of those before it.

    Each partition of the sorted rows adds up its own stretch of a conversation; what
    goes before is the product of earlier stretches, one row per partition at most.
    """
    order = ["turn", *[f"v{i}" for i in range(SUMS)], "row"]
    values = [F.pmod(F.xxhash64(F.lit(x), "role", "text"), F.lit(PRIME)).alias(f"v{i}") for i, x in enumerate(base)]
    size = F.octet_length("text").cast("long").alias("bytes")
    placed = written(
        store.select("conv_id", "turn", *values, size, "row")
        .repartitionByRange("conv_id", *order)
        .withColumn("part", F.spark_partition_id()),
        "trie-placed",
    )
    window = Window.partitionBy("conv_id", "part").orderBy(*order)
    numbered = placed.withColumn("r", F.row_number().over(window).cast("long"))
    terms = numbered.select(
        "conv_id", "part", "r", "bytes", "row", *order[:-1],
        *[(F.col(f"v{i}") * _power(x, F.col("r")) % PRIME).alias(f"t{i}") for i, x in enumerate(base)],
    )
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = written(
        terms.select(
            "conv_id", "part", "r", "bytes", "row",
            *[F.sum(f"t{i}").over(upto).alias(f"l{i}") for i in range(SUMS)],
            *[f"t{i}" for i in range(SUMS)],
        ),
        "trie-local",
    )
    totals = local.groupBy("conv_id", "part").agg(
        F.max("r").alias("n"), *[_modulo(F.sum(f"t{i}")).alias(f"l{i}") for i in range(SUMS)]
    )
    spread = totals.groupBy("conv_id").count().where("count > 1").select("conv_id")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    shifted = totals.join(spread, "conv_id").withColumn("before", before)
    # A partition continues one conversation at most, so there are no more rows than partitions.
    carried = shifted.select(
        "conv_id", "part", "before",
        *[F.coalesce(F.sum(F.col(f"l{i}") * _power(x, F.col("before")) % PRIME).over(earlier), F.lit(0)).alias(f"c{i}") for i, x in enumerate(base)],
    ).where("before > 0")
    joined = local.join(F.broadcast(carried), ["conv_id", "part"], "left").withColumn("before", F.coalesce("before", F.lit(0)))
    for i, x in enumerate(base):
        raised, carry = _power(x, F.col("before")), F.coalesce(f"c{i}", F.lit(0))
        joined = joined.withColumn(f"s{i}", _modulo(_modulo(F.col(f"l{i}")) * raised + carry))
        joined = joined.withColumn(f"p{i}", _modulo(F.col(f"s{i}") - F.col(f"t{i}") * raised % PRIME))
    sums = [f"{k}{i}" for k in "sp" for i in range(SUMS)]
    return joined.select("conv_id", (F.col("r") + F.col("before")).alias("pos"), *sums, "bytes", "row")


def rebuilt(turns: DataFrame, base: list[int]) -> DataFrame:
    """One row per conversation: ``h`` turns of its own that go, ``head`` (up to eight
    turns of its base that come first), ``length`` when rebuilt, ``stored`` turns, and
    the affine map (m, a) from its own prefix fingerprints to rebuilt ones."""
    fields = ["pos", *[f"s{i}" for i in range(SUMS)], *[f"p{i}" for i in range(SUMS)], "bytes", "row"]
    first = F.collect_list(F.when(F.col("pos") < HEADS, F.struct(*fields)))
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("stored"), F.array_sort(first).alias("first"))
    convs = written(
        convs.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")), "trie-heads"
    )
    origin = convs.select(F.col("conv_id").alias("base_id"), F.col("first").alias("base_first"))
    both = convs.join(origin, F.col("base_id") == F.col("conv_id") - F.col("conv_id") % FAMILY, "left")
    head = F.coalesce(F.slice("base_first", F.lit(1), F.col("h")), F.slice("first", F.lit(1), F.lit(0)))
    both = both.withColumn("head", head).withColumn("taken", F.size("head"))
    own = F.greatest(F.col("stored") - F.col("h"), F.lit(0))
    maps = []
    for i, x in enumerate(base):
        back = F.element_at(F.lit([pow(x, -k, PRIME) for k in range(HEADS)]).cast("array<long>"), F.col("h") - F.col("taken") + 1)
        at_head = F.coalesce(F.get("head", F.col("taken") - 1).getField(f"s{i}"), F.lit(0))
        at_own = F.coalesce(F.get("first", F.col("h") - 1).getField(f"s{i}"), F.lit(0))
        maps += [back.alias(f"m{i}"), _modulo(at_head - back * at_own % PRIME).alias(f"a{i}")]
    return both.select("conv_id", "h", "head", "taken", "stored", (F.col("taken") + own).cast("long").alias("length"), *maps)


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, k1, k2, pk1, pk2, c, bytes, row, ends): every prefix of every rebuilt
    conversation ``c``, with the key of its parent and the stored turn it ends with."""
    heads = convs.select(F.col("conv_id").alias("c"), "length", F.explode("head").alias("t"))
    sums = {k: [F.col(f"t.{k}{i}") for i in range(SUMS)] for k in "sp"}
    from_base = heads.select(
        F.col("t.pos").alias("depth"), *_named(sums["s"], sums["p"]), "c", "t.bytes", "t.row", (F.col("t.pos") == F.col("length")).alias("ends")
    )
    maps = [f"{k}{i}" for i in range(SUMS) for k in "ma"]
    total = convs.agg(F.sum("stored")).first()[0] or 0
    values = convs.select("conv_id", "h", "taken", "length", *maps, "stored")
    hot = values.where(F.col("stored") * SHARE > total)
    own = look_up(turns, values, ["conv_id"], hot, "trie-hot").where("pos > h")
    depth = F.col("pos") - F.col("h") + F.col("taken")
    mapped = {k: [_modulo(F.col(f"m{i}") * F.col(f"{k}{i}") + F.col(f"a{i}")) for i in range(SUMS)] for k in "sp"}
    from_own = own.select(
        depth.alias("depth"), *_named(mapped["s"], mapped["p"]), F.col("conv_id").alias("c"), "bytes", "row", (depth == F.col("length")).alias("ends")
    )
    return from_base.unionByName(from_own)


def _named(sums: list[Column], parents: list[Column]) -> list[Column]:
    columns = [*_packed(sums), *_packed(parents)]
    return [c.alias(name) for c, name in zip(columns, ["k1", "k2", "pk1", "pk2"], strict=True)]


def differing(rows: DataFrame, nodes: DataFrame, store: DataFrame) -> DataFrame:
    """Nodes whose prefixes end with different turns or have different parents."""
    unsure = nodes.where("row <> last_row").select(*KEY)
    references = rows.select(*KEY, "row").distinct().join(unsure, KEY)
    turns = references.join(store.select("row", "role", "text"), "row")
    turn = F.struct("role", "text")
    ends = turns.groupBy(*KEY).agg(F.min(turn).alias("low"), F.max(turn).alias("high")).where("low <> high")
    return ends.select(*KEY).union(nodes.where("pk1 <> last_pk1 or pk2 <> last_pk2").select(*KEY))


def digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ascending ids ``c`` of every key, comma-joined.

    Ids are sorted by range over key and id and joined to pieces where they are; the
    pieces of a key are then digested one after the other, so a task holds one.
    """

    def piece(frames):
        for frame in frames:
            if not len(frame):
                continue
            keys, ids = frame[KEY].to_numpy(), frame["c"].to_numpy()
            new = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
            # A piece begins with a key and after so many ids of one key.
            place = np.arange(len(ids)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            starts = np.flatnonzero(place % PIECE == 0)
            names = list(map(str, ids.tolist()))
            texts = [",".join(names[i:j]) for i, j in zip(starts, [*starts[1:], len(names)], strict=True)]
            yield pd.DataFrame(keys[starts], columns=KEY).assign(c=ids[starts], ids=texts)

    def digest(frames):
        key, state = None, None
        for frame in frames:
            done = []
            for *own, ids in frame.drop(columns="c").itertuples(index=False):
                if own == key:
                    state.update(f",{ids}".encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=[*KEY, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    schema = "depth long, k1 long, k2 long"
    in_order = ends.select(*KEY, "c").repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c")
    pieces = in_order.mapInPandas(piece, f"{schema}, c long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "c").mapInPandas(digest, f"{schema}, ends_sha256 string")


def trie(df: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of ``df``.

    ``df`` has conv_id, turn, role and text; other columns are not looked at. Null
    roles and texts are "". Rows without a conversation are left out. Turns with one
    number follow the hashes of their contents; repeated rows are turns of their own.
    An empty table has no node, also no root.
    """
    store = written(stored_turns(df), "trie-store")
    for attempt in attempts():
        base = bases(attempt)
        turns = written(prefix_products(store, base), "trie-turns")
        convs = written(rebuilt(turns, base), "trie-convs")
        rows = written(prefixes(turns, convs), "trie-prefixes")
        nodes = written(
            rows.groupBy(*KEY).agg(
                F.count(F.lit(1)).alias("n_convs"),
                F.min("c").alias("conv_id"),
                F.min("bytes").alias("bytes"),
                *[F.min(k).alias(k) for k in ("row", "pk1", "pk2")],
                *[F.max(k).alias(f"last_{k}") for k in ("row", "pk1", "pk2")],
            ),
            "trie-nodes",
        )
        if differing(rows, nodes, store).isEmpty():
            return _figures(convs, rows, nodes)


def _figures(convs: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Children, leaves, savings and digests of verified nodes, and the root."""
    spark = convs.sparkSession
    parent = [(F.col("depth") - 1).alias("depth"), F.col("pk1").alias("k1"), F.col("pk2").alias("k2")]
    kids = nodes.where("depth > 1").groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children"))
    weight = (F.col("n_convs") - 1) * F.col("bytes")
    nodes = written(
        nodes.join(kids, KEY, "left").select(
            *KEY, "pk1", "pk2", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), weight.alias("weight")
        ),
        "trie-kids",
    )
    leaves = nodes.where("n_children = 0").select(F.col("conv_id").alias("c"), F.lit(1).alias("leaf"), F.lit(0).cast("long").alias("total"))
    shared = nodes.where("n_convs > 1")
    totals = shared.select(F.col("conv_id").alias("c"), F.lit(0).alias("leaf"), F.col("weight").alias("total"))
    values = leaves.union(totals).groupBy("c").agg(F.max("leaf").alias("leaf"), F.sum("total").alias("total"))
    values = values.join(convs.select(F.col("conv_id").alias("c"), "length"), "c")
    values = written(values, "trie-values")
    n_rows, n_nodes = rows.count(), nodes.count()
    valued = look_up(rows.select(*KEY, "c"), values, ["c"], values.where(F.col("length") * SHARE > n_rows), "trie-hot")
    sums = valued.groupBy(*KEY).agg(
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"), F.coalesce(F.sum("total"), F.lit(0)).alias("below")
    )
    # Of its smallest member, a node leaves out what that member represents above it.
    above = ordered.running_total(
        shared.select(*KEY, "conv_id", "weight"), ["conv_id"], ["depth"], F.col("weight"), "passed"
    ).select(*KEY, (F.col("passed") - F.col("weight")).alias("above"))
    ends = rows.where("ends").select(*KEY, "c")
    rootless = convs.where("length = 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.col("conv_id").alias("c")
    )
    digested = digests(ends.union(rootless))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    figures = (
        nodes.join(sums, KEY).join(above, KEY, "left").join(digested, KEY, "left").select(
            *KEY, "pk1", "pk2", "conv_id", "n_convs", "n_children", "n_leaves",
            F.when(F.col("n_convs") > 1, F.col("below") - F.col("above")).otherwise(F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        )
    )
    figures = written(figures, "trie-figures")
    parents = nodes.where("n_children > 0").select(
        F.col("depth").alias("above"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    hot = parents.where(F.col("n_children") * SHARE > n_nodes).drop("n_children")
    deep = figures.where("depth > 1").withColumn("above", F.col("depth") - 1)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    deep = look_up(deep, parents.drop("n_children"), ["above", "pk1", "pk2"], hot, "trie-hot").select(*columns)
    # The root: one row, from plain totals.
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    if not root["n_convs"]:
        return spark.createDataFrame([], deep.schema)
    top = nodes.agg(
        F.count(F.when(F.col("depth") == 1, 1)), F.count(F.when(F.col("n_children") == 0, 1)), F.coalesce(F.sum("weight"), F.lit(0))
    ).first()
    flat = figures.where("depth = 1").withColumn("parent_conv_id", F.lit(root["conv_id"]).cast("long")).select(*columns)
    single = spark.range(1).select(
        F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("k1"),
        F.lit(0).cast("long").alias("k2"),
        *[
            F.lit(v).cast("long").alias(c)
            for c, v in {
                "conv_id": root["conv_id"], "parent_conv_id": None, "n_convs": root["n_convs"],
                "n_children": top[0], "n_leaves": max(top[1], 1), "saved_tokens": top[2],
            }.items()
        ],
    )
    single = single.join(digested.where("depth = 0"), KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", empty))
    return deep.unionByName(flat).unionByName(single.select(*columns))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    return trie(table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, i::UBIGINT AS c, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
),
crc AS MATERIALIZED (SELECT list(c ORDER BY byte) AS t FROM bits WHERE step = 8),
own AS MATERIALIZED (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
cut AS (
  SELECT c, turns, xor(4294967295::UBIGINT, list_reduce(
    [ord(x)::UBIGINT FOR x IN string_split(c::VARCHAR, '')],
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT)) % 9 AS h
  FROM own, crc
),
built AS MATERIALIZED (
  SELECT x.c, coalesce(y.turns, [])[1:x.h::BIGINT] || x.turns[x.h::BIGINT + 1:] AS path
  FROM cut x LEFT JOIN own y ON y.c = x.c - x.c % 5
),
p AS MATERIALIZED (
  SELECT c, d, path[1:d] AS node, path[1:d - 1] AS up, len(path) = d AS ends FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM built)
),
n AS MATERIALIZED (
  SELECT d, node, min(CASE WHEN d > 0 THEN up END) AS up, min(c) AS c, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY d, node
),
k AS (SELECT d - 1 AS d, up AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY d, up),
f AS MATERIALIZED (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children,
    CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(n.node[n.d].t)) END AS weight
  FROM n LEFT JOIN k ON k.d = n.d AND k.node = n.node
),
s AS (
  SELECT d, node, count(*) FILTER (leaf) AS n_leaves, sum(weight)::BIGINT AS saved_tokens FROM (
    SELECT least(i, f.d) AS d, f.node[1:i] AS node, f.n_children = 0 AS leaf, f.weight
    FROM (SELECT f.*, unnest(range(0, f.d + 1)) AS i FROM f) f
  ) GROUP BY d, node
)
SELECT f.c AS conv_id, f.d AS depth, q.c AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM f JOIN s ON s.d = f.d AND s.node = f.node LEFT JOIN f q ON f.d > 0 AND q.d = f.d - 1 AND q.node = f.up
"""

QUERIES = {"op13_trie": op13_trie}
ORACLE = {"op13_trie": OP13_SQL}
