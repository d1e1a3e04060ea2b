"""The trie of rebuilt conversations against SQL, rebuilt lists, and odd rows."""

import hashlib
import random
import zlib

import pytest

from revloom.llm import trie
from tests import oracle
from tests.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for node, cs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        kids = [m for m in below if len(m) == len(node) + 1]
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(paths[c]) == len(node)))
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        leaves = sum(not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in below) for m in below)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def scattered(spark):
    """Every partition stays on its own, so long conversations span some."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield spark
    spark.conf.unset(key)


def conversations(rng, n=60):
    rows, words = [], ["a", "b", "é", "long text " * 9, ""]
    for c in range(n):
        if rng.random() < 0.15:
            continue  # also some bases are absent
        start = rng.choice([0, 0, 3])
        size = rng.choice([1, 2, 5, 8, 9, 12, 14])
        turns = [(("user", "assistant")[i % 2], rng.choice(words[: 1 + (i > 1) + (i > 6)])) for i in range(size)]
        rows += [(c, start + i, role, text) for i, (role, text) in enumerate(turns)]
    return rows


def test_query_matches_sql(spark):
    con = oracle.connect(SF)
    assert oracle.compare(trie.op13_trie(spark, SF), con, trie.OP13_SQL) is None


@pytest.mark.parametrize("share", [1000, 10])
def test_shared_prefixes_and_long_conversations(scattered, monkeypatch, share):
    """Few different turns, so nodes are shared; one conversation has a third of all rows."""
    monkeypatch.setattr(trie, "SHARE", share)
    rng = random.Random(share)
    rows = conversations(rng)
    for c in (71, 72):
        rows += [(c, i, "user", f"t{i if i < 80 else i + c}") for i in range(100)]
    rng.shuffle(rows)
    df = scattered.createDataFrame(rows, SCHEMA).repartition(3)
    found = got(trie.trie(df))
    assert found == brute(rows)
    assert max(r[3] for r in found if r[1] > 3) > 1 and max(r[1] for r in found) > 90


def test_colliding_fingerprints_are_seen(spark, monkeypatch):
    """With a base of one, turns in another order have the same fingerprint."""
    used, real = [], trie.bases

    def first_bad(attempt):
        used.append(attempt)
        return [1] * trie.SUMS if attempt == 0 else real(attempt)

    monkeypatch.setattr(trie, "bases", first_bad)
    rows = [(c, i, "user", t) for c, ts in ((0, "abc"), (10, "acb"), (15, "abc")) for i, t in enumerate(ts)]
    rows += [(c, 3 + i, "user", "z") for c in (0, 10, 15) for i in range(9)]
    found = got(trie.trie(spark.createDataFrame(rows, SCHEMA)))
    assert found == brute(rows) and used == [0, 1]


def test_odd_rows(spark):
    """Null turns, roles, texts and ids, repeated rows, very long texts, no own turn left."""
    rows = [(None, 0, "user", "x"), (1, 0, "user", "only"), (6, None, None, None), (6, 1, "user", "é" * 200_000)]
    rows += [(5, t, "user", "same") for t in (None, None, 0, 0, 1, 2, 2)] + [(20, i, None, "") for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS pos", "'x' AS k1", "2 AS row", "3 AS c", "4 AS depth")
    assert got(trie.trie(df)) == brute(rows)


def test_many_ends_of_one_node(scattered, monkeypatch):
    """Copies that end together are digested piece by piece, over partitions."""
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = [(c * 5, i, "user", f"t{i}") for c in range(90) for i in range(3)]
    assert got(trie.trie(scattered.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_ties_do_not_depend_on_the_layout(spark):
    rows = [(5, 1, "user", t) for t in "fbdace"] + [(6, 0, "user", "x")]
    a, b = (got(trie.trie(spark.createDataFrame(x, SCHEMA).repartition(n))) for x, n in ((rows, 1), (rows[::-1], 3)))
    assert a == b


def test_empty_table(spark):
    assert got(trie.trie(spark.createDataFrame([], SCHEMA))) == []
