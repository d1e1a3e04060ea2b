"""SimHash groups against all pairs, and odd rows."""

import random
import re

import numpy as np
import pytest
import xxhash

from revloom.llm import simhash
from revloom.llm.common import components, table
from tests.conftest import SF


def slow_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """(key, fingerprint, smallest key reachable), from (key, fingerprint) pairs."""
    label = {d: d for d, _ in prints if d is not None}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    known = [(d, f) for d, f in prints if d is not None]
    for i, (a, x) in enumerate(known):
        for b, y in known[:i]:
            if (x ^ y).bit_count() <= 3:
                low, high = sorted((top(a), top(b)))
                label[high] = low
    return sorted([(d, f"{f:016x}", None if d is None else top(d)) for d, f in prints], key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_query_matches_brute_force(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert got(simhash.op11_simhash(spark, SF)) == grouped([(r.doc_id, slow_print(r.text)) for r in rows])


def cloud(rng, n):
    """Fingerprints far apart, in chains, and in one tight cluster of a third."""
    prints = [rng.getrandbits(64) for _ in range(n // 3)]
    walk = rng.getrandbits(64)
    for _ in range(n // 3):
        for bit in rng.sample(range(64), rng.choice([1, 3, 3, 4])):
            walk ^= 1 << bit
        prints.append(walk)
    centre = rng.getrandbits(64)
    for _ in range(n // 3):
        mine = centre
        for bit in rng.sample(range(64), rng.randrange(5)):
            mine ^= 1 << bit
        prints.append(mine)
    return prints


@pytest.mark.parametrize(("leaf", "block", "share"), [(64, 40, 1), (4096, 1 << 14, 16), (16, 10_000, 2)])
def test_trees_blocks_and_clusters(spark, monkeypatch, leaf, block, share):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SAMPLE_SHARE", share)
    rng = random.Random(leaf)
    prints = list(enumerate(cloud(rng, 900)))
    rng.shuffle(prints)
    rows = [(f - (1 << 64) if f >> 63 else f, d) for d, f in prints]
    distinct = spark.createDataFrame(rows, "fp long, first long").groupBy("fp").agg({"first": "min"})
    distinct = distinct.withColumnRenamed("min(first)", "first")
    pairs = [tuple(r) for r in simhash.near(distinct, distinct.count()).collect()]
    by_id = dict(prints)
    assert all((by_id[a] ^ by_id[b]).bit_count() <= 3 for a, b in pairs)
    assert len(pairs) < 60 * len(prints)
    label = {d: d for d in by_id}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    first = {}
    for d, f in sorted(prints):
        label[d] = first.setdefault(f, d)
    for a, b in pairs:
        low, high = sorted((top(a), top(b)))
        label[high] = low
    assert sorted((d, f"{f:016x}", top(d)) for d, f in prints) == sorted(grouped(prints), key=lambda r: r)


def test_every_link_lies_in_a_leaf():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    other = points.copy()
    for i in range(len(other)):
        for bit in rng.choice(64, 3, replace=False):
            other[i] ^= np.uint64(1) << np.uint64(bit)
    together = np.zeros(len(points), dtype=bool)
    for mask in simhash.PARTS:
        tree = simhash.build(points & np.uint64(mask), 1, 50, iter(range(10_000)))
        assert isinstance(tree, simhash.Split)
        both = np.concatenate((points, other)) & np.uint64(mask)
        sizes = []
        for _, at in simhash.route(tree, both, np.arange(len(both)), 1):
            sizes.append(len(at))
            inside = np.zeros(len(both), dtype=bool)
            inside[at] = True
            together |= inside[: len(points)] & inside[len(points) :]
        assert max(sizes) < len(both) / 8
    assert together.all()


def test_odd_rows(spark):
    """Null and empty texts, null keys, repeated rows and keys, a very long text."""
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(None, text), (1, None), (2, ""), (3, " \t\n"), (4, text), (4, text), (9, text + " more"), (5, "one"), (6, "One"), (7, "one\x0btwo")]
    rows += [(8, "ä   Ä É"), (0, text * 300), (12, "x " * 50_000), (13, "x " * 60_000), (20, text), (20, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS id")
    assert got(simhash.link(df)) == grouped([(d, slow_print(t)) for d, t in rows])


def test_hot_fingerprint(spark):
    rows = [(d, "same words here" if d % 3 else f"other {d} text {d * 7}") for d in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(simhash.link(df)) == grouped([(d, slow_print(t)) for d, t in rows])


def test_empty_table(spark):
    assert got(simhash.link(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_components_of_a_long_chain_and_a_star(spark):
    """Labels travel far in few rounds; a node with very many links is no burden."""
    rng = random.Random(6)
    chain = rng.sample(range(1000, 2000), 150)
    links = list(zip(chain, chain[1:], strict=False)) + [(3, 3000 + i) for i in range(300)] + [(7, 7)]
    rng.shuffle(links)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    assert found == dict.fromkeys(chain, min(chain)) | dict.fromkeys([3, *range(3000, 3300)], 3)
