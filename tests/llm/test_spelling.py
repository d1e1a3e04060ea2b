"""Spelling variants against SQL, all pairs, and odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from revloom.llm import spelling
from tests import oracle
from tests.conftest import SF


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [u for u in n if one_edit(w, u)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda u: (-n[u], u), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_matches_sql(spark):
    con = oracle.connect(SF)
    assert oracle.compare(spelling.op12_spelling(spark, SF), con, spelling.OP12_SQL) is None


@pytest.mark.parametrize("bucket", [256, 2])
def test_variants_of_few_words(spark, monkeypatch, bucket):
    """Many edits of few words: chains of forms, ties, buckets in blocks."""
    monkeypatch.setattr(spelling, "BUCKET", bucket)
    rng = random.Random(bucket)
    letters = "abcdepqéÿ"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 9))) for _ in range(4)]
    for _ in range(120):
        w = list(rng.choice(words))
        at = rng.randrange(len(w))
        w[at : at + rng.randrange(2)] = rng.choice(["", rng.choice(letters)])
        words.append("".join(w))
    picked = [w for i, w in enumerate(words) for _ in range(rng.choice([5, 30, 160]) if i < 60 else 6)]
    rng.shuffle(picked)
    rows = [(d, " ".join(w.upper() if "é" not in w and "ÿ" not in w and rng.random() < 0.2 else w for w in picked[d::40])) for d in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = got(spelling.variants(df))
    assert found == brute(rows)
    assert len({r for _, f, r, *_ in found if f and f != r}) > 0


def test_odd_rows(spark):
    """Null and empty texts, null keys, repeated rows, a very long text and word."""
    long_word = "ab" * 2000
    rows = [(None, "colours " * 7), (1, None), (2, ""), (3, "colour " * 40 + "x" * 5), (3, "colour " * 40), (4, "× ÷ß12345 " * 9)]
    rows += [(5, " ".join(["wörtér"] * 3000 + ["wörter"] * 20)), (6, f"{long_word} {long_word}c " * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS word", "2 AS n", "3 AS key")
    assert got(spelling.variants(df)) == brute(rows)


def test_empty_table(spark):
    assert got(spelling.variants(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_neighbourhood_holds_every_edit():
    rng = random.Random(3)
    for _ in range(50):
        w = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randrange(6, 12)))
        at, c = rng.randrange(len(w)), rng.choice("xyzé")
        edits = [w, w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w + c]
        _, keys = spelling.neighbourhoods([w])
        assert np.isin(spelling.reduced_keys(edits), keys).all()
        assert len(np.unique(keys)) == len(keys)
