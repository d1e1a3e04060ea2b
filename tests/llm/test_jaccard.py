"""Linked groups against all pairs, SQL, and odd rows."""

import random

import pytest

from revloom.llm import jaccard
from tests import oracle
from tests.conftest import SF


def brute(rows, percent=85, width=4):
    sets = [(d, jaccard.shingles(t, width)) for d, t in rows]
    label = {d: d for d, _ in rows if d is not None}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is None or b is None or not x or not y:
                continue
            if 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((top(a), top(b)))
                label[high] = low
    return sorted([(d, len(s), None if d is None else top(d)) for d, s in sets], key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_query_matches_sql(spark):
    con = oracle.connect(SF)
    assert oracle.compare(jaccard.op9_jaccard(spark, SF), con, jaccard.OP9_SQL) is None


@pytest.mark.parametrize("block", [256, 5])
def test_a_large_group_of_near_copies(spark, monkeypatch, block):
    """Edits of one text from none to many: links between edits, chains, other lists."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(block)
    base = [f"w{rng.randrange(300)}" for _ in range(90)]
    rows = []
    for d in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
            words[rng.randrange(len(words))] = f"e{rng.randrange(40)}"
        rows.append((d, " ".join(words[: 90 - rng.choice([0, 0, 5, 9])])))
    rows += [(500 + i, " ".join(base[i * 9 : i * 9 + 12])) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = got(jaccard.link(df))
    assert found == brute(rows)
    assert len({c for _, _, c in found}) > 9
    kept = sorted(r.doc_id for r in jaccard.keep_one(df).collect())
    assert kept == sorted({c for _, _, c in found})


def test_odd_rows(spark):
    text = "One two three four five six seven"
    rows = [(4, text), (2, text.upper()), (None, text), (7, None), (8, " \t"), (9, "one two"), (3, "ONE  two\n"),
            (10, "one two three"), (2, text.upper()), (11, "long " * 90_000), (12, "long long long long long"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as n_shingles", "'x' as id")
    found = got(jaccard.link(df))
    assert found == brute([*rows])
    kept = sorted((str(r.doc_id), str(r.text)) for r in jaccard.keep_one(df).collect())
    assert [k for k, _ in kept] == ["10", "11", "2", "3", "7", "8", "None", "None"]
    assert jaccard.link(df.limit(0)).count() == 0 and jaccard.keep_one(df.limit(0)).count() == 0


def test_a_repeated_key_is_one_document(spark):
    x, y = "a b c d e f g h", "k l m n o p q r"
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(5, x), (5, near), (1, x), (9, y), (12, near + " end"), (9, y)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in jaccard.link(df).collect()}
    assert found == {(5, 1), (1, 1), (12, 1), (9, 9)}


def test_texts_that_stay_are_not_shuffled(spark):
    """Only rows that a filter takes for dropped ones travel, also where no side is small."""
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(1, near), (2, near + " end"), (3, "x y z"), (None, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard.keep_one(df)
        plan = kept._jdf.queryExecution().executedPlan().toString().splitlines()
        assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = [len(x) - len(x.lstrip(" :+-")) for x in plan]
    for i, line in enumerate(plan):
        if "Exchange hashpartitioning" in line:
            end = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
            below = "\n".join(plan[i:end])
            assert "text#" not in below or "ArrowEvalPython" in below, below
