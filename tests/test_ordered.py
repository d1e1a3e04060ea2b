"""Blocks of hot groups give what plain windows give."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from revloom.operators import history, ordered


@pytest.fixture(scope="module")
def rows(spark):
    """One group holds most rows; values repeat and lie unevenly."""
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(300):
        group = "hot" if i % 10 else f"g{i % 7}"
        seconds = rng.choice([5, 5, 5, 6, 7, rng.randrange(100_000)])
        word = rng.choice(["prefix-a", "prefix-b", "prefix-ba", "x", "prefix-"]) + str(i % 3)
        data.append((group, i, start + timedelta(seconds=seconds), word))
    return spark.createDataFrame(data, "g string, id long, ts timestamp, word string").cache()


def as_map(df, key, value):
    return {tuple(r[k] for k in key): r[value] for r in df.collect()}


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("order", [["ts", "id"], ["word", "id"], ["id"]])
def test_rank_of_hot_groups(rows, group, order):
    window = Window.partitionBy(*group).orderBy(*order)
    expected = as_map(rows.withColumn("r", F.row_number().over(window)), ["id"], "r")
    got = ordered.rank(rows, group, order, "r", block_rows=20)
    assert as_map(got, ["id"], "r") == expected


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_null_and_repeated_keys_keep_every_row(spark, block_rows):
    """Null groups, null order values and repeated keys: one result, hot or not."""
    data = [(g, o, i) for i, (g, o) in enumerate(
        [(None, k) for k in range(20)] + [("a", None)] * 15 + [("a", 3)] * 15 + [("b", k % 4) for k in range(20)]
    )]
    df = spark.createDataFrame(data, "g string, o int, id long").coalesce(1).cache()
    got = history.previous(df, ["g"], ["o"], {"p": "id"}, block_rows=block_rows)
    last, want = {}, {}
    for g, o, i in sorted(data, key=lambda r: (r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        want[i] = last.get(g)
        last[g] = i
    assert got.count() == len(data)
    assert {r["id"]: r["p"] for r in got.collect()} == want
    ranked = ordered.rank(df, ["g"], ["o"], "r", block_rows=block_rows)
    assert ranked.columns == ["g", "o", "id", "r"]
    for g in (None, "a", "b"):
        n = sum(x[0] == g for x in data)
        assert sorted(r["r"] for r in ranked.collect() if r["g"] == g) == list(range(1, n + 1))


def test_previous_of_hot_groups(rows):
    plain = history.previous(rows, ["g"], ["ts", "id"], {"p": "id"})
    blocks = history.previous(rows, ["g"], ["ts", "id"], {"p": "id"}, block_rows=20)
    assert set(blocks.columns) == set(plain.columns)
    assert as_map(blocks, ["id"], "p") == as_map(plain, ["id"], "p")


def test_moving_average_of_hot_groups(rows):
    sizes = {"a": 3, "b": 8}
    plain = history.moving_average_gap(rows, ["g"], "ts", "id", sizes)
    blocks = history.moving_average_gap(rows, ["g"], "ts", "id", sizes, block_rows=20)
    for name in sizes:
        assert as_map(blocks, ["id"], name) == as_map(plain, ["id"], name)


def test_moving_average_by_hand(spark):
    start = datetime(2024, 1, 1)
    times = [0, 10, 14, 20, 21]
    df = spark.createDataFrame(
        [("u", i, start + timedelta(seconds=t)) for i, t in enumerate(times)],
        "g string, id long, ts timestamp",
    )
    got = as_map(history.moving_average_gap(df, ["g"], "ts", "id", {"a": 2}), ["id"], "a")
    assert got == {(1,): 10.0, (2,): 7.0, (3,): 5.0, (4,): 3.5}


def test_time_gaps_of_hot_groups(rows):
    plain = history.time_gaps(rows, ["g"], "ts", "id")
    blocks = history.time_gaps(rows, ["g"], "ts", "id", block_rows=20)
    assert as_map(blocks, ["id"], "gap_seconds") == as_map(plain, ["id"], "gap_seconds")
    assert plain.count() == rows.count() - rows.select("g").distinct().count()


def test_running_total_of_hot_groups(rows):
    window = Window.partitionBy("g").orderBy("ts", "id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    value = F.col("id") % 5
    expected = as_map(rows.withColumn("s", F.sum(value).over(window)), ["id"], "s")
    for block_rows in (20, 1000):
        got = ordered.running_total(rows, ["g"], ["ts", "id"], value, "s", block_rows)
        assert as_map(got, ["id"], "s") == expected
