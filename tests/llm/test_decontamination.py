"""Benchmark passages against a plain scan, SQL, and odd rows."""

import random

from revloom.llm import decontamination as dc
from tests import oracle
from tests.conftest import SF


def plain(text, items, width):
    w, hit, found = dc.words(text), set(), set()
    for item, t in items:
        b = dc.words(t)
        if not b:
            continue
        size = min(width, len(b))
        grams = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(item)
    return len(w), sorted(hit), sorted(found)


def test_query_matches_sql(spark):
    con = oracle.connect(SF)
    assert oracle.compare(dc.op8_decontamination(spark, SF), con, dc.OP8_SQL) is None


def rows():
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "B", "ä", "c9", "don't", "x-y", "漢"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 4, 9])))) for i in range(12)] + [(50, None), (None, "zz yy")]
    docs = [(i, " ".join(word() for _ in range(rng.randrange(40)))) for i in range(60)] + [(None, None), (70, ""), (71, "Q ZZ  yy Q " * 3000)]
    return docs, items


def test_plain_scan_and_cut_benchmark(spark):
    docs, items = rows()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {d: plain(t, [("" if i is None else str(i), x) for i, x in items], 4) for d, t in docs}
    for limit in (1_000_000, 7):
        out = dc.find(df, bench, width=4, max_windows=limit)
        assert out.columns == ["doc_id", "text", "n_words", "n_words_", "hit_words", "hit_items"]
        assert {r.doc_id: (r.n_words_, list(r.hit_words), list(r.hit_items)) for r in out.collect()} == want


def test_spans_go_and_clean_texts_stay(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    docs = [(1, "Keep This, too. " + passage.upper() + "! And a good deal more of it that follows here, all of it fine and clean."),
            (2, passage), (3, "nothing  here\n"), (4, None), (3, "nothing  here\n")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = sorted((r.doc_id, r.text) for r in dc.clean(df, bench).collect() if r.text)
    assert kept[0] == (1, "Keep This, too. ! And a good deal more of it that follows here, all of it fine and clean.")
    assert kept[1:] == [(3, "nothing  here\n")] * 2
    assert dc.clean(df, bench).count() == 4
    assert dc.clean(df, bench.limit(0)).count() == 5 and dc.clean(df.limit(0), bench).count() == 0
