"""Cross-site lines against a count in one place, and odd rows."""

from collections import defaultdict

import pytest

from revloom.llm import linededup
from tests import oracle
from tests.conftest import SF


def brute(rows, least):
    """[(doc_id, lines, removed, text)] for rows (doc_id, source, text) sorted by doc_id."""
    sites, first, out = defaultdict(set), {}, []
    for d, s, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\r\f\v"):
                sites[line.strip(" \t\r\f\v")] |= {s} - {None}
                first.setdefault(line.strip(" \t\r\f\v"), (d, i))
    for d, _, t in rows:
        if t is None:
            out.append((d, 0, 0, None))
            continue
        parts = [(i, x, x.strip(" \t\r\f\v")) for i, x in enumerate(t.split("\n"))]
        kept = [x for i, x, k in parts if not k or len(sites[k]) < least or first[k] == (d, i)]
        n = sum(bool(k) for _, _, k in parts)
        out.append((d, n, len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r.n_lines, r.n_removed, r.text) for r in df.collect()), key=str)


def test_query_matches_sql(spark):
    con = oracle.connect(SF)
    assert oracle.compare(linededup.op5_linededup(spark, SF), con, linededup.OP5_SQL) is None


@pytest.mark.parametrize("least", [1, 2, 3, 6, 9, 12, 30])
def test_every_threshold_is_exact(spark, least):
    rows = []
    for d in range(200):
        text = "\n".join([f"own {d}", *(f"on {k} sites" for k in range(1, 16) if d % 40 < k), "", "  on 7 sites\r"])
        rows.append((d, f"s{d % 40}", text))
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert got(linededup.remove(df, min_sites=least)) == brute(rows, least)


def test_odd_rows(spark):
    rows = [(1, None, "a\nb"), (2, "x", None), (3, "y", ""), (4, "z", "a\n\na"), (5, "w", "a"), (5, "w", "a")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "doc_id as n_lines")
    out = linededup.remove(df, min_sites=2)
    assert out.columns == ["doc_id", "source", "text", "n_lines", "n_lines_", "n_removed"]
    found = sorted([(r.doc_id, r.text, r.n_removed) for r in out.collect()], key=str)
    assert found == [(1, "a\nb", 0), (2, None, 0), (3, "", 0), (4, "", 2), (5, "", 1), (5, "", 1)]
    assert linededup.remove(df.limit(0)).count() == 0


def test_long_text_and_null_key(spark):
    line = "word " * 40_000
    rows = [(None, f"s{i}", f"{line}\nown {i}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    texts = [r.text for r in linededup.remove(df).collect()]
    assert sum(t.startswith("word") for t in texts) == 1 and all("own" in t for t in texts)


def test_only_texts_with_odd_blanks_are_rewritten(spark):
    """Lines are equal up to the kind of their blanks; no line is translated by itself."""
    forms = ["on a site", "on\ta site", "\fon a\rsite", "on a\vsite \t", " on a site"]
    rows = [(i, f"s{i}", f"own {i}\n{form}\n\t\n") for i, form in enumerate(forms)] + [(9, "s9", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = linededup.remove(df)
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out.collect()}
    assert found[0] == (rows[0][2], 2, 0) and found[9] == (None, 0, 0)
    assert all(found[i] == (f"own {i}\n\t\n", 2, 1) for i in range(1, 5))
    keyed = df.selectExpr("*", "doc_id AS k0", "0L AS k1", "0L AS k2")
    plan = linededup.exploded(keyed, "text", "source")._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(text" in plan and "translate(line" not in plan
