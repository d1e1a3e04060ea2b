import random
import re
import time

import pytest
from pyspark.sql import functions as F

from revloom.functions import labels
from revloom.functions import text as tx
from revloom.functions.markup import plain_text, without_nested


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a. b\nc", ["a. ", "b", "c"]),
        (". . x", [". ", ". ", "x"]),
        ("\n\n", []),
        ("", []),
        ("a.\nb. c. ", ["a.", "b. ", "c. "]),
    ],
)
def test_segments(spark, text, expected):
    assert one(spark, text, tx.segments) == expected


def test_words_of_any_script(spark):
    assert one(spark, "Élan x_1 a 東京 b2!", tx.words) == ["élan", "x_1", "東京", "b2"]


def test_words_and_marks(spark):
    assert one(spark, "Hi, a-b.", tx.words_and_marks) == ["Hi", ",", "a", "-", "b", "."]


def test_characters_keep_line_breaks(spark):
    assert one(spark, "a\n𝄞", tx.characters) == ["a", "\n", "𝄞"]


@pytest.mark.parametrize(
    "low, high, expected",
    [
        (1, 1, ["a", "b", "c"]),
        (1, 2, ["a", "b", "c", "a b", "b c"]),
        (2, 3, ["a b", "b c", "a b c"]),
        (4, 4, []),
    ],
)
def test_ngrams(spark, low, high, expected):
    df = spark.createDataFrame([(["a", "b", "c"],)], "x array<string>")
    assert df.select(tx.ngrams(F.col("x"), low, high)).first()[0] == expected


def test_ngrams_of_nothing(spark):
    df = spark.createDataFrame([([],)], "x array<string>")
    assert df.select(tx.ngrams(F.col("x"), 1, 3)).first()[0] == []


def test_each_drops_empty_and_null(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "k int, x array<string>")
    rows = tx.each(df, ["k"], F.col("x"), "v", "pos").collect()
    assert {(r["k"], r["v"], r["pos"]) for r in rows} == {(1, "a", 0), (1, "b", 1)}


@pytest.mark.parametrize(
    "markup, expected",
    [
        (None, ""),
        ("a<!-- x\ny -->b", "ab"),
        ("<style>p{}</style><p>x</p><script>y</script>", "x"),
        ("{{a|{{b|{{c}}}}}}x", "x"),
        ("[[Page|label]] and [[Other]]", "label and Other"),
        ("[https://a.b/c label text] [http://x.y]", "label text "),
        ("'''bold''' ''it''", "bold it"),
        ("== Head ==\ntext", "Head\ntext"),
        ("a<ref name=x/>b<ref>z</ref>c", "abc"),
        ("x{| class=t\n| cell\n|}y", "xy"),
        ("1 &lt; 2 &amp;&nbsp;3", "1 < 2 & 3"),
        ("{{a" * 6 + "}}" * 6 + "x", "x"),
        ("a{{1|" * 20 + "z" + "}}b" * 20, "a" + "b"),
        ("{{open {{in}} text", "{{open  text"),
        ("shut}} {{a}}x}}", "shut}} x}}"),
        ("{{{three}}} {{x {y} z}}w", "} w"),
        ("{|a {|b|} c|}d", "d"),
        ("[[File:a.jpg|thumb|left|caption]]!", "caption!"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("a <br/>b</p> <!DOCTYPE html>c", "a b c"),
        ("&#65;&#x42;&#228;&#128512;&#0;&#xD800;", "ABä😀&#0;&#xD800;"),
    ],
)
def test_plain_text(spark, markup, expected):
    assert one(spark, markup, plain_text) == expected


def test_labels(spark):
    df = spark.createDataFrame(
        [
            (1, ["mw-reverted"]),
            (2, ["Reverted", "mw-undo"]),
            (3, ["mw-manual-revert"]),
            (4, []),
            (5, None),
            (6, ["mw-undo", "mw-reverted", "Reverted", "mw-manual-revert"]),
        ],
        "id int, tags array<string>",
    )
    tags = F.col("tags")
    rows = df.orderBy("id").select(
        *[labels.label(tags, p) for p in ("strict", "medium", "wide")], labels.revert_marks(tags)
    )
    assert [tuple(r) for r in rows.collect()] == [
        (1, 1, 1, 1),
        (0, 1, 1, 2),
        (0, 0, 1, 1),
        (0, 0, 0, 0),
        (0, 0, 0, 0),
        (1, 1, 1, 4),
    ]


def matched_slowly(text, opening="{{", closing="}}"):
    stack = [""]
    for piece in re.split(f"({re.escape(opening)}|{re.escape(closing)})", text):
        if piece == opening:
            stack.append("")
        elif piece == closing and len(stack) > 1:
            stack.pop()
        else:
            stack[-1] += piece
    return opening.join(stack)


def test_brackets_like_a_stack(spark):
    rng = random.Random(7)
    parts = ["{{", "}}", "{", "}", "a", " b"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, got in df.select("t", without_nested(F.col("t"), "{{", "}}")).collect():
        assert got == matched_slowly(t)


LONG = {
    "matched": "{{a}} some words here ",
    "unmatched": "{{ ",
    "deep": "{{a",
    "closed only": "b}} ",
    "comments without end": "<!-- ",
    "references without end": "<ref> ",
    "tags without end": "<a ",
    "scripts without end": "<script>",
}


@pytest.mark.parametrize("name", LONG)
def test_time_in_proportion_to_the_markup(spark, name):
    """Sixteen times the text takes at most some forty times as long, not 256."""
    part = LONG[name]

    def seconds(size):
        df = spark.createDataFrame([(part * (size // len(part)),)], "t string")
        start = time.perf_counter()
        df.select(F.length(plain_text(F.col("t")))).collect()
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(800_000) < 5 + 40 * max(0.1, seconds(50_000))


@pytest.mark.parametrize(
    "markup, expected",
    [
        ("a<!-- x --> b <!-- c", "a b <!-- c"),
        ("<ref>x</ref>a<ref name=y/>b<REF>c", "abc"),
        ("a<script>b", "ab"),
        ("<style>x</style>a<style>b <ref c", "ab <ref c"),
        ("= a =\n==  b b ==  \n=  =\n= c\n=== d = ===", "a\nb b\n \n= c\n=== d = ==="),
    ],
)
def test_openings_that_lead_nowhere(spark, markup, expected):
    assert one(spark, markup, plain_text) == expected
