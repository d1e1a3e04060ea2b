"""Language by compression: held-out accuracy and defined results for odd rows."""

import zlib

import pytest

from revloom.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def dictionaries(spark):
    return langid.fitted(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy_and_contract(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = langid.op6_langid(spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.98 * len(held)
    # What is rejected is rare and short.
    rejected = [r for r in rows if not r.accepted]
    assert len(rejected) <= 0.02 * len(rows)
    assert all(len(docs[r.doc_id].text) < 100 for r in rejected)


def test_the_whole_text_counts(spark, dictionaries):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text) > 2000]
    one = next(r.text for r in docs if r.lang == "en")
    other = " ".join(r.text for r in docs if r.lang == "fr")
    judge = langid.Judge(dictionaries)
    assert judge(one)[0] == "en" and judge(one + "\n" + other)[0] == "fr"


def test_odd_rows(spark, dictionaries):
    rows = [(1, None, "a"), (2, "", "b"), (3, "123 !?", "c"), (None, "the of and thing", "d"), (4, "x" * 300_000, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = langid.predict(df, dictionaries)
    assert out.columns == ["doc_id", "text", "score", "lang_pred", "score_", "accepted"]
    got = {r.score: r for r in out.collect()}
    assert [got[k].lang_pred for k in "abc"] == ["und"] * 3
    assert not any(got[k].accepted for k in "abc") and got["d"].lang_pred in dictionaries
    assert langid.predict(df.limit(0), dictionaries).count() == 0
    assert {r.lang_pred for r in langid.predict(df, {}).collect()} == {"und"}


def test_learning_from_nothing_and_from_null_labels(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, "en"), (3, " ", "en")], "doc_id long, text string, lang string")
    assert langid.learn(df) == {}


def test_copies_leave_room_for_other_texts(spark):
    rows = [("the same text", "en")] * 1000 + [(f"other text number {i}", "en") for i in range(150)]
    raw = langid.learn(spark.createDataFrame(rows, "text string, lang string"))["en"].decode().split("\n")
    assert len(raw) == 151 and len(set(raw)) == 151


def test_pieces_are_not_all_from_the_beginning(spark):
    rows = [("a" * 2000 + str(i) + "b" * 2000, "en") for i in range(20)]
    raw = langid.learn(spark.createDataFrame(rows, "text string, lang string"))["en"].decode().split("\n")
    assert all(len(t) == langid.SAMPLE_CHARS for t in raw) and "b" in "".join(raw)
