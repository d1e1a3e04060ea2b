"""Archives: roles, exact records, digests."""

import hashlib

import pytest

from revloom.llm import warc
from tests import oracle
from tests.conftest import SF

BIG = "é" * 600


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "u1", BIG), (2, "u\r\n2", BIG), (9, None, BIG), (3, "u3", "small"), (4, "u4", "small"), (5, "u5", None), (6, "u6", ""), (None, "u7", BIG), (9, None, BIG)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url as payload")


def test_query_matches_sql(spark):
    con = oracle.connect(SF)
    assert oracle.compare(warc.op1_warc(spark, SF), con, warc.OP1_SQL) is None


def test_records_come_back(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/archive"
    warc.write_archive(warc.describe(pages), folder)
    rows = warc.read_archive(spark, folder).select("*", warc.field("WARC-Type").alias("kind"), warc.field("WARC-Refers-To").alias("to")).collect()
    assert len(rows) == 9
    assert spark.read.parquet(f"{folder}/payloads").count() == 3
    for row in rows:
        record, header = bytes(row.record), bytes(row.header)
        assert record.startswith(header) and header.endswith(b"\r\n\r\n") and record.endswith(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in header.decode().split("\r\n\r\n")[0].split("\r\n")[1:])
        assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(bytes(row.payload)).hexdigest()
        block = record[record.index(b"\r\n\r\n") + 4 : -4]
        assert len(block) == int(fields["Content-Length"])
        assert block.endswith(bytes(row.payload)) == (row.kind == "response" or not row.payload)
    big = sorted((str(r.to), r.kind) for r in rows if len(r.payload) == 1200)
    assert big == [("<urn:page:9>", "revisit")] * 3 + [("None", "response")] * 2
    assert {r.kind for r in rows if len(r.payload) < 1200} == {"response"}


def test_a_wrong_payload_is_an_error(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/archive"
    warc.write_archive(warc.describe(pages), folder)
    stored = spark.read.parquet(f"{folder}/payloads")
    swapped = stored.selectExpr("address", "(select max(packed) from parquet.`%s/payloads`) as packed" % folder)
    swapped.write.parquet(f"{folder}2/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{folder}2/records")
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, folder + "2").collect()


def test_empty_table(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/archive"
    warc.write_archive(warc.describe(pages.limit(0)), folder)
    assert warc.read_archive(spark, folder).count() == 0
