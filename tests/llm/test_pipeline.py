"""The pipeline against the same stages done in one place, one after another."""

import json

import corpus_pipeline as pipeline
from revloom.llm import bpe, langid
from tests.conftest import SF
from tests.llm.test_decontamination import plain
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_linededup import brute as without_lines


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judge = langid.Judge(langid.fitted(docs))
    for name, stage in pipeline.STAGES:
        before = sorted(docs.collect(), key=lambda r: r.doc_id)
        docs = pipeline.written(stage(spark, docs, SF), f"test-{name}")
        after = {r.doc_id: r for r in docs.collect()}
        if name != "tokens":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "language":
            want = {r.doc_id: r.text for r in before if judge(r.text)[2] >= langid.MIN_MARGIN}
        elif name == "lines":
            cut = without_lines([(r.doc_id, r.source, r.text) for r in before], 5)
            want = {d: t for d, n, gone, t in cut if not gone or gone < n}
        elif name == "near_duplicates":
            linked = groups([(r.doc_id, r.text) for r in before], 80, 5)
            want = {r.doc_id: r.text for r in before if (r.doc_id,) in {(c,) for _, _, c in linked}}
        elif name == "contamination":
            hits = {r.doc_id: plain(r.text, items, 10) for r in before}
            kept = {d for d, (n, hit, _) in hits.items() if len(hit) <= n * 0.5}
            assert after.keys() == kept
            assert all(after[r.doc_id].text == r.text for r in before if r.doc_id in kept and not hits[r.doc_id][1])
            assert not any(plain(r.text, items, 10)[1] for r in after.values())
            continue
        else:
            with open(bpe.vocabulary_path(), encoding="utf-8") as file:
                codec = bpe.Codec(json.load(file))
            assert {d: list(r.ids) for d, r in after.items()} == {r.doc_id: codec.encode(r.text).tolist() for r in before}
            assert all(r.intact for r in after.values())
            continue
        assert {d: r.text for d, r in after.items()} == want
    assert 0 < len(after) <= 200


def test_run_and_odd_rows(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(900, None, "en", "s", 0), (901, "", None, None, 0), (None, rows.head().text, "en", "s", 1)], rows.schema)
    rows.union(odd).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "intact"]
    assert {900, 901}.isdisjoint(r.doc_id for r in out.collect())
    rows.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert pipeline.run(spark, f"{tmp_path}/none").count() == 0
