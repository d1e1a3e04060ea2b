import json
import os
import random

import pytest
from pyspark.sql import functions as F

from revloom import session
from revloom.schemas import LEDGER
from revloom.sources import ledger, links, pages, responses, store
from revloom.plans import corpus
from revloom.streaming.intake import merge_batch, read_prepared, run_intake


def page(title, texts, **extra):
    """A stored page: revisions newest first."""
    return {
        "title": title,
        "revisions": [
            {"timestamp": f"2021-01-0{9 - i}T00:00:00Z", "tags": [], **revision(t), **extra}
            for i, t in enumerate(texts)
        ],
    }


def revision(text):
    return {} if text is None else {"slots": {"main": {"content": text}}}


@pytest.fixture
def folder(tmp_path):
    stored = {
        "0.json": page("A", ["b. a. ", "a. "]),
        "1.json": page("B", ["x" * 5000]),
        "2.json": {"title": "no revisions"},
        "3.json": page("C", [None, "c"]),
    }
    for name, content in stored.items():
        (tmp_path / name).write_text(json.dumps(content, indent=1))
    return str(tmp_path)


def test_pages_and_revisions(spark, folder):
    stored = pages.read_pages(spark, folder)
    assert {r["title"] for r in stored.collect()} == {"A", "B", "C"}
    rows = {(r["title"], r["pos"]): r for r in pages.read_revisions(stored).collect()}
    assert len(rows) == 5
    assert rows["A", 0]["slots"]["main"]["content"] == "b. a. "
    assert rows["C", 0]["slots"] is None


def test_size_guard_prunes_files(spark, folder):
    small = pages.read_pages(spark, folder, max_bytes=2000)
    assert {r["title"] for r in small.collect()} == {"A", "C"}


def test_doc_index_is_in_name_order_and_first_files(spark, folder):
    indexed = pages.with_doc_index(pages.read_pages(spark, folder))
    assert {r["file_name"]: r["doc_index"] for r in indexed.collect()} == {
        "0.json": 0,
        "1.json": 1,
        "3.json": 2,
    }
    first = pages.first_files(pages.read_pages(spark, folder), 2)
    assert {r["title"] for r in first.collect()} == {"A", "B"}


def test_nested_pages_split_long_histories(spark, tmp_path):
    rows = spark.range(25).select(
        F.lit("t").alias("title"),
        (-F.col("id")).alias("newest"),
        F.col("id").alias("userid"),
    )
    nested = pages.nest_pages(rows, ["newest"], per_row=10)
    assert sorted((r["offset"], len(r["revisions"])) for r in nested.collect()) == [
        (0, 10),
        (10, 10),
        (20, 5),
    ]
    path = str(tmp_path / "out")
    store.write_pages(nested, path)
    back = pages.read_revisions(pages.read_pages(spark, path, one_page_per_file=False))
    assert {r["pos"]: r["userid"] for r in back.collect()} == {i: 24 - i for i in range(25)}


def test_within_size(spark):
    df = spark.createDataFrame([("a", "éé"), ("a", "xx"), ("b", "yy")], "k string, t string")
    kept = pages.within_size(df, "k", "t", 5)
    assert [(r["k"], r["page_bytes"]) for r in kept.collect()] == [("b", 2)]


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    titles = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "position long, title string")
    nothing = spark.createDataFrame([], LEDGER)
    ledger.append_ledger(ledger.new_entries(titles, nothing), path)
    done = ledger.read_ledger(spark, path)
    assert {tuple(r) for r in done.collect()} == {("x", "1.json"), ("y", "2.json")}
    assert ledger.new_entries(titles, done).count() == 0
    assert ledger.unseen(titles, done, "title").count() == 0
    assert ledger.unseen(titles, done, "title", rewrite=True).count() == 3


def body(revisions=None, more=False, **extra):
    found = {} if revisions is None else {"revisions": [revision(t) for t in revisions]}
    out = {"query": {"pages": [found]}, **extra}
    if more:
        out["continue"] = {"rvcontinue": "n"}
    return json.dumps(out)


def test_response_status(spark):
    bodies = [
        (body(["a"], error={"code": "x"}), "error"),
        (body(None), "malformed"),
        (json.dumps({"query": {}}), "malformed"),
        ("not json", "malformed"),
        (body(["a"], warning="w"), "warning"),
        (body(["a"]), "ok"),
        (body([]), "ok"),
        (body(None, warning="w"), "malformed"),
    ]
    df = spark.createDataFrame([("t", i, b) for i, (b, _) in enumerate(bodies)],
                               "title string, batch_no int, body string")
    got = {r["batch_no"]: r["status"] for r in responses.classify(df).collect()}
    assert [got[i] for i in range(len(bodies))] == [status for _, status in bodies]


def test_assemble(spark):
    batches = [
        ("good", 0, body(["a", "b"], more=True)),
        ("good", 1, body(["c"], warning="w")),
        ("good", 2, body(None)),  # after the last one: not looked at
        ("broken", 0, body(["a"], more=True)),
        ("broken", 1, body(["a"], error={})),
        ("unfinished", 0, body(["a"], more=True)),
    ]
    df = spark.createDataFrame(batches, "title string, batch_no int, body string")
    rows = responses.assemble(df).collect()
    assert {(r["title"], r["pos"], r["revision"]["slots"]["main"]["content"]) for r in rows} == {
        ("good", 0, "a"),
        ("good", 1, "b"),
        ("good", 2, "c"),
    }


def test_time_range_includes_both_ends(spark):
    stamps = ["2020-07-20T21:06:20Z", responses.OLDEST, responses.NEWEST, "2021-12-11T00:00:00Z"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        F.to_timestamp("s").alias("ts")
    )
    assert responses.in_time_range(df, "ts").count() == 2


def test_titles(spark):
    link = '<a href="/wiki/{0}" title="{0} &amp; co">{0}</a>'
    listed = links.START + link.format("A") + "\n" + link.format("B") + link.format("A")
    html = [
        (1, link.format("Z") + listed + links.END + link.format("Y")),
        (2, listed),
        (3, links.END + listed),
    ]
    df = spark.createDataFrame(html, "id int, html string")
    rows = links.extract_titles(df, "html", ["id"]).orderBy("pos").collect()
    assert [(r["id"], r["title"]) for r in rows] == [
        (1, "A &amp; co"),
        (1, "B &amp; co"),
        (1, "A &amp; co"),
    ]
    assert links.pages_without_list(df, "html").first()[0] == 1


def test_written_shards_are_left_alone(spark, tmp_path):
    path = str(tmp_path / "features")
    first = spark.createDataFrame([(1, 0, "a", 1)], "doc_id long, shard int, term string, tf long")
    second = spark.createDataFrame(
        [(9, 0, "z", 1), (2, 1, "b", 1)], "doc_id long, shard int, term string, tf long"
    )
    store.write_features(first, path)
    store.write_features(second, path)
    rows = store.read_features(spark, path).collect()
    assert {(r["doc_id"], r["shard"]) for r in rows} == {(1, 0), (2, 1)}
    labels = spark.createDataFrame([(2, 1)], "doc_id long, label int")
    assert store.align(store.read_features(spark, path), labels).count() == 1


def test_intake_takes_each_file_once(spark, folder, tmp_path):
    target, checkpoint = str(tmp_path / "out/ready"), str(tmp_path / "out/offsets")
    run_intake(spark, folder + "/*.json", target, checkpoint)
    once = spark.read.parquet(target)
    assert once.count() == 5
    run_intake(spark, folder + "/*.json", target, checkpoint)
    assert spark.read.parquet(target).count() == 5
    with open(f"{folder}/4.json", "w") as f:
        json.dump(page("D", ["new"]), f)
    run_intake(spark, folder + "/*.json", target, checkpoint)
    rows = spark.read.parquet(target)
    assert rows.count() == 6
    diffs = {(r["title"], r["pos"]): r["content_diff"] for r in rows.collect()}
    assert diffs["A", 0] == "+b. \n" and diffs["A", 1] == ""


def test_left_out_pages_are_counted(spark, folder):
    from pathlib import Path

    Path(folder, "9.json").write_text('{"title": "broken", "revisions": [{"us')
    row = pages.intake_counts(spark, folder, max_bytes=2000).head()
    assert row.asDict() == {"stored": 5, "kept": 2, "too_large": 1, "corrupt": 1, "without_revisions": 1}


def batch(title, number, texts, more):
    body = {"query": {"pages": [{"revisions": [revision(t) for t in texts]}]}}
    return (title, number, json.dumps(body | ({"continue": {"rvcontinue": "x"}} if more else {})))


def test_gaps_and_repeated_batches(spark):
    rows = [batch("gap", 0, "a", True), batch("gap", 2, "b", False)]
    rows += [batch("twice", 0, "cd", True)] * 2 + [batch("twice", 1, "e", False)] * 3
    df = spark.createDataFrame(rows, "title string, batch_no long, body string")
    got = sorted((r["title"], r["pos"], r["revision"]["slots"]["main"]["content"]) for r in responses.assemble(df).collect())
    assert got == [("twice", 0, "c"), ("twice", 1, "d"), ("twice", 2, "e")]


def piece(title, offset, texts):
    return json.dumps(page(title, texts, comment=f"{title}{offset}") | {"offset": offset})


def whole(rows):
    fields = ("title", "pos", "content", "comment_plaintext", "content_diff", "content_plaintext_diff")
    return sorted(tuple(r[f] for f in fields) for r in rows.collect())


def test_a_page_in_three_files_over_two_runs(spark, tmp_path):
    """The middle piece comes last: its newer neighbour is prepared again."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out/ready", "out/offsets"))
    texts = [f"s{n}. same. t{n % 3}. " for n in range(9)]
    pieces = [piece("P", 0, texts[:3]), piece("P", 3, texts[3:6]), piece("P", 6, texts[6:])]
    (tmp_path / "in").mkdir()
    for name, lines in (("a", [pieces[2]]), ("b", [pieces[0], piece("Q", 0, ["x. "])])):
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(lines))
    run_intake(spark, source, target, checkpoint, one_page_per_file=False, max_files_per_batch=1)
    halfway = {r["pos"]: r["content_diff"] for r in read_prepared(spark, target).where("title = 'P'").collect()}
    assert len(halfway) == 6 and "-s6. " in halfway[2]
    (tmp_path / "in" / "c.json").write_text(pieces[1])
    run_intake(spark, source, target, checkpoint, one_page_per_file=False)
    result = read_prepared(spark, target)
    assert result.count() == 10 and spark.read.parquet(target).where("pos = 2").count() == 2
    (tmp_path / "all").mkdir()
    (tmp_path / "all" / "d.json").write_text("\n".join([*pieces, piece("Q", 0, ["x. "])]))
    stored = pages.read_pages(spark, str(tmp_path / "all"), one_page_per_file=False)
    assert whole(result) == whole(corpus.prepare(pages.read_revisions(stored)))


def test_any_order_of_pieces_gives_what_one_batch_gives(spark, tmp_path):
    """Pieces in random order and repeated; a batch that is tried again changes nothing."""
    rng = random.Random(4)
    texts = {t: [f"{t}{n}. common. v{rng.randrange(3)}. " for n in range(rng.randrange(1, 12))] for t in "ABC"}
    pieces = [(t, at, own[at : at + 2]) for t, own in texts.items() for at in range(0, len(own), 2)]
    target, state = (str(tmp_path / n) for n in ("ready", "state"))
    (tmp_path / "all.json").write_text("\n".join(piece(*p) for p in pieces))
    rng.shuffle(pieces)
    for batch, at in enumerate(range(0, len(pieces), 4)):
        path = tmp_path / f"in{batch}.json"
        path.write_text("\n".join(piece(*p) for p in [*pieces[at : at + 4], pieces[0], pieces[at]]))
        stored = pages.read_pages(spark, str(path), one_page_per_file=False)
        for _ in range(2 if batch == 1 else 1):
            merge_batch(corpus.flattened(pages.read_revisions(stored)), batch, target, state)
    stored = pages.read_pages(spark, str(tmp_path / "all.json"), one_page_per_file=False)
    assert whole(read_prepared(spark, target)) == whole(corpus.prepare(pages.read_revisions(stored)))
    # Whole pages need nothing kept but their oldest revision.
    last = spark.read.parquet(state).groupBy("title").agg(F.max_by(F.struct("batch", "pos"), "batch").alias("x"))
    assert last.count() == 3


def test_large_files_are_pruned_before_the_scan(spark, folder):
    """The scan opens only files below the limit: it reads fewer rows and files."""

    def scanned(limit):
        stored = pages.read_pages(spark, folder, max_bytes=limit)
        plan = stored._jdf.queryExecution().executedPlan()
        stored._jdf.queryExecution().toRdd().count()
        while plan.children().size():
            plan = plan.children().head()
        return plan.metrics().apply("numFiles").value()

    assert (scanned(None), scanned(2000)) == (4, 3)


def test_a_shard_has_a_bounded_number_of_files(spark, tmp_path):
    """Also where all rows are in one shard and come from many tasks."""
    path = tmp_path / "features"
    rows = spark.range(20_000).select("id", (F.col("id") % 50 == 0).cast("int").alias("shard"), F.lit("t").alias("term"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.write_features(rows.repartition(40), str(path), files=3)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for shard in (0, 1):
        assert 1 <= len(list((path / f"shard={shard}").glob("part-*"))) <= 3
    assert store.read_features(spark, str(path)).count() == 20_000
    more = spark.createDataFrame([(7, 2, "u"), (8, 0, "v")], "id long, shard int, term string")
    store.write_features(more, str(path), files=3)
    assert store.read_features(spark, str(path)).count() == 20_001


def test_an_intake_leaves_no_intermediate_tables(spark, tmp_path, monkeypatch):
    """What a batch writes for itself is gone when it ends; results and state stay."""
    paths, make = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: paths.append(make(spark, name)) or paths[-1])
    kept = session.written(spark.range(3), "kept")
    with session.short_lived(spark):
        assert session.written(spark.range(3), "gone").count() == 3
    rows = corpus.as_revisions(
        spark.createDataFrame([("P", i, f"text {i}. ", ["x"]) for i in range(6)], "page string, rev long, content string, tags array<string>")
    )
    nested = pages.nest_pages(rows.withColumn("_n", -F.col("rev")).drop("rev"), ["_n"], 2).localCheckpoint()
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (0, 4, 2):
        store.write_pages(nested.where(F.col("offset") == part), source)
        run_intake(spark, source, target, str(tmp_path / "offsets"), one_page_per_file=False)
    assert len(paths) > 8 and [os.path.exists(p.removeprefix("file:")) for p in paths] == [True, *[False] * (len(paths) - 1)]
    assert read_prepared(spark, target).count() == 6 and kept.count() == 3
