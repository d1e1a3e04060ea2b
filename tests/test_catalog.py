"""Every registered query against its SQL, and the shape of its plan."""

import pytest
from pyspark.sql import functions as F

from revloom.functions.text import segments
from revloom.plans import catalog, views
from tests import oracle
from tests.conftest import SF

SQL = catalog.oracle_sql()
LEARNED = {"linear_by_shards", "linear_predict", "embedding_features", "nb_ml", "linear_svm", "doc_embedding", "mlp_classifier", "model_report"}
# Queries that run jobs or train while they are built are not explained again.
EAGER = LEARNED | {
    "incremental_stream",
    "page_scan",
    "revision_scan",
    "features_labels_join",
    "ledger_first_wins",
    "intake_counts",
    "file_guard",
    "nb_scaled",
    "titles_stored",
    "revisions_by_shard",
    "prev_with_null_keys",
}
# The longest chain of matched positions is found in Python; no text goes there.
POSITIONS_IN_PYTHON = {"ordered_diff"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


# What solvers give; the rows of these queries are tested by skill below.
SOLVED = {"linear_svm_scores", "mlp_scores", "model_metrics", "validation_curve", "document_vectors"}


def test_every_other_query_has_sql():
    assert set(catalog.queries()) - set(SQL) == SOLVED


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert oracle.compare(catalog.queries()[name](spark, SF), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(SQL) - EAGER))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().toString()
    python = () if name in POSITIONS_IN_PYTHON else ("PythonUDF", "ArrowEval")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", *python):
        assert bad not in plan


def test_time_filter_and_columns_reach_the_scan(spark):
    plan = catalog.queries()["time_range"](spark, SF)._jdf.queryExecution().toString()
    scan = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(ts" in scan and "LessThanOrEqual(ts" in scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in scan


def test_joined_segments_are_the_text_without_line_breaks(spark):
    docs = views.table(spark, SF, "documents").select("text")
    joined = F.concat_ws("", segments(F.col("text")))
    assert docs.where(joined != F.replace("text", F.lit("\n"), F.lit(""))).count() == 0


def test_label_policies_widen(spark):
    rows = catalog.queries()["label_policies"](spark, SF)
    assert rows.where("strict > medium or medium > wide").count() == 0


def test_confusion_adds_up(spark):
    rows = catalog.queries()["confusion"](spark, SF).collect()
    sums = {r["model"]: r["tp"] + r["fp"] + r["tn"] + r["fn"] for r in rows}
    assert sums["length rule"] == views.table(spark, SF, "labels").count()
