"""A linear classifier trained shard by shard, its weights a table of terms.

The loss is the hinge loss with an L2 penalty. A step takes the rows of one batch: rows
whose margin is below one pull the weights towards their class. Margins and pulls are
sums per document and per term, so a step is two joins and two aggregations, however
many terms there are; nothing but a bias and a few numbers is on the driver. Batches
follow one another by shard, then by batch number, so the result is defined.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.operators import features
from revloom.operators.split import hash_number
from revloom.session import written

# Fixed value: weight of the penalty.
L2 = 1e-4
BATCHES = 4
# Size of the first step, in units of one over the mean squared length of a row.
RATE = 10.0


@dataclass(frozen=True)
class Linear:
    """(term, weight, df) per term, the bias, and how far training has come.

    ``df`` counts the rows that pulled at a term. ``norm`` is the mean squared length
    of the rows of the first batch; the k-th step has the size RATE / (norm * sqrt(k)).
    """

    weights: DataFrame
    bias: float = 0.0
    steps: int = 0
    norm: float | None = None


def untrained(spark: SparkSession) -> Linear:
    return Linear(spark.createDataFrame([], "term string, weight double, df long"))


def batch_number(id_col: str, batches: int) -> Column:
    """The batch of a row within its shard, by a hash of its id."""
    return (hash_number(F.col(id_col).cast("string")) % batches).cast("int")


def scores(model: Linear, tf: DataFrame, docs: DataFrame, id_col: str, value: str = "tf") -> DataFrame:
    """``docs`` with ``score``, positive for class 1; a document without known terms
    has the bias. Frequent terms are answered from a broadcast of bounded size."""
    known = features.look_up(tf.select(id_col, "term", value), model.weights, ["term"], "df", ["weight"], id_col)
    sums = known.groupBy(id_col).agg(F.sum(F.col(value) * F.coalesce("weight", F.lit(0.0))).alias("_sum"))
    return docs.join(sums, id_col, "left").withColumn("score", F.lit(model.bias) + F.coalesce("_sum", F.lit(0.0))).drop("_sum")


def predict(model: Linear, tf: DataFrame, docs: DataFrame, id_col: str, value: str = "tf") -> DataFrame:
    """``docs`` with ``score`` and ``prediction``: 1 above zero."""
    return scores(model, tf, docs, id_col, value).withColumn("prediction", (F.col("score") > 0).cast("int"))


def step(model: Linear, tf: DataFrame, docs: DataFrame, id_col: str, label: str = "label", value: str = "tf", penalty: float = L2) -> Linear:
    """The model after one batch: ``docs`` (id, label 0 or 1) and their term values.

    A batch without rows changes nothing. The new weights are a written table, so the
    lineage does not grow with the steps and a lost executor costs one step at most.
    """
    sign = 2 * F.col(label) - 1
    judged = scores(model, tf, docs.select(id_col, label), id_col, value)
    judged = judged.select(id_col, sign.alias("_sign"), (sign * F.col("score") < 1).alias("_short"))
    judged = written(judged, "judged")
    wrong = judged.where("_short").select(id_col, "_sign")
    total, pull = judged.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("_short"), F.col("_sign"))), F.lit(0))).first()
    if not total:
        return model
    norm = model.norm
    if norm is None:
        squares = tf.agg(F.coalesce(F.sum(F.col(value).cast("double") * F.col(value)), F.lit(0.0))).first()[0]
        norm = 1.0 + squares / total
    rate = RATE / (norm * sqrt(model.steps + 1))
    pulls = tf.join(wrong, id_col).groupBy("term").agg(F.sum(F.col("_sign") * F.col(value)).alias("_pull"), F.count(F.lit(1)).alias("_n"))
    moved = model.weights.join(pulls, "term", "full").select(
        "term",
        (
            F.coalesce("weight", F.lit(0.0)) * (1.0 - rate * penalty) + F.coalesce(F.col("_pull") / total, F.lit(0.0)) * rate
        ).alias("weight"),
        (F.coalesce("df", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("df"),
    )
    return Linear(written(moved, "weights"), model.bias + rate * pull / total, model.steps + 1, norm)


def fit_shards(
    tf: DataFrame,
    docs: DataFrame,
    id_col: str,
    label: str = "label",
    shard: str = "shard",
    value: str = "tf",
    batches: int = BATCHES,
    passes: int = 1,
    start: Linear | None = None,
    penalty: float = L2,
) -> Linear:
    """Train over the shards in ascending order, each in ``batches`` batches.

    ``tf`` has (id, term, value), ``docs`` (id, label, shard). ``start`` is a model to go
    on with: fitting one shard and then the next from its result is the same as fitting
    both. Rows are stored by shard and batch once, so a step reads its batch only.
    """
    spark = docs.sparkSession
    model = start or untrained(spark)
    placed = docs.select(id_col, label, F.col(shard).alias("_shard"), batch_number(id_col, batches).alias("_batch"))
    placed = written(placed, "rows", ["_shard", "_batch"])
    terms = tf.select(id_col, "term", value).join(placed.select(id_col, "_shard", "_batch"), id_col)
    terms = written(terms, "values", ["_shard", "_batch"])
    shards = [r[0] for r in placed.select("_shard").distinct().orderBy("_shard").collect()]
    for _ in range(passes):
        for one in shards:
            for number in range(batches):
                mine = F.col("_shard").eqNullSafe(F.lit(one)) & (F.col("_batch") == number)
                model = step(model, terms.where(mine).drop("_shard", "_batch"), placed.where(mine), id_col, label, value, penalty)
    return model


def save(model: Linear, path: str) -> None:
    """Weights and numbers as two Parquet tables under ``path``."""
    spark = model.weights.sparkSession
    model.weights.write.mode("overwrite").parquet(f"{path}/weights")
    numbers = spark.createDataFrame([(model.bias, model.steps, model.norm)], "bias double, steps long, norm double")
    numbers.write.mode("overwrite").parquet(f"{path}/numbers")


def load(spark: SparkSession, path: str) -> Linear:
    numbers = spark.read.parquet(f"{path}/numbers").first()
    return replace(Linear(spark.read.parquet(f"{path}/weights")), **numbers.asDict())
