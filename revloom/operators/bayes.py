"""Multinomial naive Bayes over long term counts.

The state of a fit is two tables of plain counts, so shards can be counted apart
and added up. Smoothing is additive with ``alpha``; the class prior is not
smoothed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.operators.features import look_up
from revloom.session import written


@dataclass(frozen=True)
class Counts:
    """terms: (term, n_<class>...), one row per term. docs: (label, docs)."""

    terms: DataFrame
    docs: DataFrame
    classes: tuple[int, ...] = (0, 1)


def _n(c: int) -> str:
    return f"n_{c}"


def count(
    tf: DataFrame, docs: DataFrame, label: str, classes: tuple[int, ...] = (0, 1)
) -> Counts:
    """Count one set of training rows: ``tf`` has (term, tf, label), ``docs`` the
    label of every document. Negative values are refused."""
    value = F.when(F.col("tf") < 0, F.raise_error(F.lit("negative feature value"))).otherwise(
        F.col("tf")
    )
    terms = tf.groupBy("term").agg(
        *[F.sum(F.when(F.col(label) == c, value).otherwise(0)).alias(_n(c)) for c in classes]
    )
    per_class = docs.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("docs"))
    return Counts(terms, per_class, classes)


def add(parts: list[Counts]) -> Counts:
    """The counts of all shards together: the same as counting them at once."""
    classes = parts[0].classes
    terms = reduce(DataFrame.unionByName, [p.terms for p in parts])
    docs = reduce(DataFrame.unionByName, [p.docs for p in parts])
    return Counts(
        terms.groupBy("term").agg(*[F.sum(_n(c)).alias(_n(c)) for c in classes]),
        docs.groupBy("label").agg(F.sum("docs").alias("docs")),
        classes,
    )


def over_vocabulary(counts: Counts, vocab: DataFrame) -> Counts:
    """Fix the columns: terms outside ``vocab`` go, unseen ones count as zero."""
    terms = vocab.select("term").join(counts.terms, "term", "left")
    return Counts(terms.fillna(0), counts.docs, counts.classes)


def fitted(counts: Counts) -> Counts:
    """The counts as written tables, to predict with them repeatedly."""
    return Counts(
        written(counts.terms, "bayes-terms"), written(counts.docs, "bayes-docs"), counts.classes
    )


def class_table(counts: Counts, alpha: float = 1.0) -> DataFrame:
    """(label, log_prior, log_total): a row per class."""
    total = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("label"), F.col(_n(c)).alias("tokens"))
                for c in counts.classes
            ]
        )
    )
    sums = counts.terms.agg(
        F.count(F.lit(1)).alias("size"), *[F.sum(_n(c)).alias(_n(c)) for c in counts.classes]
    )
    tokens = sums.select("size", total.alias("_t")).select("size", "_t.*")
    all_docs = counts.docs.agg(F.sum("docs")).scalar()
    priors = counts.docs.select("label", F.log(F.col("docs") / all_docs).alias("log_prior"))
    return tokens.join(priors, "label").select(
        "label", "log_prior", F.log(F.col("tokens") + alpha * F.col("size")).alias("log_total")
    )


def model(counts: Counts, alpha: float = 1.0) -> DataFrame:
    """(label, term, log_prob, log_prior), a row per class and term."""
    weights = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("label"), F.log(F.col(_n(c)) + alpha).alias("_w"))
                for c in counts.classes
            ]
        )
    )
    rows = counts.terms.select("term", weights.alias("_c")).select("term", "_c.*")
    # a row per class: its size is the number of classes
    return rows.join(F.broadcast(class_table(counts, alpha)), "label").select(
        "label", "term", (F.col("_w") - F.col("log_total")).alias("log_prob"), "log_prior"
    )


def predict(
    counts: Counts, tf: DataFrame, docs: DataFrame, id_col: str, alpha: float = 1.0
) -> DataFrame:
    """Add ``prediction`` and ``margin`` (best minus second score) to ``docs``.
    ``counts`` should be ``fitted``.

    Only observed (document, term) pairs meet the model. Each document first gets
    one sum per class, to which class totals and prior are added afterwards, so
    documents without a known term still get the prior. Ties go to the lower class.
    """
    names = [_n(c) for c in counts.classes]
    weighted = counts.terms.withColumn("_weight", sum((F.col(n) for n in names), F.lit(0)))
    known = look_up(tf, weighted, ["term"], "_weight", names, id_col)
    sums = known.where("_found").groupBy(id_col).agg(
        F.sum("tf").alias("_t"),
        *[
            F.sum(F.col("tf") * F.log(F.col(_n(c)) + alpha)).alias(f"_w_{c}")
            for c in counts.classes
        ],
    )
    # one small map, label -> (log_prior, log_total), next to every document
    parameters = class_table(counts, alpha).agg(
        F.map_from_entries(
            F.collect_list(F.struct("label", F.struct("log_prior", "log_total")))
        )
    )

    def score(c):
        of_class = F.element_at("_parameters", F.lit(c))
        words = F.coalesce(f"_w_{c}", F.lit(0.0))
        value = of_class["log_prior"] + words - F.coalesce("_t", F.lit(0)) * of_class["log_total"]
        return F.struct(
            F.coalesce(value, F.lit(float("-inf"))).alias("score"), F.lit(-c).alias("negative")
        )

    ranked = F.sort_array(F.array(*[score(c) for c in counts.classes]), asc=False)
    return (
        docs.join(sums, id_col, "left")
        .withColumn("_parameters", parameters.scalar())
        .withColumn("_ranked", ranked)
        .select(
            *docs.columns,
            (-F.col("_ranked")[0]["negative"]).alias("prediction"),
            (F.col("_ranked")[0]["score"] - F.col("_ranked")[1]["score"]).alias("margin"),
        )
    )
