"""Confusion counts and quality metrics of binary predictions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def predictions(df: DataFrame, model: str, truth: str, prediction: str) -> DataFrame:
    """(model, truth, prediction), the input of ``confusion``."""
    return df.select(
        F.lit(model).alias("model"),
        F.col(truth).cast("int").alias("truth"),
        F.col(prediction).cast("int").alias("prediction"),
    )


def threshold(df: DataFrame, score: str, cut: float = 0.5) -> DataFrame:
    """Binary ``prediction`` of a score: 1 above the cut."""
    return df.withColumn("prediction", (F.col(score) > cut).cast("int"))


def confusion(df: DataFrame) -> DataFrame:
    """(model, tp, fp, tn, fn, mistakes), a row per model."""
    hit, said = F.col("truth") == F.col("prediction"), F.col("prediction") == 1
    return (
        df.groupBy("model")
        .agg(
            F.count_if(hit & said).alias("tp"),
            F.count_if(~hit & said).alias("fp"),
            F.count_if(hit & ~said).alias("tn"),
            F.count_if(~hit & ~said).alias("fn"),
        )
        .withColumn("mistakes", F.col("fp") + F.col("fn"))
    )


def metrics(counts: DataFrame) -> DataFrame:
    """Percentages from ``confusion``; an undefined metric is null."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return counts.select(
        "model",
        (F.try_divide(tp + tn, tp + fp + tn + fn) * 100).alias("accuracy"),
        (precision * 100).alias("precision"),
        (recall * 100).alias("recall"),
        (F.try_divide(tn, tn + fp) * 100).alias("specificity"),
        (F.try_divide(2 * precision * recall, precision + recall) * 100).alias("f1"),
    )


def report(parts: list[DataFrame]) -> DataFrame:
    """Confusion counts and metrics of several models side by side."""
    counts = confusion(reduce(DataFrame.unionByName, parts))
    return counts.join(metrics(counts), "model")


def curve_row(df: DataFrame, number: int, truth: str, score: str, prediction: str) -> DataFrame:
    """One row for a pass of a fit: mean squared error of the score, accuracy and counts."""
    counts = confusion(predictions(df, "", truth, prediction)).drop("model")
    loss = df.agg(F.avg(F.pow(F.col(score) - F.col(truth), 2)).alias("loss"))
    rows = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return (
        counts.withColumn("pass", F.lit(number))
        .withColumn("loss", loss.scalar())
        .withColumn("accuracy", F.try_divide(F.col("tp") + F.col("tn"), rows) * 100)
        .select("pass", "loss", "accuracy", "tp", "fp", "tn", "fn")
    )
