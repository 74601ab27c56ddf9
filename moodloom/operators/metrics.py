"""Classifier metrics (inventory ML-9 to ML-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per pair of true and predicted class, in one pass."""
    pairs = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
    return pairs.agg(F.count(F.lit(1)).alias("rows"))


def classification_metrics(confused: DataFrame) -> DataFrame:
    """One row with the four metrics; classes weigh by their share of the true labels."""
    rows, none = F.col("rows"), F.lit(0).cast("long")
    hits = F.when(F.col("label") == F.col("prediction"), rows).otherwise(none)
    sides = F.array(
        F.struct(F.col("label").alias("class"), rows.alias("actual"), none.alias("claimed"), hits.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("actual"), rows.alias("claimed"), none.alias("hits")),
    )
    by_class = (
        confused.select(F.explode(sides).alias("side"))
        .select("side.*")
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "claimed", "hits")])
    )

    def or_zero(ratio: Column) -> Column:
        return F.coalesce(ratio, F.lit(0.0))

    def weighted(metric: Column) -> Column:
        return F.try_divide(F.sum(F.col("actual") * metric), F.sum("actual"))

    precision = or_zero(F.try_divide("hits", "claimed"))
    recall = or_zero(F.try_divide("hits", "actual"))
    # 2PR / (P + R) in counts.
    f1 = or_zero(F.try_divide(2.0 * F.col("hits"), F.col("claimed") + F.col("actual")))
    return by_class.agg(
        F.try_divide(F.sum("hits"), F.sum("actual")).alias("accuracy"),
        weighted(precision).alias("weightedPrecision"),
        weighted(recall).alias("weightedRecall"),
        weighted(f1).alias("f1"),
    )


def agreement(confused: DataFrame) -> DataFrame:
    """EXT-8: one row with ``rows``, the share that agrees, and Cohen's kappa of two labelings from their pairs.

    Pairs that lack a label are left out; kappa is null where chance alone agrees always, or without rows.
    """
    pairs = confused.where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    rows, none = F.col("rows"), F.lit(0).cast("long")
    same = F.when(F.col("label") == F.col("prediction"), rows).otherwise(none)
    sides = F.array(
        F.struct(F.col("label").alias("class"), rows.alias("first"), none.alias("second"), same.alias("same")),
        F.struct(F.col("prediction").alias("class"), none.alias("first"), rows.alias("second"), none.alias("same")),
    )
    by_class = pairs.select(F.explode(sides).alias("side")).select("side.*").groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("first", "second", "same")]
    )
    total = F.sum("first")
    sums = by_class.agg(
        F.coalesce(total, none).alias("rows"),
        F.try_divide(F.sum("same"), total).alias("agreement"),
        F.try_divide(F.sum(F.col("first").cast("double") * F.col("second")), total.cast("double") * total).alias("chance"),
    )
    kappa = F.try_divide(F.col("agreement") - F.col("chance"), 1 - F.col("chance"))
    return sums.select("rows", "agreement", kappa.alias("kappa"))
