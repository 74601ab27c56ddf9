"""Operator 7: toxic text by character n-grams scaled with naive Bayes log-count ratios.

A text is the set of its hashed character n-grams. The log-count ratio of an n-gram, counted over all
training rows, says how much more often it occurs in toxic texts; a logistic regression on the
ratios of the n-grams present sets the weights.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import if_small, map_arrow, slices, texts_of

ORDERS = (3, 4, 5)
BUCKET_BITS = 18
SMOOTHING = 1.0
# The regression is fitted on about this many training rows, drawn by a hash of their ids and texts, and on this many n-grams, those
# whose ratio is surest. The ratios themselves are counted over all training rows.
FIT_ROWS = 12_000
FEATURES = 1 << 12
RIDGE = 3.0
STEPS = 300
# Training text that a counting task takes at least, if there is enough for ``COUNT_TASKS``: it bounds what the partial counts,
# 6 MB a task at most, add to a shuffle.
COUNT_BYTES = 256 * 1024 * 1024
COUNT_TASKS = 64


def ngram_buckets(text: str, orders=ORDERS, bits: int = BUCKET_BITS) -> np.ndarray:
    """Buckets of the lower-cased character n-grams, with a space before and after the text."""
    characters = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    hashes, shift = characters.astype("u4"), np.uint32(32 - bits)
    found = []
    for order in range(2, max(orders) + 1):
        if len(characters) < order:
            break
        hashes = hashes[:-1] * np.uint32(0x01000193) + characters[order - 1 :] * np.uint32(0x9E3779B1)
        if order in orders:
            mixed = (hashes ^ (hashes >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            found.append(mixed >> shift)
    return np.concatenate(found) if found else np.zeros(0, "u4")


@dataclass(frozen=True)
class Model:
    """Weight of each bucket (the regression's times the ratio) and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        buckets = ngram_buckets(text)
        weighty = np.unique(buckets[self.weights[buckets] != 0])
        value = self.intercept + float(self.weights[weighty].sum(dtype="f8"))
        return 1 / (1 + math.exp(-value)) if value > -700 else 0.0


def fit_logistic(rows: list[np.ndarray], scale: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Adam steps over all rows; feature j of a row is ``scale[j]`` if present."""
    sizes = np.fromiter(map(len, rows), "i8", len(rows))
    columns = np.concatenate([np.zeros(0, "i8"), *rows]).astype("i8")
    owners = np.repeat(np.arange(len(rows)), sizes)
    values = scale[columns]
    positive = labels.mean()
    intercept = math.log(positive / (1 - positive))
    weights, momentum, squares = np.zeros(len(scale)), np.zeros(len(scale)), np.full(len(scale), 1e-8)
    pull = squares_0 = 0.0
    for n in range(1, STEPS + 1):
        margin = intercept + np.bincount(owners, weights[columns] * values, len(rows))
        error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels
        slope = np.bincount(columns, error[owners] * values, len(scale)) + RIDGE * weights
        rate = 0.05 / math.sqrt(1 + n / 50)
        momentum = 0.9 * momentum + 0.1 * slope
        squares = 0.999 * squares + 0.001 * slope**2
        weights = weights - rate * (momentum / (1 - 0.9**n)) / (np.sqrt(squares / (1 - 0.999**n)) + 1e-8)
        total = error.sum()
        pull = 0.9 * pull + 0.1 * total
        squares_0 = 0.999 * squares_0 + 0.001 * total**2
        intercept -= rate * (pull / (1 - 0.9**n)) / (math.sqrt(squares_0 / (1 - 0.999**n)) + 1e-8)
    return weights, intercept


def train(labelled: DataFrame) -> Model:
    """A model from ``doc_id, text, toxic`` (0 or 1); rows without a label count for nothing.

    With no rows, or rows of one class only, the model scores every text with that class's smoothed share.
    """
    size = 1 << BUCKET_BITS
    known = labelled.where(F.col("toxic").isin(0, 1)).select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))

    def count(batches):
        seen, rows = np.zeros((2, size), "i8"), np.zeros(2, "i8")
        for batch in slices(batches, "text"):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic, np.unique(ngram_buckets(text))] += 1
                rows[toxic] += 1
        used = np.flatnonzero(seen.any(axis=0))
        yield {"bucket": [*used.tolist(), -1], "clean": [*seen[0, used].tolist(), rows[0]], "toxic": [*seen[1, used].tolist(), rows[1]]}

    total = known.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    tasks = max(COUNT_TASKS, total // COUNT_BYTES)
    counted = map_arrow(known.coalesce(tasks), count, "bucket long, clean long, toxic long")
    totals = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).collect()
    seen, rows = np.zeros((2, size)), np.zeros(2)
    for bucket, clean, toxic in totals:  # one per bucket at most
        if bucket < 0:
            rows[:] = clean, toxic
        else:
            seen[:, bucket] = clean, toxic
    if not rows.all():
        share = (rows[1] + 0.5) / (rows.sum() + 1)
        return Model(np.zeros(size, "f4"), math.log(share / (1 - share)))

    smooth = seen + SMOOTHING
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    sure = np.abs(ratio) * np.sqrt(seen.sum(axis=0))
    chosen = np.sort(np.argsort(-sure, kind="stable")[:FEATURES])
    chosen = chosen[sure[chosen] > 0]
    place = np.full(size, -1, "i4")
    place[chosen] = np.arange(len(chosen))

    def features(batches):
        for batch in slices(batches, "text"):
            lists = []
            for text in batch.column("text").to_pylist():
                found = place[np.unique(ngram_buckets(text))]
                lists.append(found[found >= 0].astype("<u2").tobytes())
            yield {"toxic": batch.column("toxic"), "places": lists}

    drawn = F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1 << 30)) * float(rows.sum()) < float(FIT_ROWS << 30)
    sample = map_arrow(known.where(drawn), features, "toxic int, places binary").collect()
    labels = np.array([row["toxic"] for row in sample], "f8")
    if not len(labels) or not 0 < labels.mean() < 1:
        share = rows[1] / rows.sum()
        return Model(np.zeros(size, "f4"), math.log(share / (1 - share)))
    weights, intercept = fit_logistic([np.frombuffer(row["places"], "<u2") for row in sample], ratio[chosen], labels)
    scaled = np.zeros(size, "f4")
    scaled[chosen] = weights * ratio[chosen]
    return Model(scaled, intercept)


def held_out(id_column: str | Column = "doc_id") -> Column:
    """The fold that no model learns from: ids whose text has a CRC-32 divisible by 5; null ids are in it."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Learn from the labelled documents outside the held-out fold; of two labels for an id the higher counts."""
    marked = labels.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(F.col("toxic").isNotNull())
    small = if_small(marked, 64)
    return train(texts_of(docs, id_column, text_column).join(small, "doc_id"))


def score_toxicity(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for each row, in one pass without a shuffle.

    The score is the model's probability of label 1 for the whole text; null and empty texts are scored by the intercept and the
    n-grams of two spaces. Repeated rows and null ids stay; other columns are ignored.
    """

    texts = texts_of(docs, id_column, text_column)
    scored = texts.select("doc_id", toxicity_score(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity_score(model: Model) -> Callable[[str | Column], Column]:
    """A column function: the score of a text column, null texts as empty ones."""

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(text or "") for text in texts], dtype="float64")

    return F.pandas_udf(score, "double")
