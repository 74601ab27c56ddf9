"""Multinomial Naive Bayes on whole words (inventory ML-5, ML-8, without hashing).

With ``idf_j`` from the training texts and ``S_kj`` the summed TF-IDF of word j in class k::

    prior_k = ln(n_k + 1) - ln(n + K)
    theta_kj = ln(S_kj + 1) - ln(sum_j S_kj + D)

``D`` is the number of training words. A text takes the class with the largest
``prior_k + sum_j tf_j * idf_j * theta_kj``; of equal ones the more frequent, then the first by name.

Only pairs of a class and a word that occur are stored. With ``T_k = sum_j S_kj + D`` and ``A = sum_j tf_j * idf_j`` a text
scores ``prior_k - A * ln(T_k)`` plus what its words add in the class, which is never negative.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodloom.functions import text
from moodloom.operators.lookup import BROADCAST_BYTES, lookup
from moodloom.sources.readers import TEXT
from moodloom.sources.staging import stage

# Classes of a word that lie in one row.
CLASSES_PER_ROW = 1_000


@dataclass(frozen=True)
class WordBayes:
    """Written tables of any number of classes.

    ``classes``: class, rows, log_prior, log_total. ``words``: word, tokens, idf. ``weights``: word, class, weight, where
    the weight of a word in a class it occurs in is ``ln(S_kj + 1)``.
    """

    classes: DataFrame
    words: DataFrame
    weights: DataFrame


def fit_word_bayes(train: DataFrame, class_column: str, text_column: str = TEXT) -> WordBayes:
    """ML-5. One pass over the texts counts words and texts with the word, per class; rows without a class are left out.

    The summed TF-IDF of a class is ``idf_j`` times its tokens of the word, so no count per
    text is shuffled: tasks send one row per class and word they saw.
    """
    train = train.where(F.col(class_column).isNotNull())
    sizes = stage(train.groupBy(F.col(class_column).alias("class")).agg(F.count(F.lit(1)).alias("rows")), "classes")
    all_rows = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("texts"), F.count(F.lit(1)).alias("classes")).first()
    occurrences = (
        train.select(F.col(class_column).alias("class"), text.cleaned_words(text_column).alias("all"))
        .select(
            "class",
            F.size("all").alias("tokens"),
            F.posexplode(F.concat("all", F.array_distinct("all"))).alias("at", "word"),
        )
        .select("class", "word", (F.col("at") < F.col("tokens")).alias("is_token"))
    )
    counted = occurrences.groupBy("class", "word").agg(
        F.count_if(~F.col("is_token")).alias("docs"), F.count_if("is_token").alias("tokens")
    )
    counted = stage(counted, "class-words")
    idf = F.log(F.lit(all_rows["texts"] + 1.0) / (F.sum("docs") + 1))
    words = stage(counted.groupBy("word").agg(F.sum("tokens").alias("tokens"), idf.alias("idf")), "words")
    summed = F.col("idf") * F.col("counted.tokens")
    pairs = counted.alias("counted").join(words, "word").select("word", "class", summed.alias("s"))
    pairs = stage(pairs, "weights")
    totals = pairs.groupBy("class").agg(F.sum("s").alias("s"))
    total = F.coalesce("s", F.lit(0.0)) + F.lit(words.count())
    prior = F.log(F.col("rows") + 1.0) - F.log(F.lit(float(all_rows["texts"] + all_rows["classes"])))
    classes = sizes.join(totals, "class", "left").select(
        "class", "rows", prior.alias("log_prior"), F.when(total > 0, F.log(total)).otherwise(0.0).alias("log_total")
    )
    return WordBayes(
        classes=stage(classes, "priors"),
        words=words,
        weights=pairs.select("word", "class", F.log(F.col("s") + 1.0).alias("weight")),
    )


def class_parts(model: WordBayes) -> int:
    return max(1, -(-model.classes.count() // CLASSES_PER_ROW))


def parameters(model: WordBayes) -> DataFrame:
    """One row per class and word: ``(class, log_prior, word, log_prob)``, also for words that a class lacks."""
    parts = class_parts(model)
    classes = model.classes.withColumn("part", F.pmod(F.xxhash64("class"), F.lit(parts)).cast("int"))
    words = model.words.select("word", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    every = words.join(classes, "part").join(model.weights, ["class", "word"], "left")
    log_prob = F.coalesce("weight", F.lit(0.0)) - F.col("log_total")
    return every.select("class", "log_prior", "word", log_prob.alias("log_prob"))


def best_lines(model: WordBayes) -> list[tuple[float, float, int, str]]:
    """Log prior, log total, rows and class of those that can win some text by ``log_prior - A * log_total`` alone, A >= 0.

    Classes with equally many rows share their prior, so only the one with the least total can; that leaves fewer
    classes than the square root of twice the rows. These come to the driver, which keeps their upper envelope.
    """
    least = F.min(F.struct("log_total", "class")).alias("least")
    rows = model.classes.groupBy("rows", "log_prior").agg(least).select("rows", "log_prior", "least.*").collect()
    hull: list[tuple[float, float, int, str]] = []
    for line in sorted((r["log_prior"], r["log_total"], r["rows"], r["class"]) for r in rows)[::-1]:
        if hull and line[1] >= hull[-1][1]:
            continue  # a smaller prior and no smaller total
        while len(hull) > 1:
            (p0, t0, *_), (p1, t1, *_), (p2, t2, *_) = hull[-2], hull[-1], line
            if (p0 - p2) * (t0 - t1) < (p0 - p1) * (t0 - t2):
                hull.pop()  # beaten by its neighbours everywhere
            else:
                break
        hull.append(line)
    return hull


def predict(
    model: WordBayes,
    df: DataFrame,
    keys: list[str],
    text_column: str = TEXT,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """ML-8: ``keys`` (which identify a text), ``prediction`` and its ``log_score``.

    The words of a text meet their weights in a skew-safe join and are summed by task before the shuffle on the keys. A
    class without any word of the text can only win as one of ``best_lines``. A row per text keeps texts without a known word.
    """
    part = F.pmod(F.xxhash64("class"), F.lit(class_parts(model)))
    lists = model.weights.groupBy("word", part.alias("part")).agg(F.collect_list(F.struct("class", "weight")).alias("classes"))
    lists = lists.drop("part").unionByName(
        model.words.select("word", F.array(F.struct(F.lit(None).cast("string").alias("class"), F.lit(1.0).alias("weight"))).alias("classes"))
    )
    lists = stage(lists.join(model.words.select("word", "idf"), "word"), "lists")
    tokens = df.select(*keys, F.explode(text.cleaned_words(text_column)).alias("word"))
    bytes_of = F.lit(64) + 48 * F.size("classes")
    known = lookup(tokens, lists, "word", "inner", row_bytes=bytes_of, broadcast_bytes=broadcast_bytes)
    terms = known.select(*keys, "idf", F.explode("classes").alias("_c"))
    terms = terms.select(*keys, F.col("_c.class").alias("_class"), (F.col("idf") * F.col("_c.weight")).alias("_value"))
    none = df.select(*keys, F.lit(None).cast("string").alias("_class"), F.lit(0.0).alias("_value"))
    sums = terms.unionByName(none).groupBy(*keys, "_class").agg(F.sum("_value").alias("_value"))
    weight = F.max(F.when(F.col("_class").isNull(), F.col("_value"))).over(Window.partitionBy(*keys))
    sums = sums.withColumn("_weight", weight)

    def candidate(score: Column, rows: Column, name: Column) -> Column:
        """Its least is the best class."""
        return F.struct((-score).alias("score"), (-rows).alias("rows"), name.alias("class"))

    seen = lookup(
        sums.where("_class is not null"), model.classes.withColumnRenamed("class", "_class"), "_class", "inner", broadcast_bytes=broadcast_bytes
    )
    score = F.col("log_prior") - F.col("_weight") * F.col("log_total") + F.col("_value")
    seen = seen.select(*keys, candidate(score, F.col("rows"), F.col("_class")).alias("_best"))
    lines = [
        candidate(F.lit(prior) - F.col("_weight") * F.lit(total), F.lit(rows).cast("long"), F.lit(name))
        for prior, total, rows, name in best_lines(model)
    ]
    lines.append(F.lit(None).cast("struct<score: double, rows: bigint, class: string>"))  # a model of no rows has no class
    unseen = sums.where("_class is null").select(*keys, F.array_min(F.array(*lines)).alias("_best"))
    best = seen.unionByName(unseen).groupBy(*keys).agg(F.min("_best").alias("_best"))
    return best.select(*keys, F.col("_best.class").alias("prediction"), (-F.col("_best.score")).alias("log_score"))
