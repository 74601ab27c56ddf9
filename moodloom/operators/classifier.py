"""The sentiment classifier on Spark ML (inventory ML-5 to ML-12, CMP-4)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IndexToString
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.functions import rules
from moodloom.operators.features import bucket_weights, class_index, split_by_content, word_buckets, word_split
from moodloom.operators.labeling import CATEGORY
from moodloom.operators.lookup import lookup
from moodloom.operators.metrics import classification_metrics, confusion
from moodloom.sources.readers import TEXT
from moodloom.sources.staging import stage

WEIGHT = "class_weight"
# Ridge of the logistic regression.
RIDGE = 0.01


def sentiment_classifier(num_features: int = rules.HASHED_FEATURES) -> Pipeline:
    """ML-6: class index, words, hashed TF-IDF and Naive Bayes as one estimator.

    Index and document frequencies are thus learnt from the rows it is fitted on alone; those without a class are left out.
    """
    return Pipeline(stages=[*feature_stages(num_features), NaiveBayes()])


def feature_stages(num_features: int = rules.HASHED_FEATURES) -> list:
    """The stages that both classifiers share: class index, words, hashed TF-IDF."""
    return [class_index(CATEGORY), word_split(), word_buckets(num_features), bucket_weights()]


def logistic_classifier(num_features: int = rules.HASHED_FEATURES) -> Pipeline:
    """EXT-7: multinomial logistic regression on the features of ML-6, each class with the same total weight.

    The rows need ``class_weight``, as ``with_class_weight`` adds it. Gradients are summed by task.
    """
    logistic = LogisticRegression(weightCol=WEIGHT, regParam=RIDGE, family="multinomial")
    return Pipeline(stages=[*feature_stages(num_features), logistic])


def with_class_weight(df: DataFrame) -> DataFrame:
    """``df`` with ``class_weight``: all rows over the rows of the class and the number of classes; rows without a class go."""
    sizes = df.where(F.col(CATEGORY).isNotNull()).groupBy(CATEGORY).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = stage(sizes, "class-sizes")
    all_rows = sizes.agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    weights = sizes.select(CATEGORY, (F.lit(all_rows["rows"] or 0) / F.col("_rows") / all_rows["classes"]).alias(WEIGHT))
    return lookup(df, weights, CATEGORY, "inner")


def with_class(df: DataFrame) -> DataFrame:
    """Text and class of the rows that have one, written once.

    The filter stands behind the write: before it, Catalyst would push it below the de-duplication and score every raw row once more.
    """
    return stage(df.select(TEXT, CATEGORY), "labeled").where(F.col(CATEGORY).isNotNull())


def compare_classifiers(df: DataFrame, num_features: int = rules.HASHED_FEATURES) -> dict[str, dict[str, float]]:
    """EXT-7: the four metrics of Naive Bayes and of weighted logistic regression on one split by content.

    The stages that both share are fitted once, and both last stages read the features they write.
    """
    train, test = split_by_content(with_class(df))
    shared = Pipeline(stages=feature_stages(num_features)).fit(train)
    rows = stage(shared.transform(train).select(CATEGORY, "label", "features"), "features")
    bayes, logistic = (c(num_features).getStages()[-1] for c in (sentiment_classifier, logistic_classifier))
    fitted = {"naive_bayes": bayes.fit(rows), "logistic": logistic.fit(with_class_weight(rows))}
    models = {name: PipelineModel([*shared.stages, last]) for name, last in fitted.items()}
    return {name: metrics_of(score_texts(model, test)) for name, model in models.items()}


def score_texts(model: PipelineModel, df: DataFrame) -> DataFrame:
    """ML-8: add ``prediction`` and ``predicted_category`` to texts in ``tweets``.

    The class column may be missing. A class that the model never saw gets an index of its own
    and counts as missed, where the fitted index would fail or the row be lost.
    """
    index, *rest = model.stages
    lenient = PipelineModel([index.copy().setHandleInvalid("keep"), *rest])
    names = IndexToString(
        inputCol="prediction", outputCol="predicted_category", labels=index.labels
    )
    return names.transform(lenient.transform(df))


def metrics_of(predictions: DataFrame) -> dict[str, float]:
    """ML-9 to ML-12 from one pass over the predictions."""
    row = classification_metrics(confusion(predictions)).first()
    return {name: row[name] for name in rules.METRICS}


def train_and_evaluate(
    df: DataFrame,
    train_ratio: float = rules.TRAIN_RATIO,
    num_features: int = rules.HASHED_FEATURES,
    seed: int = rules.SPLIT_SEED,
    random_split: bool = False,
    staged: bool = False,
) -> tuple[PipelineModel, dict[str, float]]:
    """CMP-4: the fitted model and its metrics on the held-out rows.

    Rows without a class take no part. The others are written once, unless ``df`` is a ``staged`` table already; the three fits and the
    test read that table. The split follows the text unless ``random_split`` asks for Spark's own.
    """
    rows = df.select(TEXT, CATEGORY).where(F.col(CATEGORY).isNotNull()) if staged else with_class(df)
    if random_split:
        train, test = rows.randomSplit([train_ratio, 1 - train_ratio], seed)
    else:
        train, test = split_by_content(rows, TEXT, train_ratio, seed)
    model = sentiment_classifier(num_features).fit(train)
    return model, metrics_of(score_texts(model, test))
