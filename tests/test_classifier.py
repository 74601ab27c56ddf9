from collections import Counter, defaultdict
from math import log
from random import Random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, StringIndexer

from moodloom.functions import rules, text
from moodloom.operators import bayes, classifier, lookup, metrics
from moodloom.sources import sinks
from moodloom.sources.staging import stage
from tests.conftest import physical_plan


@pytest.fixture(scope="module")
def labeled(spark):
    words = {"Positive": "great good fine", "Negative": "awful bad worse", "Neutral": "table chair lamp"}
    rows = []
    for i in range(240):
        name = ("Neutral", "Neutral", "Positive", "Negative")[i % 4]
        picked = words[name].split()[i % 3] + " " + words["Neutral"].split()[i // 3 % 3]
        rows.append((i, f"{picked} w{i % 11} {picked}" if i else "", name))
    return spark.createDataFrame(rows, "id long, tweets string, sentiment_category string").cache()


def test_word_bayes_equals_spark_ml(labeled):
    train, test = labeled.where("id % 10 < 7"), labeled.where("id % 10 >= 7")
    ours = bayes.fit_word_bayes(train, "sentiment_category")
    with_words = lambda df: df.withColumn("words", text.cleaned_words("tweets"))
    index = StringIndexer(inputCol="sentiment_category", outputCol="label").fit(train)
    vocabulary = CountVectorizer(inputCol="words", outputCol="tf").fit(with_words(train))
    prepared = vocabulary.transform(index.transform(with_words(train)))
    idf = IDF(inputCol="tf", outputCol="features").fit(prepared)
    model = NaiveBayes().fit(idf.transform(prepared))

    priors = {r["class"]: r["log_prior"] for r in ours.classes.collect()}
    assert priors == dict(zip(index.labels, map(pytest.approx, model.pi.toArray())))
    theta = model.theta.toArray()
    expected = {
        (name, word): theta[k, j]
        for k, name in enumerate(index.labels)
        for j, word in enumerate(vocabulary.vocabulary)
    }
    found = {(r["class"], r["word"]): r["log_prob"] for r in bayes.parameters(ours).collect()}
    assert found == {key: pytest.approx(value) for key, value in expected.items()}

    theirs = model.transform(idf.transform(vocabulary.transform(index.transform(with_words(test)))))
    expected = {r["id"]: index.labels[int(r["prediction"])] for r in theirs.collect()}
    predicted = bayes.predict(ours, test, ["id"])
    assert {r["id"]: r["prediction"] for r in predicted.collect()} == expected


def test_text_without_known_word_gets_the_prior(spark, labeled):
    model = bayes.fit_word_bayes(labeled, "sentiment_category")
    unknown = spark.createDataFrame([(1, "zzz"), (2, "")], "id long, tweets string")
    found = bayes.predict(model, unknown, ["id"]).collect()
    assert {r["prediction"] for r in found} == {"Neutral"} and len(found) == 2
    assert found[0]["log_score"] == pytest.approx(log(121) - log(243))


def test_prediction_beyond_the_broadcast_limit(monkeypatch, labeled):
    model = bayes.fit_word_bayes(labeled, "sentiment_category")
    small = bayes.predict(model, labeled, ["id"]).collect()
    monkeypatch.setattr(lookup, "HOT_KEYS", 20)
    large = bayes.predict(model, labeled, ["id"], broadcast_bytes=0).collect()
    scores = lambda rows: {r["id"]: (r["prediction"], pytest.approx(r["log_score"])) for r in rows}
    assert {r["id"]: (r["prediction"], r["log_score"]) for r in large} == scores(small)


def plain_bayes(rows, texts):
    """Scores of each text in each class, straight from the formula."""
    sizes, docs, tokens = Counter(name for _, name in rows), Counter(), defaultdict(Counter)
    for value, name in rows:
        docs.update(set(value.split()))
        tokens[name].update(value.split())
    idf = {w: log((len(rows) + 1) / (n + 1)) for w, n in docs.items()}
    total = {k: sum(idf[w] * n for w, n in tokens[k].items()) + len(idf) for k in sizes}
    for value in texts:
        known = [w for w in value.split() if w in idf]
        yield {
            k: log(n + 1) - log(len(rows) + len(sizes)) + sum(idf[w] * (log(tokens[k][w] * idf[w] + 1) - log(total[k])) for w in known)
            for k, n in sizes.items()
        }, sizes


@pytest.mark.parametrize("per_row", [1_000, 50])
def test_a_thousand_classes(spark, monkeypatch, per_row):
    monkeypatch.setattr(bayes, "CLASSES_PER_ROW", per_row)
    rng = Random(7)
    vocabulary = [f"v{i}" for i in range(300)]
    names = [f"c{i}" for i in range(1_001)]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))), name) for name in names for _ in range(1 + rng.randrange(30) // 28 * 9)]
    rows += [("", "plain")] * 40 + [("v1 v2", "often")] * 30
    train = spark.createDataFrame([*rows, ("v1", None)], "tweets string, label string")
    texts = [" ".join(rng.choices(vocabulary + ["unknown"], k=n)) for n in (0, 1, 2, 5, 9, 40, 90) for _ in range(5)]
    model = bayes.fit_word_bayes(train, "label")
    assert model.classes.count() == 1_003
    df = spark.createDataFrame(list(enumerate(texts)), "_class long, tweets string").withColumnRenamed("_class", "id")
    found = {r["id"]: r for r in bayes.predict(model, df, ["id"]).collect()}
    for i, (scores, sizes) in enumerate(plain_bayes(rows, texts)):
        best = max(scores.values())
        assert found[i]["log_score"] == pytest.approx(best)
        assert found[i]["prediction"] in [k for k, v in scores.items() if v == pytest.approx(best, abs=1e-9)]
    assert bayes.parameters(model).count() == 1_003 * model.words.count()
    assert {found[i]["prediction"] for i in range(5)} == {"plain"}


def test_equal_scores_and_no_training_rows(spark):
    rows = [("a", "y"), ("a", "x"), ("a", "z"), ("a", "z")]
    train = spark.createDataFrame(rows, "tweets string, label string")
    model = bayes.fit_word_bayes(train.where("tweets = 'a' and label <> 'z'"), "label")
    texts = spark.createDataFrame([(1, "a"), (2, "b")], "id long, tweets string")
    assert {r["prediction"] for r in bayes.predict(model, texts, ["id"]).collect()} == {"x"}
    nothing = bayes.fit_word_bayes(train.limit(0), "label")
    assert [r["prediction"] for r in bayes.predict(nothing, texts, ["id"]).collect()] == [None, None]
    assert bayes.parameters(nothing).count() == 0


def test_metrics_equal_spark_ml(spark):
    pairs = [(0, 0)] * 50 + [(0, 1)] * 7 + [(1, 1)] * 20 + [(1, 0)] * 5 + [(2, 0)] * 3 + [(0, 3)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    evaluator = MulticlassClassificationEvaluator()
    expected = {m: evaluator.evaluate(df, {evaluator.metricName: m}) for m in rules.METRICS}
    found = classifier.metrics_of(df)
    assert list(found) == list(rules.METRICS) and found == pytest.approx(expected)
    assert metrics.confusion(df).count() == 6


def test_train_and_evaluate(labeled):
    model, found = classifier.train_and_evaluate(labeled)
    assert set(found) == set(rules.METRICS) and 0.5 < found["accuracy"] <= 1
    assert found["weightedRecall"] == pytest.approx(found["accuracy"])
    _, again = classifier.train_and_evaluate(labeled.repartition(3))
    assert again == pytest.approx(found)
    _, drawn = classifier.train_and_evaluate(labeled, random_split=True)
    assert set(drawn) == set(rules.METRICS)


def test_saved_model_scores_new_texts(texts, labeled, tmp_path):
    path = str(tmp_path / "model")
    classifier.sentiment_classifier(200).fit(labeled).write().save(path)
    model = PipelineModel.load(path)
    new = classifier.score_texts(model, texts(["great good great", "awful worse awful"], "tweets"))
    found = {r["tweets"]: r["predicted_category"] for r in new.collect()}
    assert found == {"great good great": "Positive", "awful worse awful": "Negative"}


def test_class_unknown_to_the_model_counts_as_missed(labeled):
    model = classifier.sentiment_classifier().fit(labeled.where("sentiment_category <> 'Negative'"))
    scored = classifier.score_texts(model, labeled)
    assert scored.count() == 240
    assert scored.where("sentiment_category = 'Negative' and label = prediction").count() == 0


def test_stages_learn_from_training_rows_alone(labeled):
    train = labeled.where("id < 100")
    model = classifier.sentiment_classifier(50).fit(train)
    assert model.stages[3].numDocs == 100
    assert list(model.stages[0].labels)[0] == "Neutral"
    assert model.stages[2].getNumFeatures() == 50


def test_rows_without_a_class_take_no_part(labeled):
    nameless = labeled.where("id < 20").selectExpr("id", "tweets", "cast(null as string) as sentiment_category")
    _, expected = classifier.train_and_evaluate(labeled)
    _, found = classifier.train_and_evaluate(labeled.unionByName(nameless))
    assert found == pytest.approx(expected)
    model = classifier.sentiment_classifier(100).fit(labeled.unionByName(nameless))
    assert model.stages[3].numDocs == 240


def test_empty_test_part_gives_no_numbers(labeled):
    model, found = classifier.train_and_evaluate(labeled, train_ratio=1.0)
    assert set(found.values()) == {None}
    assert sinks.metric_lines(found) == [f"{name}: nan" for name in rules.METRICS]


def test_weighted_logistic_beside_bayes(labeled):
    weighted = classifier.with_class_weight(labeled)
    totals = {r[0]: r[1] for r in weighted.groupBy("sentiment_category").agg({"class_weight": "sum"}).collect()}
    assert set(map(round, totals.values())) == {80} and weighted.count() == 240
    found = classifier.compare_classifiers(labeled, 200)
    assert set(found) == {"naive_bayes", "logistic"}
    assert found["logistic"]["accuracy"] > 0.8


def test_agreement(spark):
    pairs = [(1, 1)] * 20 + [(1, 0)] * 5 + [(0, 1)] * 10 + [(0, 0)] * 15 + [(None, 1), (0, None)]
    row = metrics.agreement(metrics.confusion(spark.createDataFrame(pairs, "label int, prediction int"))).first()
    assert row["rows"] == 50 and row["agreement"] == pytest.approx(0.7) and row["kappa"] == pytest.approx(0.4)
    none = metrics.agreement(metrics.confusion(spark.createDataFrame([], "label int, prediction int"))).first()
    assert tuple(none) == (0, None, None)
    same = spark.createDataFrame([(1, 1)] * 3, "label int, prediction int")
    assert metrics.agreement(metrics.confusion(same)).first()["kappa"] is None


def test_texts_are_scored_and_hashed_once(monkeypatch, labeled):
    """The filter on the class stays behind the write, and both classifiers read one table of features."""
    written = []

    def recorded(df, name):
        written.append((name, physical_plan(df)))
        return stage(df, name)

    monkeypatch.setattr(classifier, "stage", recorded)
    classifier.compare_classifiers(labeled, 200)
    assert [name for name, _ in written] == ["labeled", "features", "class-sizes"]
    assert "Filter" not in written[0][1]
