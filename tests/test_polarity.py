from itertools import permutations

import pytest
from pyspark.sql import functions as F

from moodloom.functions import polarity
from moodloom.operators import labeling
from moodloom.operators.lookup import lookup
from tests.conftest import physical_plan

WORDS = {"good": 0.7, "bad": -0.7, "great": 0.8}
BOOSTS = {"very": 1.5, "slightly": 0.5}
CASES = [
    ("nothing here", 0.0),
    ("", 0.0),
    (None, None),
    ("good", 0.7),
    ("GOOD bad", 0.0),
    ("good good bad", 0.7 / 3),
    ("not good", -0.35),
    ("not very good", -0.5),  # 1.05 is held at 1.0
    ("very good", 1.0),
    ("slightly bad", -0.35),
    ("not a good", 0.7),  # the negator is not next to the word
    ("not good bad great", (-0.35 - 0.7 + 0.8) / 3),
    ("very", 0.0),
]


def scores(df):
    return {row["tweets"]: row["sentiment_score"] for row in df.collect()}


@pytest.fixture
def cases(texts):
    return texts([value for value, _ in CASES], "tweets")


def test_inline_scores(cases):
    found = scores(labeling.score_inline(cases, "tweets", WORDS, BOOSTS, ["not"]))
    assert found == {value: pytest.approx(score) for value, score in CASES}


def lexicon_table(spark):
    rows = [(w, p, None) for w, p in WORDS.items()] + [(w, None, i) for w, i in BOOSTS.items()]
    return spark.createDataFrame(rows, "word string, polarity double, intensity double")


@pytest.mark.parametrize("literal_bytes", [5_000, 0])
def test_table_scores(spark, cases, literal_bytes):
    found = scores(
        labeling.add_polarity(cases, "tweets", lexicon_table(spark), ["not"], literal_bytes)
    )
    assert found == {value: pytest.approx(score) for value, score in CASES}


def test_join_keeps_equal_rows_and_other_columns(spark, texts):
    df = texts(["good", "good", None, "x"], "tweets").withColumn("n", F.lit(1))
    joined = labeling.add_polarity(df, "tweets", lexicon_table(spark), (), literal_bytes=0)
    assert joined.columns == ["tweets", "n", "sentiment_score"]
    assert joined.count() == 4 and joined.where("sentiment_score = 0.7").count() == 2


@pytest.mark.parametrize("values", [5, 300])
def test_mapping_of_any_variety(texts, values):
    lexicon = {f"w{i}": (i % values - values / 2) / values for i in range(1_000)}
    df = labeling.add_polarity(texts(["w7 w299", "w7", "x"], "tweets"), "tweets", lexicon, ())
    expected = {
        "w7 w299": pytest.approx((lexicon["w7"] + lexicon["w299"]) / 2),
        "w7": pytest.approx(lexicon["w7"]),
        "x": 0.0,
    }
    assert scores(df) == expected
    assert "Join" not in physical_plan(df)


MANY = {f"w{i}é": (i % 201 - 100) / 100 for i in range(5_001)}  # 5,001 words, 201 values


def many_texts():
    return [f"w{i}é w{(i * 7) % 6000}é other" for i in range(0, 6_000, 13)] + ["", None, "not w7é"]


def many_scores():
    found = {}
    for value in many_texts():
        hits = [MANY[w] for w in (value or "").split() if w in MANY]
        found[value] = None if value is None else pytest.approx(sum(hits) / len(hits)) if hits else 0.0
    found["not w7é"] = pytest.approx(MANY["w7é"] * -0.5)
    return found


@pytest.mark.parametrize("scored_before", [False, True])
@pytest.mark.parametrize("how", ["literal", "joined", "table", "stream"])
def test_any_lexicon_scores_batches_and_streams_alike(spark, texts, tmp_path, how, scored_before):
    df = texts(many_texts(), "tweets").withColumns({"_words": F.lit("kept"), "_hits": F.lit(1), "_text_id": F.lit(2)})
    if scored_before:
        df = df.withColumn("sentiment_score", F.lit(9.0))
    lexicon = MANY
    if how in ("table", "stream"):
        lexicon = spark.createDataFrame([*MANY.items(), (None, 1.0)], "word string, polarity double")
    if how == "stream":
        df.write.parquet(str(tmp_path / "in"))
        df = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    scored = labeling.add_polarity(df, "tweets", lexicon, ["not"], 0 if how in ("joined", "stream") else labeling.LITERAL_BYTES)
    if how == "stream":
        run = scored.writeStream.format("memory").queryName(f"many{int(scored_before)}").trigger(availableNow=True).start()
        run.awaitTermination()
        scored = spark.table(f"many{int(scored_before)}")
    assert scores(scored) == many_scores()
    assert sorted(scored.columns) == sorted({*df.columns, "sentiment_score"})
    assert scored.where("_words = 'kept' and _hits = 1 and _text_id = 2").count() == len(many_texts())


def test_every_join_may_be_shuffled(spark, cases):
    found = labeling.score_by_join(cases, "tweets", lexicon_table(spark), ["not"], broadcast_bytes=0)
    assert scores(found) == {value: pytest.approx(score) for value, score in CASES}


def test_empty_lexicon(texts):
    assert scores(labeling.add_polarity(texts(["good", None], "tweets"), "tweets", {})) == {"good": 0.0, None: None}


@pytest.mark.parametrize("literal_bytes", [5_000, 0])
def test_word_order_does_not_decide_the_class(spark, texts, literal_bytes):
    """The mean is -0.5 whatever the order; added up in floating point it is so in some orders only."""
    table = spark.createDataFrame(
        [("p", -0.7), ("q", -0.9), ("r", 0.1)], "word string, polarity double"
    )
    df = texts([" ".join(o) for o in permutations("pqr")], "tweets")
    scored = labeling.add_polarity(df, "tweets", table, (), literal_bytes)
    category = polarity.sentiment_category("sentiment_score")
    assert {tuple(r) for r in scored.select("sentiment_score", category).collect()} == {(-0.5, "Neutral")}


def test_senses_are_averaged(spark, texts):
    senses = spark.createDataFrame([("fine", 0.2), ("fine", 0.6)], "word string, polarity double")
    found = labeling.add_polarity(texts(["fine"], "tweets"), "tweets", senses, ())
    assert found.first()["sentiment_score"] == pytest.approx(0.4)


def test_default_lexicon(texts):
    df = labeling.label_sentiment(texts(["excellent", "awful", "table", "not good"], "tweets"))
    found = {r["tweets"]: r["sentiment_category"] for r in df.collect()}
    assert found == {
        "excellent": "Positive", "awful": "Negative", "table": "Neutral", "not good": "Neutral",
    }
    assert dict(df.dtypes)["sentiment_score"] == "float"
    assert df.columns == ["tweets", "sentiment_score", "sentiment_category"]


@pytest.mark.parametrize(
    ("score", "thresholds", "expected"),
    [
        (0.8, {}, "Positive"),
        (-0.8, {}, "Negative"),
        (0.0, {}, "Neutral"),
        (0.5, {}, "Neutral"),
        (-0.5, {}, "Neutral"),
        (0.2, {"positive_threshold": 0.1}, "Positive"),
        (-0.2, {"negative_threshold": -0.1}, "Negative"),
        (None, {}, None),
    ],
)
def test_category(spark, score, thresholds, expected):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(polarity.sentiment_category("s", **thresholds)).first()[0] == expected


def test_class_is_decided_on_the_double(texts):
    # 0.1 as a float is above 0.1; the double is not.
    df = labeling.label_sentiment(
        texts(["x"], "tweets"), scorer=lambda _: F.lit(0.1), positive_threshold=0.1
    )
    assert df.first()["sentiment_category"] == "Neutral"


def test_scores_stay_in_the_jvm_without_a_shuffle(cases):
    plan = physical_plan(labeling.label_sentiment(cases))
    assert "Exchange" not in plan and "PythonUDF" not in plan and "EvalPython" not in plan


def test_words_are_joined_once(monkeypatch, spark, texts):
    """The second lookup reads written hits instead of splitting the texts again."""
    plans = []

    def recorded(facts, *args, **settings):
        plans.append(physical_plan(facts))
        return lookup(facts, *args, **settings)

    monkeypatch.setattr(labeling, "lookup", recorded)
    lexicon = spark.createDataFrame([("good", 0.5, None), ("very", None, 1.5)], "word string, polarity double, intensity double")
    labeling.score_by_join(texts(["very good", "good"], "tweets"), "tweets", lexicon, (), broadcast_bytes=0)
    assert ["Generate" in plan for plan in plans] == [True, False, False]
