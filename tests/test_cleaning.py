from pyspark.sql import functions as F

from moodloom.operators import cleaning, explore
from tests.conftest import column, physical_plan

RAW = [
    "Good news http://x.y",
    "Good news http://z.w",
    "RT @a: Good news http://x.y",
    "RT @b: Good news http://q",
    "good NEWS ",
    None,
    None,
    "",
    "Good news http://x.y",
]


def test_clean_tweets_keeps_what_meets_late(texts):
    # Three originals: "Good news ", "good NEWS " and ""; the first two only meet afterwards.
    assert column(cleaning.clean_tweets(texts(RAW))) == ["", "good news", "good news"]


def test_other_column_and_type(spark):
    df = spark.createDataFrame([(1, 7), (2, 7)], "id int, body int")
    cleaned = cleaning.clean_tweets(df, "body")
    assert cleaned.columns == ["tweets"] and column(cleaned) == ["7"]


def test_blank_is_kept_null_is_not(texts):
    assert column(cleaning.drop_null_text(texts([None, "", " "]), "text")) == ["", " "]


def test_dedup_passes(texts):
    once = cleaning.dedup_exact(cleaning.drop_null_text(texts(RAW, "tweets")))
    assert once.count() == 6
    assert cleaning.dedup_retweets(once).count() == 3


def test_rename(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert cleaning.rename_columns(df, {"a": "x", "b": "y"}).columns == ["x", "y"]


def test_plan_has_one_shuffle_and_a_pruned_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("x", 1)], "text string, other int").write.parquet(path)
    cleaned = cleaning.clean_tweets(spark.read.parquet(path))
    plan = physical_plan(cleaned)
    assert plan.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(text)]" in plan
    assert "ReadSchema: struct<text:string>" in plan
    assert "Python" not in plan


def test_funnel(texts):
    found = {r["stage"]: r["rows"] for r in explore.cleaning_funnel(texts(RAW)).collect()}
    assert found == {"raw": 9, "distinct_text": 6, "distinct_original": 3}


def test_funnel_of_nothing(texts):
    found = {r["stage"]: r["rows"] for r in explore.cleaning_funnel(texts([])).collect()}
    assert found == {"raw": 0, "distinct_text": 0, "distinct_original": 0}


def test_a_third_of_all_rows_share_one_text(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot text http://a")
        .otherwise(F.concat(F.lit("text "), F.col("id").cast("string")))
        .alias("text")
    )
    cleaned = cleaning.clean_tweets(rows)
    assert cleaned.count() == 40_001
    assert cleaned.where("tweets = 'hot text'").count() == 1
    # Each task drops its copies before the shuffle.
    assert physical_plan(cleaned).count("HashAggregate(keys=[tweets") == 2


def test_keywords(texts):
    df = texts(["vaccine Vaccine rt rt covid covid", "alpha gamma delta tiny", "gamma"], "tweets")
    counts = {r["word"]: r["count"] for r in explore.word_counts(df).collect()}
    assert counts == {"vaccine": 2, "covid": 2, "alpha": 1, "gamma": 2, "delta": 1}
    top = [tuple(r) for r in explore.top_keywords(df, k=4).collect()]
    assert top == [("covid", 2), ("gamma", 2), ("vaccine", 2), ("alpha", 1)]
    short = {r["word"] for r in explore.word_counts(df, min_length=0).collect()}
    assert "tiny" in short and "rt" not in short and "" not in short
    assert "TakeOrderedAndProject" in physical_plan(explore.top_keywords(df))


def test_distribution(spark):
    df = spark.createDataFrame([("Neutral",), ("Neutral",), ("Positive",)], "sentiment_category string")
    found = {r[0]: r["count"] for r in explore.sentiment_distribution(df).collect()}
    assert found == {"Neutral": 2, "Positive": 1}
