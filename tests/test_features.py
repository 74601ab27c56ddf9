from collections import Counter
from math import log

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from moodloom.functions import hashing, rules
from moodloom.operators import features
from tests.conftest import column

TEXTS = ["covid cases covid", "cases fall", "", "vaccine"]


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, tweets string")


def test_labels_by_frequency_then_name(spark):
    df = spark.createDataFrame([("Pos",), ("Neg",), ("Neu",), ("Neu",)], "c string")
    found = {r["c"]: r["label"] for r in features.index_labels(df, "c").collect()}
    assert found == {"Neu": 0.0, "Neg": 1.0, "Pos": 2.0}


def test_tokenizer_keeps_empty_words(texts):
    df = features.tokenize(texts(["", "a  b", " a", "A B"], "tweets"))
    found = {r["tweets"]: r["words"] for r in df.collect()}
    assert found == {"": [""], "a  b": ["a", "", "b"], " a": ["", "a"], "A B": ["a", "b"]}


def test_hash_buckets(texts):
    """Fixed buckets of Spark's hash for 1000 features."""
    buckets = {"covid": 795, "abcd": 100, "abcdefgh": 185, "a": 467, "": 372, "guidance": 631}
    df = features.hashed_tf(texts(list(buckets), "tweets"))
    df = df.select("tweets", vector_to_array("raw_features").alias("v"))
    found = {r["tweets"]: r["v"].index(1.0) for r in df.collect()}
    assert found == buckets


def test_murmur3_equals_the_hashed_features(texts):
    """All lengths of the last block, other scripts, and the buckets of another number of features."""
    words = ["", *("abcdefghijk"[:n] for n in range(1, 12)), "é", "日本語", "naïve", "x" * 100, "\U0001f600", "ünïcödé"]
    df = texts(words, "tweets")
    for size in (rules.HASHED_FEATURES, 1 << 18):
        hashed = features.hashed_tf(df, num_features=size).select("tweets", vector_to_array("raw_features").alias("v"))
        hashed = hashed.select("tweets", (F.array_position("v", 1.0) - 1).cast("int").alias("expected"))
        both = hashed.select("tweets", "expected", hashing.bucket("tweets", size).alias("found")).collect()
        assert all(row["expected"] == row["found"] for row in both) and len(both) == len(words)
    assert texts([None]).select(hashing.murmur3("text")).first()[0] is None
    assert texts(["abc"]).select(hashing.murmur3("text").alias("h")).dtypes == [("h", "int")]


def test_term_frequency(corpus):
    found = {(r["id"], r["word"]): r["tf"] for r in features.term_frequency(corpus, "id").collect()}
    expected = {
        (i, word): n for i, value in enumerate(TEXTS) for word, n in Counter(value.split()).items()
    }
    assert found == expected


def test_idf_and_tfidf(corpus):
    idf = {r["word"]: r["idf"] for r in features.idf_weights(corpus).collect()}
    assert idf == {
        "covid": pytest.approx(log(5 / 2)),
        "cases": pytest.approx(log(5 / 3)),
        "fall": pytest.approx(log(5 / 2)),
        "vaccine": pytest.approx(log(5 / 2)),
    }
    weighed = {(r["id"], r["word"]): r["tfidf"] for r in features.tfidf(corpus, "id").collect()}
    assert weighed[(0, "covid")] == pytest.approx(2 * log(5 / 2))
    assert len(weighed) == 5


def test_split_follows_the_text_alone(spark):
    df = spark.range(5_000).select(F.concat(F.lit("text "), (F.col("id") % 2_000).cast("string")).alias("tweets"))
    train, test = features.split_by_content(df)
    assert train.count() + test.count() == 5_000
    assert train.select("tweets").intersect(test.select("tweets")).count() == 0
    again, _ = features.split_by_content(df.repartition(7))
    assert again.exceptAll(train).count() == 0
    share = train.distinct().count() / 2_000
    assert 0.65 < share < 0.75
    other, _ = features.split_by_content(df, seed=7)
    assert other.exceptAll(train).count() > 0


def test_split_of_any_ratio(spark):
    df = spark.range(20_000).select(F.format_string("t%d", "id").alias("tweets"))
    train, test = features.split_by_content(df, train_ratio=0.99999)
    assert test.count() <= 4 and train.count() + test.count() == 20_000
    assert features.split_by_content(df, train_ratio=0.0005)[0].count() in range(1, 30)
    for ratio, expected in ((0.0, 0), (1.0, 20_000)):
        assert features.split_by_content(df, train_ratio=ratio)[0].count() == expected


def test_null_texts_lie_in_the_test_part(texts):
    train, test = features.split_by_content(texts([None, None, "a"], "tweets"), train_ratio=1.0)
    assert column(test) == [None, None] and column(train) == ["a"]


def classes(spark):
    name = F.when(F.col("id") % 3 > 0, "most").when(F.col("id") % 30 == 0, "few").when(F.col("id") % 7 == 0, None).otherwise("some")
    text = F.when(F.col("id") % 50 == 1, None).otherwise(F.format_string("t%d", F.col("id") % 1_500))
    return spark.range(3_000).select("id", name.alias("c"), text.alias("tweets")).repartition(9)


def test_quota_split_is_exact_in_each_class(spark):
    df = classes(spark)
    split = features.quota_split(df, "c", ["id"], train_ratio=0.33)
    assert split.drop("in_train").exceptAll(df).count() == 0 and split.count() == 3_000
    sizes = {r["c"]: (r["n"], r["k"]) for r in split.groupBy("c").agg(F.count("*").alias("n"), F.count_if("in_train").alias("k")).collect()}
    assert len(sizes) == 4 and all(k == int(0.33 * n + 0.5) for n, k in sizes.values())
    again = features.quota_split(df.repartition(2), "c", ["id"], train_ratio=0.33)
    assert again.exceptAll(split).count() == 0
    hashed = split.withColumn("h", features.content_hash())
    edge = hashed.groupBy("c").agg(F.max(F.when(F.col("in_train"), F.col("h"))).alias("a"), F.min(F.when(~F.col("in_train"), F.col("h"))).alias("b"))
    assert edge.where("a > b").count() == 0
    assert features.quota_split(df.limit(0), "c", ["id"]).count() == 0


def test_ranks_run_over_tasks(spark):
    ranked = features.ranked_in_class(spark.range(1_000).select("id", F.lit("one").alias("c")).repartition(5), "c", [F.col("id")])
    assert {(r["id"] + 1, r["_rows"]) for r in ranked.collect()} == {(r["_rank"], 1_000) for r in ranked.collect()}


def test_balanced_rows(spark):
    df = classes(spark)
    sizes = {r["c"]: r["count"] for r in df.where("tweets is not null").groupBy("c").count().collect()}
    kept = {r["c"]: r["count"] for r in features.balanced(df, "c").groupBy("c").count().collect()}
    assert set(kept) == {"most", "some", "few"} and kept["few"] == sizes["few"]
    assert all(0.6 * sizes["few"] < n < 1.4 * sizes["few"] for n in kept.values())
    assert features.balanced(df.limit(0), "c").count() == 0


def test_rows_without_a_class_are_left_out(spark):
    df = spark.createDataFrame([("Pos",), (None,), ("Neu",), ("Neu",)], "c string")
    assert {r["c"] for r in features.index_labels(df, "c").collect()} == {"Pos", "Neu"}
