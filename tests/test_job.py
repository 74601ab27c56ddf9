import pytest
from pyspark.errors import AnalysisException

from moodloom.functions import text
from moodloom.operators import classifier, cleaning, labeling
from moodloom.plans import job
from moodloom.streaming import scoring


@pytest.fixture
def inputs(spark, tmp_path):
    words = ["excellent", "awful", "table", "lamp", "chair"]
    rows = [(f"{words[i % 5]} item{i} {words[i % 5]}!", i) for i in range(120)]
    spark.createDataFrame(rows, "text string, n int").write.option("header", True).csv(str(tmp_path / "c"))
    more = [("RT @x: awful item1 awful!",), ("perfect\nday",), (None,)]
    spark.createDataFrame(more, "content string").write.json(str(tmp_path / "j"))
    return tmp_path


def test_whole_job(spark, inputs, capsys):
    out, model = str(inputs / "out"), str(inputs / "model")
    args = job.parser().parse_args(
        ["--input", str(inputs / "c" / "*.csv"), "--source", "json", str(inputs / "j"), "content",
         "--output", out, "--train", "--model-output", model, "--funnel", "--keywords", "3",
         "--preview", "2", "--schema", "--num-features", "200"]
    )
    metrics = job.run(spark, args)
    shown = capsys.readouterr().out
    assert set(metrics) == {"accuracy", "weightedPrecision", "weightedRecall", "f1"}
    for expected in ("distinct_original", "sentiment_category", "accuracy: 1.0000", "sentiment_score: float"):
        assert expected in shown
    written = spark.read.option("header", True).csv(out)
    assert written.columns == ["tweets", "sentiment_score", "sentiment_category"]
    assert written.count() == 121  # the retweet falls onto its original, the null is gone
    assert classifier.PipelineModel.load(model).stages[2].getNumFeatures() == 200


def test_lexicon_and_thresholds(spark, inputs, capsys):
    path = str(inputs / "lexicon")
    spark.createDataFrame([("table", -0.3)], "word string, polarity double").write.parquet(path)
    args = job.parser().parse_args(
        ["--source", "csv", str(inputs / "c"), "text", "--lexicon", path,
         "--negative-threshold", "-0.2", "--output", str(inputs / "o"), "--output-format", "parquet"]
    )
    assert job.run(spark, args) == {}
    found = spark.read.parquet(str(inputs / "o")).groupBy("sentiment_category").count().collect()
    assert {r[0]: r[1] for r in found} == {"Negative": 24, "Neutral": 96}


@pytest.mark.parametrize(
    ("size", "partitions", "split"),
    [(10, 8, None), (1024**4, 8193, None), (100 * 1024**4, 50_000, 100 * 1024**4 // 50_000)],
)
def test_shuffles_follow_the_input(spark, monkeypatch, size, partitions, split):
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(name) for name in names]
    monkeypatch.setattr(job, "input_bytes", lambda *_: size)
    try:
        spark.conf.set(names[0], 8)
        job.size_shuffles(spark, job.parser().parse_args(["--input", "x"]))
        assert int(spark.conf.get(names[0])) == partitions
        assert spark.conf.get(names[1]) == (str(split) if split else before[1])
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_no_source_is_an_error():
    with pytest.raises(SystemExit):
        job.main(["--train"])


def test_stream_scores_like_the_batch(spark, texts, tmp_path):
    arrived = str(tmp_path / "arrived")
    values = ["RT @a: Excellent!\nhttp://x", "awful the day", None, "plain"]
    texts(values).repartition(2).write.parquet(arrived)
    train = labeling.label_sentiment(texts(["excellent day", "awful day", "plain day"] * 4, "tweets"))
    model = classifier.sentiment_classifier(100).fit(train)
    stream = spark.readStream.schema("text string").parquet(arrived)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    scored = scoring.score_stream(stream, model)
    query = scoring.write_stream(scored, out, checkpoint)
    query.awaitTermination()
    found = {r["tweets"]: (r["sentiment_category"], r["predicted_category"]) for r in spark.read.parquet(out).collect()}
    assert found == {
        "excellent": ("Positive", "Positive"),
        "awful day": ("Negative", "Negative"),
        "plain": ("Neutral", "Neutral"),
    }
    texts(["late arrival"]).write.mode("append").parquet(arrived)
    scoring.write_stream(scored, out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_stream_without_a_model(spark, texts, tmp_path):
    texts(["great"]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    scoring.write_stream(scoring.score_stream(stream), str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).columns == [
        "tweets", "sentiment_score", "sentiment_category",
    ]


def test_sources_are_shown_and_plain_output_is_never_replaced(spark, inputs, capsys):
    plain = str(inputs / "plain")
    command = ["--input", str(inputs / "c"), "--source", "json", str(inputs / "j"), "content", "--schema", "--plain-output", plain]
    job.run(spark, job.parser().parse_args(command))
    shown = capsys.readouterr().out
    assert "|-- content: string" in shown and "|-- n: string" in shown
    assert spark.read.option("multiLine", True).csv(plain).count() == 121
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        job.run(spark, job.parser().parse_args(command))


def test_a_later_stream_goes_on_beside_its_data(spark, tmp_path):
    """Without a named checkpoint no arrived text is lost or written twice."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for text in (["one"], ["two", "three"]):
        spark.createDataFrame([(t,) for t in text], "text string").write.mode("append").parquet(source)
        arriving = spark.readStream.schema("text string").parquet(source)
        scoring.write_stream(scoring.score_stream(arriving), out).awaitTermination()
    assert sorted(r["tweets"] for r in spark.read.parquet(out).collect()) == ["one", "three", "two"]


def test_stream_and_batch_drop_the_same_copies(spark, tmp_path):
    rows = [
        (1, "hello world", "10:00"), (2, "RT @a: hello world", "10:01"), (3, "hello world https://t.co/x", "10:02"), (4, None, "10:02"),
        (5, "hello\nworld", "10:03"), (6, "hello world ", "10:04"), (7, "other", "10:05"), (8, "other", "10:05"),
    ]
    source = str(tmp_path / "in")
    for row in rows:  # one file a row, so that they arrive one by one
        df = spark.createDataFrame([row], "id long, tweets string, at string").selectExpr("id", "tweets", "timestamp('2024-01-01 ' || at) as at")
        df.coalesce(1).write.mode("append").parquet(source)
    arriving = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    scoring.write_stream(scoring.dedup_stream(arriving, "at", "1 hour"), out).awaitTermination()
    found = spark.read.parquet(out)
    assert found.columns == ["id", "tweets", "at"]
    originals = {r[0] for r in found.select(text.original_text("tweets")).collect()}
    batch = cleaning.dedup_retweets(cleaning.dedup_exact(spark.createDataFrame([(r[1],) for r in rows if r[1]], "tweets string")))
    assert originals == {r[0] for r in batch.collect()} and found.count() == batch.count()


def test_copies_beyond_the_delay_come_again(spark, tmp_path):
    source = str(tmp_path / "in")
    for i, (value, at) in enumerate([("a", "10:00"), ("b", "13:00"), ("b", "13:01"), ("c", "13:02"), ("a", "13:03")]):
        df = spark.createDataFrame([(i, value, at)], "id long, tweets string, at string")
        df.selectExpr("id", "tweets", "timestamp('2024-01-01 ' || at) as at").coalesce(1).write.parquet(f"{source}/{i}")
    schema = "id long, tweets string, at timestamp"
    for i in range(5):
        arriving = spark.readStream.schema(schema).parquet(f"{source}/[0-{i}]")
        scoring.write_stream(scoring.dedup_stream(arriving, "at", "10 minutes"), str(tmp_path / "out")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).groupBy("tweets").count().collect()
    assert {r[0]: r[1] for r in found} == {"a": 2, "b": 1, "c": 1}
