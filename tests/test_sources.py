import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from moodloom.sources import readers, sinks, staging
from tests.conftest import column, physical_plan

CSV = 'id,text,n\n1,"first\nsecond, ""quoted""",007\n2,plain,8\n3,,9\n'


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "in" / "a.csv"
    path.parent.mkdir()
    path.write_text(CSV)
    return str(path)


def test_csv_keeps_line_feeds_and_quotes(spark, csv_path):
    found = column(readers.read_text(spark, csv_path))
    assert found == [None, 'first\nsecond, "quoted"', "plain"]
    split = readers.read_text(spark, csv_path, multi_line=False)
    assert split.count() == 4


def test_csv_schema_inference_and_given_schema(spark, csv_path):
    assert dict(readers.read_csv(spark, csv_path).dtypes)["n"] == "string"
    assert dict(readers.read_csv(spark, csv_path, infer_schema=True).dtypes)["n"] == "int"
    given = readers.read_csv(spark, csv_path, "id long, text string, n string")
    assert given.schema.simpleString() == "struct<id:bigint,text:string,n:string>"
    assert given.first()["n"] == "007"


def test_csv_reads_the_text_column_alone(spark, csv_path):
    assert "ReadSchema: struct<text:string>" in physical_plan(readers.read_text(spark, csv_path))


def test_json_parquet_globs_and_lists(spark, tmp_path):
    spark.createDataFrame([("a\nb", 1)], "content string, n int").write.json(str(tmp_path / "j1"))
    spark.createDataFrame([("c", 2)], "content string, n int").write.json(str(tmp_path / "j2"))
    assert column(readers.read_text(spark, str(tmp_path / "j*"), "json", "content")) == ["a\nb", "c"]
    paths = [str(tmp_path / "j1"), str(tmp_path / "j2")]
    assert readers.read_text(spark, paths, "json", "content").count() == 2
    assert readers.read_json(spark, paths).columns == ["content", "n"]
    spark.createDataFrame([("p",)], "body string").write.parquet(str(tmp_path / "p"))
    assert column(readers.read_text(spark, str(tmp_path / "p"), "parquet", "body")) == ["p"]
    with pytest.raises(ValueError, match="unknown source format"):
        readers.read_text(spark, "x", "xml")


def test_merge_by_position(texts):
    merged = readers.merge_sources(
        texts(["a", "b"]), texts(["b"], "content"), texts([None], "body")
    )
    assert merged.columns == ["tweets"] and column(merged) == [None, "a", "b", "b"]


def test_spread_only_what_is_narrow(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "one"))
    narrow = readers.spread(spark.read.parquet(str(tmp_path / "one")))
    assert narrow.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 16)
    assert readers.spread(wide).rdd.getNumPartitions() == 16


def test_input_bytes(spark, csv_path):
    assert readers.input_bytes(spark, [csv_path]) == len(CSV)


@pytest.fixture
def labeled(spark):
    rows = [(' a "b"\nc, d ', 0.5, "Neutral"), ("x", -1.0, "Negative")]
    return spark.createDataFrame(rows, "tweets string, sentiment_score float, sentiment_category string")


def test_csv_round_trip_and_overwrite(spark, labeled, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_labeled(labeled.limit(1), path)
    sinks.write_labeled(labeled, path)
    back = readers.read_csv(spark, path, labeled.schema)
    assert back.exceptAll(labeled).count() == 0 and back.count() == 2


def test_parquet_keeps_empty_text(spark, texts, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_labeled(texts(["", None, "x"], "tweets"), path, "parquet")
    assert column(spark.read.parquet(path)) == [None, "", "x"]
    with pytest.raises(ValueError, match="unknown output format"):
        sinks.write_labeled(texts([]), path, "xml")


def test_plain_csv_has_no_header_and_never_replaces(spark, labeled, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_plain_csv(labeled, path)
    assert spark.read.option("multiLine", True).option("escape", '"').csv(path).count() == 2
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.write_plain_csv(labeled, path)


def test_preview_and_schema(labeled, capsys):
    sinks.preview(labeled, 1, truncate=False)
    labeled.printSchema()
    shown = capsys.readouterr().out
    assert "only showing top 1 row" in shown and "sentiment_score: float" in shown


def test_metric_lines():
    assert sinks.metric_lines({"accuracy": 0.79612, "f1": 1.0}) == ["accuracy: 0.7961", "f1: 1.0000"]


def test_staging_uses_the_shared_folder(spark, texts):
    root = staging.staging_root(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or root == named.rstrip("/")
    staged = staging.stage(texts(["a", None]).withColumn("n", F.lit(1)), "unit")
    assert staged.count() == 2 and root in staged.inputFiles()[0]
    assert staging.staging_path(spark, "x") != staging.staging_path(spark, "x")


def test_headers_may_differ(spark, tmp_path):
    for name, content in (("a", 'id,text\n1,one\n2,"two\nlines"\n'), ("b", "text,id\nthree,3\n"), ("c", "text,mood\nfour,calm\n"), ("d", "")):
        (tmp_path / f"{name}.csv").write_text(content)
    for paths in (str(tmp_path / "*.csv"), str(tmp_path), [str(tmp_path / "[a-b].csv"), str(tmp_path / "c.csv")]):
        found = readers.read_csv(spark, paths)
        assert sorted(found.columns) == ["id", "mood", "text"]
        rows = {(r["id"], r["text"], r["mood"]) for r in found.collect()}
        assert rows == {("1", "one", None), ("2", "two\nlines", None), ("3", "three", None), (None, "four", "calm")}
        assert column(readers.read_text(spark, paths)) == ["four", "one", "three", "two\nlines"]


def test_unseen_headers_fail_instead_of_misreading(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,one\n")
    (tmp_path / "b.csv").write_text("text,id\nthree,3\n")
    one_by_one = readers.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], per_file=False)
    assert {r["text"] for r in one_by_one.collect()} == {"one", "three"}
    for multi_line in (True, False):
        with pytest.raises(Exception, match="(?i)header"):
            readers.read_csv(spark, str(tmp_path), per_file=False, multi_line=multi_line).collect()


def test_source_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert readers.read_csv(spark, str(tmp_path / "a.csv")).count() == 0


def test_schemas_of_sources(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "content string, n int").write.json(str(tmp_path / "j"))
    assert readers.read_source(spark, str(tmp_path / "j"), "json").columns == ["content", "n"]
