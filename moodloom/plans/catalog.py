"""One registered query per operator, each over whole tables and whole texts.

The tables hold no URL, retweet prefix or null, so the cleaning queries read ``noisy_texts``: every
document as it is, as a retweet, as a retweet with a link, and as a null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodloom.functions import polarity, rules, text
from moodloom.operators import bayes, classifier, cleaning, explore, features, labeling, metrics
from moodloom.sources import readers, sinks
from moodloom.sources.readers import TEXT
from moodloom.sources.staging import stage, staging_path

Query = Callable[[SparkSession, str], DataFrame]

# Polarities for frequent words of the test tables, chosen so that all classes occur.
LEXICON = {
    "was": 0.1, "be": 0.9, "are": -0.4,
    "nicht": -0.9, "und": -0.7, "les": 0.8,
    "pour": 0.6, "los": -0.3, "para": 0.4,
}
INTENSITIES = {"les": 1.5, "los": 1.5, "die": 1.5, "which": 0.5}
NEGATORS = ("que", "le", "der")
SOFT_THRESHOLD = 0.1


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """For work on every text: a table in one piece is dealt out to all cores first."""
    return readers.spread(table(spark, sf_dir, name, *columns))


def noisy_texts(spark: SparkSession, sf_dir: str, read: Callable = spread_table) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    user = F.format_string("RT @user%d: ", F.col("doc_id") % 7)
    retweet = F.concat(user, "text")
    linked = F.concat(retweet, F.lit(" https://t.co/"), F.col("doc_id").cast("string"))
    variants = F.array("text", retweet, linked, F.lit(None).cast("string"))
    return documents.select("doc_id", F.explode(variants).alias(TEXT))


def cleaned_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents cleaned one by one, so that they keep their id."""
    documents = spread_table(spark, sf_dir, "documents", "doc_id", "text", *columns)
    cleaned = text.normalize(text.original_text("text")).alias(TEXT)
    return documents.select("doc_id", *columns, cleaned)


def labeled_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = cleaning.clean_tweets(noisy_texts(spark, sf_dir), TEXT)
    return labeling.label_sentiment(corpus, lexicon=LEXICON, negators=())


def rounded(column: str, digits: int = 6) -> Column:
    return F.round(F.col(column).cast("double"), digits).alias(column)


# Sources, sinks, projections, set operations.


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = staging_path(spark, "documents-csv")
    sinks.write_labeled(documents, path, "csv")
    return readers.read_csv(spark, path, documents.schema)


def csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four folders of one path and a list: other orders of columns, another column, and no ``lang``."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = staging_path(spark, "headers")
    for part, columns in enumerate((["doc_id", "text", "lang"], ["lang", "text", "doc_id"], ["text", "source", "doc_id", "lang"], ["text", "doc_id"])):
        sinks.write_labeled(documents.where(F.col("doc_id") % 4 == part).select(*columns), f"{path}/{part}", "csv")
    read = readers.read_csv(spark, [f"{path}/[0-2]", f"{path}/3"])
    return read.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")


def plain_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = staging_path(spark, "documents-plain")
    sinks.write_plain_csv(documents, path)
    read = spark.read.schema(documents.schema).option("multiLine", True).option("escape", '"')
    return read.csv(path)


def read_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glob and a plain path in one list."""
    return readers.read_text(spark, [f"{sf_dir}/convers*.parquet", f"{sf_dir}/benchmark.parquet"], "parquet")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = staging_path(spark, "documents-json")
    documents.write.json(path)
    return readers.read_json(spark, path, documents.schema)


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.merge_sources(
        table(spark, sf_dir, "documents", "text"),
        table(spark, sf_dir, "conversations", "text"),
        cleaning.rename_columns(table(spark, sf_dir, "benchmark", "text"), {"text": "content"}),
    )


def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    renamed = cleaning.rename_columns(documents, {"text": TEXT, "lang": "language"})
    return renamed.withColumns(
        {TEXT: text.lowercase(TEXT), "length": text.word_length(TEXT).cast("long")}
    )


# Cleaning.


def on_noisy(step: Callable[[str], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return noisy_texts(spark, sf_dir).select("doc_id", step(TEXT).alias(TEXT))

    return query


def drop_null_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_null_text(noisy_texts(spark, sf_dir, table))


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = readers.select_text(noisy_texts(spark, sf_dir), TEXT)
    return cleaning.dedup_exact(cleaning.drop_null_text(texts))


def dedup_retweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.dedup_retweets(dedup_exact(spark, sf_dir))


def remove_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread_table(spark, sf_dir, "documents", "doc_id", "text")
    return documents.select("doc_id", text.remove_stopwords("text").alias(TEXT))


def clean_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_tweets(noisy_texts(spark, sf_dir), TEXT)


def cleaning_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.cleaning_funnel(noisy_texts(spark, sf_dir), TEXT)


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.word_counts(clean_corpus(spark, sf_dir))


def top_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.top_keywords(clean_corpus(spark, sf_dir))


# Labeling.


def lexicon_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = labeling.add_polarity(cleaned_documents(spark, sf_dir), TEXT, LEXICON, ())
    return scored.select("doc_id", rounded("sentiment_score"))


def modified_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With intensifiers and negators."""
    documents = cleaned_documents(spark, sf_dir)
    scored = labeling.score_inline(documents, TEXT, LEXICON, INTENSITIES, NEGATORS)
    return scored.select("doc_id", rounded("sentiment_score"))


def joined_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores by joins, as for lexicons too large for the plan: every table counts as too large to broadcast."""
    entries = [(w, LEXICON.get(w), INTENSITIES.get(w)) for w in {**LEXICON, **INTENSITIES}]
    lexicon = spark.createDataFrame(entries, "word string, polarity double, intensity double")
    documents = cleaned_documents(spark, sf_dir)
    scored = labeling.score_by_join(documents, TEXT, stage(lexicon, "lexicon"), NEGATORS, broadcast_bytes=0)
    return scored.select("doc_id", rounded("sentiment_score"))


def sentiment_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = labeling.add_polarity(cleaned_documents(spark, sf_dir), TEXT, LEXICON, ())
    category = polarity.sentiment_category("sentiment_score")
    return scored.select("doc_id", category.alias("sentiment_category"))


def labeled_corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = labeled_corpus(spark, sf_dir)
    return labeled.select(TEXT, rounded("sentiment_score"), "sentiment_category")


def sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.sentiment_distribution(labeled_corpus(spark, sf_dir))


# Features and classifiers.


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = stage(labeled_corpus(spark, sf_dir).select("sentiment_category"), "categories")
    indexed = features.index_labels(labeled, "sentiment_category")
    return indexed.groupBy("sentiment_category", "label").agg(F.count(F.lit(1)).alias("rows"))


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread_table(spark, sf_dir, "documents", "doc_id", "text")
    tokens = features.tokenize(documents, "text")
    return tokens.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.array_join("words", "|").alias("words")
    )


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.term_frequency(cleaned_documents(spark, sf_dir), "doc_id")


def hashed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = features.hashed_tf(cleaned_documents(spark, sf_dir))
    return hashed.select("doc_id", vector_to_array("raw_features").alias("buckets"))


def hashed_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filled buckets of the sparse vectors."""
    numbered = F.transform(
        "buckets", lambda tf, bucket: F.struct(bucket.alias("bucket"), tf.alias("tf"))
    )
    filled = F.filter(numbered, lambda entry: entry["tf"] > 0)
    return hashed_buckets(spark, sf_dir).select("doc_id", F.inline(filled))


def hashed_tf_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.aggregate("buckets", F.lit(0.0), lambda acc, tf: acc + tf)
    return hashed_buckets(spark, sf_dir).select("doc_id", total.cast("long").alias("terms"))


def idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = features.idf_weights(cleaned_documents(spark, sf_dir))
    return weights.select("word", "docs", rounded("idf"))


def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = stage(cleaned_documents(spark, sf_dir), "cleaned")
    return features.tfidf(cleaned, "doc_id").select("doc_id", "word", rounded("tfidf"))


def content_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(features.in_training(), "train").otherwise("test")
    return cleaned_documents(spark, sf_dir).select("doc_id", part.alias("part"))


def quota_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = features.quota_split(cleaned_documents(spark, sf_dir, "lang"), "lang", ["doc_id"])
    return split.select("doc_id", "lang", "in_train")


def balanced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.balanced(cleaned_documents(spark, sf_dir, "lang"), "lang").select("doc_id", "lang")


def label_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative polarity beside the hand label of toxic texts."""
    scored = labeling.add_polarity(cleaned_documents(spark, sf_dir), TEXT, LEXICON, ())
    negative = F.when(F.col("sentiment_score") < -SOFT_THRESHOLD, 1).otherwise(0)
    pairs = scored.select("doc_id", negative.alias("label")).join(table(spark, sf_dir, "labels", "doc_id", "toxic"), "doc_id")
    found = metrics.agreement(metrics.confusion(pairs, "label", "toxic"))
    return found.select("rows", rounded("agreement"), rounded("kappa"))


def language_bayes(
    spark: SparkSession, sf_dir: str
) -> tuple[bayes.WordBayes, DataFrame]:
    """A model of ``lang`` and the rows held out of it."""
    cleaned = stage(cleaned_documents(spark, sf_dir, "lang"), "cleaned")
    train, test = features.split_by_content(cleaned)
    return bayes.fit_word_bayes(train, "lang"), test


def nb_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = language_bayes(spark, sf_dir)
    found = bayes.parameters(model).withColumnRenamed("class", "lang")
    return found.select("lang", rounded("log_prior"), "word", rounded("log_prob"))


def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = language_bayes(spark, sf_dir)
    predicted = bayes.predict(model, test, ["doc_id", "lang"])
    return predicted.select("doc_id", "lang", "prediction", rounded("log_score", 3))


def classifier_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark ML on the weak labels of the whole corpus; the held-out rows with their class."""
    labeled = stage(labeled_corpus(spark, sf_dir), "labeled")
    train, test = features.split_by_content(labeled)
    model = classifier.sentiment_classifier().fit(train)
    scored = classifier.score_texts(model, test)
    return scored.select(TEXT, "sentiment_category", "predicted_category")


def classifier_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    confused = metrics.confusion(
        classifier_predict(spark, sf_dir), "sentiment_category", "predicted_category"
    )
    found = metrics.classification_metrics(confused)
    return found.select(*[rounded(name) for name in rules.METRICS])


def classifier_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes beside weighted logistic regression, on the weak labels of the whole corpus and one split."""
    found = classifier.compare_classifiers(labeled_corpus(spark, sf_dir))
    rows = [(name, *[values[m] for m in rules.METRICS]) for name, values in found.items()]
    return spark.createDataFrame(rows, "classifier string, " + ", ".join(f"{m} double" for m in rules.METRICS))


def classifier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default thresholds as truth, softer ones as prediction."""
    scored = labeling.add_polarity(cleaned_documents(spark, sf_dir), TEXT, LEXICON, ())
    pairs = scored.select(
        polarity.sentiment_category("sentiment_score").alias("label"),
        polarity.sentiment_category(
            "sentiment_score", SOFT_THRESHOLD, -SOFT_THRESHOLD
        ).alias("prediction"),
    )
    found = metrics.classification_metrics(metrics.confusion(pairs))
    return found.select(*[rounded(name) for name in rules.METRICS])


QUERIES: dict[str, Query] = {
    "read_csv_roundtrip": csv_roundtrip,
    "read_json_roundtrip": json_roundtrip,
    "read_csv_headers": csv_headers,
    "plain_csv_roundtrip": plain_csv_roundtrip,
    "read_paths": read_paths,
    "union_sources": union_sources,
    "rename_columns": rename_columns,
    "drop_null_text": drop_null_text,
    "dedup_exact": dedup_exact,
    "strip_urls": on_noisy(text.strip_urls),
    "newline_to_space": on_noisy(text.newline_to_space),
    "strip_retweet_prefix": on_noisy(text.strip_retweet_prefix),
    "lowercase": on_noisy(text.lowercase),
    "strip_non_alnum": on_noisy(text.strip_non_alnum),
    "dedup_retweets": dedup_retweets,
    "remove_stopwords": remove_stopwords,
    "clean_text": on_noisy(text.clean_text),
    "clean_corpus": clean_corpus,
    "cleaning_funnel": cleaning_funnel,
    "lexicon_polarity": lexicon_polarity,
    "modified_polarity": modified_polarity,
    "joined_polarity": joined_polarity,
    "sentiment_bucket": sentiment_bucket,
    "labeled_corpus": labeled_corpus_report,
    "sentiment_distribution": sentiment_distribution,
    "word_counts": word_counts,
    "top_keywords": top_keywords,
    "label_index": label_index,
    "tokenize": tokenize,
    "term_frequency": term_frequency,
    "hashed_tf": hashed_tf,
    "hashed_tf_totals": hashed_tf_totals,
    "idf_weights": idf_weights,
    "tfidf": tfidf,
    "content_hash_split": content_hash_split,
    "quota_split": quota_split,
    "balanced_rows": balanced_rows,
    "label_agreement": label_agreement,
    "nb_parameters": nb_parameters,
    "nb_predict": nb_predict,
    "classifier_predict": classifier_predict,
    "classifier_evaluate": classifier_evaluate,
    "classifier_comparison": classifier_comparison,
    "classifier_metrics": classifier_metrics,
}
