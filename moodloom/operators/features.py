"""Word features of a corpus (inventory ML-1 to ML-4, ML-7)."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, StringIndexer, Tokenizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodloom.functions import rules, text
from moodloom.operators.lookup import lookup
from moodloom.sources.readers import TEXT
from moodloom.sources.staging import stage


# Bits of the hash that decides on a part.
HASH_BITS = 60
HASH_RANGE = 1 << HASH_BITS


def class_index(class_column: str, label_column: str = "label") -> StringIndexer:
    """ML-1: number the classes, most frequent first, equal counts by name. Rows without a class go."""
    return StringIndexer(inputCol=class_column, outputCol=label_column, handleInvalid="skip")


def word_split(text_column: str = TEXT, words_column: str = "words") -> Tokenizer:
    """ML-2: lower-case words between single whitespace characters; an empty text is one empty word."""
    return Tokenizer(inputCol=text_column, outputCol=words_column)


def word_buckets(num_features: int = rules.HASHED_FEATURES, words_column: str = "words") -> HashingTF:
    """ML-3: counts of hashed words as a sparse vector ``raw_features``."""
    return HashingTF(inputCol=words_column, outputCol="raw_features", numFeatures=num_features)


def bucket_weights() -> IDF:
    """ML-4 on hashed words: ``features`` from ``raw_features``."""
    return IDF(inputCol="raw_features", outputCol="features")


def index_labels(df: DataFrame, class_column: str, label_column: str = "label") -> DataFrame:
    """ML-1 fitted on and applied to the same rows."""
    return class_index(class_column, label_column).fit(df).transform(df)


def tokenize(df: DataFrame, text_column: str = TEXT, words_column: str = "words") -> DataFrame:
    """ML-2 applied."""
    return word_split(text_column, words_column).transform(df)


def hashed_tf(
    df: DataFrame, text_column: str = TEXT, num_features: int = rules.HASHED_FEATURES
) -> DataFrame:
    """ML-3 applied."""
    return word_buckets(num_features).transform(tokenize(df, text_column))


def term_frequency(df: DataFrame, id_column: str, text_column: str = TEXT) -> DataFrame:
    """ML-3 without hashing: ``(id, word, tf)``.

    A text lies within one row, so its words are sorted and counted there and nothing is shuffled.
    """
    words = df.select(id_column, F.sort_array(text.cleaned_words(text_column)).alias("words"))
    last_of_run = F.filter(
        F.sequence(F.lit(1), F.size("words")),
        lambda i: ~F.get("words", i - 1).eqNullSafe(F.get("words", i)),
    )
    # A condition in the column, not a filter: Catalyst would push a filter below the cleaning
    # and clean every text twice.
    runs = words.withColumn("ends", F.when(F.size("words") > 0, last_of_run))

    def run(end: Column, position: Column) -> Column:
        start = F.coalesce(F.get("ends", position - 1), F.lit(0))
        return F.struct(F.get("words", end - 1).alias("word"), (end - start).alias("tf"))

    return runs.select(id_column, F.explode(F.transform("ends", run)).alias("run")).select(
        id_column, "run.word", F.col("run.tf").cast("long").alias("tf")
    )


def idf_weights(df: DataFrame, text_column: str = TEXT) -> DataFrame:
    """ML-4: ``(word, docs, idf)`` with ``idf = ln((m + 1) / (docs + 1))`` over ``m`` texts."""
    texts = df.count()
    distinct = df.select(
        F.explode(F.array_distinct(text.cleaned_words(text_column))).alias("word")
    )
    docs = distinct.groupBy("word").agg(F.count(F.lit(1)).alias("docs"))
    return docs.withColumn("idf", F.log(F.lit(texts + 1.0) / (F.col("docs") + 1)))


def tfidf(df: DataFrame, id_column: str, text_column: str = TEXT) -> DataFrame:
    """ML-4 applied: ``(id, word, tfidf)``."""
    counts = term_frequency(df, id_column, text_column)
    weights = stage(idf_weights(df, text_column), "idf")
    weighted = lookup(counts, weights, "word", "inner", frequency="docs")
    return weighted.select(id_column, "word", (F.col("tf") * F.col("idf")).alias("tfidf"))


def content_hash(text_column: str = TEXT, seed: int = rules.SPLIT_SEED) -> Column:
    """A number from 0 to ``HASH_RANGE`` that depends on a text and the seed alone; null of a null text."""
    salted = F.concat(F.lit(f"{seed}:"), F.col(text_column))
    return F.conv(F.substring(F.md5(salted), 1, HASH_BITS // 4), 16, 10).cast("long")


def in_training(
    text_column: str = TEXT,
    train_ratio: float = rules.TRAIN_RATIO,
    seed: int = rules.SPLIT_SEED,
) -> Column:
    """ML-7: whether a text belongs to the training part; a null text does not.

    It depends on the text and the seed alone: not on partitions, task order or a second run, and
    equal texts stay together. Any ratio is met to within one part in ``HASH_RANGE``.
    """
    return F.coalesce(content_hash(text_column, seed) < round(train_ratio * HASH_RANGE), F.lit(False))


def split_by_content(
    df: DataFrame,
    text_column: str = TEXT,
    train_ratio: float = rules.TRAIN_RATIO,
    seed: int = rules.SPLIT_SEED,
) -> tuple[DataFrame, DataFrame]:
    """ML-7: training and test rows; each row is in one of them."""
    train = in_training(text_column, train_ratio, seed)
    return df.where(train), df.where(~train)


def ranked_in_class(df: DataFrame, class_column: str, order: list[Column]) -> DataFrame:
    """``df`` with ``_rank`` from 1 within each class and ``_rows`` of the class, by one range shuffle.

    Rows are sorted by class and ``order`` over all tasks. A row's rank is its place in its task, less that of the first row of its
    class there, plus the rows of the class in the tasks before: so a class of any size is ranked by many tasks.
    """
    named = df.withColumns({f"_by{i}": column for i, column in enumerate(order)})
    by = [F.col(class_column), *[F.col(f"_by{i}") for i in range(len(order))]]
    dealt = named.repartitionByRange(*by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id()  # the task in the upper bits, the row in the lower ones
    placed = dealt.select("*", F.shiftright(place, 33).alias("_task"), place.bitwiseAND((1 << 33) - 1).alias("_place"))
    placed = stage(placed.drop(*[f"_by{i}" for i in range(len(order))]), "sorted")
    groups = placed.groupBy(F.col(class_column).alias("_class"), "_task").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_here")
    )
    whole = Window.partitionBy("_class")
    earlier = F.sum("_here").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.select(
        "_class", "_task", "_first", F.coalesce(earlier, F.lit(0)).alias("_earlier"), F.sum("_here").over(whole).alias("_rows")
    )
    same = placed[class_column].eqNullSafe(groups["_class"]) & (placed["_task"] == groups["_task"])
    joined = placed.join(groups, same).drop(groups["_task"])
    rank = F.col("_place") - F.col("_first") + F.col("_earlier") + 1
    return joined.select(*df.columns, rank.alias("_rank"), "_rows")


def quota_split(
    df: DataFrame,
    class_column: str,
    keys: list[str],
    text_column: str = TEXT,
    train_ratio: float = rules.TRAIN_RATIO,
    seed: int = rules.SPLIT_SEED,
) -> DataFrame:
    """ML-7 with exact shares: ``df`` and ``in_train``, true for the rounded ``train_ratio`` of the rows of each class.

    Rows are taken in the order of their content hash; ``keys`` order equal texts, which may thus be parted. Rows without a class are a
    class of their own; null texts come first.
    """
    ranked = ranked_in_class(df, class_column, [content_hash(text_column, seed), *map(F.col, keys)])
    quota = F.round(F.col("_rows") * F.lit(train_ratio))
    return ranked.withColumn("in_train", F.col("_rank") <= quota).drop("_rank", "_rows")


def balanced(
    df: DataFrame, class_column: str, text_column: str = TEXT, seed: int = rules.SPLIT_SEED
) -> DataFrame:
    """EXT-3: rows of each class with about as many as the rarest has, chosen by the content hash of their text.

    Each class has its own threshold, so no row is shuffled; equal texts of a class stay or go together. Rows without a class
    or text go.
    """
    labeled = df.where(F.col(class_column).isNotNull() & F.col(text_column).isNotNull())
    sizes = labeled.groupBy(F.col(class_column).alias("_class")).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = stage(sizes, "class-sizes")
    least = sizes.agg(F.min("_rows").alias("least")).first()["least"] or 0
    limit = F.floor(F.lit(float(least)) / F.col("_rows") * HASH_RANGE)
    limits = stage(sizes.select("_class", limit.alias("_limit")), "limits")
    chosen = lookup(labeled.withColumn("_class", F.col(class_column).cast("string")), limits, "_class", "inner")
    return chosen.where(content_hash(text_column, seed) < F.col("_limit")).select(*df.columns)
