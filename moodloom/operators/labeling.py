"""Sentiment labels for a corpus (inventory UDF-2, UDF-3, CMP-3)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.functions import polarity, rules, text
from moodloom.operators.lookup import BROADCAST_BYTES, lookup, measured_bytes
from moodloom.sources.readers import TEXT
from moodloom.sources.staging import stage

# A lexicon is a literal of the plan up to this size, which every task unpacks; a larger one is joined, except on streams.
LITERAL_BYTES = 16 * 1024 * 1024
# Two numbers and the places of a word in its map.
ENTRY_BYTES = 48

SCORE = "sentiment_score"
CATEGORY = "sentiment_category"


def merged_lexicon(lexicon: DataFrame) -> DataFrame:
    """One row per word; the senses of a word are averaged."""
    columns = [c for c in ("polarity", "intensity") if c in lexicon.columns]
    merged = lexicon.where(F.col("word").isNotNull()).groupBy("word").agg(*[F.avg(c).alias(c) for c in columns])
    missing = {"polarity", "intensity"} - set(columns)
    return merged.withColumns({c: F.lit(None).cast("double") for c in missing})


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores in front until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def add_polarity(
    df: DataFrame,
    text_column: str = TEXT,
    lexicon: DataFrame | Mapping[str, float] | None = None,
    negators: Iterable[str] = polarity.NEGATORS,
    literal_bytes: int = LITERAL_BYTES,
) -> DataFrame:
    """UDF-2: the polarity of each text, as a double in [-1, 1], in ``sentiment_score``, which replaces a column of that name.

    ``lexicon`` maps words to polarities, or is a table with ``word`` and ``polarity``,
    ``intensity`` or both. Without one the built-in English words are used. Any lexicon scores a batch and a
    stream alike. One measured at over ``literal_bytes`` is joined to a batch; a stream has it in every task.
    """
    if lexicon is None:
        polarities = polarity.by_word(polarity.DEFAULT_POLARITIES)
        return score_inline(df, text_column, polarities, polarity.by_word(polarity.DEFAULT_INTENSITIES), negators)
    if isinstance(lexicon, Mapping):
        if df.isStreaming or sum(len(word.encode()) + ENTRY_BYTES for word in lexicon) <= literal_bytes:
            return score_inline(df, text_column, lexicon, {}, negators)
        lexicon = df.sparkSession.createDataFrame(list(lexicon.items()), "word string, polarity double")
    words = stage(merged_lexicon(lexicon), "lexicon")
    if not df.isStreaming and measured_bytes(words, "word", ENTRY_BYTES) > literal_bytes:
        return score_by_join(df, text_column, words, negators)
    rows = words.collect()
    polarities = {r["word"]: r["polarity"] for r in rows if r["polarity"] is not None}
    intensities = {r["word"]: r["intensity"] for r in rows if r["intensity"] is not None}
    return score_inline(df, text_column, polarities, intensities, negators)


def score_inline(
    df: DataFrame,
    text_column: str,
    polarities: Mapping[str, float],
    intensities: Mapping[str, float],
    negators: Iterable[str],
) -> DataFrame:
    """Score inside each row: no shuffle, and it works on streams too."""
    words, hits = free_names(df, "_words", "_hits")
    found = polarity.contributions(words, polarity.WordTable(polarities, intensities), negators)
    return (
        df.withColumn(words, text.split_words(text_column))
        .withColumn(hits, found)
        .withColumn(SCORE, polarity.mean_contribution(hits))
        .drop(words, hits)
    )


def score_by_join(
    df: DataFrame,
    text_column: str,
    lexicon: DataFrame,
    negators: Iterable[str],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Score through joins of the words to a written lexicon of any size; tables over ``broadcast_bytes`` are shuffled.

    Texts travel as their SHA-256; equal texts share a score, so they need not be told apart. ``df``
    is written once, as several passes read it.
    """
    negators = list(negators)
    polarities = lexicon.where(F.col("polarity").isNotNull()).select("word", "polarity")
    intensities = lexicon.where(F.col("intensity").isNotNull()).select(
        F.col("word").alias("before"), "intensity"
    )
    text_id, score = free_names(df, "_text_id", "_score")
    keyed = stage(df.withColumn(text_id, F.unhex(F.sha2(text_column, 256))), "keyed")

    shifted = [F.concat(F.array(*[F.lit(None).cast("string")] * n), "_words").alias(c) for n, c in ((1, "before"), (2, "before_that"))]
    words = (
        keyed.select(text_id, text.split_words(text_column).alias("_words"))
        .select(text_id, F.explode(F.arrays_zip(F.col("_words").alias("word"), *shifted)).alias("w"))
        .select(text_id, "w.*")
    )
    # Written once: the next lookup reads its rows up to four times, and each time would split all texts again.
    hits = stage(lookup(words, polarities, "word", "inner", broadcast_bytes=broadcast_bytes), "hits")
    boosted = lookup(hits, intensities, "before", "left", broadcast_bytes=broadcast_bytes)
    boost = F.col("intensity")
    negated = polarity.is_negated(F.col("before"), F.col("before_that"), boost, negators)
    value = polarity.contribution(F.col("polarity"), boost, negated)
    mean = F.round(F.avg(value), polarity.SCORE_DIGITS)
    scores = stage(boosted.groupBy(text_id).agg(mean.alias(score)), "scores")
    scored = lookup(keyed, scores, text_id, "left", broadcast_bytes=broadcast_bytes)
    no_hit = F.when(F.col(text_column).isNotNull(), F.lit(0.0))
    return scored.withColumn(SCORE, F.coalesce(F.col(score), no_hit)).drop(text_id, score)


def label_sentiment(
    df: DataFrame,
    text_column: str = TEXT,
    lexicon: DataFrame | Mapping[str, float] | None = None,
    negators: Iterable[str] = polarity.NEGATORS,
    positive_threshold: float = rules.POSITIVE_ABOVE,
    negative_threshold: float = rules.NEGATIVE_BELOW,
    scorer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """CMP-3: add ``sentiment_score`` (float) and ``sentiment_category``.

    The class is decided on the double score. ``scorer`` replaces the lexicon by a column
    function of the caller.
    """
    if scorer is None:
        scored = add_polarity(df, text_column, lexicon, negators)
    else:
        scored = df.withColumn(SCORE, scorer(F.col(text_column)))
    category = polarity.sentiment_category(SCORE, positive_threshold, negative_threshold)
    return scored.withColumns({SCORE: F.col(SCORE).cast("float"), CATEGORY: category})
