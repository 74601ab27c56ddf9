"""Reports on a corpus (inventory AGG-1 to AGG-3, GEN-1, SCL-6, SCL-7, FLT-2, TOP-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.functions import rules, text
from moodloom.sources.readers import TEXT, select_text

# The stage names of the funnel, in order.
STAGES = ("raw", "distinct_text", "distinct_original")


def _fingerprint(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def cleaning_funnel(df: DataFrame, text_column: str = "text") -> DataFrame:
    """AGG-1: rows before cleaning, after the null drop with pass 1, and after pass 2.

    One scan. The counts need no text, so only SHA-256 fingerprints are shuffled, once per distinct
    text and task.
    """
    raw = select_text(df, text_column)
    copies = (
        raw.select(
            _fingerprint(F.col(TEXT)).alias("text_id"),
            _fingerprint(text.original_text(TEXT)).alias("original_id"),
        )
        .groupBy("text_id", "original_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    originals = copies.groupBy("original_id").agg(
        F.sum("rows").alias("rows"), F.count("text_id").alias("texts")
    )
    totals = originals.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias(STAGES[0]),
        F.coalesce(F.sum("texts"), F.lit(0)).alias(STAGES[1]),
        F.count("original_id").alias(STAGES[2]),
    )
    return totals.unpivot([], list(STAGES), "stage", "rows")


def sentiment_distribution(labeled: DataFrame) -> DataFrame:
    """AGG-2."""
    return labeled.groupBy("sentiment_category").count()


def explode_words(df: DataFrame, text_column: str = TEXT) -> DataFrame:
    """SCL-6 and GEN-1: one row per word of the lower-case text."""
    return df.select(F.explode(text.split_words(text_column)).alias("word"))


def is_keyword(word: str, min_length: int = rules.KEYWORD_MIN_LENGTH) -> Column:
    """FLT-2: long enough, not empty and not the retweet marker."""
    return (text.word_length(word) >= min_length) & ~F.col(word).isin("", "rt")


def word_counts(
    df: DataFrame,
    text_column: str = TEXT,
    min_length: int = rules.KEYWORD_MIN_LENGTH,
) -> DataFrame:
    """AGG-3 over the keywords. Tasks add up their own words first, so no word is hot."""
    words = explode_words(df, text_column).where(is_keyword("word", min_length))
    return words.groupBy("word").count()


def top_keywords(
    df: DataFrame,
    text_column: str = TEXT,
    k: int = rules.TOP_KEYWORDS,
    min_length: int = rules.KEYWORD_MIN_LENGTH,
) -> DataFrame:
    """TOP-1: the ``k`` most frequent keywords; equal counts are ordered by word."""
    counts = word_counts(df, text_column, min_length)
    return counts.orderBy(F.desc("count"), "word").limit(k)
