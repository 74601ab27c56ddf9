"""The cleaning job and its row-level steps (inventory FLT-1, AGG-4, AGG-5, PRJ-4, CMP-2)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.functions import rules, text
from moodloom.sources.readers import TEXT, select_text


def drop_null_text(df: DataFrame, column: str = TEXT) -> DataFrame:
    """FLT-1: nulls go, blanks stay. ``isNotNull`` reaches the Parquet scan, ``na.drop`` does not."""
    return df.where(F.col(column).isNotNull())


def dedup_exact(df: DataFrame) -> DataFrame:
    """AGG-4: one row per distinct row.

    Tasks drop their own copies before the shuffle, so the most copied text sends at most one row
    per task to the task that owns it.
    """
    return df.dropDuplicates()


def dedup_retweets(df: DataFrame, column: str = TEXT) -> DataFrame:
    """AGG-5: retweets fall onto their original once URL, line feeds and prefix are gone."""
    return dedup_exact(df.withColumn(column, text.original_text(column)))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """PRJ-4."""
    return df.withColumnsRenamed(dict(names))


def clean_tweets(
    df: DataFrame,
    text_column: str = "text",
    stop_words: Iterable[str] = rules.STOP_WORDS,
) -> DataFrame:
    """CMP-2: the cleaned texts, in one column ``tweets``.

    Texts that only meet after the last step stay separate rows. Equal raw texts have equal
    original texts, so Catalyst folds the two de-duplications into one shuffle.
    """
    distinct = dedup_exact(drop_null_text(select_text(df, text_column)))
    originals = dedup_retweets(distinct)
    return originals.select(text.normalize(TEXT, stop_words).alias(TEXT))
