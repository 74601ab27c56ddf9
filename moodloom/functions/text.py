"""Cleaning steps as ``Column -> Column`` functions (inventory SCL-1 to SCL-7, CMP-1, UDF-1).

Every function accepts a column or a column name and keeps nulls as nulls.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodloom.functions import rules

ColumnOrName = Column | str


def as_column(text: ColumnOrName) -> Column:
    return F.col(text) if isinstance(text, str) else text


def strip_urls(text: ColumnOrName) -> Column:
    """SCL-1: remove each URL. The byte search spares texts without one the regex."""
    text = as_column(text)
    without = F.regexp_replace(text, rules.URL, "")
    return F.when(F.contains(text, F.lit("http")), without).otherwise(text)


def newline_to_space(text: ColumnOrName) -> Column:
    """SCL-2: each line feed becomes one space."""
    return F.replace(as_column(text), F.lit("\n"), F.lit(" "))


def strip_retweet_prefix(text: ColumnOrName) -> Column:
    """SCL-3: remove one ``RT @user: `` at the very start, case-sensitive."""
    return F.regexp_replace(as_column(text), rules.RETWEET_PREFIX, "")


def lowercase(text: ColumnOrName) -> Column:
    """SCL-4."""
    return F.lower(as_column(text))


def strip_non_alnum(text: ColumnOrName) -> Column:
    """SCL-5: each character but ASCII letters, digits and whitespace becomes one space."""
    return F.regexp_replace(as_column(text), rules.NON_ALNUM, " ")


def original_text(text: ColumnOrName) -> Column:
    """SCL-1 to SCL-3: the text that a retweet shares with its original."""
    return strip_retweet_prefix(newline_to_space(strip_urls(text)))


def clean_text(text: ColumnOrName) -> Column:
    """CMP-1. The prefix goes while its case is intact, the URLs while they have punctuation."""
    return strip_non_alnum(lowercase(original_text(text)))


def split_words(text: ColumnOrName) -> Column:
    """SCL-6: lower-case words between whitespace runs."""
    return F.split(lowercase(text), r"\s+")


def word_length(word: ColumnOrName) -> Column:
    """SCL-7."""
    return F.length(as_column(word))


def remove_stopwords(
    text: ColumnOrName, stop_words: Iterable[str] = rules.STOP_WORDS
) -> Column:
    """UDF-1: drop stop words in any case and leave one space between the other words."""
    dropped = [*stop_words, ""]
    words = F.split(as_column(text), rules.ANY_SPACE)
    return F.array_join(F.filter(words, lambda word: ~F.lower(word).isin(dropped)), " ")


def normalize(text: ColumnOrName, stop_words: Iterable[str] = rules.STOP_WORDS) -> Column:
    """SCL-4, SCL-5 and UDF-1 in one pass over the characters.

    After SCL-5 only ASCII letters, digits and whitespace are left, so the words are the runs
    of letters and digits in the lower-case text.
    """
    dropped = list(stop_words)
    words = F.regexp_extract_all(lowercase(text), F.lit(rules.WORD), 0)
    return F.array_join(F.filter(words, lambda word: ~word.isin(dropped)), " ")


def cleaned_words(text: ColumnOrName) -> Column:
    """Words of a cleaned text; an empty text has none."""
    return F.array_remove(F.split(as_column(text), r"\s+"), "")
