"""Polarity of a text and its sentiment class (inventory UDF-2, UDF-3).

A text scores the mean contribution of its lexicon words. A word contributes its polarity, times the
intensity of an intensifier right before it, held within [-1, 1]; a negator before the
word or before its intensifier turns the contribution around and halves it. No hit scores 0.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodloom.functions import rules

NEGATION = -0.5

# Scores are rounded to this many digits: the order in which words are added up must not decide
# on which side of a threshold a text falls.
SCORE_DIGITS = 12

# The default lexicon, (polarity, words) and (intensity, words).
DEFAULT_POLARITIES = (
    (1.0, "awesome excellent perfect best wonderful outstanding"),
    (0.8, "great amazing brilliant fantastic happy love loved delighted"),
    (0.6, "good nice beautiful glad enjoy enjoyed helpful win"),
    (0.4, "better safe fine hope hopeful strong recover recovered effective useful"),
    (0.2, "improve improved calm ready clear fair"),
    (-0.2, "slow unclear late hard difficult"),
    (-0.4, "wrong weak sick tired unsafe problem risk worry worried"),
    (-0.6, "bad sad angry fail failed failure poor fear dangerous"),
    (-0.8, "hate hated disaster tragic dreadful deadly"),
    (-1.0, "awful terrible horrible worst disgusting evil"),
)
DEFAULT_INTENSITIES = (
    (1.5, "extremely absolutely incredibly"),
    (1.3, "very really so too highly"),
    (0.7, "quite rather fairly"),
    (0.5, "slightly somewhat barely"),
)
NEGATORS = ("not", "no", "never")


def by_word(table: Iterable[tuple[float, str]]) -> dict[str, float]:
    return {word: value for value, words in table for word in words.split()}


class WordTable:
    """Polarities and intensities of words as one literal of the plan, looked up in the row.

    Spark searches a map entry by entry, so the words lie in many small maps, found by a hash of the word: a lookup
    costs the same for any number of words and of different values. Every mention of the table is folded to a literal.
    """

    ENTRIES = 4
    SCHEMA = "array<map<string, struct<polarity: double, intensity: double>>>"

    def __init__(self, polarities: Mapping[str, float], intensities: Mapping[str, float]) -> None:
        words = dict.fromkeys([*polarities, *intensities])
        self.has_intensities = bool(intensities)
        self.buckets = max(1, len(words) // self.ENTRIES)
        maps: list[dict] = [{} for _ in range(self.buckets)]
        for word in words:
            entry = {"polarity": polarities.get(word), "intensity": intensities.get(word)}
            maps[crc32(word.encode()) % self.buckets][word] = entry
        self.json = json.dumps(maps)

    def find(self, word: Column) -> Column:
        """The entry of ``word``, else null."""
        table = F.from_json(F.lit(self.json), self.SCHEMA)
        bucket = (F.crc32(word.cast("binary")) % self.buckets).cast("int")
        return F.try_element_at(F.get(table, bucket), word)


def contribution(polarity: Column, boost: Column, negated: Column) -> Column:
    """What one lexicon word adds to the mean."""
    boosted = polarity * F.coalesce(boost, F.lit(1.0))
    held = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), boosted))
    return held * F.when(negated, F.lit(NEGATION)).otherwise(F.lit(1.0))


def is_negated(before: Column, before_that: Column, boost: Column, negators: list[str]) -> Column:
    """A negator stands right before the word, or right before its intensifier."""
    if not negators:
        return F.lit(False)
    skipped = boost.isNotNull() & before_that.isin(negators)
    return F.coalesce(before.isin(negators) | skipped, F.lit(False))


def contributions(words: str, table: WordTable, negators: Iterable[str]) -> Column:
    """Contributions of the lexicon words in the array column named ``words``."""
    negators = list(negators)

    def weigh(word: Column, position: Column) -> Column:
        polarity = table.find(word)["polarity"]
        before = F.get(F.col(words), position - 1)
        before_that = F.get(F.col(words), position - 2)
        boost = table.find(before)["intensity"] if table.has_intensities else F.lit(None).cast("double")
        negated = is_negated(before, before_that, boost, negators)
        return F.when(polarity.isNotNull(), contribution(polarity, boost, negated))

    return F.filter(F.transform(F.col(words), weigh), lambda value: value.isNotNull())


def mean_contribution(values: str) -> Column:
    """Mean of the array column named ``values``; 0 if it is empty, null if it is null."""
    total = F.aggregate(F.col(values), F.lit(0.0), lambda acc, value: acc + value)
    hits = F.size(values)
    mean = F.round(total / hits, SCORE_DIGITS)
    return F.when(hits > 0, mean).when(hits == 0, F.lit(0.0))


def sentiment_category(
    score: Column | str,
    positive_threshold: float = rules.POSITIVE_ABOVE,
    negative_threshold: float = rules.NEGATIVE_BELOW,
) -> Column:
    """UDF-3: both thresholds are exclusive; a null score has no class."""
    score = F.col(score) if isinstance(score, str) else score
    return (
        F.when(score > positive_threshold, "Positive")
        .when(score < negative_threshold, "Negative")
        .when(score.isNotNull(), "Neutral")
    )
