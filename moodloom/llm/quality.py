"""Operator 8: a ledger of quality rules, kept as bits, and policies applied to it.

Every rule is evaluated once per text. The ledger keeps what was measured and one bit per failed
rule; a policy is a mask of rules, so a new version of it, or the effect of leaving one rule out, needs no text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import texts_of

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARACTERS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Rules by name, in the order of their bits: true where a text fails. All compare whole numbers.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 30 * n_words",
}
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """Rules that a kept text must not fail."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(rule) for rule in self.rules)


POLICIES = (Policy("1", BASE), Policy("2", (*BASE, "many_symbols")), Policy("3", tuple(RULES)))


def without(text: str | Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def words_of(text: str | Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def trigram_hashes(words: str) -> Column:
    def hashed(word: Column, i: Column) -> Column:
        return F.xxhash64(word, F.get(F.col(words), i + 1), F.get(F.col(words), i + 2))

    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), hashed)


def sorted_trigrams(words: str, hashes: str) -> Column:
    """Hash, words and place of each trigram; equal ones lie side by side, whatever their hashes."""

    def entry(h: Column, i: Column) -> Column:
        word = F.col(words)
        return F.struct(
            h.alias("h"), F.get(word, i).alias("a"), F.get(word, i + 1).alias("b"), F.get(word, i + 2).alias("c"), i.alias("i")
        )

    return F.sort_array(F.transform(hashes, entry))


def repeated_places(entries: str) -> Column:
    """Places of the trigrams that a neighbour in the sorted list equals."""

    def equal(x: Column, y: Column) -> Column:
        return (x.h == y.h) & (x.a == y.a) & (x.b == y.b) & (x.c == y.c)

    def place(x: Column, k: Column) -> Column:
        near = F.col(entries)
        return F.when(equal(x, F.get(near, k - 1)) | equal(x, F.get(near, k + 1)), x.i)

    return F.array_compact(F.transform(entries, place))


def covered_words(places: str) -> Column:
    """Words in the three-word windows that begin at ``places``."""
    second, third = F.transform(places, lambda p: p + 1), F.transform(places, lambda p: p + 2)
    return F.size(F.array_union(F.array_union(places, second), third))


def build_ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, the measurements (long) and ``failures``, a bit per failed rule.

    One row per input row, in one pass without a shuffle. A null text has no words, so it fails
    ``few_words`` alone. Other columns are ignored; repeated rows stay.
    """
    texts = texts_of(docs, id_column, text_column)
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(without(line, WHITE_CHARACTERS)) > 0)
    split = texts.select(
        "doc_id",
        words_of("text").alias("words"),
        F.length(without("text", WHITE_CHARACTERS)).alias("word_chars"),
        (F.length("text") - F.length(without("text", SYMBOLS))).alias("n_symbols"),
        lines.alias("lines"),
    )
    counted = split.select(
        "doc_id",
        "words",
        F.size("words").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        trigram_hashes("words").alias("hashes"),
    )
    plain = [name for name in counted.columns if name not in ("words", "hashes")]
    has_repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = counted.select(*plain, F.when(has_repeats, sorted_trigrams("words", "hashes")).alias("entries"))
    placed = ordered.select(*plain, repeated_places("entries").alias("places"))
    repeats = F.coalesce(covered_words("places"), F.lit(0)).alias("n_repeat_words")
    measured = placed.select(*plain, repeats)
    measured = measured.select("doc_id", *[F.col(name).cast("long").alias(name) for name in MEASURES])
    failures = sum(F.expr(rule).cast("long") * (1 << bit) for bit, rule in enumerate(RULES.values()))
    return measured.withColumn("failures", failures)


def fails(mask: int) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask)) != 0


def apply_policy(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Add ``kept`` by the policy's mask."""
    return ledger.withColumn("kept", ~fails(policy.mask))


def ablations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """``rule, n_failed, n_only``: the texts that fail each rule, and those that only this rule of the policy drops."""
    hit = F.col("failures").bitwiseAND(F.lit(policy.mask))
    combinations = ledger.groupBy(hit.alias("failures")).agg(F.count(F.lit(1)).alias("n"))
    bits = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(1 << list(RULES).index(rule)).alias("bit")) for rule in policy.rules
    ]))
    each = combinations.select("failures", "n", bits.alias("r")).select("failures", "n", "r.*")
    failed = F.col("failures").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failures") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )
