import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodloom.functions import rules, text


@pytest.fixture
def apply(texts):
    def run(step, value):
        return texts([value]).select(step(F.col("text"))).first()[0]

    return run


@pytest.mark.parametrize(
    ("step", "value", "expected"),
    [
        (text.strip_urls, "see https://t.co/abc123 now", "see  now"),
        (text.strip_urls, "httpx and HTTP://x", " and HTTP://x"),
        (text.strip_urls, "http://x.y\u00a0tail end", " end"),
        (text.newline_to_space, "first line\nsecond\r\nthird", "first line second\r third"),
        (text.strip_retweet_prefix, "RT @WHO: Stay safe", "Stay safe"),
        (text.strip_retweet_prefix, "thanks RT @WHO: ok", "thanks RT @WHO: ok"),
        (text.strip_retweet_prefix, "RT @a: RT @b: x", "RT @b: x"),
        (text.strip_retweet_prefix, "RT @a:x", "RT @a:x"),
        (text.strip_retweet_prefix, "rt @a: x", "rt @a: x"),
        (text.strip_retweet_prefix, "RT @café: hi", "RT @café: hi"),
        (text.lowercase, "RISING Été", "rising été"),
        (text.strip_non_alnum, "a-b_c \u00e9 \U0001f600!\tz", "a b c" + 5 * " " + "\tz"),
        (text.original_text, "http://u RT @a: x", " RT @a: x"),
        (text.original_text, "\nRT @a: x", " RT @a: x"),
        (text.clean_text, "RT @bakery_7: Fresh Rye", "fresh rye"),
        (text.clean_text, "Timetable http://rail.example/x?y=1 Page", "timetable  page"),
        (text.clean_text, "Left\n\nRight", "left  right"),
        (text.remove_stopwords, "a crane lifts the beam and a pipe", "crane lifts beam pipe"),
        (text.remove_stopwords, "THE Tide and The moon", "Tide moon"),
        (text.remove_stopwords, "", ""),
        (text.remove_stopwords, " a\u00a0b the\x1cc ", "b c"),
    ],
)
def test_step(apply, step, value, expected):
    assert apply(step, value) == expected


@pytest.mark.parametrize(
    "step",
    [
        text.strip_urls,
        text.newline_to_space,
        text.strip_retweet_prefix,
        text.clean_text,
        text.remove_stopwords,
        text.normalize,
    ],
)
def test_null_stays_null(texts, step):
    assert texts([None, "x"]).select(step("text").alias("t")).where("t is null").count() == 1


def test_cleaned_words(apply):
    assert apply(text.split_words, "Boeing-747 Lands") == ["boeing-747", "lands"]
    words = lambda c: text.split_words(text.clean_text(c))
    assert apply(words, "Boeing-747 Lands?") == ["boeing", "747", "lands", ""]
    assert apply(text.cleaned_words, "") == []
    assert apply(text.cleaned_words, "a  b ") == ["a", "b"]


def test_full_chain(apply):
    raw = "RT @port: The ferry is late;\nsee http://harbour.example/7"
    chain = lambda c: text.remove_stopwords(text.clean_text(c))
    assert apply(chain, raw) == "ferry late see"


def test_own_stop_words(texts):
    kept = texts(["the cat sat"]).select(text.remove_stopwords("text", ["cat"])).first()[0]
    assert kept == "the sat"


AWKWARD = [
    "",
    " ",
    "...",
    "The the THE",
    "a\tb\x0bc\x0cd\re",
    "\u0130stanbul \u212a the",
    "don't http://x.y/z?q=1 stop\nhttps://a",
    "RT @u_1: RT @b: The end—of it",
    "naïve café \U0001f600\U0001f600 42",
    "x\u0085y\u00a0z\u2003w\u3000v",
    "UPPER lower MiXeD 0x1F",
    "e\u0301 combined",
    "tail of",
    "." * 5000 + "x" * 5000,
]


def test_normalize_is_the_chain_in_one_split(texts):
    originals = texts(AWKWARD).select("text", text.original_text("text").alias("o"))
    both = originals.select(
        "text",
        text.normalize("o").alias("fused"),
        text.remove_stopwords(text.strip_non_alnum(text.lowercase("o"))).alias("stepwise"),
    )
    assert both.where("fused <> stepwise").count() == 0


def brute_force(value):
    """The same rules, one text at a time."""
    value = re.sub(rules.URL, "", value).replace("\n", " ")
    value = re.sub(rules.RETWEET_PREFIX, "", value).lower()
    words = re.findall(r"[a-z0-9]+", value)
    return " ".join(w for w in words if w not in rules.STOP_WORDS)


# ASCII, where both regex dialects agree; without the four controls that only Python calls spaces.
PIECES = ["RT @who: ", "http", "https://t.co/", "\n", "\t", " ", "the", "The ", "of", "a", "Zz", "9", "-", ":", "!"]
LETTERS = st.characters(max_codepoint=126, exclude_characters="\x1c\x1d\x1e\x1f")
TEXTS = st.lists(st.one_of(st.sampled_from(PIECES), st.text(LETTERS, max_size=4)), max_size=12).map("".join)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXTS, min_size=50, max_size=200, unique=True))
def test_against_brute_force(texts, values):
    rows = texts(values).select("text", text.normalize(text.original_text("text"))).collect()
    assert {row[0]: row[1] for row in rows} == {value: brute_force(value) for value in values}


def test_stop_list_is_whole():
    assert len(rules.STOP_WORDS) == len(set(rules.STOP_WORDS)) == 29
