"""Sentiment analytics for large collections of short texts, on Spark DataFrames."""

from moodloom.functions.polarity import sentiment_category
from moodloom.functions.text import clean_text, remove_stopwords
from moodloom.operators.classifier import score_texts, sentiment_classifier, train_and_evaluate
from moodloom.operators.cleaning import clean_tweets
from moodloom.operators.labeling import label_sentiment
from moodloom.sources.readers import merge_sources, read_text

__all__ = [
    "clean_text",
    "clean_tweets",
    "label_sentiment",
    "merge_sources",
    "read_text",
    "remove_stopwords",
    "score_texts",
    "sentiment_category",
    "sentiment_classifier",
    "train_and_evaluate",
]
