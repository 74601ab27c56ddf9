"""Labels and predictions for texts as they arrive (UDF-2, UDF-3 and ML-8 on a stream).

Each row is handled on its own: no state, no watermark. Only ``dedup_stream`` keeps state, bounded by a time
column that the caller names.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodloom.functions import rules, text
from moodloom.operators.classifier import score_texts
from moodloom.operators.cleaning import drop_null_text
from moodloom.operators.labeling import free_names, label_sentiment
from moodloom.sources.readers import TEXT, select_text


def dedup_stream(arriving: DataFrame, time_column: str, delay: str, text_column: str = TEXT) -> DataFrame:
    """AGG-4, AGG-5 on a stream: the first arrival of each text, with all its columns; null texts go.

    Texts are equal if they are once URL, line feeds and retweet prefix are gone, as in the batch job. A copy goes if it arrives
    within ``delay`` after the first one in event time, as the watermark on ``time_column`` tells; rows that come later than
    the watermark go too. The state holds one hash of 32 bytes for each different text of the last ``delay``.
    """
    key, *_ = free_names(arriving, "_text_key")
    texts = arriving.where(F.col(text_column).isNotNull() & F.col(time_column).isNotNull())
    keyed = texts.withColumn(key, F.unhex(F.sha2(text.original_text(text_column), 256)))
    return keyed.withWatermark(time_column, delay).dropDuplicatesWithinWatermark([key]).drop(key)


def score_stream(
    arriving: DataFrame,
    model: PipelineModel | None = None,
    text_column: str = "text",
    stop_words: Iterable[str] = rules.STOP_WORDS,
    **labeling,
) -> DataFrame:
    """Clean and label each text, and predict its class where a model is given."""
    texts = drop_null_text(select_text(arriving, text_column))
    cleaned = texts.select(text.normalize(text.original_text(TEXT), stop_words).alias(TEXT))
    labeled = label_sentiment(cleaned, **labeling)
    if model is None:
        return labeled
    scored = score_texts(model, labeled)
    return scored.select(*labeled.columns, "predicted_category")


def write_stream(scored: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append to a Parquet table, each row once, until the arrived texts are used up.

    A later call goes on where the last one stopped: the ``checkpoint`` lies beside the data unless named.
    """
    checkpoint = checkpoint or f"{path.rstrip('/')}/_checkpoint"
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
