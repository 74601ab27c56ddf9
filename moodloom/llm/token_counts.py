"""Operator 9: token counts of whole texts, lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import map_arrow, slices, texts_of
from moodloom.llm.encoder import encoder

# A text longer than this is counted in parts.
LONG_TEXT = 64 * 1024
# Bytes that go to the encoder at once.
BATCH_BYTES = 1024 * 1024
# A piece never begins before white space that follows something else, nor spans it.
SAFE_CUT = regex.compile(r"(?<=[!-~])[ \n](?=[!-~])")


def safe_parts(text: str, size: int = LONG_TEXT) -> list[str]:
    """Parts of at least ``size`` characters whose tokens add up to those of ``text``.

    Cut before a space or line feed between visible ASCII characters. No word piece and no added
    token without white space runs over such a place. A text without one stays whole.
    """
    parts, start = [], 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        parts.append(text[start : cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


def balanced(sizes: list[int], limit: int) -> Iterator[slice]:
    """Runs of parts with at most ``limit`` bytes each, or one part."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield slice(first, i)
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield slice(first, len(sizes))


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 512,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row, in one pass without a shuffle.

    No begin, end or added special tokens; an added token inside a text counts as the file says.
    Null and empty texts have 0 tokens, a null id stays, repeated rows stay, other columns are ignored.
    """

    def work(batches):
        encode = encoder(tokenizer).encode
        for batch in slices(batches, "text"):
            parts, owners = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                cut = safe_parts(text) if encoder(tokenizer).by_words else [text]
                parts += cut
                owners += [row] * len(cut)
            lengths = []
            for run in balanced([len(p.encode()) for p in parts], BATCH_BYTES):
                lengths += [len(ids) // 4 for ids in encode(parts[run])]
            tokens = np.bincount(owners, lengths, batch.num_rows).astype("i8")
            yield {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": tokens}

    rows = texts_of(docs, id_column, text_column)
    sized = rows.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    kind = dict(rows.dtypes)["doc_id"]
    counted = map_arrow(sized, work, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
