"""Operator 3: token ids in files, each document compressed alone with a shared dictionary.

The folder holds two Parquet tables. ``dictionary`` has one row: the zstandard dictionary, its SHA-256
and the bytes per id. A row of ``blocks`` is a run of documents in ascending order of id: their ids,
token counts and offsets, and the compressed frames one after the other. The ids at both ends of a
block let a reader skip all other blocks, and the offset leads to the one frame.
"""

from __future__ import annotations

import hashlib

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodloom.llm.common import if_small, map_arrow, slices, texts_of
from moodloom.llm.encoder import encoder

# The dictionary is trained on about so many documents, and on this many bytes of each at most. It decides the
# size of the files only.
SAMPLE_DOCUMENTS = 2_000
SAMPLE_BYTES = 16 * 1024
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
BLOCK_BYTES = 1024 * 1024
BLOCK_DOCUMENTS = 1024

BLOCKS = (
    "part int, block int, dictionary string, first_id long, last_id long, start long, tokens long, "
    "doc_ids array<long>, n_tokens array<long>, offsets array<long>, frames binary"
)


def narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def widen(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def encoded(batch, tokenizer: str, end_id: int) -> list[bytes]:
    end = np.array([end_id], "<u4").tobytes()
    return [ids + end for ids in encoder(tokenizer).encode(batch.column("text").to_pylist())]


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> bytes:
    """A zstandard dictionary from the serialized ids of documents drawn by a hash of their ids and texts."""
    total = docs.count()
    drawn = F.pmod(F.xxhash64(F.lit(7), "doc_id", "text"), F.lit(1 << 30)) * total < SAMPLE_DOCUMENTS << 30

    def work(batches):
        for batch in slices(batches, "text"):
            yield {"ids": [narrow(x, width)[:SAMPLE_BYTES] for x in encoded(batch, tokenizer, end_id)]}

    sample = [bytes(row["ids"]) for row in map_arrow(docs.where(drawn), work, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # too few or too small samples: their content serves as it is
        return b"".join(sample)[:DICTIONARY_BYTES]


def shared(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if len(dictionary) >= 8 else {}


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode each whole text, append ``end_id`` and write the folder ``path``.

    The texts are sorted by id in one range shuffle (nulls first, equal ids by text). Null texts are
    empty and hold the end id alone. Repeated rows are written as often as they occur. Ids are whole numbers; an empty table gives
    a folder without blocks. A reader that meets a block of another dictionary ends with an error.
    """
    spark = docs.sparkSession
    rows = texts_of(docs, id_column, text_column)
    width = 2 if max(encoder(tokenizer).library.get_vocab_size() - 1, end_id) < 1 << 16 else 4
    dictionary = train_dictionary(rows, tokenizer, end_id, width)
    name = hashlib.sha256(dictionary).hexdigest()

    def work(batches):
        part, block, total = TaskContext.get().partitionId(), 0, 0
        compress = zstandard.ZstdCompressor(level=LEVEL, **shared(dictionary)).compress
        doc_ids, counts, frames, held = [], [], [], 0

        def row():
            ends = np.cumsum([len(f) for f in frames])
            known = [i for i in doc_ids if i is not None]
            return {
                "part": [part], "block": [block], "dictionary": [name],
                "first_id": [min(known, default=None)], "last_id": [max(known, default=None)],
                "start": [total], "tokens": [sum(counts)], "doc_ids": [doc_ids], "n_tokens": [counts],
                "offsets": [[0, *ends[:-1].tolist()]], "frames": [b"".join(frames)],
            }

        for batch in slices(batches, "text"):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded(batch, tokenizer, end_id)):
                frame = compress(narrow(ids, width))
                doc_ids.append(doc_id)
                counts.append(len(ids) // 4)
                frames.append(frame)
                held += len(frame)
                if held >= BLOCK_BYTES or len(frames) >= BLOCK_DOCUMENTS:
                    yield row()
                    block, total = block + 1, total + sum(counts)
                    doc_ids, counts, frames, held = [], [], [], 0
        if frames:
            yield row()

    spark.createDataFrame([(name, dictionary, width)], "dictionary string, content binary, width int").write.parquet(
        f"{path}/dictionary"
    )
    in_order = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_arrow(in_order, work, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_blocks(blocks: DataFrame, spark: SparkSession, path: str, wanted: int | None = None) -> DataFrame:
    head = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, width = bytes(head["content"]), head["width"]
    if hashlib.sha256(dictionary).hexdigest() != head["dictionary"]:
        raise ValueError(f"{path} holds another dictionary than it names")

    def work(batches):
        expand = zstandard.ZstdDecompressor(**shared(dictionary)).decompress
        for batch in slices(batches, "frames"):
            for row in batch.to_pylist():
                if row["dictionary"] != head["dictionary"]:
                    raise ValueError(f"{path} holds blocks of another dictionary: {row['dictionary']}")
                start = row["start"]
                ends = [*row["offsets"][1:], len(row["frames"])]
                out = {"part": [], "doc_id": [], "start": [], "n_tokens": [], "ids": []}
                held = 0
                for doc_id, count, first, last in zip(row["doc_ids"], row["n_tokens"], row["offsets"], ends):
                    if wanted is None or doc_id == wanted:
                        ids = widen(expand(row["frames"][first:last]), width)
                        for key, value in zip(out, (row["part"], doc_id, start, count, ids)):
                            out[key].append(value)
                        held += len(ids)
                    start += count
                    if held >= 4 * BLOCK_BYTES:
                        yield out
                        out, held = {key: [] for key in out}, 0
                yield out

    return map_arrow(blocks, work, "part int, doc_id long, start long, n_tokens long, ids binary")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of each document in the folder; ``start`` counts the ids before it."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")  # one row per written file
    parts = if_small(sizes.select("part", before.alias("before")), 16)
    read = read_blocks(blocks, spark, path).join(parts, "part")
    return read.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The ids of one document: other blocks are skipped by their ends, other frames by the offsets."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    near = blocks.where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    return read_blocks(near, spark, path, doc_id).select("doc_id", "n_tokens", "ids")
