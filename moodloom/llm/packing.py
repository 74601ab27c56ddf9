"""Operator 6: token sequences of one length by first-fit decreasing in random groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import if_small, map_arrow, slices, texts_of
from moodloom.llm.encoder import FEW_WORDS, encoder
from moodloom.sources.staging import stage

LENGTH = 1024
# Pieces shorter than a sequence that are packed together.
GROUP_PIECES = 16_384
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


class Tournament:
    """Free space of bins in a tree of maxima; ``take`` finds the first bin with enough of it."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def take(self, size: int) -> tuple[int, int]:
        """The bin, and its free space before ``size`` is taken from it."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        chosen, before = node - self.leaves, free[node]
        free[node] = before - size
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
        return chosen, before


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length."""
    tree = Tournament(len(lengths), capacity)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bins[i], before = tree.take(lengths[i])
        offsets[i] = capacity - before
    return bins, offsets


def cut_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
    hold: bool = True,
) -> DataFrame:
    """Encode whole texts, append ``end_id``, and cut each into pieces of ``length`` ids and a rest.

    ``ids`` are little-endian unsigned 32-bit integers. A null or empty text is its end id alone. With ``hold`` a worker keeps
    some of the words it knows for its next task; else it remembers fewer, and their memory is free for what comes after.
    """
    end = np.array([end_id], "<u4").tobytes()

    def work(batches):
        known = encoder(tokenizer) if hold else encoder(tokenizer, FEW_WORDS)
        for batch in slices(batches, "text"):
            out = {"doc_id": [], "start": [], "length": [], "doc_tokens": [], "ids": []}
            texts = known.encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    for key, value in zip(out, (doc_id, start, len(piece) // 4, total, piece)):
                        out[key].append(value)
            yield out
        if hold:
            known.trim()
        else:
            encoder.cache_clear()

    return map_arrow(texts_of(docs, id_column, text_column), work, PIECES)


def pack_pieces(pieces: DataFrame, length: int = LENGTH, group: int = GROUP_PIECES, seed: int = 0) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``length``; other columns pass through.

    Pieces are dealt out by a hash of document and start, so that a task holds a random mix; each run of ``group``
    short pieces in hash order is packed by itself. A full piece is a sequence of its own.
    Inside a sequence the pieces lie without gaps from 0.
    """
    mixed = pieces.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "start"))
    dealt = mixed.repartition("_order").sortWithinPartitions("_order", "doc_id", "start")
    schema = pieces.schema.simpleString()[len("struct<") : -1]

    def work(batches):
        made = TaskContext.get().partitionId() << 40
        waiting, held = [], 0

        def placed(part):
            nonlocal made
            lengths = part.column("length").to_pylist()
            bins, offsets = first_fit_decreasing(lengths, length)
            columns = {name: part.column(name).combine_chunks() for name in pieces_columns}
            yield columns | {"sequence_id": [made + b for b in bins], "offset": offsets}
            made += max(bins, default=-1) + 1

        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            while held >= group:
                table = pa.Table.from_batches(waiting)
                yield from placed(table.slice(0, group))
                waiting, held = table.slice(group).to_batches(), held - group
        if held:
            yield from placed(pa.Table.from_batches(waiting))

    pieces_columns = pieces.columns
    return map_arrow(dealt, work, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, **columns) -> DataFrame:
    """Cut and pack whole documents; each row is a piece with its ids and its place in a sequence.

    Pieces are written once and placed by their lengths alone; their ids meet the places afterwards, row by row. Null and
    empty texts are their end id alone; repeated rows and ids are packed one by one; an empty table gives no row.
    """
    cut = cut_documents(docs, tokenizer, end_id, length, hold=False, **columns)
    pieces = stage(cut.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    placed = pack_pieces(pieces.drop("ids"), length).select("_piece", "sequence_id", "offset")
    return pieces.join(if_small(stage(placed, "places"), 32), "_piece").drop("_piece")
