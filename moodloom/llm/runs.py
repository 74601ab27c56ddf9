"""Operator 11: stretches of words that repeat themselves with a period, found by a dictionary of basic factors.

Every stretch of 1, 2, 4, ... words gets a name, equal stretches the same one; the name of a stretch is that of its two
halves. A stretch whose next equal one begins within its own length, so that both lie in a window of twice the
length, proposes the distance as a period. Places in a row that propose one period are one run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from moodloom.llm.common import map_arrow, slices, texts_of

MIN_WORDS = 6
MIN_EXPONENT = 4


def proposals(names: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Rows of start, length and period: places in a row whose next equal stretch is equally far away, ``length`` at most.

    ``places`` are sorted by name and then by place.
    """
    same = names[places[1:]] == names[places[:-1]]
    distance = np.where(same, places[1:] - places[:-1], 0)
    near = (distance > 0) & (distance <= length)
    at, period = places[:-1][near], distance[near]
    order = np.argsort(at)
    at, period = at[order], period[order]
    if not len(at):
        return np.zeros((0, 3), "i8")
    breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(period) != 0)) + 1
    first, last = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(at)]]) - 1
    return np.stack([at[first], at[last] - at[first] + length + period[first], period[first]], axis=1)


def periodic_runs(symbols: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows of start, length and smallest period of the maximal runs, by start and then period.

    A run has at least ``min_words`` symbols and ``min_exponent`` (3 or more) times its period; negative symbols equal none.

    A run of period q shows at the length L with q <= L < 2q: there a stretch inside it has its next equal one exactly q
    further on, since a stretch as long as the period fixes its place within it. So the places of the run are those in a
    row that propose q, from its first word on, and neither end can be extended. Longer stretches propose it again.
    """
    if min_exponent < 3:
        raise ValueError("runs under three periods do not show at every length")
    n, length, found = len(symbols), 1, []
    names = np.where(symbols >= 0, symbols, -1).astype("i8")
    places = np.flatnonzero(names >= 0)
    keys = names[places]
    while True:
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], places[order]
        changes = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        number = np.cumsum(changes) - 1
        several = np.bincount(number, minlength=1)[number] > 1  # a stretch that comes once is in no longer one that repeats
        places, number = places[several], number[several]
        if not len(places):
            break
        names = np.full(n, -1, "i8")
        names[places] = number
        found.append(proposals(names, places, length))
        left = np.sort(places[places + length < n])
        right = names[left + length]
        places = left[right >= 0]
        keys = names[places] * (int(number[-1]) + 1) + right[right >= 0]
        length *= 2
    if not found:
        return np.zeros((0, 3), "i8")
    rows = np.concatenate(found)
    rows = rows[rows[:, 1] >= np.maximum(min_words, min_exponent * rows[:, 2])]
    return np.unique(rows[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def numbered_words(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers that are equal only within a text, -1 after each text; and where the texts begin."""
    parts, begins, used, at = [], [], 0, 0
    for words in texts:
        number = dict.fromkeys(words)
        number.update(zip(number, range(used, used + len(number))))
        parts.append(np.fromiter(map(number.__getitem__, words), "i8", len(words)))
        parts.append(np.array([-1]))
        begins.append(at)
        used, at = used + len(number), at + len(words) + 1
    return np.concatenate(parts), np.array(begins)


def find_runs(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_exponent: int = MIN_EXPONENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row of ``docs``; other columns are ignored.

    Words are separated by ASCII white space. ``runs`` are structs of ``start`` (number of a word), ``length`` and ``period``
    in that order of start and period: maximal stretches of at least ``min_words`` words and ``min_exponent`` periods, with their smallest
    period. ``collapsed`` is the text without the words that any run holds after its first period, joined by spaces. Null,
    empty and short texts have no run; a null text counts as empty. Equal rows are judged one by one. Ids may
    be of any type, missing or repeated. Nothing is shuffled; a text is handled whole, whatever its length.
    """
    texts = texts_of(docs, id_column, text_column)

    def work(batches):
        for batch in slices(batches, "text"):
            texts = [text.split() for text in batch.column("text").cast(pa.binary()).to_pylist()]
            symbols, begins = numbered_words(texts)
            rows = periodic_runs(symbols, min_words, min_exponent)
            owner = np.searchsorted(begins, rows[:, 0], side="right") - 1
            drop = np.zeros(len(symbols) + 1, "i8")
            np.add.at(drop, rows[:, 0] + rows[:, 2], 1)
            np.add.at(drop, rows[:, 0] + rows[:, 1], -1)
            kept = np.cumsum(drop) == 0
            collapsed = [b" ".join(words) for words in texts]
            for i in np.unique(owner).tolist():
                words, begin = texts[i], int(begins[i])
                collapsed[i] = b" ".join([words[j] for j in np.flatnonzero(kept[begin : begin + len(words)]).tolist()])
            places = [rows[:, 0] - begins[owner], rows[:, 1], rows[:, 2]]
            ends = np.searchsorted(owner, np.arange(len(texts) + 1)).astype("i4")
            structs = pa.StructArray.from_arrays([pa.array(p) for p in places], ["start", "length", "period"])
            yield {
                "doc_id": batch.column("doc_id"),
                "n_words": [len(words) for words in texts],
                "runs": pa.ListArray.from_arrays(pa.array(ends), structs),
                "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
            }

    kind = texts.schema["doc_id"].dataType.simpleString()
    run = "struct<start: bigint, length: bigint, period: bigint>"
    return map_arrow(texts, work, f"doc_id {kind}, n_words long, runs array<{run}>, collapsed string")
