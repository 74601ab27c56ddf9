"""Shared seeds of different texts: the first step of both substring operators.

A text is a row of symbols (bytes or words). A seed is a run of ``k`` symbols whose hash is the smallest of
``w`` neighbouring runs, so any two equal stretches of ``w + k - 1`` symbols hold the same seed at the same place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import give_back, if_small, map_arrow, slices, text_key
from moodloom.sources.staging import stage

BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be divided by
PLACE_BITS = 24
NO_ID = (1 << 63) - 1

# Seeds that a task gathers before it deals them out.
SEEDS_AT_ONCE = 500_000
# Symbols hashed in one go.
STRETCH = 1 << 20

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2 to the 64th."""
    if len(_powers.get("up", ())) < n:
        size = 1 << n.bit_length()
        for name, factor in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, factor, "u8")
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """``out[j] - out[i]``, divided by the i-th power, is the polynomial hash of symbols i to j."""
    sums = np.zeros(len(symbols) + 1, "u8")
    np.cumsum(symbols.astype("u8") * powers(len(symbols))[0], out=sums[1:])
    return sums


def window_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit hash of each run of ``k`` symbols; long texts are hashed stretch by stretch."""
    out = np.zeros(max(len(symbols) - k + 1, 0), "u8")
    for start in range(0, len(out), STRETCH):
        part = symbols[start : start + STRETCH + k - 1]
        sums = prefix_sums(part)
        h = (sums[k:] - sums[:-k]) * powers(len(part))[1][: len(part) - k + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out[start : start + STRETCH] = h ^ (h >> np.uint64(32))
    return out


def minimizer_places(hashes: np.ndarray, w: int) -> np.ndarray:
    """For each window of ``w`` hashes the place of the smallest, the first one of equals."""
    if len(hashes) < w:
        return np.zeros(0, "i8")
    if len(hashes) > 1 << PLACE_BITS:  # very long texts go in stretches that overlap by a window
        step, out = (1 << PLACE_BITS) - w, []
        for start in range(0, len(hashes) - w + 1, step):
            out.append(minimizer_places(hashes[start : start + step + w - 1], w) + start)
        return np.concatenate(out)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = (hashes & ~mask) | np.arange(len(hashes), dtype="u8")
    span = 1
    while 2 * span <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[: len(least) - (w - span)], least[w - span :])
    return (least & mask).astype("i8")


def order_of(id_column: str | Column) -> Column:
    """Ids as longs; rows without one come after all others."""
    return F.coalesce(F.col(id_column) if isinstance(id_column, str) else id_column, F.lit(NO_ID)).cast("long")


def repeated_texts(texts: DataFrame) -> DataFrame:
    """``text_id, owner`` of the texts that occur under several ids: the smallest of them."""
    owners = texts.groupBy(text_key().alias("text_id")).agg(
        F.min(order_of("doc_id")).alias("owner"), F.max(order_of("doc_id")).alias("last")
    )
    return stage(owners.where("owner < last").select("text_id", "owner"), "copies")


def shared_ids(texts: DataFrame) -> DataFrame:
    """``id, text_id, number`` of the rows whose id several texts have; numbers are negative."""
    pairs = texts.select(order_of("doc_id").alias("id"), text_key().alias("text_id"))
    several = pairs.groupBy("id").agg(F.min("text_id").alias("least"), F.max("text_id").alias("most")).where("least < most")
    several = stage(several.select("id"), "shared-ids")
    rows = pairs.join(if_small(several, 16), "id").distinct()
    return stage(rows.withColumn("number", -1 - F.monotonically_increasing_id()), "numbers")


@dataclass(frozen=True)
class Texts:
    """``rows``: ``doc_id, id, text_id, uid, owner, text``, where ``owner`` is the smallest id of the text.

    ``uid`` tells texts apart and is the id itself, unless different texts share an id: those have numbers below 0, so
    they count as earlier than all others where only ``uid`` decides. ``copies`` are the texts under several ids.
    """

    rows: DataFrame
    copies: DataFrame

    @property
    def units(self) -> DataFrame:
        """``uid, owner, text`` of each text once, under its smallest id; a repeated row comes again."""
        return self.rows.where("id = owner").select("uid", "owner", "text")


def numbered(texts: DataFrame) -> Texts:
    """Texts with their owners. Only what repeats is joined, so the texts themselves are seldom shuffled."""
    copies, numbers = repeated_texts(texts), shared_ids(texts)
    rows = texts.select("doc_id", order_of("doc_id").alias("id"), text_key().alias("text_id"), "text")
    rows = rows.join(if_small(copies, 96), "text_id", "left")
    if numbers.isEmpty():
        uid = F.col("id")
    else:
        rows = rows.join(if_small(numbers, 96), ["id", "text_id"], "left")
        uid = F.coalesce("number", "id")
    owner = F.coalesce("owner", "id").alias("owner")
    return Texts(rows.select("doc_id", "id", "text_id", uid.alias("uid"), owner, "text"), copies)


def dealt_seeds(units: DataFrame, symbols_of: Callable[[str], np.ndarray], k: int, w: int, parts: int) -> DataFrame:
    """The seeds of all texts, dealt out by hash into ``part``, in packed arrays of about ten bytes each."""

    def deal(batches):
        uids, found, held = [], [], 0

        def packed():
            hash_of, place = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            row = np.repeat(np.arange(len(uids)), [len(f[0]) for f in found])
            part = (hash_of >> np.uint64(32)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype="u8"))
            all_uids = np.array(uids, "i8")
            out = {"part": [], "uids": [], "counts": [], "hashes": [], "low": [], "high": []}
            for p in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                here = order[cuts[p] : cuts[p + 1]]
                used, counts = np.unique(row[here], return_counts=True)
                values = (
                    p, all_uids[used].tobytes(), counts.astype("u4").tobytes(), hash_of[here].astype("u4").tobytes(),
                    place[here].astype("u2").tobytes(), (place[here] >> 16).astype("u2").tobytes(),
                )
                for key, value in zip(out, values):
                    out[key].append(value)
            return out

        for batch in slices(batches, "text"):
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist()):
                hashes = window_hashes(symbols_of(text), k)
                chosen = minimizer_places(hashes, w)
                if len(chosen):
                    chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]
                    uids.append(uid)
                    found.append((hashes[chosen], chosen.astype("u4")))
                    held += len(chosen)
            if held >= SEEDS_AT_ONCE:
                yield packed()
                uids, found, held = [], [], 0
        if found:
            yield packed()

    return map_arrow(
        units.select("uid", "text"), deal, "part int, uids binary, counts binary, hashes binary, low binary, high binary"
    )


def sorted_seeds(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, uid and place of the seeds of a part, in this order."""

    def joined(name: str, dtype: str) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)

    uid = np.repeat(joined("uids", "i8"), joined("counts", "u4"))
    hash_of = joined("hashes", "u4")
    place = joined("low", "u2").astype("u4") | (joined("high", "u2").astype("u4") << np.uint32(16))
    order = np.lexsort((place, uid, hash_of))
    return hash_of[order], uid[order], place[order]


def shared_seeds(units: DataFrame, symbols_of: Callable[[str], np.ndarray], k: int, w: int, parts: int) -> DataFrame:
    """``uid, place, first_uid, first_place``: seeds that two different texts hold, each with its first place in the smallest ``uid``.

    A repeated unit is harmless.
    """

    def match(table: pa.Table) -> pa.Table:
        hash_of, uid, place = sorted_seeds(table)
        starts = np.flatnonzero(np.concatenate([[True], hash_of[1:] != hash_of[:-1]]))
        sizes = np.diff(np.append(starts, len(hash_of)))
        shared = uid[starts] != uid[starts + sizes - 1]
        first, mine = np.repeat(starts[shared], sizes[shared]), np.repeat(shared, sizes)
        columns = {"uid": uid[mine], "place": place[mine].astype("i8"), "first_uid": uid[first], "first_place": place[first].astype("i8")}
        return pa.table(columns)

    dealt = dealt_seeds(units, symbols_of, k, w, parts)
    return dealt.groupBy("part").applyInArrow(match, "uid long, place long, first_uid long, first_place long")


def shared_places(units: DataFrame, symbols_of: Callable[[str], np.ndarray], k: int, w: int, parts: int) -> DataFrame:
    """``uid, place, seed, kind``: every place of a seed that two different texts hold.

    ``kind`` adds up 1 for the first place in its text, 2 if a smaller ``uid`` holds the seed, and 4 if three or more do, so that
    ``earlier_seeds`` leaves some of them out. ``first_uid`` and ``last_uid`` are the first and the last of the smaller ``uid``, with the
    seed's first place in them; without any they are the text itself.
    """

    def match(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        hash_of, uid, place = sorted_seeds(table)
        new_hash = np.concatenate([[True], hash_of[1:] != hash_of[:-1]])
        new_text = new_hash | np.concatenate([[True], uid[1:] != uid[:-1]])
        turn, starts = np.cumsum(new_text), np.flatnonzero(new_hash)
        sizes = np.diff(np.append(starts, len(uid)))
        rank = turn - np.repeat(turn[starts], sizes)
        shared = np.repeat(uid[starts] != uid[starts + sizes - 1], sizes)
        first = np.repeat(starts, sizes)[shared]
        rank, turn = rank[shared], turn[shared]
        last = np.where(rank > 0, np.flatnonzero(new_text)[turn - 1 - (rank > 0)], first)
        out = {"uid": uid[shared], "place": place[shared].astype("i8"), "seed": (part << 32) + hash_of[shared].astype("i8")}
        out["kind"] = (new_text[shared] + 2 * (rank > 0) + 4 * (rank > 2)).astype("i4")
        for name, at in (("first", first), ("last", last)):
            out |= {f"{name}_uid": uid[at], f"{name}_place": place[at].astype("i8")}
        give_back()
        return pa.table(out)

    dealt = dealt_seeds(units, symbols_of, k, w, parts)
    columns = "uid long, place long, seed long, kind int, first_uid long, first_place long, last_uid long, last_place long"
    return dealt.groupBy("part").applyInArrow(match, columns)


def earlier_seeds(shared: DataFrame) -> DataFrame:
    """``uid, first_uid, places``: each place of ``shared_places`` beside the first and the last of the smaller ``uid`` that hold the seed.

    ``places`` holds that place in its upper and the seed's first place in the other text in its lower 32 bits. A seed that n texts
    hold has two rows for each of its places at most.
    """
    other = lambda name: F.struct(*[F.col(f"{name}_{c}").alias(c) for c in ("uid", "place")])
    both = F.array_distinct(F.array(other("first"), other("last")))
    rows = shared.where("kind >= 2").select("uid", "place", F.explode(both).alias("other"))
    places = F.shiftleft("place", 32).bitwiseOR(F.col("other.place"))
    return rows.select("uid", F.col("other.uid").alias("first_uid"), places.alias("places"))


def parts_for(total: int, per_part: int) -> int:
    return max(1, -(-int(total) // per_part))
