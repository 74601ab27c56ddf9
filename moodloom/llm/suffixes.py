"""Operator 10: bytes that repeat an earlier document, by a hash-compared suffix sort.

Every string of ``LENGTH`` bytes holds a seed of ``K`` bytes that depends on its content alone, so equal strings
meet at their seed. Only stretches around seeds that two texts share are gathered. There the suffixes
are merge-sorted; two suffixes are compared by the length of their common extension, a binary search
over hashes of prefixes; and the bytes of neighbours that the hashes call equal are compared. All suffixes that agree in
``LENGTH`` bytes then lie together, and each learns the smallest document among them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import if_small, map_arrow, slices, texts_of
from moodloom.llm.seeds import (
    minimizer_places,
    numbered,
    parts_for,
    powers,
    prefix_sums,
    shared_seeds,
    window_hashes,
)
from moodloom.sources.staging import stage

LENGTH = 50
K = 20
# Text bytes per part of the seed exchange, and stretches per part of the suffix sort.
SEED_PART_BYTES = 8 * 1024 * 1024
STRETCHES_PER_PART = 12_000
# Stretches whose seeds are judged in one go; the stretches of one seed stay together.
JUDGED_AT_ONCE = 8_000
# Suffixes whose groups are sorted in one go; a larger group alone.
SORTED_AT_ONCE = 100_000
# Stretches that a task gathers before it deals them out.
STRETCHES_AT_ONCE = 100_000


def bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), "u1")


class Suffixes:
    """Comparison of suffixes of ``data``, which must reach ``length`` bytes beyond each suffix."""

    def __init__(self, data: np.ndarray, length: int) -> None:
        self.data, self.length = data, length
        self.sums = prefix_sums(data)
        self.down = powers(len(data) + 1)[1]
        self.steps = [1 << b for b in range(length.bit_length() - 1, -1, -1)]

    def hashes(self, at: np.ndarray, size) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.down[at]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension, up to ``length``."""
        found = np.zeros(len(a), "i8")
        for step in self.steps:
            fits = found + step <= self.length
            size = np.where(fits, step, 0)
            equal = fits & (self.hashes(a + found, size) == self.hashes(b + found, size))
            found += step * equal
        return found

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether suffix a comes before suffix b."""
        found = self.common(a, b)
        tied = found == self.length
        last = np.minimum(found, self.length - 1)
        return np.where(tied, or_equal, self.data[a + last] < self.data[b + last])

    def merge_sort(self, at: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sort each group of places: group i is ``at[start[i] : start[i] + size[i]]``, many groups at once."""
        out = at.copy()
        batch = (np.cumsum(size) - 1) // SORTED_AT_ONCE
        for few in np.split(np.arange(len(size)), np.flatnonzero(np.diff(batch)) + 1):
            if len(few):
                low, high = start[few[0]], start[few[-1]] + size[few[-1]]
                out[low:high] = self.merged(at[low:high], start[few] - low, size[few])
        return out

    def merged(self, at: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        at, width = at.copy(), 1
        while True:
            wide = size > width
            if not wide.any():
                return at
            start, size = start[wide], size[wide]
            group = np.repeat(np.arange(len(size)), size)
            local = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
            block = local // (2 * width) * (2 * width)
            middle = np.minimum(block + width, size[group])
            end = np.minimum(block + 2 * width, size[group])
            left = local < middle
            low, high = np.where(left, middle, block), np.where(left, end, middle)
            other = low.copy()
            base = start[group]
            mine = at[base + local]
            open_ = np.flatnonzero(low < high)
            while len(open_):
                mid = (low[open_] + high[open_]) // 2
                theirs = at[base[open_] + mid]
                # Equal suffixes of the left half stay before those of the right half.
                from_left = left[open_]
                ahead = np.empty(len(open_), bool)
                ahead[from_left] = self.before(theirs[from_left], mine[open_][from_left], False)
                ahead[~from_left] = self.before(theirs[~from_left], mine[open_][~from_left], True)
                low[open_] = np.where(ahead, mid + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            rank = np.where(left, local - block, local - middle) + (low - other)
            at[base + block + rank] = mine
            width *= 2

    def same_bytes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        same = np.ones(len(a), bool)
        for k in range(self.length):
            same &= self.data[a + k] == self.data[b + k]
        return same


def starts_of(changed: np.ndarray) -> np.ndarray:
    """Starts of the runs of a list, from the places where neighbours differ."""
    return np.flatnonzero(np.concatenate([[True], changed]))


def least_owners(data: np.ndarray, at: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """For each suffix at ``at`` the smallest owner of a suffix that begins with the same ``length`` bytes."""
    least = owner.copy()
    if not len(at):
        return least
    suffixes = Suffixes(data, length)
    whole = suffixes.hashes(at, length)
    order = np.argsort(whole, kind="stable")
    sizes = np.diff(np.append(starts_of(np.diff(whole[order]) != 0), len(order)))
    # A hash that stands alone has no equal string; equal strings have equal hashes.
    several = order[np.repeat(sizes > 1, sizes)]
    if not len(several):
        return least
    head = np.zeros(len(several), "u8")
    for k in range(8):
        head = (head << np.uint64(8)) | data[at[several] + k].astype("u8")
    several = several[np.argsort(head, kind="stable")]
    head.sort()
    start = starts_of(head[1:] != head[:-1])
    size = np.diff(np.append(start, len(head)))
    # The sort moves places; suffix numbers follow, as a place belongs to one suffix.
    number = np.full(len(data) + 1, -1, "i8")
    number[at] = np.arange(len(at))
    sorted_at = suffixes.merge_sort(at[several], start, size)
    equal = suffixes.common(sorted_at[:-1], sorted_at[1:]) == length
    equal[equal] = suffixes.same_bytes(sorted_at[:-1][equal], sorted_at[1:][equal])
    runs = starts_of(~equal)
    run_sizes = np.diff(np.append(runs, len(sorted_at)))
    which = number[sorted_at]
    least[which] = np.repeat(np.minimum.reduceat(owner[which], runs), run_sizes)
    return least


def least_of_places(data: np.ndarray, size: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """For each place of each stretch the smallest owner of its string; the stretches lie one after the other."""
    begin = np.cumsum(size) - size
    # Equal stretches are judged once, with the smallest owner among them.
    whole = Suffixes(data, length).hashes(begin, size)
    order = np.lexsort((owner, size, whole))
    same = (whole[order][1:] == whole[order][:-1]) & (size[order][1:] == size[order][:-1])
    for k in range(int(size.max())):
        at = np.flatnonzero(same)
        a, b = order[at], order[at + 1]
        inside = k < size[a]
        same[at[inside][data[begin[a[inside]] + k] != data[begin[b[inside]] + k]]] = False
    heads = starts_of(~same)
    class_of = np.empty(len(order), "i8")
    class_of[order] = np.cumsum(np.concatenate([[1], ~same])) - 1
    chosen = order[heads]
    spots = size[chosen] - length + 1
    offset = np.cumsum(spots) - spots
    at = np.repeat(begin[chosen] - offset, spots) + np.arange(spots.sum())
    owners = np.minimum.reduceat(owner[order], heads)
    least = least_owners(data, at, np.repeat(owners, spots), length)
    mine = size - length + 1
    k = np.arange(mine.sum()) - np.repeat(np.cumsum(mine) - mine, mine)
    return least[np.repeat(offset[class_of], mine) + k]


def pack_places(batches):
    """The places of each text in one compressed list of differences, about a byte each."""
    compress = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed, counts = [], []
        for row in batch.column("places"):
            places = np.unique(np.asarray(row.values)).astype("u4")
            packed.append(compress(np.diff(places, prepend=np.uint32(0)).view("u1").reshape(-1, 4).T.tobytes()))
            counts.append(len(places))
        yield {"uid": batch.column("uid"), "n": counts, "places": packed}


def unpacked(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "u1").reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(steps.T).view("u4").ravel(), dtype="i8")


def repeated_spans(units: DataFrame, total: int, length: int) -> DataFrame:
    """``uid, spans``: packed (start, end) pairs (u4) of bytes of a unit that repeat one with a smaller owner, unmerged."""
    w = length - K + 1
    seeds = shared_seeds(units, bytes_of, K, w, parts_for(total, SEED_PART_BYTES)).select("uid", "place")
    lists = seeds.groupBy("uid").agg(F.collect_list("place").alias("places"))
    places = stage(map_arrow(lists, pack_places, "uid long, n long, places binary"), "places")
    parts = parts_for(places.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], STRETCHES_PER_PART)
    small = if_small(places.drop("n"), F.octet_length("places") + 32)
    columns = (
        "part int, uids binary, owners binary, counts binary, firsts binary, which binary, seeds binary, sizes binary, "
        "data binary"
    )

    def cut(batches):
        rows, held = [], 0

        def dealt_out():
            row = np.repeat(np.arange(len(rows)), [len(r[3]) for r in rows])
            first, end, seed = (np.concatenate([r[i] for r in rows]) for i in (3, 4, 5))
            key = (seed >> np.uint64(32)) % np.uint64(parts)
            order = np.argsort(key, kind="stable")
            cuts = np.searchsorted(key[order], np.arange(parts + 1, dtype="u8"))
            out = {name.split()[0]: [] for name in columns.split(", ")}
            compress = zstandard.ZstdCompressor(level=1).compress
            for p in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                here = order[cuts[p] : cuts[p + 1]]
                used, counts = np.unique(row[here], return_counts=True)
                # Equal stretches of a task travel once.
                different: dict[bytes, int] = {}
                which = [
                    different.setdefault(rows[r][2][a:b].tobytes(), len(different))
                    for r, a, b in zip(row[here].tolist(), first[here].tolist(), end[here].tolist())
                ]
                heads = here[np.unique(which, return_index=True)[1]]
                values = (
                    p, np.array([rows[r][0] for r in used], "i8").tobytes(), np.array([rows[r][1] for r in used], "i8").tobytes(),
                    counts.astype("u4").tobytes(), first[here].astype("u4").tobytes(), np.array(which, "u4").tobytes(),
                    seed[heads].astype("u2").tobytes(), (end - first)[heads].astype("u2").tobytes(),
                    compress(b"".join(different)),
                )
                for name, value in zip(out, values):
                    out[name].append(value)
            return out

        for batch in slices(batches, "text"):
            for uid, owner, text, packed in zip(*(batch.column(c).to_pylist() for c in ("uid", "owner", "text", "places"))):
                data = bytes_of(text)
                found = window_hashes(data, K)
                chosen = minimizer_places(found, w)
                first = starts_of(chosen[1:] != chosen[:-1])
                last = np.append(first[1:], len(chosen)) - 1
                wanted = np.zeros(len(found), bool)
                wanted[unpacked(packed)] = True
                keep = wanted[chosen[first]]
                first, last = first[keep], last[keep]
                key = found[chosen[first]]
                if len(first):
                    rows.append((uid, owner, data, first, last + length, key))
                    held += len(first)
            if held >= STRETCHES_AT_ONCE:
                yield dealt_out()
                rows, held = [], 0
        if rows:
            yield dealt_out()

    with_places = units.join(small, "uid").select("uid", "owner", "text", "places")
    dealt = map_arrow(with_places, cut, columns)
    kind = pa.schema([("uid", pa.int64()), ("spans", pa.binary())])

    def match(table: pa.Table) -> pa.Table:
        def joined(name: str, dtype: str) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)

        expand = zstandard.ZstdDecompressor().decompress
        data = np.frombuffer(b"".join(map(expand, table.column("data").to_pylist())), "u1")
        counts, first = joined("counts", "u4"), joined("firsts", "u4").astype("i8")
        uid, owner = np.repeat(joined("uids", "i8"), counts), np.repeat(joined("owners", "i8"), counts)
        seed, size = joined("seeds", "u2"), joined("sizes", "u2").astype("i8")
        each = np.array([len(x) // 2 for x in table.column("sizes").to_pylist()])
        here = np.array([len(x) // 4 for x in table.column("which").to_pylist()])
        which = joined("which", "u4").astype("i8") + np.repeat(np.cumsum(each) - each, here)
        least_owner = np.full(len(size), np.iinfo("i8").max)
        np.minimum.at(least_owner, which, owner)
        # Seeds are handled a few at a time; all stretches of a seed have the same 16 bits of its hash.
        begin, order = np.cumsum(size) - size, np.argsort(seed, kind="stable")
        runs = starts_of(np.diff(seed[order].astype("i4")) != 0)
        lots = np.append(runs[1:], len(order)) // JUDGED_AT_ONCE
        by_stretch = np.argsort(which, kind="stable")
        uses = np.bincount(which, minlength=len(size))
        use_of = np.cumsum(uses) - uses
        texts, places, ends = [], [], []
        for lot in np.split(order, runs[1:][np.diff(lots) > 0]):
            length_of = size[lot]
            source = np.repeat(begin[lot] - (np.cumsum(length_of) - length_of), length_of) + np.arange(length_of.sum())
            least = least_of_places(data[source], length_of, least_owner[lot], length)
            spots = length_of - length + 1
            offset = np.cumsum(spots) - spots
            user = by_stretch[np.repeat(use_of[lot], uses[lot]) + np.arange(uses[lot].sum()) - np.repeat(np.cumsum(uses[lot]) - uses[lot], uses[lot])]
            place_in_lot = np.repeat(np.arange(len(lot)), uses[lot])
            for i in range(0, len(user), JUDGED_AT_ONCE):
                users, number = user[i : i + JUDGED_AT_ONCE], place_in_lot[i : i + JUDGED_AT_ONCE]
                mine = spots[number]
                row = np.repeat(np.arange(len(users)), mine)
                k = np.arange(mine.sum()) - np.repeat(np.cumsum(mine) - mine, mine)
                hit = least[offset[number][row] + k] < owner[users][row]
                row, k = row[hit], k[hit]
                if len(row):  # neighbouring places become one span
                    opens = starts_of((row[1:] != row[:-1]) | (k[1:] != k[:-1] + 1))
                    closes = np.append(opens[1:], len(row)) - 1
                    texts.append(uid[users][row[opens]])
                    places.append(first[users][row[opens]] + k[opens])
                    ends.append(first[users][row[closes]] + k[closes] + length)
        if not texts:
            return pa.Table.from_arrays([pa.array([], pa.int64()), pa.array([], pa.binary())], schema=kind)
        names, pairs = np.concatenate(texts), np.stack([np.concatenate(places), np.concatenate(ends)], axis=1).astype("u4")
        order = np.argsort(names, kind="stable")
        names, pairs = names[order], pairs[order]
        cuts = starts_of(names[1:] != names[:-1])
        ends = np.append(cuts[1:], len(names))
        return pa.Table.from_arrays(
            [pa.array(names[cuts]), pa.array([pairs[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())], schema=kind
        )

    return dealt.groupBy("part").applyInArrow(match, "uid long, spans binary")


def merged(packed: list[bytes]) -> np.ndarray:
    """Maximal spans of (start, end) pairs; touching ones are joined."""
    pairs = np.frombuffer(b"".join(packed), "u4").reshape(-1, 2).astype("i8")
    if not len(pairs):
        return pairs
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    first = starts_of(pairs[1:, 0] > reach[:-1])
    return np.stack([pairs[first, 0], reach[np.append(first[1:], len(pairs)) - 1]], axis=1)


def merge_spans(batches):
    for batch in batches:
        spans = [merged(packed).astype("u4").tobytes() for packed in batch.column("spans").to_pylist()]
        yield {"uid": batch.column("uid"), "spans": spans}


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, removed, kept`` of each row.

    A byte is removed if a string of ``length`` bytes over it begins in a document with a smaller id too, judged on the input.
    ``removed`` are the maximal (start, end) byte spans, ``kept`` the other bytes. A text with copies is judged
    once, for its smallest id; its later copies lose all bytes if they have ``length`` or more. Rows with equal ids never take
    bytes from each other; rows without an id come after all others. Null texts are empty; other columns are ignored.
    """
    if not 32 <= length <= 200:
        raise ValueError("length must be between 32 and 200")
    texts = texts_of(docs, id_column, text_column)
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    known = numbered(texts)
    found = repeated_spans(known.units.where(F.octet_length("text") >= length), total, length)
    lists = found.groupBy("uid").agg(F.collect_list("spans").alias("spans"))
    spans = stage(map_arrow(lists, merge_spans, "uid long, spans binary"), "spans")
    rows = known.rows.join(if_small(spans, F.octet_length("spans") + 32), "uid", "left").select("doc_id", "id", "owner", "text", "spans")
    kind = dict(texts.dtypes)["doc_id"]

    def cut(batches):
        for batch in slices(batches, "text"):
            out = {"doc_id": batch.column("doc_id"), "n_bytes": [], "removed": [], "kept": []}
            columns = (batch.column(c).to_pylist() for c in ("id", "owner", "text", "spans"))
            for order, owner, text, packed in zip(*columns):
                data = text.encode()
                if order > owner and len(data) >= length:
                    gone = [(0, len(data))]
                else:
                    gone = np.frombuffer(packed or b"", "u4").reshape(-1, 2).tolist()
                ends = [0, *(end for _, end in gone)]
                out["kept"].append(b"".join(data[a:b] for a, b in zip(ends, [*(start for start, _ in gone), len(data)])))
                out["n_bytes"].append(len(data))
                out["removed"].append([{"start": a, "end": b} for a, b in gone])
            yield out

    return map_arrow(rows, cut, f"doc_id {kind}, n_bytes long, removed array<struct<start:bigint,end:bigint>>, kept binary")
