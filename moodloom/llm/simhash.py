"""Operator 5: near duplicates by SimHash, compared in bit-sliced blocks.

Different fingerprints are gathered by bands of their bits. Inside the buckets of a band they are held as bit
planes: word w of plane b holds bit b of 64 fingerprints. One pass over the planes adds up the distances of a
fingerprint to 64 others at once in carry-save counters, and drops the blocks that are all beyond the radius.

With 64 bits and a small radius, the ``radius + 1`` bands of ``EXACT`` lose no pair: one of them is equal. Texts that share
four fifths of their shingles differ in about a seventh of the bits, which no such bands reach; ``WIDE`` takes 256 bits for them,
whose distance is a sharper estimate, and 42 bands of 12 bits, one of which nearly all such pairs share (a band of 12 with 14 in 100). There the
distance only proposes: with ``similarity`` the shingles of the linked texts are compared. Pairs that no band or the radius loses, as it does
where texts have few shingles, are found by ``missed_edges``: similar texts share one of their rarest shingles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import if_small, map_arrow, slices, text_key, texts_of
from moodloom.llm.seeds import parts_for
from moodloom.sources.staging import stage

RADIUS = 2
SHINGLE = 3
SEED = 42
# Fingerprints compared in one go, and planes between two looks at the counters.
BLOCK = 16_384
LOOK = 16
# A band value with more fingerprints than this is divided: of an exact scheme by bands of the remaining bits, else into
# blocks of half as many, each of which meets each other block in a bucket of its own.
LARGE_BUCKET = 4_096
# ``part`` is the smallest node of a group that close pairs of the bucket join; -1 until they are known.
BUCKET = ["band", "key", "sub", "sub_key", "part"]
BUCKET_TYPES = "band int, key long, sub int, sub_key long, part long"
# Each round of judged links takes so many times the forests of the round before.
MORE_FORESTS = 4
# Shingles that so many texts hold, of one in ``LOOKED_AT``, are looked up after all others; the most frequent ones up to a number.
FREQUENT = 4
LOOKED_AT = 32
MOST_FREQUENT = 200_000
# The most by which a bit of two texts differs that share four fifths of their shingles, by the smaller number of these: four of five,
# and the angle between them with some room.
MOST_CHANCE = {0: 0.1875, 16: 0.16}
# Shingles gathered before they are dealt out, those of a part, and pairs looked at in one go.
PREFIXES_AT_ONCE = 500_000
PREFIXES_A_PART = 500_000
PAIRS_AT_ONCE = 1 << 20
# Odd factors that make further hashes of a hash, for fingerprints of more than 64 bits.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class Scheme:
    """``words`` of 64 bits, linked at ``radius`` differing bits or fewer, gathered by ``bands`` of ``band_bits``.

    With ``sets`` the bits are those of the different shingles, else a shingle counts as often as it occurs.
    """

    words: int
    radius: int
    bands: int
    band_bits: int
    exact: bool
    sets: bool = False

    def band(self, i: int) -> list[int]:
        if self.exact:  # all bits, in as many bands as must leave one equal
            return [b for b in range(64 * self.words) if b * self.bands // (64 * self.words) == i]
        across = 64 * self.words // self.band_bits
        if i < across:  # neighbouring bits
            return list(range(i * self.band_bits, (i + 1) * self.band_bits))
        return [i - across + k * across for k in range(self.band_bits)]  # each bit once more, beside others


EXACT = Scheme(1, RADIUS, RADIUS + 1, 0, True)
# Similarity 0.8 over shingles is an angle of 27 degrees, so 39 of 256 bits, give or take 6; 56 is three such errors above.
WIDE = Scheme(4, 56, 42, 12, False, True)


def shingle_hashes(text: str, size: int, seed: int) -> np.ndarray:
    """XXH64 of each word shingle; fewer words than ``size`` are one shingle."""
    words = text.encode().lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1)
    n = max(len(words) - size + 1, 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[min(size, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], "<u8")


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes; none: 0."""
    counts = np.zeros(64, "i8")
    for first in range(0, len(hashes), 1 << 15):
        part = hashes[first : first + (1 << 15)].view("u1").reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, size: int = SHINGLE, seed: int = SEED, words: int = 1, sets: bool = False) -> list[int]:
    """``words`` times 64 bits, each set if it is set in over half of the hashes of the word shingles (``sets``: of the different ones)."""
    hashes = shingle_hashes(text, size, seed)
    return print_of(np.unique(hashes) if sets else hashes, words)


def print_of(hashes: np.ndarray, words: int) -> list[int]:
    """The fingerprint of a text with these hashes of shingles."""
    out = [majority(hashes)]
    for factor in FACTORS[: words - 1]:
        mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(factor)
        out.append(majority(mixed ^ (mixed >> np.uint64(32))))
    return out


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def columns_of(words: int) -> list[str]:
    return ["fp", "fp1", "fp2", "fp3"][:words]


def add_fingerprints(
    docs: DataFrame, size: int = SHINGLE, seed: int = SEED, words: int = 1, sets: bool = False, similarity: float | None = None
) -> DataFrame:
    """``doc_id``, ``text_key`` and the bits as longs ``fp``, ``fp1`` ... of each row with ``doc_id`` and ``text``.

    With ``similarity`` also the number of different ``shingles`` and those of its ``prefix``.
    """
    names = columns_of(words)
    frequent = None if similarity is None else frequent_shingles(docs, size, seed)
    docs = docs.withColumn("text_key", text_key())

    def work(batches):
        for batch in slices(batches, "text"):
            hashes = [shingle_hashes(text, size, seed) for text in batch.column("text").to_pylist()]
            different = [np.unique(h) for h in hashes] if sets or similarity is not None else hashes
            prints = [print_of(h, words) for h in (different if sets else hashes)]
            out = {c: batch.column(c) for c in ("doc_id", "text_key")} | {n: [signed(p[i]) for p in prints] for i, n in enumerate(names)}
            if similarity is not None:
                out |= {"shingles": [len(h) for h in different], "prefix": [prefix(h, frequent, similarity).view("<i8") for h in different]}
            yield out

    more = ", shingles int, prefix array<long>" * (similarity is not None)
    return map_arrow(docs, work, "doc_id long, text_key string, " + ", ".join(f"{n} long" for n in names) + more)


def frequent_shingles(texts: DataFrame, size: int, seed: int) -> np.ndarray:
    """Sorted hashes of shingles that many texts hold, as a part of the texts tells.

    They decide only which shingles are looked up first, as rare ones have few partners. Every link is found with any of them, or none.
    """

    def work(batches):
        held: list[np.ndarray] = []

        def counted():
            hashes, n = np.unique(np.concatenate(held), return_counts=True)
            return {"h": hashes.view("<i8"), "n": n}

        for batch in slices(batches, "text"):
            held += [np.unique(shingle_hashes(text, size, seed)) for text in batch.column("text").to_pylist()]
            if sum(map(len, held)) > PREFIXES_AT_ONCE:
                yield counted()
                held = []
        if held:
            yield counted()

    part = texts.where(F.pmod(F.xxhash64("text"), F.lit(LOOKED_AT)) == 0).select("text")
    counts = map_arrow(part, work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    found = counts.orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).select("h").toArrow().column("h").to_numpy()
    return np.sort(found.astype("<i8").view("<u8"))


def prefix(hashes: np.ndarray, frequent: np.ndarray, similarity: float) -> np.ndarray:
    """The first of the different ``hashes`` in an order that all texts share, so many that similar texts have one in common.

    Of n shingles, two texts share at least ``similarity * n``, so one of any n less that, and one more. Those not ``frequent`` come first.
    """
    n = len(hashes)
    if not n:
        return hashes
    at = np.minimum(np.searchsorted(frequent, hashes), max(len(frequent) - 1, 0))
    often = frequent[at] == hashes if len(frequent) else np.zeros(n, bool)
    return np.concatenate([hashes[~often], hashes[often]])[: n - int(np.ceil(similarity * n - 1e-9)) + 1]


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """``planes[b, w]``: bit b of the fingerprints 64 w to 64 w + 63; the last word is filled with the last one."""
    blocks = -(-len(prints) // 64)
    padded = np.concatenate([prints, np.repeat(prints[-1:], blocks * 64 - len(prints), axis=0)])
    bits = np.unpackbits(padded.view("u1").reshape(len(padded), -1), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """The lanes whose counter is greater than ``radius``, compared from the highest bit plane down."""
    more, equal = over.copy(), ~over
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            more |= equal & counters[k]
            equal &= ~counters[k]
    return more


def close_pairs(prints: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of fingerprints of one bucket at ``radius`` or fewer differing bits.

    ``prints`` has a row per fingerprint and a column per 64 bits; ``bucket`` numbers the buckets in order, so a bucket is a
    run of rows. A row meets the blocks of 64 rows that its bucket reaches, from its own block on.
    """
    planes = bit_planes(prints)
    last = np.searchsorted(bucket, bucket, side="right") - 1
    own = np.arange(len(prints)) // 64
    reach = last // 64 - own + 1
    rows = np.repeat(np.arange(len(prints)), reach)
    blocks = own[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(reach) - reach, reach)
    counters = [np.zeros(len(rows), "u8") for _ in range(radius.bit_length())]
    over = np.zeros(len(rows), "u8")
    for bit in range(len(planes)):
        ones = (prints[rows, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
        carry = planes[bit, blocks] ^ (np.uint64(0) - ones)
        for k in range(len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if bit % LOOK == LOOK - 1:
            live = beyond(counters, over, radius) != ~np.uint64(0)
            if not live.all():
                rows, blocks, over = rows[live], blocks[live], over[live]
                counters = [c[live] for c in counters]
                if not len(rows):
                    break
    near = (~beyond(counters, over, radius)).astype("<u8").view("u1").reshape(-1, 8)
    at, lane = np.nonzero(np.unpackbits(near, axis=1, bitorder="little"))
    i, j = rows[at], blocks[at] * 64 + lane
    inside = (j > i) & (j <= last[i])
    return i[inside], j[inside]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of n places in a link, the smallest place that links lead to: at most n edges."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            places = np.flatnonzero(root != np.arange(n))
            return places, root[places]


def shortest_tree(n: int, left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of the links, n - 1 at most, that join all that the links join, shorter ones first (Boruvka's rounds)."""
    order = np.lexsort((right, left, length))
    left, right, root, chosen = left[order], right[order], np.arange(n), np.zeros(len(order), bool)
    while True:
        open_links = np.flatnonzero(root[left] != root[right])
        if not len(open_links):
            return order[chosen]
        best = np.full(n, len(order))
        np.minimum.at(best, root[left[open_links]], open_links)
        np.minimum.at(best, root[right[open_links]], open_links)
        chosen[best[best < len(order)]] = True
        places, roots = forest(n, left[chosen], right[chosen])
        root = np.arange(n)
        root[places] = roots


def bits_key(bits: list[int], names: list[str]):
    """The values of some bits of a fingerprint as one long; contiguous bits of a word are taken at once."""
    key, taken = F.lit(0).cast("long"), 0
    while bits:
        run = 1
        while run < len(bits) and bits[run] == bits[0] + run and bits[run] // 64 == bits[0] // 64:
            run += 1
        part = F.shiftrightunsigned(names[bits[0] // 64], bits[0] % 64).bitwiseAND(F.lit((1 << run) - 1))
        key = key.bitwiseOR(F.shiftleft(part, taken))
        bits, taken = bits[run:], taken + run
    return key


def gathered(prints: DataFrame, scheme: Scheme = EXACT) -> DataFrame:
    """The rows of ``prints`` (a ``node`` for each different fingerprint, and its bits) for each bucket they share with others.

    A large bucket of an exact scheme is divided by bands of the other bits, one of which linked pairs share too. One of another
    scheme is cut into blocks, and each two blocks meet in a bucket of at most about ``LARGE_BUCKET`` rows, so no pair is lost.
    """
    names = columns_of(scheme.words)
    all_bits = range(64 * scheme.words)

    def keys(df, kind, bands):
        made = F.array(*[F.struct(F.lit(i).alias(kind[0]), bits_key(bits, names).alias(kind[1])) for i, bits in bands])
        return df.select("*", F.explode(made).alias("k")).select(*df.columns, "k.*")

    keyed = keys(prints, ("band", "key"), [(i, scheme.band(i)) for i in range(scheme.bands)])
    sizes = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = keyed.join(if_small(stage(sizes, "buckets"), 64), ["band", "key"])
    whole, part = [F.lit(0).alias("sub"), F.lit(0).cast("long").alias("sub_key")], F.lit(-1).cast("long").alias("part")
    ready = shared.where(F.col("n") <= LARGE_BUCKET).drop("n").select("*", *whole)
    if not scheme.exact:
        large = shared.where(F.col("n") > LARGE_BUCKET).withColumn("blocks", F.ceil(2 * F.col("n") / LARGE_BUCKET))
        own = F.pmod(F.xxhash64("node"), "blocks").alias("own")
        met = large.select("*", own).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        pair = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
        ready = ready.unionByName(met.select(*prints.columns, "band", "key", F.lit(1).alias("sub"), pair.alias("sub_key")))
        return ready.select("*", part)
    for i in range(scheme.bands):
        rest = [b for b in all_bits if b not in scheme.band(i)]
        count = scheme.radius + 1
        parts = [(j + 1, rest[j * len(rest) // count : (j + 1) * len(rest) // count]) for j in range(count)]
        large = shared.where((F.col("band") == i) & (F.col("n") > LARGE_BUCKET)).drop("n")
        ready = ready.unionByName(keys(large, ("sub", "sub_key"), parts))
    return ready.select("*", part)


def near_edges(ready: DataFrame, scheme: Scheme = EXACT, judged: DataFrame | None = None, forests: int = 1) -> DataFrame:
    """``a, b``: edges of ``node`` whose components are those of all pairs that meet in a bucket of ``ready`` and are close.

    With ``judged`` (``a, b, held`` and the bucket) each edge is itself a close pair that still needs a judgement, with its bucket and
    part: pairs judged there, and those that held pairs join, are passed over. The shortest forest of the others is taken, then the
    shortest of the rest, ``forests`` times. If that leaves pairs of a part untaken, its rows come too, with ``a`` equal to ``b`` and
    their bits: all that a later look at the part needs, and far less than the buckets.
    """
    names = columns_of(scheme.words)
    real, of_bucket, bits = judged is not None, slice(1, len(BUCKET) + 1), len(BUCKET) + 1
    rows = ready.select("node", *BUCKET, *names, F.lit(0).alias("kind"))
    if real:
        links = {"node": F.col("a"), names[0]: F.col("b"), names[1]: F.col("held").cast("long"), "kind": F.lit(1)}
        links |= {n: F.lit(0).cast("long") for n in names[2:]}
        rows = rows.unionByName(judged.select(*BUCKET, *[value.alias(n) for n, value in links.items()]))
    in_order = rows.repartition(*BUCKET).sortWithinPartitions(*BUCKET, "kind", "node")

    def work(batches):
        held: list[np.ndarray] = []  # the rows since the last end of a bucket, and whole buckets before them

        def edges(rows):
            """Of a run of rows; a bucket beyond ``BLOCK`` rows is compared as a whole."""
            number = np.cumsum(np.concatenate([[0], (rows[1:, of_bucket] != rows[:-1, of_bucket]).any(axis=1)]))
            is_node = rows[:, -1] == 0
            links, link_number = rows[~is_node], number[~is_node]
            rows, number = rows[is_node], number[is_node]
            prints = np.ascontiguousarray(rows[:, bits:-1]).view("u8")
            left, right = close_pairs(prints, number, scheme.radius)
            if not real:
                places, roots = forest(len(rows), left, right)
                return {"a": rows[places, 0], "b": rows[roots, 0]}
            part = np.arange(len(rows))
            places, roots = forest(len(rows), left, right)
            part[places] = roots
            length = np.bitwise_count(prints[left] ^ prints[right]).sum(axis=1, dtype="i8")
            nodes, compact = np.unique(rows[:, 0], return_inverse=True)
            place_of = number * len(nodes) + compact
            one, two = (np.searchsorted(place_of, link_number * len(nodes) + np.searchsorted(nodes, links[:, c])) for c in (0, bits))
            good = links[:, bits + 1] == 1
            root = np.arange(len(rows))
            places, roots = forest(len(rows), one[good], two[good])
            root[places] = roots
            known = np.minimum(one, two) * len(rows) + np.maximum(one, two)
            wanted = (root[left] != root[right]) & ~np.isin(left * len(rows) + right, known)
            left, right, length = left[wanted], right[wanted], length[wanted]
            taken = np.zeros(len(left), bool)
            for _ in range(forests):
                rest = np.flatnonzero(~taken)
                if not len(rest):
                    break
                taken[rest[shortest_tree(len(rows), root[left[rest]], root[right[rest]], length[rest])]] = True
            again = np.flatnonzero(np.isin(part, part[left[~taken]]))
            left, right = left[taken], right[taken]
            low, high = np.sort([rows[left, 0], rows[right, 0]], axis=0)
            at = np.concatenate([left, again])
            out = {"a": np.concatenate([low, rows[again, 0]]), "b": np.concatenate([high, rows[again, 0]])}
            out |= {c: rows[at, i + 1] for i, c in enumerate(BUCKET)} | {"part": rows[part[at], 0]}
            return out | {n: rows[at, bits + i] for i, n in enumerate(names)}

        for batch in batches:
            held.append(np.stack([np.asarray(batch.column(c)).astype("i8") for c in ("node", *BUCKET, *names, "kind")], axis=1))
            if sum(map(len, held)) < BLOCK:
                continue
            rows = np.concatenate(held)
            changes = np.flatnonzero((rows[1:, of_bucket] != rows[:-1, of_bucket]).any(axis=1)) + 1
            if len(changes):
                yield edges(rows[: changes[-1]])
                held = [rows[changes[-1] :]]
            else:
                held = [rows]
        if held:
            yield edges(np.concatenate(held))

    return map_arrow(in_order, work, "a long, b long" + f", {BUCKET_TYPES}, {' long, '.join(names)} long" * real)


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: each node of an edge, and the smallest node that edges lead to.

    Large-star and small-star steps in turn, until the edges are stars. Each step is written to the shared folder,
    and each joins a node to its smallest neighbour only, so no list of neighbours is gathered.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = stage(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stage(large, "large-star")
        parent = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(parent, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.unionByName(parent.select("a", F.col("m").alias("b"))).distinct()
        now = stage(small, "small-star")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def shingle_sets(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """``a, b, first`` and the sorted different ``hashes`` of the word shingles of each row's ``text``."""

    def work(batches):
        for batch in slices(batches, "text"):
            sets = [np.unique(shingle_hashes(text, size, seed)).view("<i8") for text in batch.column("text").to_pylist()]
            yield {c: batch.column(c) for c in ("a", "b", "first")} | {"hashes": sets}

    return map_arrow(docs, work, "a long, b long, first boolean, hashes array<long>")


def judged_edges(edges: DataFrame, different: DataFrame, texts: DataFrame, size: int, seed: int, similarity: float) -> DataFrame:
    """``a, b, held``: whether the texts of an edge share ``similarity`` or more of their different shingles (Jaccard).

    A text goes to its edges, and the two texts of an edge meet by the edge, so a node with many edges makes no hot group.
    """
    both = F.array(F.struct(F.col("a").alias("node"), F.lit(True).alias("first")), F.struct(F.col("b").alias("node"), F.lit(False).alias("first")))
    ends = edges.select("a", "b", F.explode(both).alias("end")).select("a", "b", "end.*")
    ends = stage(ends.join(different.select("node", "sample.*"), "node").drop("node"), "edge-ends")
    keyed = texts.withColumn("text_key", text_key()).withColumnRenamed("doc_id", "id")
    same = F.col("text_key").eqNullSafe(F.col("key")) & F.col("id").eqNullSafe(F.col("doc_id"))
    found = keyed.join(if_small(ends.withColumnRenamed("text_key", "key"), 64), same).select("a", "b", "first", "text")
    sets = shingle_sets(found, size, seed).groupBy("a", "b").agg(
        F.max(F.when(F.col("first"), F.col("hashes"))).alias("x"), F.max(F.when(~F.col("first"), F.col("hashes"))).alias("y")
    )
    shared = F.size(F.array_intersect("x", "y"))
    return sets.select("a", "b", (shared >= similarity * (F.size("x") + F.size("y") - shared)).alias("held"))


def similar_edges(
    prints: DataFrame, scheme: Scheme, different: DataFrame, texts: DataFrame, size: int, seed: int, similarity: float
) -> DataFrame:
    """``a, b, held``: judged edges; the components of those that held are those of all similar texts that meet in a bucket and are close.

    Links are judged in rounds. A part of a bucket is done when all links it asked for held, as they join what its close pairs join, or
    when all its close pairs were asked for. The others ask again, for the shortest links between what their held links leave
    apart, ``MORE_FORESTS`` times as many forests as before. Each pair is judged once. A later round reads the rows of the open parts only.
    """
    names = columns_of(scheme.words)
    ready = stage(gathered(prints, scheme), "gathered")
    asked = ready.sparkSession.createDataFrame([], f"a long, b long, {BUCKET_TYPES}, held boolean")  # by the parts that are not done
    known = asked.select("a", "b", "held")
    forests = 1
    while True:
        found = stage(near_edges(ready, scheme, asked, forests), "proposed")
        new = found.where("a <> b").drop(*names)
        pairs = stage(new.select("a", "b").distinct().join(known.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        held = stage(judged_edges(pairs, different, texts, size, seed, similarity).where("held"), "held")
        known = known.unionByName(pairs.join(held, ["a", "b"], "left").select("a", "b", F.coalesce("held", F.lit(False)).alias("held")))
        known = stage(known, "known")
        rows = found.where("a = b").select(F.col("a").alias("node"), *names, *BUCKET)
        unfinished = rows.select(*BUCKET).distinct()
        asked = asked.unionByName(new.join(known, ["a", "b"]).select(asked.columns)).join(unfinished, BUCKET, "left_semi")
        asked = stage(asked, "asked")
        failed = known.where("not held").select("a", "b")
        open_parts = new.join(unfinished, BUCKET, "left_semi").join(failed, ["a", "b"], "left_semi").select(*BUCKET).distinct()
        open_parts = stage(open_parts, "open-parts")
        if open_parts.isEmpty():
            return known
        small = if_small(open_parts, 40)
        ready = stage(rows.join(small, BUCKET, "left_semi"), "open-rows")  # else each round would repeat the joins before it
        asked = asked.join(small, BUCKET, "left_semi")
        forests *= MORE_FORESTS


def dealt_prefixes(rows: DataFrame, parts: int) -> DataFrame:
    """The shingles of all prefixes dealt out by hash into ``part``, in packed arrays; ``rows`` has ``node, root, shingles, prefix``."""

    def work(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def packed():
            hashes, row = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            nodes, roots, sizes = (np.concatenate([h[i] for h in held]) for i in (2, 3, 4))
            row = row + np.repeat(np.cumsum([0, *(len(h[2]) for h in held[:-1])]), [len(h[1]) for h in held])
            part = ((hashes >> np.uint64(32)) % np.uint64(parts)).astype("i8")
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            out = {"part": [], "low": [], "nodes": [], "roots": [], "sizes": []}
            for p in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                here = order[cuts[p] : cuts[p + 1]]
                at = row[here]
                values = (p, hashes[here].astype("u4"), nodes[at], roots[at], sizes[at].astype("u4"))
                for key, value in zip(out, values):
                    out[key].append(value if key == "part" else value.tobytes())
            return out

        for batch in batches:
            prefixes = batch.column("prefix")
            row = np.repeat(np.arange(batch.num_rows), prefixes.value_lengths().to_numpy())
            held.append((prefixes.flatten().to_numpy().view("u8"), row, *(np.asarray(batch.column(c)).astype("i8") for c in ("node", "root", "shingles"))))
            if sum(len(h[1]) for h in held) >= PREFIXES_AT_ONCE:
                yield packed()
                held = []
        if held:
            yield packed()

    return map_arrow(rows.select("node", "root", "shingles", "prefix"), work, "part int, low binary, nodes binary, roots binary, sizes binary")


def pairs_of_prefixes(dealt: DataFrame, parts: int, similarity: float) -> DataFrame:
    """``a, b, least``: nodes of different roots with a shingle in both prefixes, the smaller number of shingles of the two.

    The numbers of shingles of the two allow the similarity.
    """

    def pairs(rows: list[dict]):
        low, nodes, roots, sizes = (
            np.frombuffer(b"".join(r[c] for r in rows), kind) for c, kind in (("low", "u4"), ("nodes", "i8"), ("roots", "i8"), ("sizes", "u4"))
        )
        order = np.lexsort((nodes, roots, low))
        low, nodes, roots, sizes = (c[order] for c in (low, nodes, roots, sizes))
        new = low[1:] != low[:-1]
        ends = np.append(np.flatnonzero(new) + 1, len(low))  # of the rows of a shingle, and of those of one root
        root_ends = np.append(np.flatnonzero(new | (roots[1:] != roots[:-1])) + 1, len(low))
        at = np.arange(len(low))
        first = root_ends[np.searchsorted(root_ends, at, side="right")]
        counts = ends[np.searchsorted(ends, at, side="right")] - first
        total = np.cumsum(counts)
        start = 0
        while start < len(counts):
            stop = max(int(np.searchsorted(total, total[start] - counts[start] + PAIRS_AT_ONCE, side="right")), start + 1)
            n = counts[start:stop]
            one = np.repeat(np.arange(start, stop), n)
            two = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n) + first[one]
            fits = np.minimum(sizes[one], sizes[two]) >= similarity * np.maximum(sizes[one], sizes[two]) - 1e-6
            one, two = one[fits], two[fits]
            ends_of = np.sort(np.stack([nodes[one], nodes[two]], axis=1), axis=1)
            found, chosen = np.unique(ends_of, axis=0, return_index=True)
            yield {"a": found[:, 0], "b": found[:, 1], "least": np.minimum(sizes[one], sizes[two])[chosen]}
            start = stop

    def work(batches):
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield from pairs(held)
                    held = []
                held.append(row)
        if held:
            yield from pairs(held)

    in_order = dealt.repartition(parts, "part").sortWithinPartitions("part")
    return map_arrow(in_order, work, "a long, b long, least long").distinct()


def far_apart(bits: int, chance: float) -> int:
    """So many bits differ by a chance of about one in a million millions, where each differs by ``chance``."""
    return int(np.ceil(bits * chance + 7 * np.sqrt(bits * chance * (1 - chance))))


def missed_edges(
    prints: DataFrame, different: DataFrame, known: DataFrame, roots: DataFrame, texts: DataFrame, scheme: Scheme, size: int, seed: int,
    similarity: float,
) -> DataFrame:
    """``a, b``: the edges between different ``roots`` whose texts are similar and not in ``known``, whether they share a band or not.

    Two similar texts have a shingle of their prefixes in common, so texts meet by these and are compared, if their fingerprints are
    not so far apart that they cannot be similar: from 0.8 on each bit of two texts differs by a chance of ``MOST_CHANCE`` at most.
    """
    nodes = different.select("node", "sample.*").join(if_small(roots, 32), "node", "left").select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "node", F.coalesce("root", "node").alias("root")
    )
    same = F.col("text_key").eqNullSafe(F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id"))
    rows = prints.select("doc_id", "text_key", "shingles", "prefix").join(if_small(stage(nodes, "nodes"), 88), same)
    total = prints.agg(F.coalesce(F.sum(F.size("prefix").cast("long")), F.lit(0))).first()[0]
    parts = parts_for(total, PREFIXES_A_PART)
    pairs = pairs_of_prefixes(dealt_prefixes(rows, parts), parts, similarity)
    names, distance = columns_of(scheme.words), F.lit(0)
    bits = if_small(different.select("node", *names), 16 + 8 * len(names))
    for end in "ab":
        pairs = pairs.join(bits.select(F.col("node").alias(end), *[F.col(n).alias(f"{end}_{n}") for n in names]), end)
    for n in names:
        distance += F.bit_count(F.col(f"a_{n}").bitwiseXOR(F.col(f"b_{n}")))
    reach = F.lit(64 * scheme.words)
    for least, chance in MOST_CHANCE.items() if similarity >= 0.8 else ():
        reach = F.when(F.col("least") >= least, far_apart(64 * scheme.words, chance)).otherwise(reach)
    pairs = pairs.where(distance <= reach).select("a", "b").join(known.select("a", "b"), ["a", "b"], "left_anti")
    pairs = stage(pairs, "missed-pairs")
    return stage(judged_edges(pairs, different, texts, size, seed, similarity).where("held").select("a", "b"), "missed")


def near_duplicates(
    docs: DataFrame,
    scheme: Scheme = EXACT,
    size: int = SHINGLE,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float | None = None,
    whole: bool = False,
) -> DataFrame:
    """``doc_id``, ``text_key``, its bits (``fp`` ...) and ``component_id``, the smallest id that links lead to, for each row.

    With ``similarity`` a link between different fingerprints holds only if their texts share so much of their shingles. Close
    pairs are compared until those that held join all that hold. With ``whole`` no similar pair is missed, in a band or not (``far_apart``);
    texts with equal fingerprints count as one.

    Null, empty and wordless texts have fingerprint 0 and are linked like any other. Rows without an id keep a null id;
    they link others but never name a component unless all of it lacks ids. Repeated rows each keep their row.
    """
    names = columns_of(scheme.words)
    texts = texts_of(docs, id_column, text_column)
    whole = whole and similarity is not None
    prints = stage(add_fingerprints(texts, size, seed, scheme.words, scheme.sets, similarity if whole else None), "fingerprints")
    groups = prints.groupBy(*names).agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"), F.min(F.struct("doc_id", "text_key")).alias("sample")
    )
    different = stage(groups.withColumn("node", F.monotonically_increasing_id()), "different")
    bits = different.select("node", *names)
    if similarity is None:
        edges = near_edges(gathered(bits, scheme), scheme)
    else:
        known = similar_edges(bits, scheme, different, texts, size, seed, similarity)
        edges = known.where("held").select("a", "b")
    roots = components(edges)
    if whole:
        missed = missed_edges(prints, different, known, roots, texts, scheme, size, seed, similarity)
        if not missed.isEmpty():
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(missed))
    rooted = different.drop("sample").join(if_small(roots, 32), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stage(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = stage(rooted.join(named, "root").select(*names, "rows", "component_id"), "named")
    small = if_small(of_print, 32 + 8 * len(names))
    if small is not of_print:
        return prints.join(small.drop("rows"), names).select("doc_id", "text_key", *names, "component_id")
    # Fingerprints with one in 1,000 rows or more, a thousand at most, meet their rows by broadcast; the rest by shuffle.
    total = of_print.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    hot = F.broadcast(of_print.where(F.col("rows") * 1_000 >= total).drop("rows"))
    of_hot = prints.join(hot, names)
    others = prints.join(hot, names, "left_anti").join(of_print.drop("rows"), names)
    return of_hot.unionByName(others).select("doc_id", "text_key", *names, "component_id")
