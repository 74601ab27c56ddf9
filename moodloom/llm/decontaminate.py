"""Operator 4: benchmark passages in documents, by a prefix-filtered join of word shingles.

A benchmark item is cut into windows of ``WINDOW`` words (a shorter item is one window). A document holds a
window only if it holds each of its shingles, so the rarest one alone, counted over all documents,
brings the candidates: the prefix of exact containment has length one. Bounds on place and length
and a comparison of all words decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.llm.common import held, if_small, text_key, texts_of
from moodloom.sources.staging import stage

WINDOW = 10
SHINGLE = 3
# Everything ASCII that is no digit or letter; these classes are tests of one table, ranges are not.
GAP = r"[\p{ASCII}&&\P{Alnum}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: str | Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: str | Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), GAP), "")


def shingle_hashes(words: str, size: int) -> Column:
    """A hash of each run of ``size`` words."""

    def hashed(word: Column, i: Column) -> Column:
        return F.xxhash64(word, *[F.get(F.col(words), i + k) for k in range(1, size)])

    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (size - 1), F.lit(0))), hashed)


def item_windows(benchmark: DataFrame, id_column: str, text_column: str, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """The different windows with their words, and which items hold them."""
    items = texts_of(benchmark, id_column, text_column).select(
        F.col("doc_id").cast("string").alias("item_id"), held(words_of("text")).alias("item_words")
    )
    items = items.where(F.size("item_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("item_words") - (window - 1), F.lit(1)))
    cut = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("item_words", s, window))).alias("window_words"))
    keyed = cut.select("item_id", "window_words", F.sha2(F.concat_ws(" ", "window_words"), 256).alias("window_id"))
    of_items = stage(keyed.distinct(), "windows")
    windows = of_items.select("window_id", "window_words", F.size("window_words").alias("window_size")).distinct()
    size = F.least(F.lit(shingle), F.col("window_size"))
    return windows.withColumn("shingle_size", size), of_items.select("window_id", "item_id")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items, text_id``.

    ``spans`` are the hit windows as (first word, words) and ``items`` the ids as sorted strings. Null and empty texts have
    no words and no hits; an empty benchmark hits nothing; items without words are passed over. Repeated rows
    each get their row; other columns are ignored.
    """
    windows, of_items = item_windows(benchmark, item_column, item_text_column, window, shingle)
    windows = stage(windows, "windows")
    sizes = sorted(row[0] for row in windows.select("shingle_size").distinct().collect())  # 1 to ``shingle``
    texts = texts_of(docs, id_column, text_column)
    words = texts.select("doc_id", text_key().alias("text_id"), held(words_of("text")).alias("words"))

    parts = [
        windows.where(F.col("shingle_size") == size).select(
            "*", F.posexplode(shingle_hashes("window_words", size)).alias("offset", "hash")
        )
        for size in sizes
    ]
    if parts:
        shingles = parts[0]
        for more in parts[1:]:
            shingles = shingles.unionByName(more)
        hits = window_hits(words, windows, stage(shingles, "shingles"), sizes)
    else:
        hits = words.where(F.lit(False)).select(
            "doc_id", "text_id", F.lit(0).alias("first"), F.lit("").alias("window_id"), F.lit(0).alias("window_size")
        )
    hits = stage(hits, "hits")

    key = ["doc_id", "text_id"]
    spans = hits.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("first", "window_size"))).alias("spans"))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def cover(so_far: Column, span: Column) -> Column:
        end = F.greatest(so_far["end"], span["first"] + span["window_size"])
        return F.struct((so_far["n"] + end - F.greatest(so_far["end"], span["first"])).alias("n"), end.alias("end"))

    covered = F.aggregate("spans", start, cover)["n"].cast("long").alias("n_hit")
    small = if_small(of_items, F.octet_length("item_id") + 128)
    items = (
        hits.select(*key, "window_id").distinct().join(small, "window_id")
        .groupBy(*key).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    found = stage(
        spans.alias("l").join(items.alias("r"), same).select("l.doc_id", "l.text_id", "spans", covered, "items"), "found"
    )
    n_words = F.size(F.array_remove(F.split("text", GAP), "")).cast("long")
    base = texts.select("doc_id", text_key().alias("text_id"), n_words.alias("n_words"))
    found = if_small(found, 24 * F.size("spans") + 40 * F.size("items") + 128)
    joined = base.alias("l").join(found.alias("r"), same, "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "l.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "spans",
        "items",
        "l.text_id",
    )


def window_hits(words: DataFrame, windows: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """``doc_id, text_id, first, window_id, window_size``: each place where a document holds a window."""
    wanted = stage(shingles.select("hash").distinct(), "hashes")
    # The lists are made first: a generator over a plain column runs in one piece with the join.
    hashes = words.select(F.concat(*[shingle_hashes("words", size) for size in sizes]).alias("hashes"))
    counts = hashes.select(F.explode("hashes").alias("hash")).join(if_small(wanted, 64), "hash").groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts, "frequencies")
    # A window with a shingle that no document holds drops out; of the others the rarest shingle is kept.
    ranked = shingles.join(if_small(counts, 64), "hash", "left")
    rarest = ranked.groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("rare")
    )
    prefixes = rarest.where(F.col("rare.n") > 0).select("window_id", "rare.hash", "rare.offset")
    prefixes = prefixes.join(windows, "window_id")
    prefixes = stage(prefixes.withColumnRenamed("hash", "prefix"), "prefixes")
    small = if_small(prefixes, F.octet_length(F.concat_ws(" ", "window_words")) + 16 * F.size("window_words") + 256)
    if small is prefixes:
        return verified_places(words, windows, prefixes, sizes)
    placed = []
    for size in sizes:
        lists = words.select("doc_id", "text_id", "words", shingle_hashes("words", size).alias("hashes"))
        each = lists.select("doc_id", "text_id", "words", F.posexplode("hashes").alias("place", "hash"))
        first = F.col("place") - F.col("offset")
        of_size = small.where(F.col("shingle_size") == size) if len(sizes) > 1 else small
        same_words = F.slice("words", F.greatest(first, F.lit(0)) + 1, F.col("window_size")) == F.col("window_words")
        inside = (first >= 0) & (first + F.col("window_size") <= F.size("words"))
        hit = each.join(of_size, (F.col("hash") == F.col("prefix")) & inside & same_words)
        placed.append(hit.select("doc_id", "text_id", first.alias("first"), "window_id", "window_size"))
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def verified_places(words: DataFrame, windows: DataFrame, prefixes: DataFrame, sizes: list[int]) -> DataFrame:
    """The same for prefixes too many to broadcast: only hashes and places go to the join, no document's words.

    The places that a prefix proposes are gathered by document, where each takes its few words, which then meet those of the window.
    """
    key = ["doc_id", "text_id"]
    known = prefixes.select("prefix", "offset", "window_id", "window_size", "shingle_size")
    proposed = None
    for size in sizes:
        each = words.select(*key, F.size("words").alias("n"), shingle_hashes("words", size).alias("hashes"))
        each = each.select(*key, "n", F.posexplode("hashes").alias("place", "hash"))
        first = F.col("place") - F.col("offset")
        inside = (first >= 0) & (first + F.col("window_size") <= F.col("n"))
        of_size = known.where(F.col("shingle_size") == size)
        met = each.join(of_size.hint("shuffle_merge"), (F.col("hash") == F.col("prefix")) & inside)
        met = met.select(*key, F.struct(first.alias("first"), "window_id", "window_size").alias("at"))
        proposed = met if proposed is None else proposed.unionByName(met)
    lists = stage(proposed.groupBy(*key).agg(F.collect_set("at").alias("at")), "proposed-places")
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"p.{c}")) for c in key]
    placed = words.alias("w").join(lists.alias("p"), same).select("w.doc_id", "w.text_id", "words", F.explode("at").alias("at"))
    taken = F.slice("words", F.col("at.first") + 1, F.col("at.window_size")).alias("taken")
    placed = placed.select(*key, "at.*", taken)
    whole = windows.select(F.col("window_id").alias("id"), "window_words").dropDuplicates(["id"])
    found = placed.join(whole, (F.col("window_id") == F.col("id")) & (F.col("taken") == F.col("window_words")))
    return found.select(*key, "first", "window_id", "window_size")
