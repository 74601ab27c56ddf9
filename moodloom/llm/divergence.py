"""Operator 12: how far the sources of a language differ in their terms, by chunk factorization.

Texts are cut at white space into chunks. A block of documents counts each of its chunks per document; each chunk of the
whole collection is cut into terms once; the terms join the counts of their chunks again, and blocks add up documents and
occurrences of terms. Only terms that enough documents could hold take part in that join.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodloom.llm.common import if_small, map_arrow
from moodloom.sources.staging import stage, staging_path

MIN_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
SHARES = 1_000_000_000
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
# Text and documents of a block; a longer text is a block of its own. Numbers of documents fit in two bytes.
BLOCK_BYTES = 32 * 1024 * 1024
BLOCK_DOCS = 1 << 16
ROWS_AT_ONCE = 50_000
# Joined rows that are packed together; blocks whose postings of a term meet in one task; about the postings of such a task.
PACK_ROWS = 400_000
LOT_BLOCKS = 64
BUCKET_BYTES = 3 * 1024 * 1024
# Shares of terms that are compared in one task, and sources compared there with all others.
CELLS = 200_000
TILE = 256


def counted_chunks(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The chunks of some texts, the end of each one's postings, and the postings: number of the text, times.

    Times are 255 at most; a chunk that a text holds more often has several postings for it.
    """
    number: dict[bytes, int] = defaultdict(count().__next__)
    parts = []
    for text in texts:
        chunks = text.split()
        parts.append(np.fromiter(map(number.__getitem__, chunks), "i8", len(chunks)))
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    keys, times = np.unique(np.concatenate(parts) * BLOCK_DOCS + owner, return_counts=True)
    pieces = -(-times // 255)
    last = np.cumsum(pieces) - 1
    keys = np.repeat(keys, pieces)
    small = np.full(len(keys), 255, "u1")
    small[last] = times - 255 * (pieces - 1)
    ends = np.searchsorted(keys, (np.arange(len(number)) + 1) * BLOCK_DOCS)
    return list(number), ends, (keys % BLOCK_DOCS).astype("<u2"), small


def binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The runs of ``values`` that end at ``ends``, as binary strings."""
    offsets = np.concatenate([[0], ends]).astype("i4") * values.itemsize
    buffers = [None, pa.py_buffer(offsets.astype("i4").tobytes()), pa.py_buffer(values.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers)


def count_chunks(docs: DataFrame) -> DataFrame:
    """Rows of ``block`` of two kinds, from ``lang, source, text`` without nulls.

    With a ``chunk``: in which documents of the block it is and how often. Without: ``lang, source``, whose documents of the block
    are numbered from ``first`` up to the next one's.
    """
    columns = "block long, chunk string, first long, docs binary, times binary, lang string, source string"

    def rows_of(block: int, held: list[tuple[str, str, bytes]]):
        held.sort(key=lambda row: row[:2])
        groups = list(dict.fromkeys(row[:2] for row in held))
        firsts = {}
        for i, row in enumerate(held):
            firsts.setdefault(row[:2], i)
        first = [firsts[g] for g in groups]
        none = [None] * len(groups)
        yield {
            "block": [block] * len(groups), "chunk": none, "first": first, "docs": none, "times": none,
            "lang": [g[0] for g in groups], "source": [g[1] for g in groups],
        }
        chunks, ends, docs_of, times = counted_chunks([row[2] for row in held])
        begins = np.concatenate([[0], ends])
        for at in range(0, len(chunks), ROWS_AT_ONCE):
            stop = min(at + ROWS_AT_ONCE, len(chunks))
            low, here = int(begins[at]), ends[at:stop] - begins[at]
            high = int(ends[stop - 1])
            names = pa.array(chunks[at:stop], pa.binary()).cast(pa.string())
            nulls = pa.nulls(stop - at, pa.string())
            yield {
                "block": np.full(stop - at, block), "chunk": names, "first": pa.nulls(stop - at, pa.int64()),
                "docs": binaries(docs_of[low:high], here), "times": binaries(times[low:high], here), "lang": nulls, "source": nulls,
            }

    def work(batches):
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for row in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                if held and (size + len(row[2]) > BLOCK_BYTES or len(held) == BLOCK_DOCS):
                    yield from rows_of(block, held)
                    block, held, size = block + 1, [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield from rows_of(block, held)

    return map_arrow(docs, work, columns)


def terms_of(chunk: str) -> Column:
    return F.regexp_extract_all(F.translate(chunk, ascii_uppercase, ascii_lowercase), F.lit(TERM), 0)


def pack(rows: DataFrame) -> DataFrame:
    """``lot, bucket`` and packed rows of that kind: terms by line, and arrays of blocks, times in the chunk, sizes and postings."""
    columns = "lot long, bucket long, terms binary, blocks binary, in_chunk binary, sizes binary, docs binary, times binary"

    def packed(batches):
        table = pa.Table.from_batches(batches)
        lot, bucket = (np.asarray(table.column(c)) for c in ("lot", "bucket"))
        order = np.lexsort((bucket, lot))
        table, lot, bucket = table.take(pa.array(order)), lot[order], bucket[order]
        cuts = np.flatnonzero((np.diff(lot) != 0) | (np.diff(bucket) != 0)) + 1
        out = {c.split()[0]: [] for c in columns.split(", ")}
        lists = {c: table.column(c).to_pylist() for c in ("docs", "times")}
        terms, sizes = table.column("term").cast(pa.binary()).to_pylist(), np.array([len(t) for t in lists["times"]], "<u4")
        numbers = {c: np.asarray(table.column(n)).astype("<i8") for c, n in (("blocks", "block"), ("in_chunk", "in_chunk"))} | {"sizes": sizes}
        for start, stop in zip([0, *cuts], [*cuts, len(order)]):
            out["lot"].append(int(lot[start]))
            out["bucket"].append(int(bucket[start]))
            out["terms"].append(b"\n".join(terms[start:stop]))
            for c, values in numbers.items():
                out[c].append(values[start:stop].tobytes())
            for c, values in lists.items():
                out[c].append(b"".join(values[start:stop]))
        return out

    def work(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PACK_ROWS:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    return map_arrow(rows, work, columns)


def cells_of(head: pa.Table, body: pa.Table) -> pa.Table:
    """``lang, source, term, docs, n`` from the packed postings of some terms, and the numbering of the documents of their blocks."""

    def joined(column: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(body.column(column).to_pylist()), kind).astype("i8")

    def runs(keys: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))

    words = [term for lines in body.column("terms").to_pylist() for term in lines.split(b"\n")]
    number = {term: i for i, term in enumerate(dict.fromkeys(words))}
    term = np.fromiter(map(number.__getitem__, words), "i8", len(words))
    head_block = np.asarray(head.column("block"))
    names = np.unique(head_block)
    block, sizes = np.searchsorted(names, joined("blocks", "<i8")), joined("sizes", "<u4")
    keys = np.repeat(term * len(names) + block, sizes) * BLOCK_DOCS + joined("docs", "<u2")
    times = joined("times", "u1") * np.repeat(joined("in_chunk", "<i8"), sizes)
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = runs(keys)  # a document counts once for a term, whatever its chunks
    keys, times = keys[first], np.add.reduceat(times, first) if len(first) else times
    begins = np.searchsorted(names, head_block) * BLOCK_DOCS + np.asarray(head.column("first"))
    pairs = list(zip(head.column("lang").to_pylist(), head.column("source").to_pylist()))
    groups = {pair: i for i, pair in enumerate(dict.fromkeys(pairs))}
    order = np.argsort(begins)
    group = np.array([groups[pair] for pair in pairs])[order][np.searchsorted(begins[order], keys % (len(names) * BLOCK_DOCS), side="right") - 1]
    keys = keys // (len(names) * BLOCK_DOCS) * len(groups) + group
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = runs(keys)
    of_group, of_term = pa.array(keys[first] % len(groups)), pa.array(keys[first] // len(groups))
    columns = {
        "lang": pa.array([pair[0] for pair in groups]).take(of_group),
        "source": pa.array([pair[1] for pair in groups]).take(of_group),
        "term": pa.array(list(number), pa.binary()).cast(pa.string()).take(of_term),
        "docs": pa.array(np.diff(np.append(first, len(keys)))),
        "n": pa.array(np.add.reduceat(times, first) if len(first) else times),
    }
    return pa.table(columns)


def count_terms(postings: DataFrame, min_docs: int) -> DataFrame:
    """``lang, source, term, docs, n``: documents and occurrences, at least of each term that ``min_docs`` documents hold.

    The postings of a term meet in lots of about ``LOT_BLOCKS`` blocks, so the most frequent term fills no task.
    """
    n_docs = F.octet_length("docs") / 2
    chunks = postings.where("chunk is not null").groupBy("chunk").agg(F.sum(n_docs).alias("docs"))
    chunks = stage(chunks.select("chunk", "docs", terms_of("chunk").alias("terms")).where(F.size("terms") > 0), "chunks")
    bound = chunks.select("docs", F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.sum("docs").alias("most"))
    possible = stage(bound.where(F.col("most") >= min_docs).select("term"), "terms")
    possible = if_small(possible, 16 + F.octet_length("term"))
    joined = chunks.select("chunk", F.explode("terms").alias("term")).join(possible, "term", "left_semi")
    joined = stage(joined.groupBy("chunk", "term").agg(F.count(F.lit(1)).alias("in_chunk")), "chunk-terms")

    sizes = postings.agg(F.count_distinct("block").alias("blocks"), F.sum(F.octet_length("docs").cast("long")).alias("bytes")).first()
    lots = max(1, -(-sizes["blocks"] // LOT_BLOCKS))
    buckets = max(1, -(-(sizes["bytes"] or 0) // (lots * BUCKET_BYTES)))
    lot = F.pmod(F.xxhash64("block"), F.lit(lots)).alias("lot")
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket")
    rows = postings.where("chunk is not null").join(joined, "chunk")
    body = pack(rows.select(lot, bucket, "block", "term", "in_chunk", "docs", "times"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket")
    head = postings.where("chunk is null").select(lot, every, "block", "first", "lang", "source")

    def count_lot(table: pa.Table) -> pa.Table:
        is_head = pc.is_valid(table.column("first"))
        return cells_of(table.filter(is_head), table.filter(pc.invert(is_head)))

    both = body.unionByName(head, allowMissingColumns=True).groupBy("lot", "bucket")
    counted = both.applyInArrow(count_lot, "lang string, source string, term string, docs long, n long")
    # Dealt out by what both this sum and the next step over all sources of a term need.
    dealt = counted.repartition("lang", "term")
    return dealt.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + the whole part of SHARES * (n + SMOOTHING) / (total + SMOOTHING * terms), in decimals that hold any count."""
    big = lambda c: c.cast("decimal(19,0)")
    upper = big(F.lit(SHARES)).cast("decimal(10,0)") * (big(n) + F.lit(SMOOTHING))
    lower = big(total) + F.lit(SMOOTHING).cast("decimal(1,0)") * big(terms)
    return F.lit(1).cast("long") + F.call_function("div", upper, lower)


def distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: summed differences of shares between each two sources of a language.

    ``groups`` have ``least``, the share of a term that is not in the source. Terms are dealt into blocks, so a language is
    compared in many tasks; a task holds the shares of all sources for some terms.
    """
    spans = groups.groupBy("lang").agg(F.max("terms").alias("terms"), F.count(F.lit(1)).alias("sources"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / CELLS)).cast("long")
    spans = stage(spans.select("lang", parts.alias("parts"), F.ceil(F.col("sources") / TILE).cast("long").alias("tiles")), "spans")
    spans = if_small(spans, 32 + F.octet_length("lang"))
    of_term = F.array(F.pmod(F.xxhash64("term"), F.col("parts")))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    tiles = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile")
    cells = shares.select("lang", "source", "term", "share").join(spans, "lang").withColumn("part", F.explode(of_term))
    heads = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("least").alias("share"))
    heads = heads.join(spans, "lang").withColumn("part", F.explode(every))
    dealt = cells.unionByName(heads).select("lang", "part", tiles, "source", "term", "share")

    def compare(table: pa.Table) -> pa.Table:
        is_head = pc.is_null(table.column("term"))
        head = table.filter(is_head).sort_by("source")
        body = table.filter(pc.invert(is_head))
        sources = head.column("source").to_pylist()
        row = {source: i for i, source in enumerate(sources)}
        terms = pc.dictionary_encode(body.column("term")).combine_chunks()
        matrix = np.repeat(np.array(head.column("share").to_pylist(), "i8")[:, None], len(terms.dictionary), axis=1)
        at = np.array([row[s] for s in body.column("source").to_pylist()], "i8")
        matrix[at, np.array(terms.indices.to_pylist(), "i8")] = np.array(body.column("share").to_pylist(), "i8")
        first = TILE * table.column("tile")[0].as_py()
        mine = range(first, min(first + TILE, len(sources)))
        values = [np.delete(abs(matrix - matrix[i]).sum(axis=1), i) for i in mine]
        columns = {
            "lang": [table.column("lang")[0].as_py()] * (len(values) * (len(sources) - 1)),
            "source": [sources[i] for i in mine for _ in range(len(sources) - 1)],
            "item": [s for i in mine for s in sources[:i] + sources[i + 1 :]],
            "value": pa.array(np.concatenate(values).astype("i8")),
        }
        return pa.table(columns, pa.schema([(c, pa.string()) for c in ("lang", "source", "item")] + [("value", pa.int64())]))

    compared = dealt.groupBy("lang", "part", "tile").applyInArrow(compare, "lang string, source string, item string, value long")
    return compared.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit_sources(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from the others, and the terms it favours.

    Terms are runs of letters and non-ASCII characters, A-Z lower-cased; a language keeps those that at least ``min_docs`` of its
    documents hold. A term's share of a source or a whole language is smoothed and a whole number of billionths. Part ``pair``: for each other
    source of the language the summed differences of shares, all ranks, 0 where no term is kept. Part ``term``: the ``top_terms`` terms of the
    source whose share is furthest above that of the language. Equal values are ordered by item.

    Null texts, languages and sources are empty strings; a source whose texts have no term is compared all the same, one that is alone in its
    language has no pair. Repeated rows are documents of their own, ids do not matter, other columns are ignored, an
    empty table gives no row.
    """
    named = {"lang": lang_column, "source": source_column, "text": text_column}
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in named.items()])
    path = staging_path(docs.sparkSession, "chunk-counts")
    counts = count_chunks(texts)
    counts.write.option("compression", "zstd").parquet(path)
    postings = docs.sparkSession.read.schema(counts.schema).parquet(path)
    same = Window.partitionBy("lang", "term")
    counted = count_terms(postings, min_docs)
    counted = counted.select(
        "lang", "source", "term", "n", F.sum("docs").over(same).alias("docs"), F.sum("n").over(same).alias("total"),
        (F.row_number().over(same.orderBy("source")) == 1).alias("first"),
    )
    kept = stage(counted.where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_words"), F.count_if("first").alias("terms"))
    groups = postings.where("chunk is null").select("lang", "source").distinct()
    groups = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stage(groups.na.fill(0, ["words", "lang_words", "terms"]), "groups")
    sized = if_small(groups, 48 + F.octet_length("lang") + F.octet_length("source"))
    own = share(F.col("n"), F.col("words"), F.col("terms"))
    of_lang = share(F.col("total"), F.col("lang_words"), F.col("terms"))
    shares = kept.join(sized, ["lang", "source"]).select("lang", "source", "term", own.alias("share"), of_lang.alias("usual"))

    least = F.when(F.col("terms") > 0, share(F.lit(0), F.col("words"), F.col("terms"))).otherwise(F.lit(0).cast("long"))
    pairs = distances(shares, groups.select("lang", "source", "terms", least.alias("least")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = shares.where("share > usual").select("lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", "rank")
