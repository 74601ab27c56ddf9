"""Joins of many rows to a table with few rows per key, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodloom.sources.staging import stage

# A table is broadcast whole up to this size.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot from one in HOT_KEYS rows on, so there are at most HOT_KEYS hot keys.
HOT_KEYS = 10_000
# Keys that the sketch of the rows holds; a key it misses has fewer than one in HOT_KEYS rows.
TRACKED_KEYS = 4 * HOT_KEYS

def measured_bytes(table: DataFrame, key: str, row_bytes: int | Column) -> int:
    """Key bytes plus an allowance per row, fixed or from its columns."""
    size = F.coalesce(F.sum(F.octet_length(key) + row_bytes), F.lit(0))
    return table.agg(size.alias("size")).first()["size"]


def hot_keys(facts: DataFrame, key: str) -> DataFrame:
    """Keys that hold at least one in ``HOT_KEYS`` of the rows of ``facts``, and maybe some with slightly fewer.

    One pass without a shuffle of rows: each task keeps a sketch of its most frequent keys, and sketches are merged.
    """
    binary = dict(facts.dtypes)[key] == "binary"
    counted = facts.select((F.hex(key) if binary else F.col(key)).alias("key")).where(F.col("key").isNotNull())
    top = F.call_function("approx_top_k", F.col("key"), F.lit(HOT_KEYS), F.lit(TRACKED_KEYS))
    found = counted.agg(F.count(F.lit(1)).alias("rows"), top.alias("top")).select("rows", F.inline("top"))
    hot = found.where(F.col("count") * HOT_KEYS >= F.col("rows"))
    return hot.select((F.unhex("item") if binary else F.col("item")).alias(key))


def frequent_keys(table: DataFrame, key: str, frequency: str, row_bytes: int | Column, limit: int) -> DataFrame:
    """Keys of the table that hold one in ``HOT_KEYS`` of the facts, by their rows in ``frequency``, and as many of the next as fit ``limit``.

    Reads the table alone, not the facts. Keys of one frequency are in or out together.
    """
    size = F.sum(F.octet_length(key) + row_bytes).alias("size")
    by_frequency = table.groupBy(F.col(frequency).alias("each")).agg(size, F.sum(frequency).alias("rows"))
    above = Window.orderBy(F.desc("each"))  # one row per frequency
    summed = by_frequency.select("each", F.sum("size").over(above).alias("held"), F.sum("rows").over(Window.partitionBy()).alias("rows"))
    fits = (F.col("held") <= limit) | (F.col("each") * HOT_KEYS >= F.col("rows"))
    least = summed.where(fits).agg(F.min("each").alias("least")).first()["least"]
    return table.where(F.col(frequency) >= F.lit(least)).select(key)


def cold_rows(facts: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Rows whose key is neither hot nor missing: no key among them holds one in ``HOT_KEYS`` of all rows."""
    return facts.where(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left_anti")


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    how: str,
    row_bytes: int | Column = 64,
    broadcast_bytes: int = BROADCAST_BYTES,
    frequency: str | None = None,
) -> DataFrame:
    """Inner or left join of ``facts`` to ``table`` on the string or binary column ``key``.

    The table's size is measured, so pass a written one; ``facts`` may be read up to three times.
    A small table is broadcast. Beyond that the
    rows of hot keys meet a broadcast of those keys alone, at most ``HOT_KEYS`` of them, and
    only the other rows are shuffled. Hot is what the facts repeat, whether the table knows it or not.
    If the table holds every key of the facts and in column ``frequency`` its rows there, the facts need no pass for that, and more keys
    than the hot ones are broadcast: the most frequent, up to half of ``broadcast_bytes``.
    """
    if measured_bytes(table, key, row_bytes) <= broadcast_bytes:
        return facts.join(F.broadcast(table), key, how)
    if frequency is None:
        hot = hot_keys(facts, key)
    else:
        hot = frequent_keys(table, key, frequency, row_bytes, broadcast_bytes // 2)
    hot = stage(hot, "hot-keys")
    hot_rows = table.join(F.broadcast(hot), key, "left_semi")
    # An inner join leaves out the other rows by itself.
    of_hot = facts if how == "inner" else facts.join(F.broadcast(hot), key, "left_semi")
    joined = of_hot.join(F.broadcast(hot_rows), key, how).unionByName(
        cold_rows(facts, key, hot).join(table, key, how)
    )
    if how == "left":
        keyless = facts.where(F.col(key).isNull())
        joined = joined.unionByName(keyless, allowMissingColumns=True)
    return joined
