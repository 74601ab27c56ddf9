"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A table is broadcast only if its measured rows fit in this many bytes.
BROADCAST_BYTES = 48 * 1024 * 1024
# Text that a Python task handles at once; a longer text is handled alone.
SLICE_BYTES = 1024 * 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, so no other column of the caller can clash; null text is empty."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))


def text_key(text: str | Column = "text") -> Column:
    """A 128-bit key of a text; with the id it tells repeated ids with different texts apart."""
    return F.substring(F.sha2(text, 256), 1, 32)


def if_small(table: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``table`` with a broadcast hint if its measured size is within ``limit``, else as it is.

    ``row_bytes`` is a bound for a row, or a column with the bytes of each. Pass a written table, as
    measuring reads it once.
    """
    size = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    total = table.agg(F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()["size"]
    return F.broadcast(table) if total <= limit else table


def held(value: Column) -> Column:
    """``value`` computed once per row: a generator keeps later filters and lambdas from repeating it."""
    return F.explode(F.array(value))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``limit`` bytes in ``column``, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on for other tasks, and more wait than there are cores."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):  # glibc alone has it
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` for a generator of dictionaries of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for columns in work(batches):
            arrays = [
                value if isinstance(value, (pa.Array, pa.ChunkedArray)) else pa.array(value, field.type)
                for field, value in ((field, columns[field.name]) for field in target)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)
        give_back()

    return df.mapInArrow(run, schema)
