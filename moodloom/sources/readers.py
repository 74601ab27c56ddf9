"""Text sources (inventory SRC-1 to SRC-4, PRJ-1, PRJ-2, SET-1).

Paths go to Spark's own readers: any file system Hadoop knows, globs, or a list of both.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

TEXT = "tweets"
Paths = str | list[str]


def listed(path: Paths) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def files_of(spark: SparkSession, path: Paths) -> list[str]:
    """SRC-3: the files that paths, folders and globs stand for, in order; their content is not read."""
    files = spark.read.format("binaryFile").load(listed(path)).select("path")
    return sorted(row["path"] for row in files.collect())


def read_csv(
    spark: SparkSession,
    path: Paths,
    schema: StructType | str | None = None,
    infer_schema: bool = False,
    multi_line: bool = True,
    per_file: bool = True,
) -> DataFrame:
    """SRC-1: CSV with a header row.

    Quoted fields keep their line feeds, at the price that one file is read by one task. Where
    no field has a line feed, ``multi_line=False`` lets Spark split large files. Without a schema the
    columns are strings named by the header, which saves the pass that inference needs.

    Headers may differ between files: files with one header are read together, and columns meet by name; one that a file lacks is
    null there. That takes a look at the first line of each file. ``per_file=False`` looks at one file of each path only; then
    another header under that path is an error, never a wrong column. A file without any line is left out.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if schema is not None:
        return reader.schema(schema).csv(path)
    checked = reader.option("enforceSchema", False).option("inferSchema", infer_schema)
    groups: dict[tuple[str, ...], list[str]] = {}
    for one in files_of(spark, path) if per_file else listed(path):
        groups.setdefault(tuple(reader.csv(one).columns), []).append(one)
    groups.pop((), None)
    if not groups:
        return checked.csv(path)
    frames = [checked.csv(files) for files in groups.values()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def read_json(
    spark: SparkSession, path: Paths, schema: StructType | str | None = None
) -> DataFrame:
    """SRC-2: one JSON object per line; the schema is inferred where none is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def select_text(df: DataFrame, column: str = "text") -> DataFrame:
    """PRJ-1, PRJ-2: keep one column, as ``tweets``."""
    return df.select(F.col(column).cast("string").alias(TEXT))


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Size of the input files; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]


def spread(source: DataFrame) -> DataFrame:
    """Deal the rows of a scan out to all cores if it has fewer partitions than there are cores.

    That is a small input, or files that one task each must read. Rows are dealt in turn, so equal
    texts do not gather. Larger scans stay as they are.
    """
    cores = source.sparkSession.sparkContext.defaultParallelism
    return source.repartition(cores) if source.rdd.getNumPartitions() < cores else source


def read_source(
    spark: SparkSession,
    path: Paths,
    fmt: str = "csv",
    schema: StructType | None = None,
    multi_line: bool = True,
    per_file: bool = True,
) -> DataFrame:
    """SRC-4: all columns of a CSV, JSON or Parquet source, whose schema can be looked at; ``schema`` is for JSON alone."""
    if fmt == "csv":
        return read_csv(spark, path, multi_line=multi_line, per_file=per_file)
    if fmt == "json":
        return read_json(spark, path, schema)
    if fmt == "parquet":
        return spark.read.parquet(*listed(path))
    raise ValueError(f"unknown source format: {fmt}")


def read_text(
    spark: SparkSession,
    path: Paths,
    fmt: str = "csv",
    column: str = "text",
    multi_line: bool = True,
    per_file: bool = True,
) -> DataFrame:
    """The text column of a CSV, JSON or Parquet source, as ``tweets``."""
    schema = StructType([StructField(column, StringType())])
    return spread(select_text(read_source(spark, path, fmt, schema, multi_line, per_file), column))


def merge_sources(*sources: DataFrame) -> DataFrame:
    """SET-1: stack one-column sources by position, duplicates kept."""
    return reduce(DataFrame.union, (select_text(df, df.columns[0]) for df in sources))
