"""Writers and console output (inventory SNK-1 to SNK-4)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter


def _faithful(writer: DataFrameWriter) -> DataFrameWriter:
    """CSV that reads back as it was: quotes doubled, outer spaces kept."""
    return (
        writer.option("escape", '"')
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_labeled(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """SNK-1: replace what is at ``path``; CSV gets a header row.

    CSV cannot tell an empty text from a null; Parquet can.
    """
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        _faithful(writer).option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown output format: {fmt}")


def write_plain_csv(df: DataFrame, path: str) -> None:
    """SNK-2: no header, and an error if the path exists."""
    _faithful(df.write.mode("errorifexists")).csv(path)


def preview(df: DataFrame, rows: int = 20, truncate: bool = True) -> None:
    """SNK-3: print the first rows."""
    df.show(rows, truncate=truncate)


def metric_lines(metrics: Mapping[str, float]) -> list[str]:
    """SNK-4: one line per metric, four decimals; a metric of no rows is ``nan``."""
    shown = {name: float("nan") if value is None else value for name, value in metrics.items()}
    return [f"{name}: {value:.4f}" for name, value in shown.items()]
