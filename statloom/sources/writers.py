"""Sinks: CSV tables and JSON metadata, written in parallel as folders of parts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header, nulls as empty fields, no index column."""
    df.write.mode(mode).option("header", True).option("nullValue", "").csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row; used for the one-row metadata table."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Columnar hand-off between jobs."""
    df.write.mode(mode).parquet(path)
