"""O1: open a source by table name or by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def is_path(ref: str) -> bool:
    return "/" in ref or ":" in ref or "\\" in ref


def read_source(spark: SparkSession, ref: str, fmt: str | None = None, **options) -> DataFrame:
    """A catalog table when ``ref`` is a name and no format is given, else
    files at the path ``ref`` in format ``fmt`` (Parquet by default)."""
    if not ref:
        raise ValueError("a table name or path is required")
    if fmt is None and not is_path(ref):
        return spark.table(ref)
    return spark.read.format(fmt or "parquet").options(**options).load(ref)
