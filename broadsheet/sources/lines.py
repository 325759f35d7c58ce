"""Reading text files line by line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row ``value`` per line of a file, a folder, a glob or a list of them."""
    return spark.read.text(path)
