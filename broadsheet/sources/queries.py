"""Query lines to query rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.sources.lines import scan_lines


def unique_queries(queries: DataFrame) -> DataFrame:
    """``(query_id, original_query)`` with each text once, under its lowest id."""
    return queries.groupBy("original_query").agg(F.min("query_id").alias("query_id")).select(
        "query_id", "original_query"
    )


def read_queries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The distinct lines of a query file, with ids that follow the order of the file."""
    numbered = scan_lines(spark, path).select(
        F.monotonically_increasing_id().alias("query_id"),
        F.col("value").alias("original_query"),
    )
    return unique_queries(numbered)
