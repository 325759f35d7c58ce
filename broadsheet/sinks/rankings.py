"""Rankings as text, and written out."""

from __future__ import annotations

import uuid
from contextlib import suppress
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.cluster import checkpointed, delete_folder, intermediates, move_folder, write_mark


def ranking_text(rankings: DataFrame, score: "callable" = lambda s: s.cast("string")) -> DataFrame:
    """``(query_id, original_query, body)``: the query, then a line per result:
    two spaces, rank, ":", id, score and title. ``score`` formats a score column."""

    def line(result: Column) -> Column:
        return F.concat(
            F.lit("  "), result["rank"].cast("string"), F.lit(":"),
            result["doc_id"].cast("string"), F.lit(" "), score(result["score"]), F.lit(" "),
            F.coalesce(result["article"]["title"], F.lit("null")), F.lit("\n"),
        )

    body = F.concat(
        F.col("original_query"), F.lit("\n"), F.array_join(F.transform("results", line), "")
    )
    return rankings.select("query_id", "original_query", body.alias("body"))


def write_rankings(rankings: DataFrame, folder: str, form: str = "text") -> str:
    """Write the rankings into a new folder under ``folder``, named by the time.

    ``text`` writes ``rankings``, with a sub-folder ``query_id=<id>`` per query that holds its
    ranking as one text file, and ``queries``, a Parquet table of ids and query texts: a
    query may be of any length and hold any character. ``parquet`` writes the rows as they
    are. Returns the path.

    All is written to a hidden folder beside it first, then renamed, and marked ``_DONE`` at
    last: the path that is returned holds whole results, and a failure leaves nothing there.
    The rankings are worked out once, for both tables.
    """
    if form not in ("text", "parquet"):
        raise ValueError(f"form must be text or parquet, not {form!r}")
    spark = rankings.sparkSession
    name = f"{datetime.now():%Y%m%d-%H%M%S-%f}"
    path, staging = (f"{folder.rstrip('/')}/{n}" for n in (name, f"_{name}-{uuid.uuid4().hex}"))
    try:
        if form == "text":
            with intermediates(spark):
                # The writer ends each row with a line break, so the body goes without its last.
                texts = checkpointed(ranking_text(rankings))
                body = F.regexp_replace("body", "\n$", "")
                texts.select(body.alias("value"), "query_id").repartition(
                    "query_id").write.partitionBy("query_id").text(f"{staging}/rankings")
                texts.select("query_id", "original_query").write.parquet(f"{staging}/queries")
        else:
            rankings.write.parquet(staging)
        move_folder(spark, staging, path)
    except BaseException:
        with suppress(Exception):
            delete_folder(spark, staging)
        raise
    write_mark(spark, f"{path}/_DONE")
    return path


def read_ranking_texts(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, body)``: the text files of ``write_rankings``, whole."""
    return spark.read.text(f"{path}/rankings", wholetext=True).select(
        F.col("query_id").cast("long").alias("query_id"), F.col("value").alias("body"))
