"""Articles and queries out of the driver's tables ``documents`` and ``benchmark``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.schema import CONTENT_FIELDS
from broadsheet.sources.queries import unique_queries

# A line of at least this many characters is a paragraph, a shorter one is not.
PARAGRAPH_CHARS = 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan_partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """How many partitions to spread the documents over: as many as there are cores if
    the files have fewer splits than that, else None."""
    splits = read_table(spark, sf_dir, "documents").select("doc_id").rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    return cores if splits <= cores else None


def articles(spark: SparkSession, sf_dir: str, extra_fields: bool = False) -> DataFrame:
    """Each document as an article: the first line is the title, the other lines are the
    content items. A document of one line is all body and has no title.

    ``extra_fields`` adds the field ``lang`` to articles that are not in English, which
    makes them bad lines once written as JSON.
    """
    documents = read_table(spark, sf_dir, "documents")
    titled = F.contains("text", F.lit("\n"))
    after_title = F.substring("text", F.instr("text", "\n") + 1, F.length("text"))
    body = F.split(F.when(titled, after_title).otherwise(F.col("text")), "\n")

    def item(line):
        fields = {
            "content": line,
            "subtype": F.when(F.length(line) >= PARAGRAPH_CHARS, F.lit("paragraph")),
        }
        null = F.lit(None).cast("string")
        return F.struct(*[fields.get(name, null).alias(name) for name in CONTENT_FIELDS])

    english = F.col("lang") == "en"
    extra = [F.when(~english, F.col("lang")).alias("lang")] if extra_fields else []
    null = F.lit(None).cast("string")
    return documents.select(
        "doc_id",
        F.col("doc_id").cast("string").alias("id"),
        null.alias("article_url"),
        F.when(titled, F.substring_index("text", "\n", 1)).alias("title"),
        null.alias("author"),
        F.when(english, F.col("doc_id") * 86_400_000).alias("published_date"),
        F.transform(body, item).alias("contents"),
        F.lit("article").alias("type"),
        "source",
        *extra,
    )


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item as a query, its text on one line."""
    return unique_queries(
        read_table(spark, sf_dir, "benchmark").select(
            F.col("item_id").alias("query_id"),
            F.replace("text", F.lit("\n"), F.lit(" ")).alias("original_query"),
        )
    )
