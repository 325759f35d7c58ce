"""A corpus pipeline: raw documents in, packed training sequences out.

Toxic documents go, one document of each group of near duplicates stays, repeated strings
are taken out of the texts, the sources are mixed to their weights, and the documents are
packed in the order of the mix. Every stage works on all rows of the stage before, as read
from its Parquet files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import minhash, mixing, packing, suffixes, toxicity
from broadsheet.llm.queries import tokenizer_path
from broadsheet.llm.scratch import free_shuffles, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject, all columns."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its shingles of five words."""
    return minhash.one_of_each_group(docs, words=5, percent=80)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 100 bytes that also start earlier."""
    return suffixes.without_repeated_strings(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: from file to file, and from row to row."""
    return mixing.mixed(docs)


def _row_order(docs: DataFrame) -> list:
    """Columns that sort documents as they stand in their files, if they come from files."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    order = [F.try_to_number(part, F.lit("9999999999")), F.col("_metadata.file_name"),
             F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        return []
    return order


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens, in the order of the mix."""
    return packing.pack(docs, tokenizer_path(), order=_row_order(docs), added_tokens=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", drop_repeated_strings),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# Sketches, models and tokenizers have no SQL; the tests run plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. What a stage returns is written to the
    shared folder and read again, so that no stage is computed twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        free_shuffles(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
