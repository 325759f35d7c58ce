"""Statistics of documents and of the corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if


def document_length(tokens: DataFrame) -> DataFrame:
    """``(doc_id, length)``: the number of terms of each document with a title."""
    return tokens.select("doc_id", "length")


def corpus_stats(tokens: DataFrame) -> DataFrame:
    """One row ``(n_docs, total_length, avg_length)`` over the documents with a title."""
    return tokens.agg(
        F.count("*").alias("n_docs"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_length"),
        F.avg("length").alias("avg_length"),
    )


def term_frequency(tokens: DataFrame, surfaces: DataFrame, small: bool,
                   carry: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, length, term, corpus_tf, tf)``: how often each document has each query
    term, next to how often the corpus has it, and the columns to ``carry`` of documents.
    ``tokens`` are arrays of ``(token, n)``, as ``count_tokens`` makes them.

    Where the tokens are partitioned by ``doc_id`` and the surface forms are broadcast
    (``small``), nothing is shuffled.
    """
    occurrences = tokens.select("doc_id", "length", *carry, F.inline("tokens"))
    return (
        occurrences.join(
            broadcast_if(surfaces.select("token", "term", "corpus_tf"), small), "token"
        )
        .groupBy("doc_id", "length", *carry, "term", "corpus_tf")
        .agg(F.sum("n").alias("tf"))
    )


def check_ids(tokens: DataFrame) -> None:
    """Raise an error if an article has no id, or two have the same. The tokens are
    partitioned by ``doc_id``, so counting them shuffles nothing."""
    row = tokens.groupBy("doc_id").agg(F.count("*").alias("n")).agg(
        F.max(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("missing"),
        F.max(F.when(F.col("doc_id").isNotNull() & (F.col("n") > 1), F.struct(
            F.col("doc_id").cast("string").alias("id"), "n"))).alias("twice"),
    ).first()
    if row["missing"]:
        raise ValueError(f"{row['missing']} articles have no id; missing_ids='drop' leaves them out")
    if row["twice"]:
        raise ValueError(f"{row['twice']['n']} articles have the id {row['twice']['id']}; "
                         "duplicates='drop' takes one of each")


def corpus_term_frequency(surfaces: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, corpus_tf)``: occurrences of each query term in the corpus, 0 for none."""
    counts = surfaces.select("term", "corpus_tf").distinct()
    return (
        terms.select("term")
        .distinct()
        .join(counts, "term", "left")
        .select("term", F.coalesce("corpus_tf", F.lit(0)).alias("corpus_tf"))
    )


def article_stats(tf: DataFrame, parsed_queries: DataFrame, small: bool) -> DataFrame:
    """``(doc_id, title, length, query_id, pos, tf)``: the frequency in each document of
    the term at each position of each query, where it occurs at all. ``tf`` has the titles
    of its documents; ``small`` says that the parsed queries may be broadcast."""
    return tf.join(
        broadcast_if(parsed_queries.select("query_id", "pos", "term"), small), "term"
    ).select("doc_id", "title", "length", "query_id", "pos", "tf")
