"""DPH scores of terms and of queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if
from broadsheet.functions.dph import dph_score


def dph_term_score(tf: DataFrame, n_docs: Column, avg_length: Column) -> DataFrame:
    """``(doc_id, length, term, score)`` for each query term of each document."""
    score = dph_score(F.col("tf"), F.col("corpus_tf"), F.col("length"), avg_length, n_docs)
    return tf.select("doc_id", "length", "term", score.alias("score"))


def dph_query_score(term_scores: DataFrame, terms: DataFrame, small: bool) -> DataFrame:
    """``(query_id, doc_id, score)``: per query and document, the sum of the scores of the
    query's terms, repeats counted, over the number of its terms. Negative scores stay,
    a score of exactly 0 does not."""
    return sum_of_terms(term_scores.join(broadcast_if(terms, small), "term"))


def sum_of_terms(pairs: DataFrame) -> DataFrame:
    """``dph_query_score`` from a row for each term that a query and a document share."""
    return (
        pairs.groupBy("query_id", "doc_id", "n_terms")
        .agg(F.sum(F.col("qn") * F.col("score")).alias("total"))
        .where(F.col("total") != 0)
        .select("query_id", "doc_id", (F.col("total") / F.col("n_terms")).alias("score"))
    )
