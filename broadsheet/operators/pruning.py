"""Scores of those pairs only that can be among the best of their query.

A term adds to a score at most its bound, the greatest score it has in any document. Some of
the documents are scored in full first; the ``k``-th best of a query among them is a floor that
its ``k``-th best of all does not fall below. Terms of a query whose bounds together stay below
the floor cannot bring a document among the best, so one without any other term of the query, an
essential one, is not scored for it. The rest are scored as always: what is left out has no place
among the ``k`` best, and the best are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if, is_small
from broadsheet.operators.ranking import SCORE_UNITS, top_k

# One of so many documents is scored in full for the floors. It sets the work, not the result.
SAMPLE = 16

# Ranks compare scores as whole units, so a bound must be further below a floor than rounding.
_MARGIN = 2 / SCORE_UNITS


def sampled(doc_id: Column, sample: int = SAMPLE) -> Column:
    """Whether a document is scored for the floors: by its id, so the same in every run."""
    return F.pmod(F.xxhash64(doc_id), F.lit(sample)) == 0


def term_bounds(term_scores: DataFrame) -> DataFrame:
    """``(term, bound)``: the most a term can add to a score. One that is negative wherever it
    occurs adds most where it does not: its bound is 0."""
    return term_scores.groupBy("term").agg(
        F.greatest(F.max("score"), F.lit(0.0)).alias("bound"))


def floors(scores: DataFrame, k: int) -> DataFrame:
    """``(query_id, floor)``: the ``k``-th best score of each query that has so many."""
    return top_k(scores, k).groupBy("query_id").agg(
        F.min("score").alias("floor"), F.count("*").alias("n")
    ).where(F.col("n") >= k).select("query_id", "floor")


def essential_terms(terms: DataFrame, bounds: DataFrame, floors: DataFrame) -> DataFrame:
    """The rows of ``terms`` without which a document is not among the best of the query.

    From the least telling on, terms are left out as long as their bounds add up to less than
    the floor. All terms of a query without a floor, or with one that is not above 0, stay."""
    most = F.coalesce(F.col("qn") * F.col("bound") / F.col("n_terms"), F.lit(0.0))
    so_far = F.sum("_most").over(
        Window.partitionBy("query_id").orderBy("_most", "term")
        .rowsBetween(Window.unboundedPreceding, 0))
    reached = F.col("floor").isNull() | (so_far + F.lit(_MARGIN) >= F.col("floor"))
    return (
        terms.join(bounds, "term", "left").join(floors, "query_id", "left")
        .withColumn("_most", most).withColumn("_essential", reached)
        .where("_essential").select(*terms.columns)
    )


def possible_pairs(term_scores: DataFrame, terms: DataFrame, essential: DataFrame,
                   small: bool) -> DataFrame:
    """``(query_id, doc_id, n_terms, term, qn, score)``: the terms that each document shares with
    each query of which it has an essential term.

    ``term_scores`` are partitioned by ``doc_id``. Which queries a document may be among the best
    of is found once, from all its query terms; where the query terms are
    broadcast (``small``) nothing is shuffled, and no row is made for any other query."""
    asking = essential.groupBy("term").agg(F.collect_set("query_id").alias("_asking"))
    asked = term_scores.join(broadcast_if(asking, small and is_small(asking)), "term", "left")
    # Once for each document, not once for each of its terms.
    documents = asked.groupBy("doc_id").agg(
        F.collect_list(F.struct("term", "score")).alias("_terms"),
        F.array_distinct(F.flatten(F.collect_list("_asking"))).alias("_possible"))
    alive = documents.where(F.size("_possible") > 0).select("doc_id", "_possible", F.inline("_terms"))
    queries = broadcast_if(terms.withColumnRenamed("term", "_term"), small)
    return alive.join(
        queries,
        (F.col("term") == F.col("_term")) & F.array_contains("_possible", F.col("query_id")),
    ).select("query_id", "doc_id", "n_terms", "term", "qn", "score")
