"""Rankings: the best documents of each query, with and without near copies."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if, checkpointed, is_small
from broadsheet.functions.nearness import near_listed, near_taken, picked_of
from broadsheet.operators.indexing import number_rows

# Results per query, and the distance that titles must keep.
TOP_K = 10
MIN_DISTANCE = 0.5

# Candidates per query and round of the diverse ranking. It sets the size of a step, not
# the result.
CHUNK = 200

# Bytes of taken titles, with what goes with them, that are handed to all tasks as they are.
HANDED_BYTES = 16_000_000

# Tasks whose best are put together before the best of a query are taken. Spark cuts what a task
# hands on to the best k by itself up to this k.
TASKS_OF_A_PART = 32
CUT_BY_ITSELF = 1000
_CUT = "spark.sql.optimizer.windowGroupLimitThreshold"

# Sums of the same scores in another order differ in the last digits, so ranks compare
# scores to nine places, as whole numbers of 1e-9, and then ids.
SCORE_UNITS = 1e9


def rank_key(score: Column) -> Column:
    return F.rint(score * SCORE_UNITS)


def _best_first() -> list[Column]:
    return [rank_key(F.col("score")).desc(), F.col("doc_id")]


def rank_by_score(scores: DataFrame) -> DataFrame:
    """``(query_id, doc_id, score, rank)`` of all scored pairs, however many a query has.

    The scores are worked out once and kept: sorting by ranges reads its input twice."""
    places = number_rows(checkpointed(scores), _best_first(), "_place", within="query_id")
    return places.select("query_id", "doc_id", "score", (F.col("_place") + 1).alias("rank"))


def top_k(scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """``(query_id, rank, doc_id, score)`` of the ``k`` best per query.

    A pair belongs to the part of the task that has scored it. So a task hands on its own ``k``
    best of each query, no more, whatever ``k`` is; those of some tasks meet, are cut to ``k``
    again, and only these meet in one task per query.

    Spark makes the first cut by itself up to a ``k`` that is a setting. For a greater one the
    setting is raised while the result is worked out, and the result is checkpointed.
    """
    def best(rows: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(*_best_first())
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    part = F.floor(F.spark_partition_id() / TASKS_OF_A_PART)
    ranked = best(best(scores.withColumn("_part", part), "query_id", "_part"), "query_id").select(
        "query_id", "rank", "doc_id", "score")
    if k <= CUT_BY_ITSELF:
        return ranked
    conf = scores.sparkSession.conf
    before = conf.get(_CUT, None)
    conf.set(_CUT, str(k))
    try:
        return checkpointed(ranked)
    finally:
        conf.unset(_CUT) if before is None else conf.set(_CUT, before)


def _spread(rows: DataFrame, n_queries: int, *by: str) -> DataFrame:
    """Few bytes, much work: the number of partitions is given, so that they are not put
    together for being small."""
    spark = rows.sparkSession
    parallel = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    return rows.repartition(max(1, min(n_queries, parallel)), *by)


def _chunks(candidates: DataFrame, n_queries: int, min_distance: float) -> DataFrame:
    """One row per query: ``candidates``, an array with titles, best first; ``last``, the
    last one; and ``n``, how many there are.

    Of several candidates with one title the array holds the best: the others are near
    that one if it is taken, and near what it is near to if not. (Where no distance is
    asked for, nothing is near, and all are held.)
    """
    best = F.struct("rank", "doc_id", "score")
    rows = _spread(candidates, n_queries, "query_id")
    alike = ["query_id", "title"] if min_distance > 0 else ["query_id", "title", "rank"]
    by_title = rows.groupBy(*alike).agg(
        F.min(best).alias("best"), F.max(best).alias("last"), F.count("*").alias("n")
    )
    candidate = F.struct("best.rank", "best.doc_id", "best.score", "title")
    return by_title.groupBy("query_id").agg(
        F.array_sort(F.collect_list(candidate)).alias("candidates"),
        F.max("last").alias("last"),
        F.sum("n").alias("n"),
    ).withColumn(
        "candidates",
        F.transform("candidates", lambda c: F.struct(c["doc_id"], c["score"], c["title"])),
    )


def _take_from_chunk(chunks: DataFrame, k: int, min_distance: float, chunk: int) -> DataFrame:
    """Fold the candidates of each query into its ``taken`` array."""
    picks = picked_of(F.col("taken.title"), F.col("candidates.title"), k, min_distance)
    return chunks.withColumn("_picks", picks).select(
        "query_id",
        F.concat("taken", F.transform("_picks", lambda i: F.col("candidates")[i])).alias("taken"),
        F.size("taken").alias("known"),
        rank_key(F.col("last.score")).alias("last_key"),
        F.col("last.doc_id").alias("last_doc"),
        (F.coalesce("n", F.lit(0)) >= chunk).alias("more"),
    )


def _remaining(pairs: DataFrame, state: DataFrame, min_distance: float) -> DataFrame:
    """The pairs of open queries after their last candidate and not near a taken title. They have
    been compared with those that were ``known`` before the last round, so only the others are.

    Which titles those are is handed to the tasks as it is, up to ``HANDED_BYTES``; beyond that
    it is a column of the pairs."""
    key = rank_key(F.col("score"))
    after = (key < F.col("last_key")) | (
        (key == F.col("last_key")) & (F.col("doc_id") > F.col("last_doc"))
    )
    query, title = F.col("query_id").cast("string"), F.col("title")
    new = state.withColumn("_new", F.slice("taken.title", F.col("known") + 1, F.size("taken")))
    small = is_small(state, HANDED_BYTES)
    last = new.select("query_id", "last_key", "last_doc", *([] if small else ["_new"]))
    later = pairs.join(broadcast_if(last, small), "query_id").where(after)
    if min_distance > 0:
        if small:
            titles_of = {row[0]: row[1] for row in new.select(query, "_new").collect()}
            rejected = near_taken(query, title, titles_of, min_distance)
        else:
            rejected = near_listed(query, title, F.col("_new"), min_distance)
        later = later.where(~rejected)
    return later.select(*pairs.columns)


def diverse_top_k(scores: DataFrame, titles: DataFrame, n_queries: int, k: int = TOP_K,
                  min_distance: float = MIN_DISTANCE, chunk: int = CHUNK,
                  scores_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: per query, best first, each document whose
    title keeps ``min_distance`` from every title taken before it, until there are ``k``.

    Taking is sequential, so it is done in rounds on the ``chunk`` best candidates of each
    query. A query with places and candidates left goes on to the next round, from which
    every pair near a taken title has been removed, all at once. The best pair left is
    thus taken in each round: there are at most ``k`` rounds, also where copies of one
    title fill most of a query. A round holds ``chunk + k`` titles per query.

    The first round reads ``scores`` and looks titles up for its candidates only. If queries
    stay open, the scores of those, ``scores_of(queries)``, are written once, and later
    rounds read what the round before has left, and look its titles up. Ids are unique.
    """
    finished = []

    def named(pairs: DataFrame) -> DataFrame:
        # A candidate without a title row stays: how many there are decides if more follow.
        return pairs.join(titles.select("doc_id", "title"), "doc_id", "left")

    chunks = _chunks(named(top_k(scores, chunk)), n_queries, min_distance).withColumn(
        "taken", F.slice("candidates", 1, 0))
    pairs = None
    while True:
        # Not spread by query: they may be so already, in partitions put together.
        state = checkpointed(_take_from_chunk(_spread(chunks, n_queries), k, min_distance, chunk))
        is_open = F.col("more") & (F.size("taken") < k)
        finished.append(state.where(~is_open).select("query_id", "taken"))
        still_open = state.where(is_open)
        if still_open.isEmpty():
            break
        if pairs is None:
            pairs = scores_of(still_open.select("query_id")) if scores_of else scores
        # Written without titles: a title is there once, not once for each query.
        pairs = checkpointed(_remaining(named(pairs), still_open, min_distance).drop("title"))
        chunks = still_open.select("query_id", "taken").join(
            _chunks(named(top_k(pairs, chunk)), n_queries, min_distance), "query_id", "left"
        )
        chunks = chunks.withColumn(
            "candidates", F.coalesce("candidates", F.slice("taken", 1, 0))
        )

    return reduce(DataFrame.union, finished).select(
        "query_id", F.posexplode("taken").alias("pos", "entry")
    ).select(
        "query_id",
        (F.col("pos") + 1).alias("rank"),
        F.col("entry.doc_id").alias("doc_id"),
        F.col("entry.score").alias("score"),
    )


def ranked_article_ids(ranking: DataFrame) -> DataFrame:
    """``(doc_id)``: the articles that any query ranks, each once."""
    return ranking.select("doc_id").distinct()


def ranked_articles(articles: DataFrame, ranking: DataFrame) -> DataFrame:
    """The articles that any query ranks. The ids are broadcast if they are few enough,
    so that the articles are filtered where they are read."""
    ids = checkpointed(ranked_article_ids(ranking))
    return articles.join(broadcast_if(ids, is_small(ids)), "doc_id", "left_semi")
