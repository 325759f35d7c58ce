"""The ranking job: articles and queries in, one ranking per query out."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.cluster import (
    BROADCAST_BYTES, broadcast_if, checkpointed, intermediates, is_small,
)
from broadsheet.functions.stopwords import ENGLISH
from broadsheet.functions.tokens import Limits
from broadsheet.operators import pruning, ranking, scoring, stats, terms
from broadsheet.operators.articles import (
    FILE, article_tokens, articles_with_title, from_files, index_texts, one_per_id,
)
from broadsheet.operators.indexing import spread
from broadsheet.sinks.rankings import write_rankings
from broadsheet.sources.articles import read_articles
from broadsheet.sources.queries import read_queries, unique_queries


# Files that are named in a filter, at most. With more of them all files are read.
MAX_FILES = 10_000


@dataclass
class Corpus:
    """What scoring needs to know about the articles, seen from one set of queries.

    Text is read and tokenised once, into ``tokens``: per article its length and those
    tokens that may be query terms, partitioned by ``doc_id``. Everything after that
    works on this small table, and stays within its partitions until documents of a query
    are compared with each other.
    """

    tokens: DataFrame      # doc_id, title, length, tokens (token, n); file, if there are files
    terms: DataFrame       # query_id, term, qn, n_terms
    surfaces: DataFrame    # token, term, n, corpus_tf
    terms_small: bool
    surfaces_small: bool
    n_queries: int
    _kept: list[DataFrame] = field(default_factory=list)

    def term_frequency(self, *carry: str) -> DataFrame:
        return stats.term_frequency(self.tokens, self.surfaces, self.surfaces_small, carry)

    def corpus_stats(self) -> DataFrame:
        return stats.corpus_stats(self.tokens)

    def corpus_term_frequency(self) -> DataFrame:
        return stats.corpus_term_frequency(self.surfaces, self.terms)

    def term_scores(self) -> DataFrame:
        return scoring.dph_term_score(self.term_frequency(), *self._scalars)

    def scores(self, only: DataFrame | None = None) -> DataFrame:
        """``(query_id, doc_id, score)`` of the pairs whose score is not 0, for all queries
        or ``only`` for those with a ``query_id`` in a table.

        A term with more occurrences than there are documents scores 0 everywhere and adds
        nothing to any sum. Its tokens are left out of the join with the surface forms, so
        the most frequent terms, which would make most of the rows, make none.
        """
        n_docs, avg_length = self._scalars
        asked = self.terms
        telling = self.surfaces.where(F.col("corpus_tf") <= n_docs)
        if only is not None:
            small = self.terms_small
            asked = asked.join(broadcast_if(only, small), "query_id", "left_semi")
            telling = telling.join(broadcast_if(asked.select("term"), small), "term", "left_semi")
        tf = stats.term_frequency(self.tokens, telling, self.surfaces_small)
        return scoring.dph_query_score(
            scoring.dph_term_score(tf, n_docs, avg_length), asked, self.terms_small
        )

    def best_scores(self, k: int, sample: int = pruning.SAMPLE) -> DataFrame:
        """Rows of ``scores`` among which are the ``k`` best of every query, and the others only
        as far as they could be: see ``pruning``. One document of so many is scored in full
        before the rest. Worth it for few queries of a large corpus, whose best are far above
        most; where nothing can be left out it costs two readings of the kept tokens more."""
        n_docs, avg_length = self._scalars
        telling = self.surfaces.where(F.col("corpus_tf") <= n_docs)

        def term_scores(tokens: DataFrame) -> DataFrame:
            tf = stats.term_frequency(tokens, telling, self.surfaces_small)
            return scoring.dph_term_score(tf, n_docs, avg_length)

        few = self.tokens.where(pruning.sampled(F.col("doc_id"), sample))
        some = scoring.dph_query_score(term_scores(few), self.terms, self.terms_small)
        scored = term_scores(self.tokens)
        essential = checkpointed(pruning.essential_terms(
            self.terms, pruning.term_bounds(scored), pruning.floors(some, k)))
        return scoring.sum_of_terms(
            pruning.possible_pairs(scored, self.terms, essential, self.terms_small))

    @cached_property
    def _scalars(self) -> tuple[Column, Column]:
        row = self.corpus_stats().first()
        average = row["avg_length"] if row["n_docs"] else 0.0
        return F.lit(row["n_docs"]), F.lit(average)

    def files(self, entries: DataFrame) -> list[str] | None:
        """The files that hold the articles of some entries; None if that is not known, or
        there are too many of them to name."""
        if "file" not in self.tokens.columns:
            return None
        ids = entries.select("doc_id").distinct()
        named = self.tokens.join(broadcast_if(ids, is_small(ids)), "doc_id", "left_semi")
        rows = named.select("file").distinct().limit(MAX_FILES + 1).collect()
        return [r["file"] for r in rows] if len(rows) <= MAX_FILES else None

    def release(self) -> None:
        for df in self._kept:
            df.unpersist()


def prepare(articles: DataFrame, queries: DataFrame, stopwords: Iterable[str] = ENGLISH,
            partitions: int | None = None, limits: Limits = Limits()) -> Corpus:
    """Tokenise the articles and match their tokens with the terms of the queries.

    ``partitions`` spreads the index texts before the work on them; see ``rank_documents``.
    The tables of the result are kept in memory and on disk until ``release``; on an error
    they are released at once. Articles without an id, or with the same one, are an error.
    """
    stopwords = list(stopwords)
    kept = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist())
        return kept[-1]

    try:
        query_terms = keep(terms.query_terms(terms.parse_queries(queries, stopwords, limits)))
        n_bytes, starts = terms.term_starts(query_terms)
        terms_small = n_bytes <= BROADCAST_BYTES

        texts = index_texts(articles, from_files(articles))
        if partitions:
            texts = spread(texts, partitions)
        tokens = terms.keep_possible_tokens(article_tokens(texts, stopwords, limits), starts)
        # Counted before they are shuffled, so that repeats do not travel.
        tokens = keep(terms.count_tokens(tokens).repartition("doc_id"))
        stats.check_ids(tokens)

        surfaces = keep(terms.surface_forms(tokens, query_terms, terms_small))
        return Corpus(
            tokens, query_terms, surfaces, terms_small, is_small(surfaces), queries.count(), kept
        )
    except BaseException:
        for df in kept:
            df.unpersist()
        raise


def with_articles(entries: DataFrame, articles: DataFrame, small: bool,
                  files: list[str] | None = None) -> DataFrame:
    """``(query_id, rank, doc_id, score, article)``: the full article of each entry. Entries
    that may be broadcast (``small``) filter the articles where they are read. Articles have
    a title and ids that are unique among those.

    ``files`` names the files that hold the articles of all entries, as far as that is known:
    Spark then leaves all others out when it plans the scan, and does not open them."""
    if files is not None:
        articles = articles.where(F.col(FILE).isin(files))
    article = F.struct(*[F.col(c) for c in articles.columns if c != "doc_id"])
    return broadcast_if(entries, small).join(
        articles_with_title(articles).select("doc_id", article.alias("article")), "doc_id"
    ).select("query_id", "rank", "doc_id", "score", "article")


def document_rankings(queries: DataFrame, entries: DataFrame) -> DataFrame:
    """``(query_id, original_query, results)``: one row per query, also where nothing was
    found, with its entries as an array in rank order."""
    entry = F.struct("rank", "doc_id", "score", "article")
    results = entries.groupBy("query_id").agg(
        F.array_sort(
            F.collect_list(entry),
            lambda a, b: a["rank"] - b["rank"],
        ).alias("results")
    )
    return queries.join(results, "query_id", "left").withColumn(
        "results", F.coalesce("results", F.array())
    )


def rank_documents(articles: DataFrame, queries: DataFrame, k: int = ranking.TOP_K,
                   min_distance: float = ranking.MIN_DISTANCE,
                   stopwords: Iterable[str] = ENGLISH, partitions: int | None = None,
                   duplicates: str = "error", missing_ids: str = "error",
                   chunk: int = ranking.CHUNK, limits: Limits = Limits(),
                   prune: bool = False) -> DataFrame:
    """Rank the articles for each query: ``(query_id, original_query, results)``.

    ``articles`` has ``title``, ``contents`` and a unique ``doc_id`` (``id`` if there is
    none), and any other columns; ``queries`` has ``query_id`` and ``original_query``.
    ``results`` is an array of ``(rank, doc_id, score, article)``.

    ``partitions`` deals the index texts out evenly over so many partitions before they
    are tokenised: for a source with fewer splits than cores. By default they stay where
    their source put them, as shuffling the text of a large corpus costs more than it gains.

    Several articles with one id, ranked or not, are an error; ``duplicates="drop"`` takes
    one article of each id instead. So are articles without an id; ``missing_ids="drop"``
    leaves them out of everything. ``chunk`` is how many candidates of a query the choice of
    distant titles looks at in one round; it does not change the result. ``limits`` says
    what the tokeniser drops; ``NO_LIMITS`` keeps everything. ``prune`` leaves out pairs that
    cannot be among the first ``chunk`` of their query before they are scored; it does not
    change the result, see ``Corpus.best_scores``.
    """
    for name, value in (("duplicates", duplicates), ("missing_ids", missing_ids)):
        if value not in ("error", "drop"):
            raise ValueError(f"{name} must be error or drop, not {value!r}")
    if "doc_id" not in articles.columns:
        articles = articles.withColumn("doc_id", F.col("id"))
    if missing_ids == "drop":
        articles = articles.where(F.col("doc_id").isNotNull())
    if duplicates == "drop":
        articles = one_per_id(articles_with_title(articles))
    # Read and numbered once: a second reading might find other files, and other numbers.
    queries = checkpointed(unique_queries(queries))
    corpus = prepare(articles, queries, stopwords, partitions, limits)
    try:
        entries = checkpointed(ranking.diverse_top_k(
            corpus.best_scores(chunk) if prune else corpus.scores(),
            corpus.tokens, corpus.n_queries, k, min_distance, chunk, scores_of=corpus.scores,
        ))
        files = corpus.files(entries)
    finally:
        corpus.release()
    return document_rankings(queries, with_articles(entries, articles, is_small(entries), files))


def rank_files(spark: SparkSession, query_path: str, article_path: str, out: str,
               mode: str = "failfast", form: str = "text", **options) -> str:
    """Rank the articles of a JSON-lines file for the queries of a text file and write the
    rankings into a new folder under ``out``. Returns that folder. Nothing else is left."""
    with intermediates(spark):
        rankings = rank_documents(
            read_articles(spark, article_path, mode), read_queries(spark, query_path), **options
        )
        return write_rankings(rankings, out, form)
