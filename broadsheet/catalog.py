"""Every operator as a query over the driver's tables: name -> (spark, sf_dir) -> rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.cluster import checkpointed, is_small, new_folder
from broadsheet.functions import distance, tokens
from broadsheet.operators import articles as article_ops
from broadsheet.operators import indexing, ranking, stats, terms
from broadsheet.plans import ranking_job, tables
from broadsheet.sinks.rankings import ranking_text as rankings_as_text
from broadsheet.sinks.rankings import read_ranking_texts, write_rankings
from broadsheet.sources import articles as article_source
from broadsheet.sources.lines import scan_lines

REPORTED_PLACES = 6
INDEX_PARTITIONS = 12


# Inputs

def _query_file(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "query-lines")
    tables.queries(spark, sf_dir).select("original_query").write.text(path)
    return path


def _article_lines(spark: SparkSession, sf_dir: str, extra_fields: bool = False) -> DataFrame:
    articles = tables.articles(spark, sf_dir, extra_fields).drop("doc_id")
    return articles.select(F.to_json(F.struct(*articles.columns)).alias("value"))


def _article_file(spark: SparkSession, sf_dir: str, extra_fields: bool = False) -> str:
    path = new_folder(spark, "article-lines")
    _article_lines(spark, sf_dir, extra_fields).write.text(path)
    return path


def _index_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = article_ops.index_texts(tables.articles(spark, sf_dir))
    partitions = tables.scan_partitions(spark, sf_dir)
    return indexing.spread(texts, partitions) if partitions else texts


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article_ops.article_tokens(_index_texts(spark, sf_dir))


# The statistics that the last query of a session started from.
_kept: dict[str, ranking_job.Corpus] = {}


def _corpus(spark: SparkSession, sf_dir: str) -> ranking_job.Corpus:
    """The statistics a query starts from. Its rows are computed after it has returned, so
    the tables behind it are released when the next query of the session asks for its own.
    Those of a session that has ended went with it."""
    session = spark.sparkContext.applicationId
    for other in list(_kept):
        corpus = _kept.pop(other)
        if other == session:
            corpus.release()
    _kept[session] = ranking_job.prepare(
        tables.articles(spark, sf_dir), tables.queries(spark, sf_dir),
        partitions=tables.scan_partitions(spark, sf_dir),
    )
    return _kept[session]


def _diverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = _corpus(spark, sf_dir)
    return ranking.diverse_top_k(
        corpus.scores(), corpus.tokens, corpus.n_queries, scores_of=corpus.scores
    )


def _rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking_job.rank_documents(
        tables.articles(spark, sf_dir), tables.queries(spark, sf_dir),
        partitions=tables.scan_partitions(spark, sf_dir),
    )


def _reported(score: str = "score"):
    return F.round(score, REPORTED_PLACES).alias("score")


# Scans and parsing

def scan_queries(spark, sf_dir):
    return scan_lines(spark, _query_file(spark, sf_dir)).withColumnRenamed("value", "line")


def scan_articles(spark, sf_dir):
    line = scan_lines(spark, _article_file(spark, sf_dir))
    return line.select(
        F.get_json_object("value", "$.id").cast("bigint").alias("doc_id"),
        F.length(F.get_json_object("value", "$.title")).alias("n_chars"),
    )


def parse_articles(spark, sf_dir):
    articles = article_source.parse_articles(_article_lines(spark, sf_dir))
    paragraphs = F.filter("contents", lambda item: item["subtype"].eqNullSafe("paragraph"))
    return articles.select(
        "id", "title", "published_date",
        F.size("contents").alias("n_items"), F.size(paragraphs).alias("n_paragraphs"),
    )


def bad_article_lines(spark, sf_dir):
    lines = _article_lines(spark, sf_dir, extra_fields=True)
    return article_source.bad_article_lines(lines).select(
        F.get_json_object("value", "$.id").alias("id"),
        "problem", F.array_join("unknown", ",").alias("unknown"),
    )


def sorted_article_lines(spark, sf_dir):
    """Articles and bad lines out of one pass over a file of lines."""
    lines = scan_lines(spark, _article_file(spark, sf_dir, extra_fields=True))
    good, bad = article_source.sort_article_lines(lines)
    return good.select("id", F.lit("article").alias("kind"), F.size("contents").alias("n_items")).unionByName(
        bad.select(F.get_json_object("value", "$.id").alias("id"), F.col("problem").alias("kind"),
                   F.lit(0).alias("n_items")))


def parse_queries(spark, sf_dir):
    return terms.parse_queries(tables.queries(spark, sf_dir))


# Text to terms

def tokenize(spark, sf_dir):
    texts = _index_texts(spark, sf_dir)
    found = tokens.tokenize(F.col("index_text"))
    return texts.select("doc_id", F.posexplode(found).alias("pos", "token"))


def remove_stopwords(spark, sf_dir):
    return _tokens(spark, sf_dir).select("doc_id", F.posexplode("tokens").alias("pos", "token"))


def stem_vocabulary(spark, sf_dir):
    exploded = _tokens(spark, sf_dir).select(F.explode("tokens").alias("token"))
    return terms.stem_vocabulary(exploded).select("token", "stem")


def text_to_terms(spark, sf_dir):
    return terms.text_to_terms(_index_texts(spark, sf_dir), "doc_id", "index_text")


# Articles

def articles_with_title(spark, sf_dir):
    return article_ops.articles_with_title(tables.articles(spark, sf_dir)).select(
        "doc_id", "title"
    )


def lead_paragraphs(spark, sf_dir):
    articles = article_ops.articles_with_title(tables.articles(spark, sf_dir))
    leads = article_ops.lead_paragraphs(F.col("contents"))
    return articles.select("doc_id", F.posexplode(leads).alias("pos", "paragraph"))


def index_text(spark, sf_dir):
    return article_ops.index_texts(tables.articles(spark, sf_dir)).select(
        "doc_id", "index_text"
    )


def article_stats(spark, sf_dir):
    corpus = _corpus(spark, sf_dir)
    parsed = checkpointed(terms.parse_queries(tables.queries(spark, sf_dir)))
    return stats.article_stats(corpus.term_frequency("title"), parsed, is_small(parsed))


# Statistics

def document_length(spark, sf_dir):
    return stats.document_length(_tokens(spark, sf_dir))


def term_frequency(spark, sf_dir):
    return _corpus(spark, sf_dir).term_frequency().select("doc_id", "term", "tf")


def corpus_stats(spark, sf_dir):
    return stats.corpus_stats(_tokens(spark, sf_dir))


def corpus_term_frequency(spark, sf_dir):
    return _corpus(spark, sf_dir).corpus_term_frequency()


# Scores

def dph_term_score(spark, sf_dir):
    return _corpus(spark, sf_dir).term_scores().select("doc_id", "term", _reported())


def dph_query_score(spark, sf_dir):
    return _corpus(spark, sf_dir).scores().select("query_id", "doc_id", _reported())


def title_distance(spark, sf_dir):
    """How far each of a query's ten best titles is from the very best one."""
    corpus = _corpus(spark, sf_dir)
    top = ranking.top_k(corpus.scores()).join(corpus.tokens.select("doc_id", "title"), "doc_id")
    top = checkpointed(top)
    best = top.where("rank = 1").select("query_id", F.col("title").alias("best"))
    return top.where("rank > 1").join(best, "query_id").select(
        "query_id", "rank", "doc_id",
        F.round(
            distance.title_distance(F.col("title"), F.col("best")), REPORTED_PLACES
        ).alias("distance"),
    )


# Rankings

def rank_by_score(spark, sf_dir):
    return ranking.rank_by_score(_corpus(spark, sf_dir).scores()).select(
        "query_id", "doc_id", "rank"
    )


def top10_plain(spark, sf_dir):
    return ranking.top_k(_corpus(spark, sf_dir).scores()).select(
        "query_id", "rank", "doc_id", _reported()
    )


def top10_pruned(spark, sf_dir):
    """The ten best of each query, without scoring pairs that cannot be among them."""
    return ranking.top_k(_corpus(spark, sf_dir).best_scores(ranking.TOP_K)).select(
        "query_id", "rank", "doc_id", _reported()
    )


def top2000_plain(spark, sf_dir):
    return ranking.top_k(_corpus(spark, sf_dir).scores(), 2000).select(
        "query_id", "rank", "doc_id", _reported()
    )


def top10_diverse(spark, sf_dir):
    return _diverse(spark, sf_dir).select("query_id", "rank", "doc_id", _reported())


def diverse_far_titles(spark, sf_dir):
    """Up to 25 titles far from each other, a few candidates at a time: takes many rounds."""
    corpus = _corpus(spark, sf_dir)
    return ranking.diverse_top_k(
        corpus.scores(), corpus.tokens, corpus.n_queries, k=25, min_distance=0.9, chunk=5,
        scores_of=corpus.scores,
    ).select("query_id", "rank", "doc_id", _reported())


def ranked_article_ids(spark, sf_dir):
    return ranking.ranked_article_ids(_diverse(spark, sf_dir))


def ranked_articles(spark, sf_dir):
    articles = tables.articles(spark, sf_dir)
    return ranking.ranked_articles(articles, _diverse(spark, sf_dir)).select("doc_id", "title")


def ranking_with_articles(spark, sf_dir):
    top = _diverse(spark, sf_dir)
    entries = ranking_job.with_articles(top, tables.articles(spark, sf_dir), is_small(top))
    return entries.select(
        "query_id", "rank", "doc_id", "article.title", "article.type", "article.source"
    )


def document_rankings(spark, sf_dir):
    ids = F.transform("results", lambda result: result["doc_id"].cast("string"))
    return _rankings(spark, sf_dir).select(
        "query_id", F.size("results").alias("n_results"), F.array_join(ids, ",").alias("doc_ids")
    )


def word_rankings(spark, sf_dir):
    """Each distinct token of the benchmark texts as a query: many find little or nothing."""
    words = tables.queries(spark, sf_dir).select(
        F.explode(tokens.tokenize(F.col("original_query"), tokens.NO_LIMITS)).alias("word"))
    queries = words.groupBy("word").agg(F.xxhash64("word").alias("query_id")).select(
        "query_id", F.col("word").alias("original_query"))
    ids = F.transform("results", lambda result: result["doc_id"].cast("string"))
    return ranking_job.rank_documents(
        tables.articles(spark, sf_dir), queries, partitions=tables.scan_partitions(spark, sf_dir),
    ).select(F.col("original_query").alias("word"), F.size("results").alias("n_results"),
             F.array_join(ids, ",").alias("doc_ids"))


def written_rankings(spark, sf_dir):
    """The rankings of all queries, written as text files and read back."""
    path = write_rankings(_rankings(spark, sf_dir), new_folder(spark, "rankings"))
    names = spark.read.parquet(f"{path}/queries")
    first = F.substring_index("body", "\n", 1)
    return read_ranking_texts(spark, path).join(names, "query_id").select(
        "query_id", (first == F.col("original_query")).alias("names_query"),
        (F.size(F.split(F.regexp_replace("body", "\n$", ""), "\n")) - 1).alias("n_results"))


def ranking_text(spark, sf_dir):
    six_places = lambda score: F.format_string("%.6f", F.round(score, REPORTED_PLACES))
    return rankings_as_text(_rankings(spark, sf_dir), six_places).select("query_id", "body")


# Partitions

def article_index(spark, sf_dir):
    return indexing.article_index(tables.articles(spark, sf_dir).select("doc_id"))


def index_partition(spark, sf_dir):
    indexed = indexing.index_partition(article_index(spark, sf_dir), INDEX_PARTITIONS)
    return indexed.groupBy("part").agg(F.count("*").alias("n_articles"))


QUERIES = {
    query.__name__: query
    for query in (
        scan_queries, scan_articles, parse_articles, bad_article_lines, sorted_article_lines,
        parse_queries,
        tokenize, remove_stopwords, stem_vocabulary, text_to_terms,
        articles_with_title, lead_paragraphs, index_text, article_stats,
        document_length, term_frequency, corpus_stats, corpus_term_frequency,
        dph_term_score, dph_query_score, title_distance,
        rank_by_score, top10_plain, top10_pruned, top2000_plain, top10_diverse, diverse_far_titles,
        ranked_article_ids, ranked_articles,
        ranking_with_articles, document_rankings, word_rankings,
        ranking_text, written_rankings,
        article_index, index_partition,
    )
}
