"""Tokens to terms: stemming over a vocabulary, and the terms of queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if, checkpointed, row_bytes
from broadsheet.functions.porter import starts, stem
from broadsheet.functions.stopwords import ENGLISH
from broadsheet.functions.tokens import Limits, remove_stopwords, tokenize

# Tokens whose stems are looked up rather than worked out, and how long they may be: a table
# of a few MB, broadcast.
FREQUENT_TOKENS = 50_000
FREQUENT_CHARS = 64

# How many letters of a token are compared with the beginnings of terms, and how many different
# beginnings there may be, else fewer letters are taken. It sets the work, not the result.
START_LETTERS = 5, 4, 3
MAX_STARTS = 48_000


def stem_vocabulary(tokens: DataFrame) -> DataFrame:
    """``(token, n, stem)``: the distinct values of a column ``token``, how often each
    occurs, and its stem. Counting comes before stemming, so a token is stemmed once. A
    column ``n``, if there is one, says how often each row counts."""
    n = F.sum("n") if "n" in tokens.columns else F.count("*")
    counts = tokens.groupBy("token").agg(n.alias("n"))
    return counts.withColumn("stem", stem(F.col("token")))


def text_to_terms(texts: DataFrame, key: str, text: str, stopwords: Iterable[str] = ENGLISH,
                  limits: Limits = Limits(), frequent: int = FREQUENT_TOKENS) -> DataFrame:
    """``(key, pos, term)``: the terms of each text, in order, repeats kept.

    A counting pass finds the most frequent tokens; their stems are broadcast, a bounded
    table, and cover nearly every occurrence. The other tokens are stemmed where they are.
    No token is shuffled, however large the vocabulary.
    """
    found = remove_stopwords(tokenize(F.col(text), limits), stopwords)
    counts = texts.select(F.explode(found).alias("token")).groupBy("token").agg(
        F.count("*").alias("n"))
    most = counts.where(F.length("token") <= FREQUENT_CHARS).orderBy(
        F.desc("n"), "token").limit(frequent)
    stems = checkpointed(most.select("token", stem(F.col("token")).alias("stem")))
    return texts.select(key, F.posexplode(found).alias("pos", "token")).join(
        F.broadcast(stems), "token", "left"
    ).select(key, "pos", F.coalesce("stem", stem(F.col("token"))).alias("term"))


def parse_queries(queries: DataFrame, stopwords: Iterable[str] = ENGLISH,
                  limits: Limits = Limits()) -> DataFrame:
    """``(query_id, pos, term, cnt)``: the terms of each query, in order, repeats kept.

    ``cnt`` is 1 for every term. A query of nothing but stop words has no row.
    """
    tokens = queries.select(
        "query_id",
        F.posexplode(
            remove_stopwords(tokenize(F.col("original_query"), limits), stopwords)
        ).alias("pos", "token"),
    )
    return tokens.select(
        "query_id", "pos", stem(F.col("token")).alias("term"),
        F.lit(1).cast("smallint").alias("cnt"),
    )


def query_terms(parsed: DataFrame) -> DataFrame:
    """``(query_id, term, qn, n_terms)``: how often a query has each of its terms, and how
    many terms it has in all."""
    counts = parsed.groupBy("query_id", "term").agg(F.count("*").alias("qn"))
    whole_query = Window.partitionBy("query_id")
    return counts.withColumn("n_terms", F.sum("qn").over(whole_query))


def term_starts(terms: DataFrame, most: int = MAX_STARTS) -> tuple[int, list[str]]:
    """How many bytes the rows take, and letters that any token with one of these terms as its
    stem starts with.

    Five letters each at most, four or three if there are more than ``most`` different beginnings.
    Of three letters there are at most 36 + 36^2 + 36^3, so no more values than that, or than
    ``most``, come to the driver, however many terms there are.
    """
    n_bytes = terms.agg(F.sum(row_bytes(terms))).first()[0] or 0
    for letters in START_LETTERS:
        found = terms.select(F.explode(starts(F.col("term"), letters)).alias("start")).distinct()
        last = letters == START_LETTERS[-1]
        rows = (found if last else found.limit(most + 1)).collect()
        if last or len(rows) <= most:
            return n_bytes, sorted(row["start"] for row in rows)


def keep_possible_tokens(tokens: DataFrame, starts: list[str]) -> DataFrame:
    """Leave in the array column ``tokens`` what may have a stem among the terms.

    This is a test of set membership per token, before any token becomes a row.
    """
    by_length: dict[int, list[str]] = {}
    for start in starts:
        by_length.setdefault(len(start), []).append(start)
    tests = [
        "left(token, {}) IN ({})".format(n, ", ".join(f"'{start}'" for start in group))
        for n, group in sorted(by_length.items())
    ]
    kept = F.expr(f"filter(tokens, token -> {' OR '.join(tests) or 'false'})")
    return tokens.withColumn("tokens", kept)


def count_tokens(tokens: DataFrame) -> DataFrame:
    """The array column ``tokens`` as an array of ``(token, n)``, each different token once: the
    runs of the sorted array. Nothing leaves its row."""
    n = F.size("_sorted")
    at = F.sequence(F.lit(1), n)
    starts = F.when(n > 0, F.filter(at, lambda i: (i == 1) | (
        F.element_at("_sorted", i) != F.element_at("_sorted", F.greatest(i - 1, F.lit(1)))))).otherwise(
        F.array().cast("array<int>"))
    runs = F.transform("_starts", lambda i, j: F.struct(
        F.element_at("_sorted", i).alias("token"),
        (F.coalesce(F.get("_starts", j + 1), n + 1) - i).alias("n")))
    return tokens.withColumn("_sorted", F.sort_array("tokens")).withColumn("_starts", starts).withColumn(
        "tokens", runs).drop("_sorted", "_starts")


def surface_forms(tokens: DataFrame, terms: DataFrame, small: bool) -> DataFrame:
    """``(token, term, n, corpus_tf)``: the tokens of the corpus whose stem is one of the
    terms, how often each occurs, and how often its term does in all its forms. ``small``
    says that the terms may be broadcast."""
    exploded = tokens.select(F.inline("tokens"))
    wanted = terms.select("term").distinct()
    # The terms are distinct, so this is a semi-join. As a semi-join it would be moved
    # below the counting, and every occurrence of a token be stemmed; so would a null
    # check on the stem, which is why the stem is never null.
    term = F.coalesce("stem", F.lit("")).alias("term")
    vocabulary = stem_vocabulary(exploded).select("token", term, "n")
    forms = vocabulary.join(broadcast_if(wanted, small), "term").select("token", "term", "n")
    return forms.withColumn("corpus_tf", F.sum("n").over(Window.partitionBy("term")))
