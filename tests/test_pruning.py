"""Pruned scores: the best of every query are those of all pairs, with fewer pairs scored."""

import random

import pytest
from plain_model import rank
from test_job import QUERIES, corpus, frames, results, same

from broadsheet import rank_documents
from broadsheet.operators import pruning, ranking
from broadsheet.plans import ranking_job

BOUNDS = "term string, bound double"
TERMS = "query_id long, term string, qn long, n_terms long"


def best(scores, k):
    return [(r.query_id, r["rank"], r.doc_id, round(r.score, 9))
            for r in ranking.top_k(scores, k).orderBy("query_id", "rank").collect()]


def prepared_from(spark, articles, queries, partitions=1):
    parsed, asked = frames(spark, articles, queries, partitions)
    return ranking_job.prepare(parsed.withColumnRenamed("id", "doc_id"), asked)


def telling_corpus(n=400, seed=9):
    """A word that half of the articles have, one that few have, and a filler of many forms."""
    rng = random.Random(seed)
    articles = []
    for i in range(n):
        words = [f"word{rng.randrange(4000)}x" for _ in range(rng.randint(20, 60))]
        words += ["harbour"] * (rng.random() < 0.5) + ["zeppelin"] * (i % 13 == 0) * rng.randint(1, 3)
        rng.shuffle(words)
        articles.append({"id": f"d{i:03d}", "title": f"title {i}", "source": "s", "published_date": i,
                         "contents": [{"subtype": "paragraph", "content": " ".join(words)}]})
    return articles


@pytest.mark.parametrize("k, sample", [(1, 2), (4, 3), (10, 1), (150, 2)])
def test_the_best_are_those_of_all_pairs(spark, k, sample):
    prepared = prepared_from(spark, corpus(), QUERIES)
    assert best(prepared.best_scores(k, sample), k) == best(prepared.scores(), k)
    prepared.release()


def test_few_pairs_are_scored(spark):
    prepared = prepared_from(spark, telling_corpus(), ["zeppelin harbour", "harbour"], 4)
    every = {(r.query_id, r.doc_id) for r in prepared.scores().collect()}
    pruned = {(r.query_id, r.doc_id) for r in prepared.best_scores(5, 2).collect()}
    assert best(prepared.best_scores(5, 2), 5) == best(prepared.scores(), 5)
    # Of the first query only articles with the rare word; those of the other have one term.
    assert pruned < every
    assert sum(q == 0 for q, _ in pruned) == 31 and sum(q == 0 for q, _ in every) > 200
    assert {d for q, d in pruned if q == 1} == {d for q, d in every if q == 1}
    prepared.release()


def test_negative_scores(spark):
    # Short articles that are mostly one frequent word: its score is below 0 in many of them.
    rng = random.Random(2)
    articles = [{"id": f"d{i:03d}", "title": "a b", "source": "s", "published_date": i, "contents": [
        {"subtype": "paragraph", "content": " ".join(
            ["harbour"] * (i % 3 == 0) * (1 if i % 2 else 4) + ["coast"] * (i % 5 == 0)
            + [f"w{rng.randrange(900)}q" for _ in range(rng.choice([0, 2, 70]))])}]} for i in range(120)]
    prepared = prepared_from(spark, articles, ["harbour coast", "harbour"], 2)
    scores = prepared.scores().collect()
    assert min(r.score for r in scores) < 0 < max(r.score for r in scores)
    for k in (2, 20, 60, 500):
        assert best(prepared.best_scores(k, 2), k) == best(prepared.scores(), k)
    prepared.release()


def test_essential_terms(spark):
    terms = spark.createDataFrame(
        [(q, t, n, 4) for q in range(5) for t, n in (("a", 1), ("b", 2), ("c", 1))], TERMS)
    bounds = spark.createDataFrame([("a", 4.0), ("b", 4.0)], BOUNDS)  # c occurs nowhere
    floors = spark.createDataFrame([(0, 3.0), (1, 1.0), (2, 0.5), (3, -1.0), (5, 1.0)],
                                   "query_id long, floor double")
    rows = pruning.essential_terms(terms, bounds, floors)
    assert rows.columns == terms.columns
    found = {q: "".join(sorted(r.term for r in rows.where(f"query_id = {q}").collect())) for q in range(5)}
    # Bounds of a document: c 0, a 1, b 2. A bound equal to the floor may reach it by its id.
    assert found == {0: "b", 1: "ab", 2: "ab", 3: "abc", 4: "abc"}


def test_whole_job(spark):
    articles = corpus()
    found = rank_documents(*frames(spark, articles, QUERIES, 3), prune=True, chunk=12)
    same(results(found), rank(articles, QUERIES))


def test_without_broadcasts(spark, monkeypatch):
    import broadsheet.cluster
    monkeypatch.setattr(broadsheet.cluster, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(ranking_job, "BROADCAST_BYTES", -1)
    prepared = prepared_from(spark, corpus(), QUERIES)
    assert best(prepared.best_scores(3, 2), 3) == best(prepared.scores(), 3)
    prepared.release()


def test_nothing_to_score(spark):
    for articles, queries in (([], QUERIES), (corpus(20), ["quetzal", "the of"])):
        prepared = prepared_from(spark, articles, queries)
        assert prepared.best_scores(10).count() == 0
        prepared.release()


def test_documents_are_not_shuffled(spark):
    prepared = prepared_from(spark, corpus(), QUERIES, 3)
    plan = prepared.best_scores(5, 2)._jdf.queryExecution().executedPlan().toString()
    above_the_kept_tokens = plan.split("InMemoryRelation")[0]
    assert "Window" in above_the_kept_tokens and "hashpartitioning" not in above_the_kept_tokens
    prepared.release()


def test_queries_of_a_document_are_found_once(spark):
    """Not again for each of its terms: the list of them is made by one row per document."""
    scores = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "b", 3.0)], "doc_id long, term string, score double")
    terms = spark.createDataFrame([(7, "a", 1, 2), (7, "b", 1, 2), (8, "b", 2, 2)],
                                  "query_id long, term string, qn long, n_terms long")
    found = pruning.possible_pairs(scores, terms, terms.where("term = 'a'"), True)
    assert sorted((r.query_id, r.doc_id, r.term, r.qn, r.score) for r in found.collect()) == [
        (7, 1, "a", 1, 1.0), (7, 1, "b", 1, 2.0)]
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
