import json
import random
from pathlib import Path

import pytest
from plain_model import rank
from pyspark.sql import functions as F

from broadsheet import rank_documents, rank_files
from broadsheet.functions.stopwords import ENGLISH
from broadsheet.functions.tokens import NO_LIMITS
from broadsheet.plans import ranking_job
from broadsheet.sinks.rankings import read_ranking_texts, write_rankings
from broadsheet.sources.articles import parse_articles, read_articles
from broadsheet.sources.queries import read_queries

WORDS = """rain flood coast storm river warning election vote party minister market shares bank
cup final goal team player running runner runs happily happy nation national nationality the a
of and is generalization general café 2024""".split()
QUERIES = ["rain rain flood", "national elections", "the of and", "running happily", "rain rain flood",
           "quetzal", "market shares/banks", "The cup final"]


def corpus(n=150, seed=4):
    rng = random.Random(seed)
    articles = []
    for i in range(n):
        text = lambda a, b: " ".join(rng.choices(WORDS, k=rng.randint(a, b)))
        contents = [
            rng.choice([
                {"subtype": "paragraph", "content": text(1, 20)}, {"subtype": "paragraph"},
                {"content": text(1, 5)}, {"subtype": "title", "content": text(1, 5)}, None,
                {"subtype": "paragraph", "content": text(1, 20), "extra": {"a": 1}},
            ]) for _ in range(rng.randint(0, 9))
        ]
        article = {"id": f"d{i:03d}", "title": rng.choice([text(1, 6), text(1, 6), "rain storm", "", None]),
                   "contents": contents or None, "source": "s", "published_date": i}
        articles.append(article)
    return articles


def write(folder, articles, queries):
    (folder / "articles.json").write_text("".join(json.dumps(a) + "\n" for a in articles))
    (folder / "queries.txt").write_text("".join(q + "\n" for q in queries))


def frames(spark, articles, queries, partitions=1):
    lines = spark.createDataFrame([(json.dumps(a),) for a in articles], "value string")
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id long, original_query string")
    return parse_articles(lines.repartition(partitions)), asked


def results(rankings):
    return {
        r.original_query: [(x.doc_id, round(x.score, 9)) for x in r.results]
        for r in rankings.collect()
    }


def same(found, expected):
    assert found.keys() == expected.keys()
    for query in expected:
        assert [d for d, _ in found[query]] == [d for d, _ in expected[query]], query
        assert [s for _, s in found[query]] == pytest.approx([s for _, s in expected[query]], abs=1e-8)


@pytest.mark.parametrize("partitions, spread", [(1, None), (7, None), (2, 12)])
def test_whole_job_against_the_plain_model(spark, partitions, spread):
    articles = corpus()
    rankings = rank_documents(*frames(spark, articles, QUERIES, partitions), partitions=spread)
    found = results(rankings)
    same(found, rank(articles, QUERIES))
    assert found["the of and"] == [] and found["quetzal"] == []
    assert len(found) == 7


def test_without_broadcasts(spark, monkeypatch):
    import broadsheet.cluster
    monkeypatch.setattr(broadsheet.cluster, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(ranking_job, "BROADCAST_BYTES", -1)
    articles = corpus()
    same(results(rank_documents(*frames(spark, articles, QUERIES))), rank(articles, QUERIES))


def test_broadcasts_go_by_bytes(spark, monkeypatch):
    import broadsheet.cluster
    few = spark.createDataFrame([(1, "x" * 5000, ["y" * 3000])], "a long, b string, c array<string>")
    monkeypatch.setattr(broadsheet.cluster, "BROADCAST_BYTES", 8000)
    assert not broadsheet.cluster.is_small(few)
    assert broadsheet.cluster.is_small(few.select("a", "b")) and broadsheet.cluster.is_small(few.where("false"))


def test_other_k_and_distance(spark):
    articles = corpus()
    found = rank_documents(*frames(spark, articles, QUERIES), k=3, min_distance=0.2)
    same(results(found), rank(articles, QUERIES, 3, 0.2))


def test_copies_of_one_title_fill_a_query(spark):
    # A third of the corpus has one title, and more of it than fits a round.
    articles = corpus() + [
        {"id": f"e{i:03d}", "title": "rain and flood", "contents": [
            {"subtype": "paragraph", "content": "rain " * (i % 7) + "storm " * (i % 5)}]}
        for i in range(90)
    ]
    found = rank_documents(*frames(spark, articles, QUERIES, 5), chunk=20)
    same(results(found), rank(articles, QUERIES))


def test_full_articles_come_with_the_results(spark):
    articles = corpus()
    by_id = {a["id"]: a for a in articles}
    for row in rank_documents(*frames(spark, articles, ["rain"])).collect():
        assert [x["rank"] for x in row.results] == list(range(1, len(row.results) + 1))
        for x in row.results:
            assert x.article.id == x.doc_id
            assert x.article.title == by_id[x.doc_id]["title"]
            assert x.article.published_date == by_id[x.doc_id]["published_date"]


def test_empty_corpus(spark):
    articles, queries = frames(spark, [{"id": "a", "title": "", "contents": []}], ["rain", "sun"])
    assert results(rank_documents(articles, queries)) == {"rain": [], "sun": []}


def test_two_articles_with_one_id(spark):
    articles = [{"id": "a", "title": "rain storm", "contents": []},
                {"id": "b", "title": "sunny day", "contents": []},
                {"id": "b", "title": "wind and snow", "contents": []}]
    # It does not matter whether a query ranks it: its scores would be added up.
    for query in ("rain", "sunny"):
        with pytest.raises(ValueError, match="2 articles have the id b"):
            rank_documents(*frames(spark, articles, [query]))
    found = rank_documents(*frames(spark, articles, ["sunny"]), duplicates="drop").collect()
    assert [x.doc_id for x in found[0].results] == ["b"]


def test_an_id_shared_with_an_untitled_article(spark):
    articles = [{"id": "a", "title": "rain storm", "contents": []},
                {"id": "a", "title": "", "contents": []}]
    for option in ("error", "drop"):
        found = results(rank_documents(*frames(spark, articles, ["storm"]), duplicates=option))
        assert [d for d, _ in found["storm"]] == ["a"]


def test_articles_without_an_id(spark):
    titles = ["rain on one hill", "rain above two towns", "seven rain clouds", "a rain of frogs",
              "rain tomorrow morning", "late rain"]
    articles = [{"id": None if i == 5 else f"a{i}", "title": t, "contents": []}
                for i, t in enumerate(titles)]
    articles += [{"id": f"z{i}", "title": "sun " * (i + 1), "contents": []} for i in range(9)]
    with pytest.raises(ValueError, match="1 articles have no id"):
        rank_documents(*frames(spark, articles, ["rain"]), k=4, chunk=2)
    found = rank_documents(*frames(spark, articles, ["rain"]), k=4, chunk=2, missing_ids="drop")
    same(results(found), rank([a for a in articles if a["id"]], ["rain"], 4))
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_nothing_stays_persisted_after_a_failure(spark, tmp_path):
    write(tmp_path, corpus(40), ["rain"])
    with open(tmp_path / "articles.json", "a") as file:
        file.write("no article\n")
    with pytest.raises(Exception, match="malformed line"):
        rank_files(spark, str(tmp_path / "queries.txt"), str(tmp_path / "articles.json"), str(tmp_path / "out"))
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_any_query_has_its_file(spark, tmp_path):
    long = " ".join(f"rain{i}" for i in range(60))
    queries = ["flood word", "flood_word", "flood/word", "", long, long + "x"]
    frame = spark.createDataFrame(list(enumerate(queries)), "query_id long, original_query string")
    articles, _ = frames(spark, corpus(40), ["rain"])
    path = write_rankings(rank_documents(articles, frame), str(tmp_path))
    names = {r.query_id: r.original_query for r in spark.read.parquet(f"{path}/queries").collect()}
    assert names == dict(enumerate(queries))
    bodies = {r.query_id: r.body for r in read_ranking_texts(spark, path).collect()}
    assert {i: body.split("\n")[0] for i, body in bodies.items()} == names


def test_limits_of_tokens_are_an_argument(spark):
    articles = [{"id": "a", "title": "call 123456 now", "contents": []},
                {"id": "b", "title": "zzzzz sleep", "contents": []},
                {"id": "c", "title": "nothing here", "contents": []}]
    asked = ["123456", "zzzzz"]
    assert results(rank_documents(*frames(spark, articles, asked))) == {"123456": [], "zzzzz": []}
    found = results(rank_documents(*frames(spark, articles, asked), limits=NO_LIMITS))
    assert {q: [d for d, _ in rows] for q, rows in found.items()} == {"123456": ["a"], "zzzzz": ["b"]}


def test_files_in_and_out(spark, tmp_path):
    articles = corpus()
    write(tmp_path, articles, QUERIES)
    out = rank_files(spark, str(tmp_path / "queries.txt"), str(tmp_path / "articles.json"),
                     str(tmp_path / "new" / "out"))
    expected = rank(articles, QUERIES)
    titles = {a["id"]: a["title"] for a in articles}
    ids = {r.original_query: r.query_id for r in spark.read.parquet(f"{out}/queries").collect()}
    folders = {p.name: p for p in (Path(out) / "rankings").iterdir() if p.is_dir()}
    assert len(folders) == len(expected) == len(ids)
    for query, entries in expected.items():
        (part,) = folders[f"query_id={ids[query]}"].glob("part-*")
        lines = part.read_text().splitlines()
        assert lines[0] == query
        assert len(lines) == 1 + len(entries)
        for rank_, (line, (doc_id, score)) in enumerate(zip(lines[1:], entries), 1):
            assert line.startswith(f"  {rank_}:{doc_id} ")
            assert float(line.split(" ")[3]) == pytest.approx(score, abs=1e-8)
            assert line.endswith(" " + titles[doc_id])


def test_parquet_out(spark, tmp_path):
    articles = corpus(40)
    write(tmp_path, articles, ["rain"])
    out = rank_files(spark, str(tmp_path / "queries.txt"), str(tmp_path / "articles.json"),
                     str(tmp_path / "out"), form="parquet")
    same(results(spark.read.parquet(out)), rank(articles, ["rain"]))


def test_bad_lines_fail_the_job_or_are_left_out(spark, tmp_path):
    write(tmp_path, corpus(40), ["rain"])
    with open(tmp_path / "articles.json", "a") as file:
        file.write("no article\n")
    paths = str(tmp_path / "queries.txt"), str(tmp_path / "articles.json"), str(tmp_path / "out")
    with pytest.raises(Exception, match="malformed line"):
        rank_files(spark, *paths)
    out = rank_files(spark, *paths, mode="drop", form="parquet")
    same(results(spark.read.parquet(out)), rank(corpus(40), ["rain"]))


def test_no_documents_are_shuffled_after_the_tokens(spark):
    articles, queries = frames(spark, corpus(), QUERIES)
    prepared = ranking_job.prepare(articles.withColumn("doc_id", F.col("id")), queries)
    plan = prepared.scores()._jdf.queryExecution().executedPlan().toString()
    # Scores are sums within the partitions of the kept tokens: apart from what lies behind
    # those, nothing is shuffled but the small tables on their way to a broadcast.
    main = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in main.split("InMemoryRelation")[0]
    prepared.release()
    assert ENGLISH


def everything_below(folder):
    return sorted(str(p) for p in Path(folder).rglob("*") if p.is_file())


@pytest.fixture
def shared(spark, tmp_path, monkeypatch):
    """A shared folder of its own, to see what is left in it."""
    context, folder = spark.sparkContext, str(tmp_path / "shared")
    old = context.getCheckpointDir()
    context.setCheckpointDir(folder)
    monkeypatch.setattr("broadsheet.cluster.shared_folder", lambda spark: folder)
    yield tmp_path / "shared"
    if old:
        context.setCheckpointDir(old)


def test_nothing_is_left_behind(spark, tmp_path, shared):
    """No file of an intermediate table stays, after a good run and after a failed one."""
    write(tmp_path, corpus(), QUERIES)
    paths = str(tmp_path / "queries.txt"), str(tmp_path / "articles.json"), str(tmp_path / "out")
    rank_files(spark, *paths, chunk=5)
    assert everything_below(shared) == []
    with open(tmp_path / "articles.json", "a") as file:
        file.write("no article\n")
    with pytest.raises(Exception, match="malformed line"):
        rank_files(spark, *paths)
    assert everything_below(shared) == []


def test_a_scope_owns_what_is_made_within_it(spark, shared):
    from broadsheet import intermediates
    from broadsheet.cluster import checkpointed, new_folder

    kept = checkpointed(spark.range(3))
    with intermediates(spark):
        outer = new_folder(spark, "outer")
        spark.range(3).write.parquet(outer)
        with intermediates(spark):
            inner = checkpointed(spark.range(5))
            assert inner.count() == 5
        n = len(everything_below(shared))
        assert spark.read.parquet(outer).count() == 3
    assert 0 < len(everything_below(shared)) < n
    assert kept.count() == 3


def test_a_failed_write_shows_nothing(spark, tmp_path, monkeypatch):
    """The second of two tables fails: no folder of results is there, nor a part of one."""
    from pyspark.sql import DataFrameWriter

    articles, queries = frames(spark, corpus(40), ["rain"])
    rankings = rank_documents(articles, queries)
    parquet = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        (_ for _ in ()).throw(OSError("disk full")) if path.endswith("/queries") else parquet(self, path, *a, **k)))
    with pytest.raises(OSError, match="disk full"):
        write_rankings(rankings, str(tmp_path / "out"))
    assert everything_below(tmp_path / "out") == []
    monkeypatch.undo()
    path = write_rankings(rankings, str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out").iterdir()] == [Path(path).name]
    assert (Path(path) / "_DONE").exists()


def test_files_without_ranked_articles_are_not_read_again(spark, tmp_path):
    """Ten files, of which one holds all that is ranked: the others may be gone by then."""
    for i in range(10):
        word = "storm" if i == 7 else "sun"
        (tmp_path / f"{i}.json").write_text("".join(json.dumps(
            {"id": f"{i}-{j}", "title": f"{word} {'abcdefgh'[j] * 20}", "contents": []}) + "\n" for j in range(8)))
    queries = spark.createDataFrame([(1, "storm")], "query_id long, original_query string")
    articles = read_articles(spark, f"{tmp_path}/*.json").where("title is not null")
    rankings = rank_documents(articles, queries)
    for i in range(10):
        if i != 7:
            (tmp_path / f"{i}.json").unlink()
    (row,) = rankings.collect()
    assert sorted(x.doc_id for x in row.results) == [f"7-{j}" for j in range(8)]
    assert {x.article.title for x in row.results} == {f"storm {c * 20}" for c in "abcdefgh"}


def test_articles_that_are_no_files_are_looked_up_in_all(spark, monkeypatch):
    articles, queries = frames(spark, corpus(40), ["rain"])
    same(results(rank_documents(articles, queries)), rank(corpus(40), ["rain"]))


def test_too_many_files_to_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranking_job, "MAX_FILES", 1)
    frame, queries = frames(spark, corpus(40), ["rain", "storm"])
    frame.repartition(6).write.parquet(str(tmp_path / "articles"))
    found = rank_documents(spark.read.parquet(str(tmp_path / "articles")), queries)
    same(results(found), rank(corpus(40), ["rain", "storm"]))
