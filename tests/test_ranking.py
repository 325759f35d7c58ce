import random
import time

import pyarrow as pa
import pytest
from plain_model import edit_distance, greedy
from pyspark.sql import functions as F

import broadsheet.cluster
from broadsheet.functions import distance, nearness
from broadsheet.operators import indexing, ranking

SCORES = "query_id long, doc_id long, score double"


def tables(spark, pairs, titles, partitions=3):
    scores = spark.createDataFrame(pairs, SCORES).repartition(partitions)
    return scores, spark.createDataFrame(list(titles.items()), "doc_id long, title string")


def diverse(spark, pairs, titles, **options):
    scores, titles = tables(spark, pairs, titles)
    n = len({q for q, _, _ in pairs})
    rows = ranking.diverse_top_k(scores, titles, n, **options).orderBy("query_id", "rank").collect()
    result = {}
    for row in rows:
        result.setdefault(row.query_id, []).append(row.doc_id)
        assert row.rank == len(result[row.query_id])
    return result


def random_pairs():
    rng = random.Random(3)
    titles = {}
    for doc in range(300):
        base = rng.choice(["flood warning coast", "election night", "market news", "cup final"])
        letters = list(base)
        for _ in range(rng.choice([0, 0, 1, 3, 8, 14])):
            letters[rng.randrange(len(letters))] = rng.choice("abcdefgh ")
        titles[doc] = "".join(letters)
    pairs = [
        (query, doc, round(rng.uniform(-1, 5), rng.choice([0, 3])))
        for query in range(6) for doc in range(300) if rng.random() < (0.05, 0.9)[query % 2]
    ]
    return pairs, titles


@pytest.mark.parametrize("k, min_distance", [(10, 0.5), (40, 0.2), (12, 0.0)])
@pytest.mark.parametrize("chunk", [7, 200])
def test_rounds_agree_with_a_plain_loop(spark, chunk, k, min_distance):
    pairs, titles = random_pairs()
    found = diverse(spark, pairs, titles, k=k, min_distance=min_distance, chunk=chunk)
    for query in range(6):
        ranked = sorted((-s, d) for q, d, s in pairs if q == query)
        expected = greedy([(d, titles[d]) for _, d in ranked], k, min_distance)
        assert found[query] == expected
        for i, a in enumerate(expected):
            for b in expected[:i]:
                x, y = titles[a], titles[b]
                assert edit_distance(x, y) / max(len(x), len(y)) >= min_distance


def test_one_candidate_per_round(spark):
    pairs, titles = random_pairs()
    assert diverse(spark, pairs, titles, k=4, chunk=1) == diverse(spark, pairs, titles, k=4)


def test_without_broadcasts(spark, monkeypatch):
    pairs, titles = random_pairs()
    expected = diverse(spark, pairs, titles)
    monkeypatch.setattr(broadsheet.cluster, "BROADCAST_BYTES", -1)
    assert diverse(spark, pairs, titles, chunk=20) == expected


def test_copies_fill_most_of_a_query(spark):
    titles = {d: "the same old story" for d in range(600)}
    titles |= {600: "flood", 601: "election results", 602: "cup"}
    pairs = [(1, d, 9.0 - d / 1000) for d in titles]
    assert diverse(spark, pairs, titles, chunk=50) == {1: [0, 600, 601, 602]}


def test_near_copies_and_others(spark):
    titles = {d: f"daily report number {d:02d}" for d in range(12)}
    titles |= {12: "flood", 13: "election results", 14: "cup"}
    pairs = [(1, d, 20.0 - d) for d in titles]
    assert diverse(spark, pairs, titles) == {1: [0, 12, 13, 14]}


@pytest.mark.parametrize("titles, expected", [
    ({1: "abcd", 2: "abxy"}, [1, 2]), ({1: "abcd", 2: "abcx"}, [1]),
    ({1: "ABCD", 2: "abcd"}, [1, 2]), ({1: "été", 2: "éte"}, [1]),
])
def test_which_titles_are_too_near(spark, titles, expected):
    assert diverse(spark, [(1, 1, 2.0), (1, 2, 1.0)], titles) == {1: expected}


def test_equal_scores_go_by_id_and_negative_scores_rank(spark):
    scores, _ = tables(spark, [(1, 3, 1.0), (1, 2, 1.0 + 1e-12), (1, 1, -2.0), (2, 5, 0.5)], {1: ""})
    rows = ranking.top_k(scores, 2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.doc_id) for r in rows] == [(1, 1, 2), (1, 2, 3), (2, 1, 5)]


@pytest.mark.parametrize("k", [10, 1000])
def test_queries_are_cut_before_they_meet_in_a_task(spark, k):
    scores, _ = tables(spark, [(q, d, float(d % 97)) for q in range(2) for d in range(7000)], {1: ""})
    top = ranking.top_k(scores, k)
    plan = top._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # From the end of the plan to its start: the shuffle by query comes after the cut by part.
    by_query = plan.index("Exchange hashpartitioning(query_id#", 0)
    by_part = plan.index("_part#", by_query)
    assert plan.index("Filter", by_query) < plan.index("Exchange hashpartitioning(query_id#", by_query + 1)
    assert by_query < by_part
    ranks = [(r.rank, r.doc_id) for r in top.where("query_id = 1").orderBy("rank").collect()]
    expected = sorted(range(7000), key=lambda d: (-(d % 97), d))[:k]
    assert ranks == [(i + 1, d) for i, d in enumerate(expected)]


def test_long_titles_are_not_broadcast(spark, monkeypatch):
    hints = []
    keep = ranking.broadcast_if
    monkeypatch.setattr(ranking, "broadcast_if", lambda df, small: hints.append(small) or keep(df, small))
    monkeypatch.setattr(broadsheet.cluster, "BROADCAST_BYTES", 150_000)
    titles = {d: chr(97 + d) * 5000 for d in range(20)}
    pairs = [(1, d, 20.0 - d) for d in titles]
    assert diverse(spark, pairs, titles, k=20, chunk=3) == {1: list(titles)}
    assert hints[0] and not hints[-1]


@pytest.mark.parametrize("partitions", [1, 5])
def test_ranks_over_many_partitions(spark, partitions):
    rng = random.Random(5)
    pairs = [(0 if rng.random() < 0.6 else q, d, float(rng.randint(0, 9)))
             for q in range(5) for d in range(400)]
    pairs = list({(q, d): (q, d, s) for q, d, s in pairs}.values())
    scores, _ = tables(spark, pairs, {0: ""}, partitions)
    found = {(r.query_id, r.doc_id): r["rank"] for r in ranking.rank_by_score(scores).collect()}
    for query in {q for q, _, _ in pairs}:
        ranked = sorted((-s, d) for q, d, s in pairs if q == query)
        assert [found[query, d] for _, d in ranked] == list(range(1, len(ranked) + 1))


@pytest.mark.parametrize("partitions", [1, 6])
def test_running_index(spark, partitions):
    ids = random.Random(2).sample(range(10**6), 1000)
    df = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, t string")
    indexed = indexing.article_index(df.repartition(partitions))
    rows = indexed.orderBy("idx").collect()
    assert [(r.doc_id, r.idx, r.t) for r in rows] == [
        (d, i, str(d)) for i, d in enumerate(sorted(ids))]
    parts = indexing.index_partition(indexed, 12).groupBy("part").count().collect()
    assert sorted(r.part for r in parts) == list(range(12))
    assert {r["count"] for r in parts} == {83, 84}


def test_index_of_nothing(spark):
    assert indexing.article_index(spark.createDataFrame([], "doc_id long")).count() == 0


def test_spread_is_even(spark):
    sizes = indexing.spread(spark.range(1200, numPartitions=1), 12).groupBy(
        F.spark_partition_id()).count().collect()
    assert len(sizes) == 12 and all(abs(r["count"] - 100) <= 12 for r in sizes)


def test_ranked_articles(spark):
    articles = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "doc_id long, title string")
    top = spark.createDataFrame([(1, 1, 3, 0.1), (2, 1, 3, 0.2), (2, 2, 0, 0.1)],
                                "query_id long, rank int, doc_id long, score double")
    assert sorted(r.doc_id for r in ranking.ranked_articles(articles, top).collect()) == [0, 3]


def handed_on(frame, key):
    """The rows that each shuffle by a key has written, in a plan that has run."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Exchange" and key in node.simpleString(1000):
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return found


def test_a_task_hands_on_its_best_only(spark):
    """12 tasks, 3 queries, 5 of each: at most 180 rows go to parts, and 15 from each of those."""
    rng = random.Random(8)
    pairs = [(q, d, float(rng.randint(0, 99))) for q in range(3) for d in range(2000)]
    scores = spark.createDataFrame(pairs, SCORES).repartition(12)
    found = ranking.top_k(scores, 5)
    rows = [(r.query_id, r.rank, r.doc_id) for r in found.collect()]
    expected = [(q, i, d) for q in range(3) for i, (_, d) in enumerate(sorted(
        (-s, d) for p, d, s in pairs if p == q)[:5], 1)]
    assert sorted(rows) == expected
    assert handed_on(found, "_part") == [180]
    assert all(n <= 180 for n in handed_on(found, "query_id"))


def test_more_than_a_thousand_of_each_query(spark, monkeypatch):
    """The cut before the shuffle is there for any k, and the setting is as before."""
    rng = random.Random(9)
    pairs = [(q, d, float(rng.randint(0, 50))) for q in range(2) for d in range(4000)]
    scores = spark.createDataFrame(pairs, SCORES).repartition(2)
    kept = []
    checkpointed = ranking.checkpointed
    monkeypatch.setattr(ranking, "checkpointed", lambda df: kept.append(df) or checkpointed(df))
    found = ranking.top_k(scores, 1500)
    rows = [tuple(r) for r in found.select("query_id", "rank", "doc_id").collect()]
    assert sorted(rows) == [(q, i, d) for q in range(2) for i, (_, d) in enumerate(sorted(
        (-s, d) for p, d, s in pairs if p == q)[:1500], 1)]
    assert kept[0]._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold") == "1000"


def test_long_titles_in_the_diverse_ranking(spark):
    titles = {i: c * 400 + "x" * i for i, c in enumerate("etaoineta")}
    pairs = [(0, d, 5.0 - d) for d in titles]
    ranked = sorted(titles)
    for chunk in (2, 50):
        assert diverse(spark, pairs, titles, chunk=chunk)[0] == greedy([(d, titles[d]) for d in ranked], 10, 0.5)


def test_titles_of_books_are_told_near_piece_by_piece(spark):
    """Letter by letter, the 60 pairs of 20,000 letters each would take minutes."""
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    titles = {d: " ".join(rng.choice(words) for _ in range(5000))[:20_000 + d] for d in range(61)}
    started = time.perf_counter()
    assert diverse(spark, [(1, d, 100.0 - d) for d in titles], titles, k=25, min_distance=0.9, chunk=5) == {1: [0]}
    assert time.perf_counter() - started < 60


@pytest.mark.parametrize("enough", [0.0, 0.5, 0.9])
def test_most_distance_is_a_bound(spark, enough):
    rng = random.Random(4)
    texts = ["", "a", "b" * 9, "é中\U0001f600" * 40] + [
        "".join(rng.choice("ab é") for _ in range(rng.randint(1, 200))) for _ in range(30)]
    pairs = spark.createDataFrame([(a, b) for a in texts for b in texts if a or b], "a string, b string")
    a, b = F.col("a"), F.col("b")
    rows = pairs.select(distance.most_distance(a, b, enough).alias("most"), F.levenshtein(a, b).alias("edits"),
                        F.greatest(F.length(a), F.length(b)).alias("longer"),
                        distance.too_near(a, b, enough).alias("near")).collect()
    for r in rows:
        assert r.edits <= r.most <= r.longer
        assert r.near == (enough > 0 and r.edits / r.longer < enough)


def titles_of_all_lengths(rng):
    alphabets = ["ab", "etaoin shrdlu", "abcdefghijklmnopqrstuvwxyz é中\U0001f600", "".join(map(chr, range(0x4e00, 0x4ee0)))]
    return [None, "", "a"] + ["".join(rng.choices(rng.choice(alphabets), k=int(2 ** rng.uniform(0, 9))))
                              for _ in range(60)]


@pytest.mark.parametrize("min_distance", [0.3, 0.75, 0.9, 1.0, 1.5])
def test_near_titles_of_many_pairs_at_once(monkeypatch, min_distance):
    """Pieces and bits say what the table of distances says, in lots and slices of any size."""
    rng = random.Random(12)
    texts = titles_of_all_lengths(rng)
    taken = {str(q): rng.choices(texts, k=rng.randint(0, 4)) for q in range(20)}
    rows = [(str(rng.randint(0, 22)), rng.choice(texts)) for _ in range(400)] + [(None, "a")]

    def near(a, b):
        longest = max(len(a or ""), len(b or ""))
        return None not in (a, b) and longest > 0 and (
            abs(len(a) - len(b)) / longest < min_distance and edit_distance(a, b) / longest < min_distance)

    expected = [any(near(t, title) for t in taken.get(query, [])) for query, title in rows]
    columns = [pa.array(column, pa.string()) for column in zip(*rows)]
    assert nearness.Taken(taken, min_distance).near(*columns).tolist() == expected
    for name, value in (("LANES", 7), ("PIECES_OF_PAIRS", 5), ("PIECES_OF_TITLES", 3), ("LONG", 10)):
        monkeypatch.setattr(nearness, name, value)
    assert nearness.Taken(taken, min_distance).near(*columns).tolist() == expected
    for a, b in [(rng.choice(texts), rng.choice(texts)) for _ in range(150)]:
        assert nearness.are_near(a, b, min_distance) == near(a, b)


def test_edits_of_a_title_as_one_number():
    rng = random.Random(13)
    for _ in range(100):
        a, b = ("".join(rng.choices("etaoin é", k=rng.randint(0, 90))) for _ in range(2))
        assert nearness.edits(a, b) == edit_distance(a, b)
    assert nearness.edits("a" * 3000 + "b", "a" * 2000) == 1001


def test_pairs_that_are_near_by_few_letters_take_microseconds():
    """300 titles against three each of 100 queries: 30,000 pairs, of which one in a hundred is far.
    Letter by letter, and with the columns of ``distance``, they take over 200 microseconds each."""
    rng = random.Random(14)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(300)]

    def title():
        return " ".join(rng.choices(words, k=rng.randint(20, 150)))

    taken = {str(q): [title() for _ in range(3)] for q in range(100)}
    rows = [(str(q), t) for t in (title() for _ in range(300)) for q in range(100)]
    queries, titles = (pa.array(column) for column in zip(*rows))
    started = time.perf_counter()
    found = nearness.Taken(taken, 0.9).near(queries, titles)
    assert time.perf_counter() - started < 3
    assert found.mean() > 0.9


def test_taken_titles_handed_to_tasks_or_joined(spark, monkeypatch):
    """Ids of queries that are strings, a document without a title, and a state that is not handed on."""
    rng = random.Random(15)
    titles = {d: " ".join(rng.choices(["flood", "coast", "cup", "vote", "x" * 90], k=rng.randint(1, 6))) for d in range(200)}
    pairs = [(f"q{q}", d, float(rng.randint(0, 50))) for q in range(4) for d in range(201)]
    scores = spark.createDataFrame(pairs, "query_id string, doc_id long, score double").repartition(3)
    named = spark.createDataFrame(list(titles.items()), "doc_id long, title string")
    found = []
    for handed in (ranking.HANDED_BYTES, 0):
        monkeypatch.setattr(ranking, "HANDED_BYTES", handed)
        rows = ranking.diverse_top_k(scores, named, 4, k=12, min_distance=0.7, chunk=3).collect()
        found.append(sorted((r.query_id, r["rank"], r.doc_id) for r in rows))
    assert found[0] == found[1] and found[0]
    for q in range(4):
        ranked = [d for _, d in sorted((-s, d) for p, d, s in pairs if p == f"q{q}")]
        left = [(d, titles.get(d)) for d in ranked]
        taken = []
        for d, t in left:
            if len(taken) < 12 and not any(nearness.are_near(t, o, 0.7) for _, o in taken):
                taken.append((d, t))
        assert [d for p, _, d in found[0] if p == f"q{q}"] == [d for d, _ in taken]


def test_queries_are_taken_from_in_tasks_of_their_own(spark, monkeypatch):
    """Also in later rounds, whose rows are few bytes."""
    tasks = []
    take = ranking._take_from_chunk
    monkeypatch.setattr(ranking, "_take_from_chunk", lambda chunks, *a: tasks.append(
        chunks.rdd.getNumPartitions()) or take(chunks, *a))
    titles = {d: chr(97 + d % 20) * 9 for d in range(60)}
    assert all(len(own) == 20 for own in diverse(
        spark, [(q, d, 60.0 - d) for q in range(8) for d in titles], titles, k=20, chunk=9).values())
    assert len(tasks) > 2 and min(tasks) == 4
