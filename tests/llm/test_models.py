"""PPM, quality and toxicity against plain models; the latter two also by their labels."""

import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from broadsheet.llm import lookup, ppm, quality, textarrays, toxicity

SMALL = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ppm(texts, order):
    """The log10 probability of each text, one byte after the other."""
    streams = {d: b"".join(b" " + w.encode() for w in words_of(t)) + b"\n" for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    trie = defaultdict(Counter)
    for d, s in streams.items():
        padded = b"\n" * order + s
        for i in range(order, len(padded)):
            if not held[d]:
                for j in range(order + 1):
                    trie[padded[i - j:i]][padded[i]] += 1

    def price(context, byte):
        out, p = set(), 1.0
        for j in range(order, -1, -1):
            seen = trie.get(context[order - j:], {})
            counts = {b: n for b, n in seen.items() if b not in out}
            total = sum(counts.values())
            if total:
                if byte in counts:
                    return p * (2 * counts[byte] - 1) / (2 * total)
                p *= len(counts) / (2 * total)
            out |= set(seen)
        return p / (256 - len(out))

    return {d: sum(math.log10(price((b"\n" * order + s)[i:i + order], s[i])) for i in range(len(s)))
            for d, s in streams.items()}


def plain_base(texts):
    train = Counter()
    for d, t in texts.items():
        if zlib.crc32(str(d).encode()) % 5 != 1:
            train.update([*words_of(t), None])
    n, v = sum(train.values()), len(train)
    out = {}
    for d, t in texts.items():
        tokens = [*words_of(t), None]
        out[d] = (zlib.crc32(str(d).encode()) % 5 == 1, len(tokens), sum(train[w] > 0 for w in tokens), n,
                  sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens))
    return out


@pytest.mark.parametrize("order, entries", [(5, 4_000_000), (2, 300)])
def test_ppm(spark, small_docs, monkeypatch, order, entries):
    monkeypatch.setattr(lookup, "SHARD_ENTRIES", entries)
    monkeypatch.setattr(lookup.shards, "__defaults__", ("key", None, entries))
    docs = small_docs.where("doc_id < 25").unionByName(
        spark.createDataFrame([(90, None), (91, ""), (96, "ÉÀ zz ☃ Q")], "doc_id long, text string"),
        allowMissingColumns=True)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in ppm.score_texts(docs, order).collect()}
    expected, base = plain_ppm(texts, order), plain_base(texts)
    assert got.keys() == texts.keys()
    for d, r in got.items():
        assert r["score"] == pytest.approx(expected[d], rel=1e-9)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == base[d][:4]
        assert r["base_score"] == pytest.approx(base[d][4], rel=1e-9)


def test_ppm_odd_rows(odd_docs, no_docs):
    rows = {r["doc_id"]: r for r in ppm.score_texts(odd_docs.distinct()).collect()}
    assert rows.keys() == {None, *range(1, 11)} and not rows[None]["held_out"]
    assert all(r["score"] < 0 for r in rows.values())
    assert ppm.score_texts(no_docs).count() == 0


def test_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.train(docs, labels.where("doc_id % 3 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    rows = toxicity.severities(docs, model).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    right = np.mean([r["is_toxic"] == (r["toxic"] == 1) for r in rows])
    assert right > 0.9
    assert np.mean([r["expected_severity"] for r in rows if r["toxic"] == 1]) > 5 * np.mean(
        [r["expected_severity"] for r in rows if r["toxic"] == 0])
    kept = {r["doc_id"] for r in toxicity.without_toxic(docs, model).collect()}
    every = toxicity.severities(docs, model).collect()
    assert kept == {r["doc_id"] for r in every if not r["is_toxic"]}


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (5, 1), (7, None), (None, 1), (77, 1), (9, 0)],
                                   "doc_id long, toxic int")
    model = toxicity.train(odd_docs, labels)
    assert toxicity.severities(odd_docs, model).count() == odd_docs.count()
    assert toxicity.without_toxic(odd_docs, model).columns == odd_docs.columns
    assert toxicity.severities(no_docs, model).count() == 0
    empty = toxicity.train(odd_docs, labels.where("false"))
    assert toxicity.without_toxic(odd_docs, empty).count() == odd_docs.count()
    grades = spark.createDataFrame([(1, 0), (7, 2), (9, 1)], "doc_id long, grade int")
    graded = toxicity.train(odd_docs, grades, grades=2)
    assert len(graded.thresholds) == 2


def plain_severity(model, text):
    """Expected severity and grade of one text, feature by feature."""
    hasher, counts = textarrays.Hasher(), Counter()
    raw = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()

    def bucket(piece, whole):
        sums = hasher.prefix(np.frombuffer(piece, np.uint8))
        value = int(hasher.spans(sums, np.array([0]), np.array([len(piece)]))[0])
        return (value & (toxicity.BUCKETS - 2)) | whole

    for word in re.findall(rb"[a-z\x80-\xff]+", raw):
        counts[bucket(word, 1)] += 1
        for size in toxicity.BEGINNINGS:
            if len(word) > size:
                counts[bucket(word[:size], 0)] += 1
    score = sum(model.weights[b] * math.log(1 + n) for b, n in counts.items())
    above = [1 / (1 + math.exp(theta - score)) for theta in model.thresholds]
    return sum(above), sum(p >= 0.5 for p in above)


def test_toxicity_against_plain_scores(spark, odd_docs):
    """Every row of a whole table, and odd rows, scored one feature after the other."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert (model.weights != 0).sum() > 10
    for table in docs, odd_docs:
        texts = {(r["doc_id"], zlib.crc32((r["text"] or "").encode())): r["text"] for r in table.collect()}
        plain = sorted((d or 0, *plain_severity(model, t)) for (d, _), t in texts.items())
        found = sorted({(r["doc_id"] or 0, r["expected_severity"], r["severity"])
                        for r in toxicity.severities(table, model).collect()})
        assert [(d, g) for d, _, g in found] == [(d, g) for d, _, g in plain]
        assert np.allclose([s for _, s, _ in found], [s for _, s, _ in plain], rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("grades", [1, 3])
def test_cumulative_link_fit_against_plain_descent(grades):
    """The likelihood and its optimum, by loops over rows and numeric slopes."""
    rng = np.random.default_rng(grades)
    x = rng.integers(0, 3, (60, 3)).astype(float)
    hidden = x @ np.array([1.0, -0.7, 0.3]) + rng.logistic(size=60)
    grade = np.digitize(hidden, [0.5, 1.5, 2.5][:grades])

    def loss(p):
        theta = [-math.inf, *toxicity._thresholds(p[3:]), math.inf]
        reach = lambda t, s: 0.0 if t == -math.inf else 1.0 if t == math.inf else 1 / (1 + math.exp(s - t))
        fits = [math.log(max(reach(theta[g + 1], s) - reach(theta[g], s), 1e-12))
                for g, s in zip(grade, x @ p[:3])]
        return -sum(fits) / len(grade) + toxicity.STRENGTH / 2 * float(p[:3] @ p[:3])

    p = np.zeros(3 + grades)
    for _ in range(1500):
        slope = [(loss(p + h) - loss(p - h)) / 2e-5 for h in np.eye(len(p)) * 1e-5]
        p = p - 0.5 * np.array(slope)
    row, feature = np.nonzero(x)
    model = toxicity.fit(row, feature, x[row, feature], grade, grades)
    assert np.allclose(model.weights[:3], p[:3], atol=0.02)
    assert np.allclose(model.thresholds, toxicity._thresholds(p[3:]), atol=0.02)


def plain_kneser_ney(train, texts):
    """Log10 probability of each text, and its number of words and ends."""
    def stream(t):
        return ["<s>", "<s>", *words_of(t), "</s>"]

    tri = Counter(tuple(s[i:i + 3]) for s in map(stream, train) for i in range(len(s) - 2))
    bi = Counter(t[1:] for t in tri)
    uni = Counter(b[1:] for b in bi)

    def discounts(counts):
        n = [0] + [sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)]
        if not n[1] or not n[2]:
            return [0.5] * 3
        y = n[1] / (n[1] + 2 * n[2])
        return [min(max(i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i, 0.1), i - 0.1)
                for i in (1, 2, 3)]

    levels = []
    for counts in (tri, bi, uni):
        d, total, left = discounts(counts), Counter(), Counter()
        for gram, c in counts.items():
            total[gram[:-1]] += c
            left[gram[:-1]] += d[min(c, 3) - 1]
        levels.append((counts, d, total, left))

    def p(gram, level=0):
        if level == 3:
            return 1 / (len(uni) + 1)
        counts, d, total, left = levels[level]
        context = gram[:-1]
        if not total[context]:
            return p(gram[1:], level + 1)
        c = counts[gram]
        own = (c - d[min(c, 3) - 1]) / total[context] if c else 0.0
        return own + left[context] / total[context] * p(gram[1:], level + 1)

    return [(sum(math.log10(p(tuple(s[i:i + 3]))) for i in range(len(s) - 2)), len(s) - 2)
            for s in map(stream, texts)]


@pytest.mark.parametrize("entries", [4_000_000, 500])
def test_kneser_ney(spark, small_docs, monkeypatch, entries):
    monkeypatch.setattr(quality, "SHARD_ENTRIES", entries)
    train = [r["text"] for r in small_docs.where("doc_id < 12").collect()]
    some = small_docs.where("doc_id between 8 and 20")
    model, unknown = quality.train(small_docs.where("doc_id < 12").select("text"))
    got = {r["doc_id"]: r for r in quality.perplexities(some, model, unknown).collect()}
    rows = some.collect()
    for r, (score, n) in zip(rows, plain_kneser_ney(train, [r["text"] for r in rows])):
        assert got[r["doc_id"]]["log10_prob"] == pytest.approx(score, rel=1e-9)
        assert got[r["doc_id"]]["n_tokens"] == n
        assert got[r["doc_id"]]["perplexity"] == pytest.approx(10 ** (-score / n), rel=1e-6)


def test_quality_by_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.classify(docs, labels, train_rows=200).join(labels, "doc_id").collect()
    assert np.mean([r["kept"] for r in rows if r["quality"] == 1]) > 0.98
    assert np.mean([r["kept"] for r in rows if r["quality"] == 0]) < 0.6


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (9, 1), (7, 0), (None, 1), (77, 1)], "doc_id long, quality int")
    rows = quality.classify(odd_docs, labels, train_rows=1).collect()
    assert len(rows) == odd_docs.count() and all(r["perplexity"] >= 1 for r in rows)
    assert all(r["kept"] for r in quality.classify(odd_docs, labels.where("false")).collect())
    assert quality.classify(no_docs, labels).count() == 0


def test_quality_thresholds_from_texts_not_trained_on(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    trained, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda texts: (
        trained.extend(r["text"] for r in texts.collect()), train(texts))[1])
    rows = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    texts = defaultdict(set)
    held = defaultdict(list)
    for d in docs.where(docs["doc_id"].isin(*good)).collect():
        texts[d["lang"]].add(d["text"])
        if d["text"] not in trained:
            held[d["lang"]].append(rows[d["doc_id"]])
    assert len(trained) == len(set(trained)) and trained
    for lang, own in texts.items():
        assert abs(2 * len(own & set(trained)) - len(own)) <= 1
        limits = {r["threshold"] for r in held[lang]}
        assert len(limits) == 1 and limits <= {r["perplexity"] for r in held[lang]}
    unseen = [r["kept"] for own in held.values() for r in own]
    assert np.mean(unseen) > 0.98


@pytest.fixture
def unnamed_docs(spark, odd_docs):
    """Odd rows, with different texts without an id and repeated rows."""
    more = [(None, "another row without an id"), (None, "a third one"), (None, "a third one"), (None, None)]
    return odd_docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame([(*r, "en") for r in more], "doc_id long, text string, lang string"))


def test_every_row_has_its_quality(unnamed_docs, small_docs, monkeypatch):
    model, unknown = quality.train(small_docs.where("doc_id < 12").select("text"))

    def scored(entries):
        monkeypatch.setattr(quality, "SHARD_ENTRIES", entries)
        rows = quality.perplexities(unnamed_docs, model, unknown).collect()
        return sorted(((r["doc_id"] or 0, r["n_tokens"], r["log10_prob"], r["lang"] or "") for r in rows),
                      key=lambda r: (r[0], r[3], r[1], r[2]))

    whole, parts = scored(4_000_000), scored(500)
    assert len(whole) == len(parts) == unnamed_docs.count()
    for a, b in zip(whole, parts):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9) and a[3] == b[3]


@pytest.mark.parametrize("entries", [4_000_000, 300])
def test_every_row_has_its_score(unnamed_docs, monkeypatch, entries):
    monkeypatch.setattr(lookup.shards, "__defaults__", ("key", None, entries))
    docs = unnamed_docs.where("doc_id is null or doc_id not in (7, 8)")
    rows = ppm.score_texts(docs, 2).collect()
    expected = Counter((d["doc_id"], len(words_of(d["text"])) + 1) for d in docs.collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == expected
    twice = [r for r in rows if r["doc_id"] == 10]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_quality_counts_every_second_trusted_text(spark, monkeypatch):
    """All of them, also more than any sample; single words are in one shard, not in all."""
    docs = spark.range(4203).selectExpr("id AS doc_id", "concat('word', id, ' and word', id + 1) AS text", "'en' AS lang")
    labels = spark.range(4203).selectExpr("id AS doc_id", "1 AS quality")
    counted, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda texts: (counted.append(texts.count()), train(texts))[1])
    whole = {r["doc_id"]: r["log10_prob"] for r in quality.classify(docs, labels).collect()}
    assert counted == [2102]
    monkeypatch.setattr(quality, "SHARD_ENTRIES", 7000)
    shards, tables = quality._shards, []
    monkeypatch.setattr(quality, "_shards", lambda model: (
        tables.append(len(shard.value["p1"][0])) or (i, n, shard) for i, n, shard in shards(model)))
    parts = {r["doc_id"]: r["log10_prob"] for r in quality.classify(docs, labels).collect()}
    assert len(tables) > 2 and max(tables) < 0.7 * sum(tables)
    assert parts == pytest.approx(whole, rel=1e-9)


def test_texts_are_scored_in_one_reading(small_docs):
    """Prices and words are looked up together, and what one shard says is not added up."""
    plan = ppm.score_texts(small_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Aggregate" not in plan and "Union" not in plan


def test_slots_find_what_is_there():
    rng = np.random.default_rng(3)
    every = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64) >> rng.integers(0, 60, 5000).astype(np.uint64))
    odd = np.array([0, 2**64 - 1, pow(0x9E3779B97F4A7C15, -1, 2**64) * (2**64 - 1) % 2**64], np.uint64)
    every = np.unique(np.append(every, odd))
    for keys in every[::2], every[1::2], every[:1], every[:0], every:
        slots, order = lookup.Slots.of(keys)
        at, there = slots.find(every)
        assert (there == np.isin(every, keys)).all()
        assert (keys[order][at[there]] == every[there]).all()
        assert not len(keys) or ((0 <= at) & (at < len(keys))).all()


def test_windows_are_counted_and_looked_up_without_search_by_halves(small_docs, monkeypatch):
    """The two steps that took the operator over its CPU seconds: an argsort for counting, and a
    binary search for each byte of the texts."""
    import pyarrow as pa

    texts = small_docs.select("text").limit(40).toArrow().column("text").combine_chunks()
    held = np.arange(len(texts)) % 5 == 1
    batch = pa.RecordBatch.from_arrays([texts, pa.array(held)], names=["text", "held_out"])
    plain, unique = Counter(), np.unique
    for text, out in zip(texts.to_pylist(), held):
        s = b"\n" * 5 + b"".join(b" " + w.encode() for w in words_of(text)) + b"\n"
        for i in range(5, len(s)):
            plain[int.from_bytes(s[i - 5:i + 1], "big")] += not out
    monkeypatch.setattr(np, "unique", lambda x, return_counts: unique(x, return_counts=return_counts))
    counted, *_ = ppm._count_rows(5)(iter([batch]))
    assert dict(zip(counted.column("key").to_pylist(), counted.column("n").to_pylist())) == plain

    class Table:
        def slots(self):
            slots, order = lookup.Slots.of(np.array(list(plain), np.uint64))
            return slots, {"price": np.ones(len(plain))[order]}

    monkeypatch.setattr(ppm, "find", None)
    batch = batch.append_column("doc_id", pa.array(range(len(texts)))).append_column(
        "text_key", pa.array([""] * len(texts)))
    rows, *_ = ppm._score_rows(5, Table(), None, 0, 0, 0, False)(iter([batch]))
    assert rows.column("score").to_pylist() == [1 + sum(len(w.encode()) + 1 for w in words_of(t))
                                                for t in texts.to_pylist()]


def test_the_model_is_made_and_used_in_rounds(spark, small_docs, monkeypatch):
    """Whatever its size, in as many readings of the texts; joins of words may shuffle; a round's
    shards are gone after it, and no task makes all of a model that one can hold."""
    train, some = small_docs.where("doc_id < 6").select("text"), small_docs.where("doc_id between 4 and 9")
    whole, unknown = quality.train(train)
    assert len(next(quality._shards(whole))[2].paths) >= 2 * quality.ROUNDS
    expected = {r["doc_id"]: r["log10_prob"] for r in quality.perplexities(some, whole, unknown).collect()}
    monkeypatch.setattr(quality, "SHARD_ENTRIES", 2000)
    monkeypatch.setattr(quality, "ROUNDS", 2)
    monkeypatch.setattr(quality, "STEPS", 2)
    monkeypatch.setattr(quality, "is_small", lambda table: False)
    turns, turn = [], quality._round
    monkeypatch.setattr(quality, "_round", lambda texts, i, n, shards, unknown: (
        turns.append((i, shards)), turn(texts, i, n, shards, unknown))[1])
    model, unknown = quality.train(train)
    got = {r["doc_id"]: r["log10_prob"] for r in quality.perplexities(some, model, unknown).collect()}
    assert got == pytest.approx(expected, rel=1e-9)
    assert [i for i, _ in turns] == [0, 1] and min(len(shards) for _, shards in turns) > 2
    assert not any(len(shard.value["trigrams"][0]) for _, shards in turns for shard in shards.values())


def test_no_words_of_the_model_pass_through_the_driver(small_docs, monkeypatch):
    """However few they are: joins with them shuffle, and their number grows with the texts."""
    monkeypatch.setattr(quality, "SHARD_ENTRIES", 2000)
    monkeypatch.setattr(quality, "ROUNDS", 2)
    monkeypatch.setattr(quality, "broadcast_if", lambda table, small: pytest.fail("broadcast"))
    model, unknown = quality.train(small_docs.where("doc_id < 4").select("text"))
    assert quality.perplexities(small_docs.where("doc_id < 6"), model, unknown).count() == 6


def test_a_round_leaves_nothing_shuffled(spark, small_docs, monkeypatch):
    """Neither its own shuffles nor its shards, for the next round to be made beside them; words are
    written once for all rounds, and the shards of a model stay small in a task."""
    context = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def shuffled():
        files = context.blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    def new(before):
        end = time.time() + 5
        while shuffled() - before and time.time() < end:
            time.sleep(0.1)
        return shuffled() - before

    monkeypatch.setattr(quality, "SHARD_ENTRIES", 4000)
    monkeypatch.setattr(quality, "ROUNDS", 2)
    model, unknown = quality.train(small_docs.where("doc_id < 4").select("text"))
    before, left, sizes, words, turn = shuffled(), [], [], set(), quality._round

    def watched(texts, i, n, shards, unknown):
        left.append(new(before))
        sizes.extend(sum(len(keys) for keys, _ in shard.value.values()) for shard in shards.values())
        words.update(shard.paths[0].rsplit("/", 1)[0] for shard in shards.values())
        out = turn(texts, i, n, shards, unknown)
        left.append(new(before))
        left.append({i for i, shard in shards.items() if any(len(keys) for keys, _ in shard.value.values())})
        return out

    monkeypatch.setattr(quality, "_round", watched)
    quality.perplexities(small_docs.where("doc_id < 6"), model, unknown)
    assert left == [set()] * 6 and len(words) == 1
    assert max(sizes) < 4000 / 4


def test_rounds_divide_shards(spark):
    """The part of a pair is the same in Spark and in tasks, and says its round."""
    a, b = np.random.default_rng(1).integers(-2**63, 2**63, (2, 500))
    parts = quality._dealt(a.view(np.uint64), b.view(np.uint64), 63)
    assert (parts % 9 == quality._dealt(a.view(np.uint64), b.view(np.uint64), 9)).all() and len(set(parts)) == 63
    rows = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long").select(quality._part("a", "b", 63))
    assert sorted(r[0] for r in rows.collect()) == sorted(parts)


def peak_bytes(work):
    import tracemalloc

    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_slots_take_little_beside_their_keys():
    keys = np.random.default_rng(4).integers(0, 2**63, 1_000_000).astype(np.uint64)
    (slots, order), peak = peak_bytes(lambda: lookup.Slots.of(keys))
    assert peak < 40 * len(keys)
    at, there = slots.find(keys[::7])
    assert there.all() and (keys[order][at] == keys[::7]).all()


def test_texts_are_scored_a_little_at_a_time():
    import pyarrow as pa

    class Table:
        def slots(self):
            return lookup.Slots.of(np.array([5], np.uint64))[0], {"price": np.ones(1), "n": np.ones(1, np.int64)}

    texts = [f"word{i} and more {i % 7} of it " * 100 for i in range(1500)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array([False] * len(texts)), pa.array(range(len(texts))), pa.array([""] * len(texts))],
        names=["text", "held_out", "doc_id", "text_key"])
    score = ppm._score_rows(5, Table(), Table(), 1, 9, 9, True)
    parts, peak = peak_bytes(lambda: list(score(iter([batch]))))
    assert [n for part in parts for n in part.column("n_tokens").to_pylist()] == [601] * len(texts)
    assert peak < 40_000_000
