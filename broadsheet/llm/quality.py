"""Quality by an interpolated modified Kneser-Ney model of trusted text.

A trigram model of words is counted on trusted documents: trigrams by how often they occur,
bigrams and words by how many different words they follow, each order with three discounts
taken from its own counts of counts. Counts, continuation counts and discounted weights come
from Spark joins and aggregates. Kept are the different trigrams, as three words and their
counts, sorted so that Parquet stores them in some ten bytes each, and a table of words.

The logarithm of a probability is a sum of what a word, a pair of words and a trigram say by
themselves: a word what it has as a single word and leaves as a context, a pair what it has
beyond that and leaves, a trigram what it has beyond its pairs. So all of it is dealt into
shards by hash. Where a task cannot hold the model, the shards are made and used in a fixed
number of rounds: each reads the texts once, sends their pairs and trigrams of the round to the
shards, and adds up what these say. So no table grows with the input in a task, no pass
over the texts is added as the model grows, and only a round's share is on disk at a time.
Nor does a table of words pass through the driver: trigrams meet what is known of their middle
word when they have been counted, and of their last word in their round, by joins that shuffle.

A document is kept if its perplexity is not above the quantile, in its language, of trusted
texts that were not trained on. Every second trusted text of a language is left out of the
training at any size, so there are such texts however few or many are trusted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if, delete_folder, is_small, new_folder
from broadsheet.llm.lookup import SHARD_ENTRIES, Slots, StoredTable, text_key
from broadsheet.llm.scratch import free_shuffles, written
from broadsheet.llm.textarrays import SLICE_BYTES, mix, signed, text_slices, totals, word_spans
from broadsheet.llm.words import pieces, span_hashes
from broadsheet.operators.indexing import number_rows

QUANTILE = 0.995

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_START, _END = np.uint64(0x1234567), np.uint64(0x89ABCDE)
_KINDS = ("p1", "pairs", "trigrams")

# What does not fit a shard is counted and looked up in so many rounds, each of at least as many shards.
ROUNDS = 7
# A round's shards may be made in steps: less is shuffled at a time, and the trigrams are read in each.
STEPS = 1

# Bytes of text that are taken into arrays at a time: these fit a processor's cache, as 2 MB do not.
_SLICE_BYTES = 400_000


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a * _A) ^ (b * _B))


def _dealt(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` parts a pair of words belongs to; as ``_part`` has it."""
    return _rest(signed(a ^ (b << np.uint64(1))), n)


def _rest(x: np.ndarray, n: int) -> np.ndarray:
    """``x % n``, several times faster."""
    return x - x // n * n


def _part(a: str, b: str, n: int) -> Column:
    return F.pmod(F.col(a).bitwiseXOR(F.shiftleft(b, 1)), F.lit(n).cast("long"))


def _stream(data: np.ndarray, offsets: np.ndarray):
    """``(row, stream, first)``: every text as two starts, its words and an end, and the place of
    the first start of each."""
    starts, ends, bounds = word_spans(data, offsets)
    names = span_hashes(pieces(data), starts, ends)
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    stream = np.full(len(names) + 3 * n, _START)
    stream[np.arange(len(names)) + 3 * row + 2] = names
    stream[bounds[1:] + 3 * np.arange(n) + 2] = _END
    return np.repeat(np.arange(n), np.diff(bounds) + 3), stream, bounds[:-1] + 3 * np.arange(n)


def _count_rows(part: int, parts: int):
    """The trigrams whose last two words belong to a part, and how often they are there."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text"), True, _SLICE_BYTES):
                _, stream, first = _stream(data, offsets)
                own = np.ones(len(stream), bool)
                own[first] = own[first + 1] = False
                at = np.flatnonzero(own)
                if parts > 1:
                    at = at[_dealt(stream[at - 1], stream[at], parts) == part]
                u, v, w = stream[at - 2], stream[at - 1], stream[at]
                _, example, n = np.unique(_pair(_pair(u, v), w), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(x[example])) for x in (u, v, w)] + [pa.array(n)], names=["u", "v", "w", "n"])

    return work


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """The three discounts of an order, from its numbers of n-grams counted 1 to 4 times."""
    n = [0, n1, n2, n3, n4]
    if not n[1] or not n[2]:
        return [0.5, 0.5, 0.5]
    y = n[1] / (n[1] + 2 * n[2])
    own = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i for i in (1, 2, 3)]
    return [min(max(d, 0.1), i - 0.1) for i, d in zip((1, 2, 3), own)]


def _counted(count: str, where: str = "true") -> list[Column]:
    return [F.count(F.when((F.col(count) == i) & F.expr(where), 1)) for i in (1, 2, 3, 4)]


def _taken(count: str, discounts: list[float]) -> Column:
    d1, d2, d3 = discounts
    return F.when(F.col(count) == 1, d1).when(F.col(count) == 2, d2).otherwise(d3)


@dataclass(frozen=True)
class Model:
    """``grams(u, v, w, n, k, first, total, left, turn)``: the different trigrams, how often they
    occur, how many different words stand before their last two, whether they are the first with
    these, the numbers after their middle word and the weight it leaves, and their round;
    ``words(word, left, p1)``: the weight a word leaves and its own probability; the discounts of
    trigrams and bigrams; and how many entries it has."""

    grams: DataFrame
    words: DataFrame
    d3: list[float]
    d2: list[float]
    entries: int


def train(texts: DataFrame) -> tuple[Model, float]:
    """The model of ``texts(text)``, and the logarithm of the probability of an unknown word."""
    spark = texts.sparkSession
    texts = written(texts, "texts")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = 1 if size <= 5 * SHARD_ENTRIES else ROUNDS
    folder, schema = new_folder(spark, "trigrams"), "u long, v long, w long, n long, k long, first boolean"
    alike = Window.partitionBy("v", "w")
    for part in range(parts):
        counted = texts.mapInArrow(_count_rows(part, parts), "u long, v long, w long, n long").repartition("v", "w")
        counted.groupBy("u", "v", "w").agg(F.sum("n").alias("n")).select(
            "u", "v", "w", "n", F.count("*").over(alike).alias("k"),
            (F.col("u") == F.min("u").over(alike)).alias("first")).write.parquet(f"{folder}/part={part}")
        free_shuffles(spark)
    _delete(texts)
    grams = spark.read.schema(f"{schema}, part int").parquet(folder)
    *counts, trigrams, bigrams = grams.agg(
        *_counted("n"), *_counted("k", "first"), F.count("*"), F.count(F.when(F.col("first"), 1))).first()
    d3, d2 = _discounts(*counts[:4]), _discounts(*counts[4:])
    after = written(grams.groupBy("v").agg(F.count("*").alias("total"), (
        F.sum(F.when(F.col("first"), _taken("k", d2))) / F.count("*")).alias("left")), "after")
    uni = written(grams.where("first").groupBy("w").agg(F.count("*").alias("k1")), "words")
    free_shuffles(spark)
    d1 = _discounts(*uni.agg(*_counted("k1")).first())
    total, kinds, left = uni.agg(F.sum("k1"), F.count("*"), F.sum(_taken("k1", d1))).first()
    unknown = left / total / (kinds + 1) if kinds else 1.0
    p1 = (F.col("k1") - _taken("k1", d1)) / F.lit(total).cast("long") + F.lit(unknown)
    words = written(uni.join(after, F.col("w") == F.col("v"), "full").select(
        F.coalesce("w", "v").alias("word"), "left", p1.alias("p1")), "words")
    _delete(uni)
    known = new_folder(spark, "grams")
    for part in range(parts):
        # In this order a round's trigrams are together, and equal contexts take little room.
        grams.where(F.col("part") == part).drop("part").join(after.hint("shuffle_hash"), "v").select(
            *[f.split()[0] for f in schema.split(", ")], "total", "left",
            _part("u", "v", ROUNDS).cast("int").alias("turn")).sortWithinPartitions("turn", "v", "u").write.mode(
            "append").parquet(known)
        delete_folder(spark, f"{folder}/part={part}")
        free_shuffles(spark)
    _delete(after)
    grams = spark.read.schema(f"{schema}, total long, left double, turn int").parquet(known)
    return Model(grams, words, d3, d2, trigrams + 2 * bigrams + kinds), math.log10(unknown)


def _delete(table: DataFrame) -> None:
    """Delete the folder of a table made by ``written``, also one without files."""
    for file in table.inputFiles()[:1]:
        delete_folder(table.sparkSession, file.rsplit("/", 1)[0])


class _Shard(StoredTable):
    """Per kind the keys, sorted, and what they say."""

    def __init__(self, paths: list[str]):
        self.paths = paths

    @property
    def value(self) -> dict:
        tables = {}
        for name, (keys, values) in self._tables(_KINDS).items():
            order = np.argsort(keys)
            tables[name] = keys[order], values[order]
        return tables

    def _tables(self, kinds: tuple[str, ...]) -> dict:
        every = [StoredTable(path).columns() for path in self.paths]
        rows = {name: np.concatenate([x[name] for x in every if x] or [np.zeros(0, kind)])
                for name, kind in (("kind", np.int8), ("key", np.int64), ("value", np.float64))}
        del every
        own = {name: rows["kind"] == _KINDS.index(name) for name in kinds}
        return {name: (rows["key"][at].view(np.uint64), rows["value"][at]) for name, at in own.items()}

    def lookups(self, *kinds: str) -> dict:
        """For each kind a function of keys: what they say, or what is said otherwise."""
        return {kind: _looked_up(*table) for kind, table in self._tables(kinds).items()}


def _looked_up(keys: np.ndarray, values: np.ndarray):
    slots, order = Slots.of(keys)
    values = np.append(values[order], 0.0)

    def look(wanted: np.ndarray, otherwise: float = 0.0) -> np.ndarray:
        at, there = slots.find(wanted)
        return np.where(there, values[at], otherwise)

    return look


def _shard_rows(d3: list[float]):
    """What pairs and trigrams say. ``p`` is what a pair says (``n`` = 0) or the probability of
    the last word of a trigram after its middle word."""
    def work(table: pa.Table) -> pa.Table:
        u, v, w, n, p = (table.column(x).to_numpy() for x in ("u", "v", "w", "n", "p"))
        pair = _pair(u.view(np.uint64), v.view(np.uint64))
        tri = n > 0
        taken = np.array([0.0, *d3])[np.minimum(n[tri], 3)]
        context, at = np.unique(pair[tri], return_inverse=True)
        total = np.bincount(at, n[tri], len(context))
        left = np.bincount(at, taken, len(context)) / total
        p2 = p[tri]
        price = np.log10((n[tri] - taken) / total[at] + left[at] * p2) - np.log10(left[at]) - np.log10(p2)
        pairs, at = np.unique(np.append(context, pair[~tri]), return_inverse=True)
        said = np.bincount(at, np.append(np.log10(left), p[~tri]), len(pairs))
        keys = np.append(pairs, _pair(pair[tri], w.view(np.uint64)[tri]))
        kind = np.repeat(np.array([1, 2], np.int8), [len(pairs), len(price)])
        shard = np.full(len(keys), table.column("shard")[0].as_py(), np.int32)
        return pa.table({"shard": shard, "kind": kind, "key": signed(keys), "value": np.append(said, price)})

    return work


def _shards(model: Model) -> Iterator[tuple[int, int, _Shard]]:
    """``(shard, shards, tables)``, written round by round, words once for all rounds: tasks read
    them, and the driver none of them. Words, pairs and trigrams are in one shard each."""
    spark = model.grams.sparkSession
    rounds = 1 if model.entries <= SHARD_ENTRIES else ROUNDS
    # Shards of an eighth of the bound at most, as a task that makes one has all its columns at once
    # and as much again while it sorts them.
    n = ROUNDS * max(2 * ROUNDS, math.ceil(model.entries / (ROUNDS * max(1, SHARD_ENTRIES // 8))))
    own = model.words.where("p1 is not null").select(F.col("word").alias("w"), "p1")
    above = ((F.col("k") - _taken("k", model.d2)) / F.col("total")).alias("above")
    words = new_folder(spark, "model")
    model.words.select(
        F.pmod("word", F.lit(n)).cast("int").alias("shard"), F.lit(0).cast("tinyint").alias("kind"),
        F.col("word").alias("key"), (F.coalesce(F.log10("left"), F.lit(0.0)) + F.coalesce(
            F.log10("p1"), F.lit(0.0))).alias("value")).repartition("shard").write.partitionBy("shard").parquet(words)
    for turn in range(rounds):
        # The trigrams, and the bigrams with no number and their last word twice.
        trigrams = model.grams.where(F.col("turn") == turn) if rounds > 1 else model.grams
        pairs = model.grams.where("first").where(_part("v", "w", rounds) == turn)
        rows = trigrams.select("u", "v", "w", "n", above, "left").union(pairs.select(
            "v", "w", "w", F.lit(0).cast("long"), above, "left"))
        p2 = F.col("above") + F.col("left") * F.col("p1")
        said = F.log10(p2) - F.log10("left") - F.log10("p1")
        step_of = F.floor(_part("u", "v", n) / rounds) % STEPS
        schema = "shard int, kind tinyint, key long, value double"
        folder = new_folder(spark, "model")
        for step in range(STEPS):
            some = (rows.where(step_of == step) if STEPS > 1 else rows).join(
                own.hint("shuffle_hash"), "w").select(
                _part("u", "v", n).cast("int").alias("shard"), "u", "v", "w", "n",
                F.when(F.col("n") == 0, said).otherwise(p2).alias("p"))
            some.groupBy("shard").applyInArrow(_shard_rows(model.d3), schema).write.mode("append").partitionBy(
                "shard").parquet(f"{folder}/grams")
            free_shuffles(spark)
        paths = {shard: [f"{words}/shard={shard}", f"{folder}/grams/shard={shard}"] for shard in range(turn, n, rounds)}
        if rounds == 1:
            yield 0, 1, _Shard([path for own_paths in paths.values() for path in own_paths])
        else:
            for shard in paths:
                yield shard, n, _Shard(paths[shard])


def _score_rows(shared: _Shard, unknown: float):
    """Tokens and logarithms of whole texts, where a task can hold the model."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.lookups(*_KINDS)
        for batch in batches:
            for start, end, data, offsets in text_slices(batch.column("text"), True, _SLICE_BYTES):
                row, stream, first = _stream(data, offsets)
                n = end - start
                word, pair, after = _places(row, first)
                keys = _pair(stream[pair], stream[pair + 1])
                tri = np.flatnonzero(after)
                price = totals(row[word], model["p1"](stream[word], unknown), n)
                price += totals(row[pair], model["pairs"](keys), n)
                price += totals(row[pair[tri]], model["trigrams"](_pair(keys[tri], stream[pair[tri] + 2])), n)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(name).slice(start, n) for name in ("doc_id", "lang", "text_key")],
                    pa.array(np.bincount(row, minlength=n) - 2), pa.array(price),
                ], names=["doc_id", "lang", "text_key", "n_tokens", "log10_prob"])

    return work


def _places(row: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in a stream: of words, with one start and the end; of pairs; and whether a word
    comes after the pair."""
    own = np.ones(len(row), bool)
    own[first] = False
    pair = np.flatnonzero(own) - 1
    after = np.ones(len(pair), bool)
    # One place of each row is left out, so its last pair is so many before the next row.
    after[np.append(first[1:], len(row)) - 1 - np.arange(1, len(first) + 1)] = False
    return pair + 1, pair, after


_SENT = "shard int, ids binary, counts binary, keys binary, trigrams binary, prices binary, tokens binary"


def _sent_rows(turn: int, rounds: int, n_shards: int, shards: list[_Shard], unknown: float):
    """What words say, and the pairs and trigrams of a round, one row for each slice and shard:
    the texts, how many pairs each has there, and the pairs, each with the trigram after it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said = _Shard([shard.paths[0] for shard in shards]).lookups("p1")["p1"]
        # A slice has some pairs for each shard, however many there are.
        size = min(SLICE_BYTES, _SLICE_BYTES * math.ceil(n_shards / (2 * rounds * rounds)))
        for batch in batches:
            ids = batch.column("text_id").to_numpy()
            for start, end, data, offsets in text_slices(batch.column("text"), True, size):
                row, stream, first = _stream(data, offsets)
                n, own = end - start, ids[start:end]
                # The rounds divide the shards, so a hash has its round without its shard.
                some = _rest(signed(stream), rounds) == turn
                some[first] = False
                word = np.flatnonzero(some)
                price = totals(row[word], said(stream[word], unknown), n)
                tokens = np.bincount(row, minlength=n) - 2 if turn == 0 else np.zeros(n, np.int64)
                next_first = np.append(first[1:], len(stream))
                some = np.append(_dealt(stream[:-1], stream[1:], rounds) == turn, False)
                some[next_first - 1] = False
                pair = np.flatnonzero(some)
                some[:] = True
                some[next_first - 2] = False
                part = _dealt(stream[pair], stream[pair + 1], n_shards)
                order = np.argsort(part, kind="stable")
                part, pair = part[order], pair[order]
                after = some[pair]
                keys = _pair(stream[pair], stream[pair + 1])
                # The last pair of a text has itself for a trigram, which is none.
                trigrams = keys.copy()
                tri = np.flatnonzero(after)
                trigrams[tri] = _pair(keys[tri], stream[pair[tri] + 2])
                bounds = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
                none = [b""] * (len(bounds) - 1)
                out = {name: [*none] for name in ("ids", "counts", "keys", "trigrams")}
                for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    texts, counts = np.unique(row[pair[a:b]], return_counts=True)
                    out["ids"][i], out["counts"][i] = own[texts].tobytes(), counts.astype(np.int32).tobytes()
                    out["keys"][i], out["trigrams"][i] = keys[a:b].tobytes(), trigrams[a:b].tobytes()
                where = np.append(part[bounds[:-1]], turn + rounds * (int(own[0]) % (n_shards // rounds)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(where.astype(np.int32)), pa.array([*out["ids"], own.tobytes()]),
                    pa.array([*out["counts"], b""]), pa.array([*out["keys"], b""]), pa.array([*out["trigrams"], b""]),
                    pa.array([*none, price.tobytes()]), pa.array([*none, tokens.astype(np.int64).tobytes()]),
                ], names=["shard", "ids", "counts", "keys", "trigrams", "prices", "tokens"])

    return work


def _answered(turn: int, shards: dict[int, _Shard]):
    """What the shards say on what was sent to them, added up by text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, model = None, {}
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                ids, counts, keys, trigrams, prices, tokens = (
                    np.frombuffer(batch.column(name)[i].as_buffer(), kind) for name, kind in (
                        ("ids", np.int64), ("counts", np.int32), ("keys", np.uint64),
                        ("trigrams", np.uint64), ("prices", np.float64), ("tokens", np.int64)))
                if len(keys):
                    if held != shard:
                        model, held = {}, shard
                        model = shards[shard].lookups("pairs", "trigrams")
                    prices = totals(np.repeat(np.arange(len(ids)), counts),
                                    model["pairs"](keys) + model["trigrams"](trigrams), len(ids))
                    tokens = np.zeros(len(ids), np.int64)
                rows = np.full(len(ids), int(turn == 0 and not len(keys)), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, rows, tokens, prices)],
                                                 names=["text_id", "rows", "tokens", "price"])

    return work


def perplexities(docs: DataFrame, model: Model, unknown: float) -> DataFrame:
    """``(doc_id, lang, n_tokens, log10_prob, perplexity)`` of whole texts."""
    return _scores(docs, model, unknown).drop("text_key")


def _scores(docs: DataFrame, model: Model, unknown: float) -> DataFrame:
    """``perplexities`` with the ``text_key`` of each row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                        text_key(), F.col("text").cast("string").alias("text"))
    rounds: dict[int, dict[int, _Shard]] = {}
    parts, text_id = [], F.conv(F.substring("text_key", 1, 15), 16, 10).cast("long").alias("text_id")
    for i, n, shard in _shards(model):
        if n == 1:
            every = texts.mapInArrow(_score_rows(shard, unknown), (
                "doc_id long, lang string, text_key string, n_tokens long, log10_prob double"))
            break
        turn = rounds.setdefault(i % ROUNDS, {})
        turn[i] = shard
        if len(turn) == n // ROUNDS:
            parts.append(_round(texts.select(text_id, "text"), i % ROUNDS, n, turn, unknown))
    else:
        sums = parts[0]
        for part in parts[1:]:
            sums = sums.union(part)
        # Copies of a text have each been counted, and say the same.
        sums = sums.groupBy("text_id").agg(*[F.sum(x).alias(x) for x in ("rows", "tokens", "price")])
        every = texts.select("doc_id", "lang", "text_key", text_id).join(sums, "text_id").select(
            "doc_id", "lang", "text_key", F.expr("tokens div rows").alias("n_tokens"),
            (F.col("price") / F.col("rows")).alias("log10_prob"))
    return every.withColumn("perplexity", F.pow(
        F.lit(10.0), F.least(-F.col("log10_prob") / F.greatest("n_tokens", F.lit(1)), F.lit(300.0))))


def _round(texts: DataFrame, turn: int, n_shards: int, shards: dict[int, _Shard], unknown: float) -> DataFrame:
    """``(text_id, rows, tokens, price)``: what the shards of a round say of each text; written, and
    the shards deleted."""
    sent = texts.mapInArrow(_sent_rows(turn, ROUNDS, n_shards, list(shards.values()), unknown), _SENT)
    said = sent.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        _answered(turn, shards), "text_id long, rows long, tokens long, price double")
    out = written(said.groupBy("text_id").agg(*[F.sum(x).alias(x) for x in ("rows", "tokens", "price")]), "scores")
    for folder in [path for shard in shards.values() for path in shard.paths]:
        delete_folder(texts.sparkSession, folder)
    free_shuffles(texts.sparkSession)
    return out


def _train_keys(docs: DataFrame, trusted: DataFrame, train_rows: int | None) -> DataFrame:
    """``text_key`` of the trusted texts to train on. The different texts of each language,
    in the order of their keys, are dealt out in turn: to the training, and to the
    thresholds. Copies of a text have one key, so none is on both sides."""
    own = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("none"))
    texts = docs.select(F.col("doc_id").cast("long").alias("trusted"), own.alias("own"), text_key()).join(
        trusted, "trusted").groupBy("text_key").agg(F.min("own").alias("own"))
    numbered = number_rows(texts, [F.col("text_key")], "number", within="own")
    own = numbered.where("number % 2 = 0").select("text_key")
    return own if train_rows is None else own.orderBy("text_key").limit(train_rows)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE,
             train_rows: int | None = None) -> DataFrame:
    """``(doc_id, lang, n_tokens, log10_prob, perplexity, threshold, kept)`` per document.

    ``docs`` has ``doc_id``, ``text`` and ``lang``, ``labels`` has ``doc_id`` and ``quality``
    (1: trusted); other columns are ignored. The model is counted on every second trusted text
    of each language, copies of a text once (all of these, unless ``train_rows`` says how many at
    most); the thresholds are quantiles over all trusted documents with other texts. Words are lower-cased (A-Z); a
    text's end counts as a word, so a null or empty text has one. A language with no trusted
    text beyond those trained on, null among them, takes the quantile over all languages;
    where no trusted text is left for thresholds at all, or none is trusted, all are kept.
    Repeated rows give the same row each; ids may be null. No rows give no rows.
    """
    trusted = labels.select(F.col("doc_id").cast("long").alias("trusted"), "quality").where(
        "trusted is not null and quality = 1").select("trusted").distinct()
    chosen = written(_train_keys(docs, trusted, train_rows), "chosen")
    texts = docs.select(text_key(), F.col("text").cast("string").alias("text"))
    small = is_small(chosen)
    model, unknown = train(texts.join(broadcast_if(chosen, small), "text_key").groupBy("text_key").agg(
        F.first("text").alias("text")).select("text"))
    scores = written(_scores(docs, model, unknown), "scores")
    held_out = scores.join(trusted, F.col("doc_id") == F.col("trusted")).join(
        broadcast_if(chosen, small), "text_key", "left_anti")
    limit = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)).alias("limit")
    overall = held_out.agg(limit).first()["limit"]
    limits = held_out.groupBy("lang").agg(limit).withColumnRenamed("lang", "_lang")
    limits = written(limits, "limits")
    threshold = F.coalesce("limit", F.lit(overall).cast("double"), F.lit(float("inf")))
    return scores.join(broadcast_if(limits, is_small(limits)), F.col("lang") == F.col("_lang"), "left").select(
        "doc_id", "lang", "n_tokens", "log10_prob", "perplexity", threshold.alias("threshold"),
        (F.col("perplexity") <= threshold).alias("kept"))
