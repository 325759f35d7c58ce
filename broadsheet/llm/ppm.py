"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts. A byte is predicted in the longest context of up to
``order`` bytes that was seen; a byte never seen there costs an escape (half a
count for each different byte seen, and half a count less for each of them: method D) to the context shorter by one, where the bytes
already ruled out are excluded, and so on down to a uniform choice. The model is pretrained:
its counts come from the training documents, all of them, and score every text.

With fixed counts, what a byte costs depends on the ``order + 1`` bytes that end in it. So
each different window of that length is priced once, by joins over the levels of the trie,
and a text's score is a sum of looked-up prices.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.lookup import added_up, find, shards, text_key
from broadsheet.llm.scratch import free_shuffles, written
from broadsheet.llm.textarrays import ragged, signed, text_slices, totals, word_spans
from broadsheet.llm.words import pieces, span_hashes

ORDER = 5
HELD_OUT = 1, 5  # remainder and divisor of crc32(doc_id as text)
END = 10  # the byte after the last word, and before the first

# Bytes of text that are scored at a time, beside the tables: some 100 bytes of arrays for each.
SCORED_BYTES = 400_000


def byte_stream(data: np.ndarray, offsets: np.ndarray, pad: int) -> tuple[np.ndarray, ...]:
    """Every text as its words, each with a space before it, and an end, after ``pad`` ends
    that are only context: the bytes, the offset of each text, and the words' spans."""
    starts, ends, bounds = word_spans(data, offsets)
    size = ends - starts
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    before = (pad + 1) * row + pad + np.arange(len(starts))
    at = before + np.cumsum(size) - size + 1
    total = int(size.sum()) + len(starts) + (pad + 1) * (len(offsets) - 1)
    stream = np.full(total, END, np.uint8)
    stream[at - 1] = 0x20
    stream[ragged(at, size)] = data[ragged(starts, size)]
    lengths = np.bincount(row, size + 1, len(offsets) - 1).astype(np.int64) + pad + 1
    return stream, np.concatenate(([0], np.cumsum(lengths))), starts, ends, bounds


def windows(stream: np.ndarray, bounds: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each byte to be predicted with the ``order`` bytes before it, as one number, and the
    text it belongs to."""
    keys = np.zeros(len(stream), np.uint64)
    for back in range(order, -1, -1):
        keys <<= np.uint64(8)
        keys[back:] |= stream[:len(stream) - back]
    count = np.diff(bounds) - order
    at = ragged(bounds[:-1] + order, count)
    return keys[at], np.repeat(np.arange(len(count)), count)


def _count_rows(order: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(kind: int, train: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
            """How often the keys stand in the training, and with 0 those of the others only.
            Sorting without places is several times faster than with them."""
            keys, n = np.unique(train, return_counts=True)
            more, _ = np.unique(others, return_counts=True)
            more = more[~find(keys, more)[1]]
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(len(keys) + len(more), kind)), pa.array(signed(np.append(keys, more))),
                pa.array(np.append(n, np.zeros(len(more), np.int64)))], names=["kind", "key", "n"])

        for batch in batches:
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            for first, end, data, offsets in text_slices(batch.column("text"), lower=True):
                stream, bounds, starts, ends, words = byte_stream(data, offsets, order)
                keys, row = windows(stream, bounds, order)
                own = train[first:end]
                trained = own[row]
                yield counted(0, keys[trained], keys[~trained])
                names = span_hashes(pieces(data), starts, ends)
                word_row = np.repeat(np.arange(end - first), np.diff(words))
                yield counted(1, names[own[word_row]], names[:0])

    return work


def trie_prices(counts: DataFrame, order: int) -> DataFrame:
    """``(key, price)``: log10 of the probability of the last byte of each window after the
    others. ``counts`` has ``key`` and ``n``, the windows of all texts and how often each
    stands in the training texts; a window of a text to be scored may have ``n`` = 0."""
    symbol, size = F.col("key").bitwiseAND(F.lit(255)), 8 * (order + 1)

    def suffix(length: int) -> Column:
        """The last ``length`` bytes of a window."""
        return F.col("key").bitwiseAND(F.lit((1 << 8 * length) - 1)) if 8 * length < size else F.col("key")

    # children[j]: (key of j + 1 bytes, n); contexts[j]: (context of j bytes, total, kinds,
    # inner: what the same bytes count for in the context shorter by one).
    children = {order: counts.where("n > 0").select("key", "n")}
    for j in range(order - 1, -1, -1):
        children[j] = written(children[j + 1].select(suffix(j + 1).alias("key"), "n").groupBy(
            "key").agg(F.sum("n").alias("n")), f"trie{j}")
    contexts = {}
    for j in range(order, -1, -1):
        level = children[j].withColumn("context", F.shiftright("key", 8))
        if j:
            lower = children[j - 1].select(F.col("key").alias("short"), F.col("n").alias("m"))
            level = level.join(lower, suffix(j) == F.col("short"))
        else:
            level = level.withColumn("m", F.lit(0))
        contexts[j] = written(level.groupBy("context").agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("m").alias("inner")),
            f"contexts{j}")

    # Walk down: what is left of the probability, and the total and number of the bytes that
    # the longer contexts have ruled out, as counted in the present one.
    walk = counts.select("key", F.lit(0.0).alias("price"), F.lit(False).alias("done"),
                         F.lit(0).cast("long").alias("out"), F.lit(0).cast("long").alias("out_kinds"))
    for j in range(order, -1, -1):
        own = children[j].select(F.col("key").alias("child"), "n")
        walk = walk.join(contexts[j], F.shiftright(suffix(j + 1), 8) == F.col("context"), "left").join(
            own, suffix(j + 1) == F.col("child"), "left")
        total = F.coalesce("total", F.lit(0)) - F.col("out")
        kinds = F.coalesce("kinds", F.lit(0)) - F.col("out_kinds")
        space = (2 * total).cast("double")
        found = F.col("n").isNotNull()
        step = F.when(F.col("done") | (total == 0), 0.0).when(
            found, F.log10((2 * F.col("n") - 1) / space)).otherwise(F.log10(kinds / space))
        walk = walk.select(
            "key", (F.col("price") + step).alias("price"), (F.col("done") | found).alias("done"),
            F.coalesce("inner", F.lit(0)).alias("out"), F.coalesce("kinds", F.lit(0)).alias("out_kinds"))
    unseen = F.log10(F.greatest(F.lit(256) - F.col("out_kinds"), F.lit(1)).cast("double"))
    return walk.select("key", F.when(F.col("done"), F.col("price")).otherwise(
        F.col("price") - unseen).alias("price"))


def _score_rows(order: int, prices, counts, end_count: int, total: int, kinds: int, first_shard: bool):
    """What a shard of prices and one of words say, either of which may be None: a text is read and
    cut into words once for both."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        price_keys, price_table = prices.slots() if prices else (None, None)
        word_keys, word_table = counts.slots() if counts else (None, None)
        space = total + 0.5 * (kinds + 1)

        def priced(stream: np.ndarray, bounds: np.ndarray, n: int) -> dict:
            keys, row = windows(stream, bounds, order)
            at, there = price_keys.find(keys)
            price = np.where(there, price_table["price"][at], 0.0) if price_keys.size else np.zeros(len(keys))
            return {"score": totals(row, price, n)}

        def based(names: np.ndarray, bounds: np.ndarray, n_rows: int) -> dict:
            row = np.repeat(np.arange(n_rows), np.diff(bounds))
            at, there = word_keys.find(names)
            n = np.where(there, word_table["n"][at], 0) if word_keys.size else np.zeros(len(names), np.int64)
            # Each shard adds what its words have over an unknown word; the first adds the rest.
            gain = totals(row, np.log10((n + 0.5) / 0.5), n_rows)
            known = np.bincount(row, n > 0, n_rows).astype(np.int64)
            tokens = np.zeros(n_rows, np.int64)
            if first_shard:
                tokens = np.diff(bounds) + 1
                gain += tokens * np.log10(0.5 / space) + np.log10((end_count + 0.5) / 0.5)
                known += end_count > 0
            return {"base_score": gain, "n_tokens": tokens, "n_known": known}

        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text"), lower=True, size=SCORED_BYTES):
                stream, bounds, starts, ends, words = byte_stream(data, offsets, order)
                values = priced(stream, bounds, end - first) if prices else {}
                if counts:
                    values |= based(span_hashes(pieces(data), starts, ends), words, end - first)
                yield _part(batch, first, end, **values)

    return work


def _part(batch: pa.RecordBatch, first: int, end: int, **values: np.ndarray) -> pa.RecordBatch:
    n = end - first
    zero, none = np.zeros(n), np.zeros(n, np.int64)
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id").slice(first, n), batch.column("held_out").slice(first, n),
        batch.column("text_key").slice(first, n),
        pa.array(values.get("score", zero)), pa.array(values.get("base_score", zero)),
        pa.array(values.get("n_tokens", none)), pa.array(values.get("n_known", none)),
    ], names=["doc_id", "held_out", "text_key", "score", "base_score", "n_tokens", "n_known"])


def score_texts(docs: DataFrame, order: int = ORDER, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per document.

    ``score`` is the log10 probability of the text under the PPM model: of its words in lower
    case, each after a space, and its end. ``base_score`` is that of a unigram model of words
    with half a count added. Both learn from the documents that are not held out.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A null text is empty and
    has the end alone. A row without an id is never held out. Every row has its own result,
    also where ids repeat or are null; repeated rows give the same row each, and count as often
    as they are there in the training. An empty table gives no rows; without training documents
    all bytes are alike.
    """
    remainder, divisor = held_out
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % divisor == remainder,
                   F.lit(False)).alias("held_out"))
    keyed = texts.withColumn("text_key", text_key())
    counts = written(texts.mapInArrow(_count_rows(order), "kind long, key long, n long").groupBy(
        "kind", "key").agg(F.sum("n").alias("n")), "counts")
    free_shuffles(spark)
    words = counts.where("kind = 1").select("key", "n")
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = texts.where("not held_out").count()
    total, kinds = total + ends, kinds + (ends > 0)
    prices = written(trie_prices(counts.where("kind = 0").select("key", "n"), order), "prices")
    free_shuffles(spark)

    schema = ("doc_id long, held_out boolean, text_key string, score double, base_score double, "
              "n_tokens long, n_known long")
    parts = [keyed.mapInArrow(_score_rows(order, shard, some, ends, total, kinds, i == 0), schema)
             for i, (shard, some) in enumerate(zip_longest(shards(prices), shards(words)))]
    every = parts[0] if len(parts) == 1 else added_up(parts, ["doc_id", "held_out", "text_key"])
    return every.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        "base_score", "score")
