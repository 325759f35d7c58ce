"""Toxicity by cumulative-link ordinal regression.

Severity grades are ordered, 0 to K. One weight vector is shared by all thresholds: the
probability of a grade above ``k`` is ``sigmoid(w . x - theta_k)`` with thresholds in
increasing order, and the expected severity is their sum. Features are sparse: words and
beginnings of words, hashed, with the logarithm of their count.

Where labels only say toxic or not, toxic training texts are graded by how many different
telling words they hold (words far more frequent in toxic texts), cut at the terciles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.scratch import written
from broadsheet.llm.textarrays import Hasher, text_slices, totals

# Hash buckets; beginnings of words in bytes; labelled rows to train on, toxic and not
# (the least by a hash of their id: the model is fitted on a bounded sample).
BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6, 7, 8, 9)
TRAIN_TOXIC, TRAIN_CLEAN = 5_000, 10_000
GRADES = 3

# Buckets with a difference between the classes of so many standard errors are features.
TELLING = 3.0
STRENGTH, STEPS, RATE = 1e-4, 400, 0.2

SCORED = "doc_id long, severity int, expected_severity double, is_toxic boolean"

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def _features(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of all words of lower-cased texts, odd, and beginnings, even."""
    n = len(data)
    letter = np.zeros(n + 2, bool)
    letter[1:-1] = _LETTER[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(letter[1:] & (~letter[:-1] | edge))
    ends = np.flatnonzero(letter[:-1] & (~letter[1:] | edge))
    row = np.searchsorted(offsets, starts, "right") - 1
    sums = hasher.prefix(data)
    mask, one = np.uint64(BUCKETS - 2), np.uint64(1)
    rows, features = [row], [hasher.spans(sums, starts, ends) & mask | one]
    for size in BEGINNINGS:
        some = ends - starts > size
        rows.append(row[some])
        features.append(hasher.spans(sums, starts[some], starts[some] + size) & mask)
    return np.concatenate(rows), np.concatenate(features).astype(np.int64)


def _counted(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pairs, n = np.unique(row * BUCKETS + feature, return_counts=True)
    return pairs // BUCKETS, pairs % BUCKETS, np.log1p(n)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, sums: np.ndarray) -> np.ndarray:
        """Probability of a grade above each threshold, a row per text."""
        return 1 / (1 + np.exp(-np.clip(sums[:, None] - self.thresholds, -500, 500)))

    def sums(self, data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> np.ndarray:
        row, feature = _features(data, offsets, hasher)
        used = self.weights[feature] != 0
        row, feature, value = _counted(row[used], feature[used])
        return totals(row, self.weights[feature] * value, len(offsets) - 1)


def _frequency_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature the number of toxic and of other texts that have it."""
    hasher = Hasher()
    for batch in batches:
        toxic = batch.column("grade").to_numpy() > 0
        for first, end, data, offsets in text_slices(batch.column("text"), lower=True):
            at, feature, _ = _counted(*_features(data, offsets, hasher))
            bad = toxic[first:end][at]
            names, inverse = np.unique(feature, return_inverse=True)
            in_bad = np.bincount(inverse, bad, len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(in_bad), pa.array(np.bincount(inverse, minlength=len(names)) - in_bad)],
                names=["feature", "bad", "good"])


def _example_rows(chosen: Broadcast):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, wanted = Hasher(), np.zeros(BUCKETS, bool)
        wanted[chosen.value] = True
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text"), lower=True):
                row, feature = _features(data, offsets, hasher)
                used = wanted[feature]
                at, feature, value = _counted(row[used], feature[used])
                edges = np.searchsorted(at, np.arange(end - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("grade").slice(first, end - first),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(feature.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(value.astype(np.float32))),
                ], names=["grade", "features", "values"])

    return work


def _thresholds(free: np.ndarray) -> np.ndarray:
    """Increasing thresholds out of free parameters: the first, and logs of the gaps."""
    return free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))


def fit(row: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int) -> Model:
    """Maximum likelihood with a penalty on squared weights, by adaptive gradient steps."""
    used, column = np.unique(feature, return_inverse=True)
    n = len(grade)
    w = np.zeros(len(used))
    share = [(grade > k).mean() for k in range(grades)]
    first = -np.log(max(share[0], 1e-3) / max(1 - share[0], 1e-3))
    free = np.concatenate(([first], np.zeros(grades - 1)))
    weight = np.full(n, 1 / n)
    moment, square = np.zeros(len(w) + grades), np.zeros(len(w) + grades)
    for step in range(1, STEPS + 1):
        theta = np.concatenate(([-np.inf], _thresholds(free), [np.inf]))
        score = np.bincount(row, w[column] * value, n)
        up = 1 / (1 + np.exp(-np.clip(theta[grade + 1] - score, -500, 500)))
        down = 1 / (1 + np.exp(-np.clip(theta[grade] - score, -500, 500)))
        chance = np.maximum(up - down, 1e-12)
        slope_up, slope_down = up * (1 - up) / chance * weight, down * (1 - down) / chance * weight
        d_theta = np.bincount(grade, -slope_up, grades + 1)[:grades] + np.bincount(
            grade, slope_down, grades + 1)[1:]
        d_free = np.concatenate(([d_theta.sum()], [
            d_theta[k:].sum() * np.exp(free[k]) for k in range(1, grades)]))
        d_w = np.bincount(column, (slope_up - slope_down)[row] * value, len(w)) + STRENGTH * w
        slope = np.concatenate((d_w, d_free))
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = RATE / step**0.5 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        w -= move[:len(w)]
        free = free - move[len(w):]
    weights = np.zeros(BUCKETS, np.float64)
    weights[used] = w
    return Model(weights, _thresholds(free))


def train(docs: DataFrame, labels: DataFrame, grades: int = GRADES, toxic_rows: int = TRAIN_TOXIC,
          clean_rows: int = TRAIN_CLEAN) -> Model:
    """A model from labelled documents: ``labels`` has ``doc_id`` and ``toxic`` (0 or 1), or
    ``grade`` (0 to ``grades``). Labels that are null or of a missing document are ignored.

    At most ``toxic_rows`` + ``clean_rows`` labelled rows are taken, those of the least hash
    of their id; only they, and no other text, are gathered.
    """
    has_grade = "grade" in labels.columns
    own = F.col("grade" if has_grade else "toxic").cast("int")
    rows = labels.select(F.col("doc_id").cast("long").alias("_doc"), own.alias("grade")).where(
        "_doc is not null and grade is not null").dropDuplicates(["_doc"])
    order = [F.xxhash64("_doc"), F.col("_doc")]
    chosen = rows.where("grade > 0").orderBy(*order).limit(toxic_rows).union(
        rows.where("grade <= 0").orderBy(*order).limit(clean_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("text"))
    examples = written(texts.join(F.broadcast(chosen), "_doc").select("grade", "text"), "examples")
    none = Model(np.zeros(BUCKETS), np.arange(1.0, grades + 1) * 50)
    n_bad, n_good = examples.agg(
        F.count(F.when(F.col("grade") > 0, 1)), F.count(F.when(F.col("grade") <= 0, 1))).first()
    if not n_bad or not n_good:
        # One class alone, or none, tells nothing apart: everything is grade 0.
        return none
    frequent = examples.mapInArrow(_frequency_rows, "feature long, bad long, good long").groupBy(
        "feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    bad, good = F.col("bad") + 0.5, F.col("good") + 0.5
    rest_bad, rest_good = n_bad - F.col("bad") + 0.5, n_good - F.col("good") + 0.5
    z = (F.log(bad / rest_bad) - F.log(good / rest_good)) / F.sqrt(
        1 / bad + 1 / rest_bad + 1 / good + 1 / rest_good)
    telling = frequent.where(F.abs(z) > TELLING).toArrow()
    names = telling.column("feature").to_numpy()
    p = (telling.column("bad").to_numpy() + 0.5) / (n_bad + 1)
    q = (telling.column("good").to_numpy() + 0.5) / (n_good + 1)
    chosen_names = docs.sparkSession.sparkContext.broadcast(names)
    rows = examples.mapInArrow(_example_rows(chosen_names),
                               "grade int, features array<int>, values array<float>").toArrow()
    grade = rows.column("grade").to_numpy().astype(np.int64)
    lists = rows.column("features").combine_chunks()
    feature = lists.flatten().to_numpy().astype(np.int64)
    value = rows.column("values").combine_chunks().flatten().to_numpy().astype(float)
    row = np.repeat(np.arange(len(grade)), np.diff(lists.offsets.to_numpy()))
    if not len(feature):
        return none
    if not has_grade:
        strong = np.zeros(BUCKETS, bool)
        strong[names[(p > 20 * q) & (names % 2 == 1)]] = True
        marks = np.bincount(row, strong[feature], len(grade))
        cuts = np.quantile(marks[grade > 0], np.arange(1, grades) / grades)
        grade = np.where(grade > 0, 1 + np.searchsorted(cuts, marks, "left"), 0)
    return fit(row, feature, value, np.clip(grade, 0, grades), grades)


def _score_rows(shared: Broadcast):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = Model(*shared.value), Hasher()
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text"), lower=True):
                above = model.above(model.sums(data, offsets, hasher))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, end - first),
                    pa.array((above >= 0.5).sum(1).astype(np.int32)),
                    pa.array(above.sum(1)), pa.array(above[:, 0] >= 0.5),
                ], names=["doc_id", "severity", "expected_severity", "is_toxic"])

    return work


def severities(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, severity, expected_severity, is_toxic)``, a row per document: the highest
    grade that is at least as likely to be reached as not, the expected grade, and whether
    grade 1 is reached.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Whole texts are read. A
    null or empty text, or one without telling features, scores by the thresholds alone.
    Ids may be null or repeat; every row has its result. An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_score_rows(_shared(docs, model)), SCORED)


def _shared(docs: DataFrame, model: Model) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, that are not toxic; see ``severities`` for the rules."""
    shared = _shared(docs, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = Model(*shared.value), Hasher()
        for batch in batches:
            text = batch.column(batch.schema.names.index("text"))
            for first, end, data, offsets in text_slices(text, lower=True):
                above = model.above(model.sums(data, offsets, hasher))
                yield batch.slice(first, end - first).filter(pa.array(above[:, 0] < 0.5))

    return docs.mapInArrow(work, docs.schema)
