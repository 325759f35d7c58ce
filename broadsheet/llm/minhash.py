"""MinHash near-dedup with fast similarity sketches.

A sketch has as many coordinates as there are bins. In round ``i`` every shingle of a set is
thrown, by the hash of that round, into one bin, which keeps the least value of the first
round that reached it; sets go through rounds until all bins are filled. Should bins be
empty after as many rounds as there are bins, each takes the least value of a hash of its
own. So every coordinate is filled, for small sets too, and a sketch costs about
``n + t log t`` throws. Bands of coordinates then give candidates, and every link is
confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.components import components
from broadsheet.llm.scratch import free_shuffles, unused, written
from broadsheet.llm.textarrays import Hasher, mix, ragged, signed, text_slices, word_spans
from broadsheet.llm.words import pieces, span_hashes

# Rows of a band and bands: two sets of similarity 0.8 share no band once in 500,000 times.
ROWS, BANDS = 7, 56

# Star rounds before what remains apart in a bucket is compared block by block, and the
# members of a block and their shingles (but for sets of more of their own).
STAR_ROUNDS = 2
BLOCK = 1024
BLOCK_SHINGLES = 1_000_000

_STEP, _BAND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LOW, _32 = np.uint64(0xFFFFFFFF), np.uint64(32)
_EMPTY = np.uint64(2**64 - 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int, hasher: Hasher
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, one text after the other, and the
    offset of each text in them. A text of fewer words than a shingle is one shingle."""
    starts, ends, bounds = word_spans(data, offsets)
    items = span_hashes(pieces(data), starts, ends)
    sums = hasher.prefix(items)
    count = np.diff(bounds)
    n = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    row = np.repeat(np.arange(len(n)), n)
    first = ragged(bounds[:-1], n)
    hashes = hasher.spans(sums, first, np.minimum(first + words, bounds[1:][row]))
    _, example = np.unique(mix(hashes ^ mix(row.astype(np.uint64))), return_index=True)
    example = example[np.argsort(row[example], kind="stable")]
    return hashes[example], np.searchsorted(row[example], np.arange(len(n) + 1))


def sketches(hashes: np.ndarray, offsets: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of each set, a row of ``bins`` coordinates; of empty sets all alike."""
    n_sets = len(offsets) - 1
    sketch = np.full(n_sets * bins, _EMPTY)
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n_sets), size)
    width = np.uint64(bins)
    for i in range(bins):
        if not len(hashes):
            break
        thrown = mix(hashes + _STEP * np.uint64(i + 1))
        at = owner * bins + ((thrown >> _32) * width >> _32).astype(np.int64)
        np.minimum.at(sketch, at, (thrown & _LOW) | np.uint64(i) << _32)
        rows = np.unique(owner)
        short = np.zeros(n_sets, bool)
        short[rows] = (sketch.reshape(n_sets, bins)[rows] == _EMPTY).any(1)
        if not short[rows].all():
            stay = short[owner]
            hashes, owner = hashes[stay], owner[stay]
    sketch = sketch.reshape(n_sets, bins)
    for row in np.unique(owner):
        own = hashes[owner == row]
        for j in np.flatnonzero(sketch[row] == _EMPTY):
            least = (mix(own + _STEP * np.uint64(bins + j + 1)) & _LOW).min()
            sketch[row, j] = least | np.uint64(bins + j) << _32
    return sketch


def band_keys(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A hash per band of each sketch."""
    parts = sketch[:, :rows * bands].reshape(len(sketch), bands, rows)
    key = np.zeros((len(sketch), bands), np.uint64) + np.arange(bands, dtype=np.uint64) * _BAND
    for j in range(rows):
        key = mix(key ^ parts[:, :, j] * _STEP)
    return key


def _sketch_rows(words: int, rows: int, bands: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text"), lower=True):
                hashes, bounds = shingle_sets(data, offsets, words, hasher)
                size = np.diff(bounds)
                keys = band_keys(sketches(hashes, bounds, rows * bands), rows, bands)
                some = size > 0
                totals = []
                for salt in (1, 2):
                    sums = np.zeros(len(hashes) + 1, np.uint64)
                    np.cumsum(mix(hashes ^ _BAND * np.uint64(salt)), out=sums[1:])
                    totals.append(signed(sums[bounds[1:]] - sums[bounds[:-1]]))
                edges = np.concatenate(([0], np.cumsum(some * bands))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, end - first), pa.array(size),
                    pa.array(totals[0]), pa.array(totals[1]),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(signed(keys[some].ravel()))),
                ], names=["doc_id", "n", "s1", "s2", "bands"])

    return work


def _set_rows(words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text"), lower=True):
                hashes, bounds = shingle_sets(data, offsets, words, hasher)
                out = [np.sort(hashes[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first), pa.array(out, pa.binary())],
                    names=["doc_id", "shingles"])

    return work


def _linked_rows(percent: int):
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = np.zeros(len(frame), bool)
            for i, (a, b) in enumerate(zip(frame["one"], frame["two"])):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(a) + len(b) - len(np.union1d(a, b))
                keep[i] = 100 * both >= percent * (len(a) + len(b) - both)
            yield frame.loc[keep, ["a", "b"]]

    return work


def _links_of_cell(percent: int):
    def links(cell: pa.Table) -> pa.Table:
        ids = cell.column("doc_id").to_numpy()
        _, component = np.unique(cell.column("component").to_numpy(), return_inverse=True)
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in cell.column("shingles")]
        size = np.array([len(s) for s in sets])
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(size) - size
        found = []
        # Every pair has a member outside the largest component.
        for x in np.flatnonzero(component != np.bincount(component).argmax()):
            own = np.zeros(len(names), bool)
            own[flat[starts[x]:starts[x] + size[x]]] = True
            both = np.add.reduceat(own[flat], starts, dtype=np.int64)
            near = (100 * both >= percent * (size + size[x] - both)) & (component != component[x])
            found += [(min(ids[x], y), max(ids[x], y)) for y in ids[near]]
        pairs = np.array(sorted(set(found)), np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return links


class _Links:
    """Confirmed links among candidates, and the components they make."""

    def __init__(self, sets: DataFrame, percent: int):
        self.sets, self.percent = sets, percent
        self.links: DataFrame | None = None

    def confirm(self, pairs: DataFrame) -> None:
        """Add those of ``pairs(a, b)`` whose full sets are similar enough."""
        one = self.sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("one"))
        two = self.sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("two"))
        found = written(pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
                        .mapInPandas(_linked_rows(self.percent), "a long, b long"), "links")
        self.links = found if self.links is None else self.links.union(found)
        free_shuffles(pairs.sparkSession)

    def confirm_apart(self, buckets: DataFrame) -> None:
        """Add all links between members of a bucket that are in different components.

        Sets that differ in size by more than the percentage allows are never linked. So a bucket
        is cut into size classes, such that links stay within a class or join two that are
        next to each other, and a class into blocks of bounded members and shingles. Every two
        blocks of such classes meet in one cell; there the sets are compared, and nothing but
        links comes out."""
        # A little wider than needed, as logarithms are rounded.
        width = math.log(100.1 / max(self.percent, 1))
        sized = buckets.withColumn("size", F.floor(F.log("n") / width))
        blocks = written(sized.groupBy("key", "size").agg(F.greatest(
            F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")),
            "blocks")
        met = blocks.select("key", (F.col("size") - 1).alias("size"), F.col("blocks").alias("above"))
        below = blocks.select("key", (F.col("size") + 1).alias("size"), F.col("blocks").alias("under"))
        around = blocks.join(met, ["key", "size"], "left").join(below, ["key", "size"], "left")
        own = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))

        def each(count: Column) -> Column:
            return F.sequence(F.lit(0).cast("long"), count - 1)

        # A cell of blocks i of a class and j of the same (i <= j) or of the next one.
        none = F.array().cast("array<struct<size:bigint,i:bigint,next:boolean,j:bigint>>")
        with_same = F.transform(each(F.col("blocks")), lambda x: F.struct(
            "size", F.least("own", x).alias("i"), F.lit(False).alias("next"),
            F.greatest("own", x).alias("j")))
        with_next = F.when(F.col("above").isNull(), none).otherwise(
            F.transform(each(F.col("above")), lambda x: F.struct(
                "size", F.col("own").alias("i"), F.lit(True).alias("next"), x.alias("j"))))
        with_last = F.when(F.col("under").isNull(), none).otherwise(
            F.transform(each(F.col("under")), lambda x: F.struct(
                (F.col("size") - 1).alias("size"), x.alias("i"), F.lit(True).alias("next"),
                F.col("own").alias("j"))))
        cells = sized.join(around, ["key", "size"]).withColumn("own", own).select(
            "key", "doc_id", "component",
            F.explode(F.concat(with_same, with_next, with_last)).alias("cell"),
        ).select("key", "cell.*", "doc_id", "component")
        found = written(cells.join(self.sets, "doc_id").groupBy(
            "key", "size", "i", "next", "j").applyInArrow(
            _links_of_cell(self.percent), "a long, b long").distinct(), "links")
        self.links = self.links.union(found)
        free_shuffles(buckets.sparkSession)

    def components(self) -> DataFrame:
        return written(components(self.links), "components")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = ROWS,
                    bands: int = BANDS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row per document: the number of its
    distinct shingles of ``words`` words, the smallest id it reaches over links, and whether
    that is its own. Two documents are linked when ``100 * |A & B| >= percent * |A | B|``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A-Z are lower-cased; a
    text of fewer words than a shingle is one shingle; a text without words, or null, has
    none and is linked with nothing. Equal sets are one class and compared once, however
    many documents share them. Repeated rows of an id give the same row each; a row without
    an id has no component and is kept. An empty table gives an empty result.

    In a bucket of a band, all classes are first compared with its least one only, then what
    still is in other components with the next; pairs in one component need no test. What
    then remains apart is compared in blocks, so no link between candidates is lost.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    sketched = written(
        texts.mapInArrow(_sketch_rows(words, rows, bands),
                         "doc_id long, n long, s1 long, s2 long, bands array<long>"), "sketches")
    usable = sketched.where("doc_id is not null and n > 0")
    classes = written(usable.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("class")), "classes")
    heads = usable.join(classes.select(F.col("class").alias("doc_id")).distinct(), "doc_id", "left_semi")
    keyed = heads.dropDuplicates(["doc_id"]).select("doc_id", "n", F.explode("bands").alias("key"))
    shared = written(
        keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "shared")
    buckets = written(keyed.join(shared, "key", "left_semi"), "buckets")
    free_shuffles(spark)

    members = buckets.select("doc_id").distinct()
    sets = written(texts.join(members, "doc_id", "left_semi").dropDuplicates(["doc_id"])
                   .mapInArrow(_set_rows(words), "doc_id long, shingles binary"), "sets")
    free_shuffles(spark)

    links = _Links(sets, percent)
    labels = None
    open_buckets = buckets.withColumn("component", F.col("doc_id"))
    possible = (F.col("n") * 100 >= F.col("hub_n") * percent) & (
        F.col("hub_n") * 100 >= F.col("n") * percent)
    for star in range(STAR_ROUNDS):
        hubs = written(open_buckets.groupBy("key").agg(
            F.min(F.struct("doc_id", "n", "component")).alias("hub")), "hubs")
        stars = open_buckets.join(hubs, "key").select(
            "*", F.col("hub.doc_id").alias("h"), F.col("hub.n").alias("hub_n"))
        # A first comparison for each, with the least hub that may be similar.
        pairs = stars.where((F.col("component") != F.col("hub.component")) & possible)
        if labels is None:
            pairs = pairs.groupBy(F.col("doc_id").alias("b")).agg(F.min("h").alias("a"))
        else:
            pairs = pairs.select(F.col("h").alias("a"), F.col("doc_id").alias("b")).distinct()
        links.confirm(pairs)
        labels = links.components()
        rest = open_buckets if star == 0 else stars.where("doc_id != h").select(*open_buckets.columns)
        open_buckets = _apart(rest, labels)
    links.confirm_apart(open_buckets)
    labels = links.components()

    classed = sketched.select("doc_id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id"))
    return classed.join(labels, F.col("class") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def _apart(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that still hold several components, with their components."""
    labelled = buckets.drop("component").join(
        labels, F.col("doc_id") == F.col("node"), "left"
    ).select("key", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
    several = written(labelled.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")
    ).where("lo != hi").select("key"), "several")
    return written(labelled.join(several, "key", "left_semi"), "apart")


def one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each group of near duplicates, that of the smallest id, and
    one row of each id; rows without an id stay. See ``near_duplicates`` for the rules."""
    (name,) = unused(docs, "kept")
    kept = near_duplicates(docs, words, percent).where("kept and doc_id is not null").select(
        F.col("doc_id").alias(name)).distinct()
    with_id = docs.where("doc_id is not null").join(
        kept, docs["doc_id"].cast("long") == F.col(name), "left_semi").dropDuplicates(["doc_id"])
    return with_id.unionByName(docs.where("doc_id is null"))
