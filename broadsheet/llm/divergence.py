"""Source divergence audit: what each source of a language says more often than the language,
and how far its sources are from each other, by count cells.

Terms that a source and its language hold equally often have equal shares in both, so the
divergence of a term is that of its cell ``(count in the source, count in the language)``.
It is worked out once per cell; cells are ranked by value, equal values merged, and how many
terms stand before a value is the sum of the multiplicities above it. Only cells that reach
the ranks asked for are expanded into terms, in the order of their UTF-8 bytes.

Distances between two sources are sums over all terms. Terms are dealt into buckets, and the
sources of a language into blocks; a bucket of two blocks is a small matrix of shares, in which
a source that lacks a term has the share of count 0. No pair of sources is a row until it is
the sum over a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if, is_small
from broadsheet.llm.scratch import free_shuffles, written
from broadsheet.llm.textarrays import text_slices
from broadsheet.llm.words import distinct, pieces

# Documents of a language that a term must be in, what is added to each count,
# the units of a share, and the ranks of terms that are reported.
LEAST_DOCUMENTS = 30
ADDED = 5
UNITS = 1_000_000_000
RANKS = 50

# Terms of a bucket and sources of a block, about: a matrix of some 4 MB.
BUCKET = 4_096
BLOCK = 64

_GROUP = ["lang", "source"]
_LETTER = np.ones(256, bool)
_LETTER[:0x80] = False
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of letters, ASCII letters and all beyond ASCII, and the offset
    of each row's first run in that list."""
    letter = np.zeros(len(data) + 2, bool)
    letter[1:-1] = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(letter[1:] & (~letter[:-1] | edge))
    ends = np.flatnonzero(letter[:-1] & (~letter[1:] | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        groups = [batch.column(name).fill_null("") for name in _GROUP]
        names, group = [], np.zeros(batch.num_rows, np.int64)
        for column in groups:
            coded = column.dictionary_encode()
            names.append(coded.dictionary)
            group = group * max(1, len(coded.dictionary)) + coded.indices.to_numpy()
        for first, end, data, offsets in text_slices(batch.column("text"), lower=True):
            starts, ends, bounds = term_spans(data, offsets)
            if not len(starts):
                continue
            example, term = distinct(pieces(data), starts, ends)
            row = np.repeat(np.arange(end - first), np.diff(bounds))
            # Each term of each document, then each term of each group.
            own, n = np.unique(row * len(example) + term, return_counts=True)
            key, at = np.unique(
                group[first + own // len(example)] * len(example) + own % len(example), return_inverse=True)
            raw = data.tobytes()
            terms = pa.array([raw[a:b].decode() for a, b in zip(starts[example], ends[example])], pa.string())
            code = key // len(example)
            inner = max(1, len(names[1]))
            yield pa.RecordBatch.from_arrays([
                names[0].take(pa.array(code // inner)), names[1].take(pa.array(code % inner)),
                terms.take(pa.array(key % len(example))),
                pa.array(np.bincount(at, n).astype(np.int64)), pa.array(np.bincount(at)),
            ], names=["lang", "source", "term", "n", "docs"])


def _share(n: Column, total: Column, kinds: Column) -> Column:
    """``1 + floor(UNITS * (n + ADDED) / (total + ADDED * kinds))`` in exact whole numbers."""
    above = (n + F.lit(ADDED)).cast("decimal(20,0)") * F.lit(UNITS).cast("decimal(10,0)")
    below = (total + F.lit(ADDED) * kinds).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, F.nullif(below, F.lit(0))).cast("long")


def _tile_sums(tile: pa.Table) -> pa.Table:
    """Of one bucket of terms and two blocks of sources: for every pair of sources the sum of
    the differences of their shares over the terms that any source of the tile has. A row
    without a term stands for each source of the blocks, so that all are there."""
    named = tile.filter(tile.column("term").is_valid())
    terms, at = np.unique(named.column("term").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    places, row = np.unique(tile.column("place").to_numpy(), return_inverse=True)
    shares = np.empty((len(places), len(terms)), np.int64)
    shares[row] = tile.column("zero").to_numpy()[:, None]
    shares[np.searchsorted(places, named.column("place").to_numpy()), at] = named.column("p").to_numpy()
    i, j = tile.column("i")[0].as_py(), tile.column("j")[0].as_py()
    one, two = np.flatnonzero(places // BLOCK == i), np.flatnonzero(places // BLOCK == j)
    sums = np.array([np.abs(shares[two] - shares[x]).sum(1) for x in one], np.int64).reshape(len(one), len(two))
    a, b = np.repeat(places[one], len(two)), np.tile(places[two], len(one))
    some = a < b
    n = int(some.sum())
    return pa.table({
        "lang": pa.array([tile.column("lang")[0].as_py()] * n, pa.string()), "a": a[some], "b": b[some],
        "apart": sums.ravel()[some], "terms": np.full(n, len(terms), np.int64)})


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every group of a language and a source.

    ``docs`` has ``text``, ``lang`` and ``source``; other columns are ignored; nulls read as
    empty strings. Terms are runs of ASCII letters and of all characters beyond ASCII, with
    A-Z in lower case, of whole texts; a language keeps those in at least ``least_documents``
    of its documents. A share is ``1 + floor(10^9 * (count + 5) / (N + 5 * V))``, for the ``V``
    kept terms of the language and the ``N`` occurrences of kept terms in the group or language.

    Part ``pair``: each other source of the language, with the sum over all kept terms of the
    difference of shares (0 without terms). Part ``term``: the terms a group has, and has a
    greater share of than its language, with the difference, to rank ``ranks``. Values rank
    from the highest, equal ones in the order of the items' UTF-8 bytes.

    Documents count as often as they are there. A group without terms has the shares of counts
    of 0. A language of one source has no pairs. An empty table gives no rows.

    What is shuffled is counts per group and term, added up where texts are read, so a hot
    source or term is no more rows than it has terms or sources.
    """
    spark = docs.sparkSession
    clean = docs.select("text", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in _GROUP])
    counted = written(
        clean.select(F.col("text").cast("string").alias("text"), *_GROUP).mapInArrow(
            _count_rows, "lang string, source string, term string, n long, docs long"
        ).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    free_shuffles(spark)
    kept = counted.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")
    ).where(F.col("docs") >= least_documents).drop("docs")
    counts = written(counted.drop("docs").join(kept, ["lang", "term"]), "counts")
    free_shuffles(spark)

    langs = counts.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(
        F.count("*").alias("kinds"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy(*_GROUP).agg(F.sum("n").alias("total"))
    own = Window.partitionBy("lang").orderBy("source")
    zero = F.lit(0).cast("long")
    groups = written(
        clean.select(*_GROUP).distinct().join(totals, _GROUP, "left").join(langs, "lang", "left").select(
            *_GROUP, F.coalesce("total", zero).alias("total"), F.coalesce("kinds", zero).alias("kinds"),
            F.coalesce("lang_total", zero).alias("lang_total"),
            (F.row_number().over(own) - 1).cast("long").alias("place"),
        ).withColumn("zero", _share(zero, F.col("total"), F.col("kinds"))), "groups")
    small = is_small(groups)
    return _pairs(counts, groups, small).unionByName(_terms(counts, groups, small, ranks))


def _pairs(counts: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
    blocks = groups.groupBy("lang").agg((F.max("place") / BLOCK).cast("long").alias("last_block"))
    buckets = F.ceil(F.col("kinds") / BUCKET)

    def shares(rows: DataFrame, term: Column, bucket: Column, share: Column) -> DataFrame:
        return rows.select("lang", term.alias("term"), "place", "zero", bucket.alias("bucket"),
                           share.alias("p"), (F.col("place") / BLOCK).cast("long").alias("own"))

    named = shares(counts.join(broadcast_if(groups, small), _GROUP), F.col("term"),
                   F.pmod(F.xxhash64("term"), buckets), _share(F.col("n"), F.col("total"), F.col("kinds")))
    each = F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1))
    unnamed = shares(groups.where("kinds > 0").withColumn("bucket", each), F.lit(None).cast("string"),
                     F.col("bucket"), F.col("zero"))
    # Each block meets each, in one tile per bucket: a row goes to as many tiles as there are blocks.
    every = named.unionByName(unnamed).join(broadcast_if(blocks, small), "lang")
    tiles = every.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_block")))).select(
        "lang", "term", "place", "zero", "p", "bucket",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    sums = tiles.groupBy("lang", "bucket", "i", "j").applyInArrow(
        _tile_sums, "lang string, a long, b long, apart long, terms long").groupBy("lang", "a", "b").agg(
        F.sum("apart").alias("apart"), F.sum("terms").alias("terms"))
    sums = written(sums, "sums")
    one = groups.select("lang", F.col("source").alias("source"), F.col("place").alias("a"),
                        F.col("zero").alias("zero_a"), "kinds")
    two = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"),
                        F.col("zero").alias("zero_b"))
    pairs = one.join(broadcast_if(two, small), "lang").where("a != b")
    # Terms in none of the tiles of a pair are in neither source.
    low, high = F.least("a", "b"), F.greatest("a", "b")
    apart = pairs.withColumn("lo", low).withColumn("hi", high).join(
        sums.select(F.col("lang").alias("of"), F.col("a").alias("lo_"), F.col("b").alias("hi_"), "apart", "terms"),
        (F.col("lang") == F.col("of")) & (F.col("lo") == F.col("lo_")) & (F.col("hi") == F.col("hi_")), "left")
    rest = F.col("kinds") - F.coalesce("terms", F.lit(0))
    value = F.coalesce(F.coalesce("apart", F.lit(0)) + rest * F.abs(F.col("zero_a") - F.col("zero_b")), F.lit(0))
    order = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    return apart.select(*_GROUP, F.lit("pair").alias("part"), "item", value.cast("long").alias("value")).withColumn(
        "rank", F.row_number().over(order))


def _terms(counts: DataFrame, groups: DataFrame, small: bool, ranks: int) -> DataFrame:
    cell = ["n", "lang_n"]
    cells = counts.groupBy(*_GROUP, *cell).agg(F.count("*").alias("terms")).join(
        broadcast_if(groups, small), _GROUP
    ).select(*_GROUP, *cell, "terms", (
        _share(F.col("n"), F.col("total"), F.col("kinds"))
        - _share(F.col("lang_n"), F.col("lang_total"), F.col("kinds"))).alias("value")).where("value > 0")
    # Equal values merged. A value has a term at least, so no more values than ranks count.
    values = cells.groupBy(*_GROUP, "value").agg(F.sum("terms").alias("terms"))
    best = Window.partitionBy(*_GROUP).orderBy(F.desc("value"))
    before = F.sum("terms").over(best.rowsBetween(Window.unboundedPreceding, -1))
    reached = values.withColumn("place", F.row_number().over(best)).where(F.col("place") <= ranks).withColumn(
        "before", F.coalesce(before, F.lit(0))).where(F.col("before") < ranks)
    chosen = written(cells.join(reached.select(*_GROUP, "value", "before"), [*_GROUP, "value"]).select(
        *_GROUP, *cell, "value", "before"), "cells")
    named = counts.join(broadcast_if(chosen, is_small(chosen)), [*_GROUP, *cell])
    alike = Window.partitionBy(*_GROUP, "value").orderBy("term")
    expanded = named.withColumn("number", F.row_number().over(alike)).where(F.col("number") <= ranks)
    rank = (F.col("before") + F.col("number")).cast("int")
    return expanded.select(*_GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value",
                           rank.alias("rank")).where(F.col("rank") <= ranks)
