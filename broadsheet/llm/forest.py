"""Approximate nearest neighbours: a forest of hash prefixes.

Each tree of a shard is a sorted array of hash strings, one bit per random hyperplane. A
query descends each tree to the longest prefix that any entry shares with it, and then
ascends all trees together, one bit at a time, until enough candidates share the prefix of
that length in some tree. How far it ascends thus depends on how crowded its place is.
Candidates are compared by exact distance.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.grid import search, vectors_of

# Trees, bits of a hash string, and the entries (over all trees, an entry counting once per
# tree) at which the ascent stops: a share of the shard, and at least so many.
TREES = 20
BITS = 32
SHARE = 1.0
LEAST = 400


class Forest:
    """Sorted arrays of hash strings over the rows of one shard, all of them."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 5):
        self.vectors, self.bits = vectors, bits
        self.centre = vectors.mean(0)
        self.scale = max(float(np.abs(vectors - self.centre).max()), 1e-300)
        self.planes = np.random.default_rng(seed).normal(size=(trees, vectors.shape[1], bits))
        keys = self._strings(vectors)
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, 1)

    def _strings(self, vectors: np.ndarray) -> np.ndarray:
        """Hash strings, one row per tree: the first bit is the highest."""
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        around = (vectors - self.centre) / self.scale
        return np.stack([((around @ p) > 0).astype(np.uint64) @ weights for p in self.planes])

    def candidates(self, queries: np.ndarray, enough: int) -> list[np.ndarray]:
        """Per query the rows that share the prefix it stops at, in any tree."""
        strings = self._strings(queries)
        trees, n = len(self.keys), len(queries)
        low = np.zeros((trees, n), np.int64)
        high = np.zeros((trees, n), np.int64)
        waiting = np.arange(n)
        for length in range(self.bits, -1, -1):
            rest = np.uint64(self.bits - length)
            first = strings[:, waiting] >> rest << rest
            last = first | ((np.uint64(1) << rest) - np.uint64(1))
            for t in range(trees):
                low[t, waiting] = np.searchsorted(self.keys[t], first[t], "left")
                high[t, waiting] = np.searchsorted(self.keys[t], last[t], "right")
            count = (high[:, waiting] - low[:, waiting]).sum(0)
            waiting = waiting[count < enough]
            if not len(waiting):
                break
        return [np.unique(np.concatenate([self.order[t, low[t, i]:high[t, i]] for t in range(trees)]))
                for i in range(n)]


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 10, trees: int = TREES,
            bits: int = BITS, share: float = SHARE, least: int = LEAST,
            vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: per query the ``k`` nearest candidates found, by
    Euclidean distance in doubles, nearest first, ties to the smaller id.

    Every candidate is in the index of its shard, and every query is put to every shard. A
    shard answers with all its rows that share a prefix, so an answer is short of ``k`` only
    if there are fewer candidates. A candidate with the query's id is the query itself and is
    left out. Vectors that are null, empty, all zero or hold nulls or non-finite numbers take
    no part; vectors are compared with those of their own length; rows that share an id
    count once (the least vector). An empty side gives an empty result. Other columns are
    ignored.
    """

    def found(asked, wanted, ids, vectors):
        forest = Forest(vectors, trees, bits)
        enough = max(int(share * len(ids)), least, 2 * k * trees)
        out = []
        for query, point, rows in zip(asked, wanted, forest.candidates(wanted, enough)):
            rows = rows[ids[rows] != query]
            difference = vectors[rows] - point
            largest = np.abs(difference).max(1, initial=0.0)
            unit = np.where(largest > 1e150, largest, 1.0)
            distance = np.sqrt(((difference / unit[:, None]) ** 2).sum(1)) * unit
            best = np.lexsort((ids[rows], distance))[:k]
            out.append((np.full(len(best), query), ids[rows][best], distance[best]))
        return tuple(np.concatenate(column) for column in zip(*out))

    def some(table: DataFrame) -> DataFrame:
        return vectors_of(table, vec_id, vector).where(F.exists("v", lambda x: x != 0))

    return search(some(queries), some(candidates), found, "double", k,
                  lambda: [F.col("score"), F.col("vec_id")])
