"""Exact top-k search: tiled matrix products of queries and shards.

Each tile of queries is multiplied with each block of a shard; of every product only the
best per query are selected, so what a cell holds and sends on does not depend on how many
vectors there are. The lists of the cells are merged in a tree.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.grid import search, vectors_of

QUERY_TILE, SHARD_TILE = 256, 4096
EXACT = float(2**53)
_LEAST, _MOST = -(2**63), 2**63 - 1


def _scaled(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): doubles, or Python's integers where doubles would not be exact."""
    if not len(vectors) or np.abs(vectors).max() * scale < EXACT:
        return np.floor(vectors * scale)
    return np.array([[math.floor(x * scale) if abs(x) < 2.0**52 else int(x) * int(scale) for x in v]
                     for v in vectors.tolist()], object)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers; a sum beyond their range becomes their end."""
    if a.dtype != object and b.dtype != object and (
            np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT):
        return (a @ b.T).astype(np.int64)
    exact = [[sum(x * y for x, y in zip(u, v)) for v in b.astype(object).tolist()]
             for u in a.astype(object).tolist()]
    return np.array([[min(max(int(x), _LEAST), _MOST) for x in row] for row in exact], np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` best of one row, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = np.flatnonzero(scores >= least)
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen].astype(object) if scores[chosen].min(initial=0) == _LEAST else -scores[chosen]))][:k]


def exact_top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, scale: float = 64.0,
                vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: per query the ``k`` candidates of the highest
    inner product of ``floor(scale * x)``, an exact integer, ties to the smaller id.

    A candidate with the query's id is the query itself and is left out. Vectors that are
    null, empty or hold nulls or non-finite numbers take no part; vectors are compared with
    those of their own length; rows that share an id count once (the least vector). Fewer
    candidates than ``k`` give all of them; an empty side gives an empty result. Sums beyond
    64 bits are held at their ends. Other columns are ignored.
    """

    def found(asked, wanted, ids, vectors):
        wanted, vectors = _scaled(wanted, scale), _scaled(vectors, scale)
        out = []
        for i in range(0, len(asked), QUERY_TILE):
            tile = slice(i, i + QUERY_TILE)
            held_ids = [np.zeros(0, np.int64)] * len(asked[tile])
            held = [np.zeros(0, np.int64)] * len(asked[tile])
            for j in range(0, len(ids), SHARD_TILE):
                block = ids[j:j + SHARD_TILE]
                scores = _products(wanted[tile], vectors[j:j + SHARD_TILE])
                for row, query in enumerate(asked[tile]):
                    others = np.flatnonzero(block != query)
                    part = others[_best(scores[row][others], block[others], k)]
                    names = np.concatenate([held_ids[row], block[part]])
                    values = np.concatenate([held[row], scores[row][part]])
                    top = _best(values, names, k)
                    held_ids[row], held[row] = names[top], values[top]
            out += [(np.full(len(a), q), a, s) for q, a, s in zip(asked[tile], held_ids, held)]
        return tuple(np.concatenate(column) for column in zip(*out))

    return search(
        vectors_of(queries, vec_id, vector), vectors_of(candidates, vec_id, vector), found,
        "long", k, lambda: [F.col("score").desc(), F.col("vec_id")],
    )
