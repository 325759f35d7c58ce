"""A stated set of queries against all rows, in blocks: the search operators' common part.

Candidates are dealt into ``rows`` shards and queries into ``columns`` tiles by a hash of
their ids. Each cell of the grid holds one tile and one shard, both of bounded size; a tile
is copied once per shard and a shard once per tile, by an equi-join on the cell. What the
cells find for a query is merged in a tree of bounded fan-in.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Vectors of a shard or a tile, about, and lists that one step of the tree merges.
SHARD_ROWS = 16_384
FAN_IN = 16


def vectors_of(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, v)``: each id once, with its vector as doubles. Rows take no part whose id
    or vector is null or empty, or whose vector holds a null or a number that is not finite.
    Of several rows with one id the least vector stands."""
    v = F.col(vector).cast("array<double>")
    return table.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
    ).where(F.size("v") > 0).where(_finite("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _finite(name: str) -> Column:
    return F.forall(
        F.col(name), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a cell's side."""
    if not table.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, 0))
    flat = pa.concat_arrays([chunk.flatten() for chunk in table.column("v").chunks])
    return table.column("vec_id").to_numpy(), flat.to_numpy().reshape(table.num_rows, -1)


def search(queries: DataFrame, candidates: DataFrame, found: Callable, kind: str, k: int,
           best_first: Callable[[], list[Column]]) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best per query over all cells.

    ``found(query ids, query vectors, ids, vectors)`` gives arrays of query id, id and score:
    at least the ``k`` best of its cell. Vectors are compared with those of their own length.
    """
    parallel = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, q = candidates.count(), queries.count()
    rows = max(1, math.ceil(n / SHARD_ROWS), min(parallel, math.ceil(n / 1024)))
    columns = max(1, math.ceil(q / SHARD_ROWS))
    key = ["dim", "row", "col"]

    def dealt(side: DataFrame, own: str, count: int, other: str, copies: int) -> DataFrame:
        return side.select(
            "vec_id", "v", F.size("v").alias("dim"),
            F.pmod(F.xxhash64("vec_id"), F.lit(count)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias(other),
        )

    tiles = dealt(queries, "col", columns, "row", rows).groupBy(*key)
    shards = dealt(candidates, "row", rows, "col", columns).groupBy(*key)

    def cell(keys, tile: pa.Table, shard: pa.Table) -> pa.Table:
        asked, wanted = matrix(tile)
        ids, vectors = matrix(shard)
        if not len(asked) or not len(ids):
            query = near = np.zeros(0, np.int64)
            score = np.zeros(0)
        else:
            query, near, score = found(asked, wanted, ids, vectors)
        return pa.table({
            "query_id": pa.array(query, pa.int64()), "vec_id": pa.array(near, pa.int64()),
            "score": pa.array(score, pa.int64() if kind == "long" else pa.float64()),
            "place": pa.array(np.full(len(query), keys[1].as_py()), pa.int64()),
        })

    best = tiles.cogroup(shards).applyInArrow(
        cell, f"query_id long, vec_id long, score {kind}, place long")
    while True:
        last = rows <= FAN_IN
        group = ["query_id"] if last else ["query_id", "place"]
        best = best.withColumn("place", F.expr(f"place div {FAN_IN}"))
        order = Window.partitionBy(*group).orderBy(*best_first())
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if last:
            return best.select("query_id", "rank", "vec_id", "score")
        best = best.drop("rank")
        rows = math.ceil(rows / FAN_IN)
