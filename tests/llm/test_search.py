"""Top-k and nearest-neighbour search against all pairs."""

import numpy as np
import pytest

from broadsheet.llm import grid
from broadsheet.llm.forest import nearest
from broadsheet.llm.topk import exact_top_k


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def plain_top(vectors, ids, queries, k):
    x = np.floor(64 * vectors).astype(np.int64)
    out = []
    for q in queries:
        scores = x @ x[ids.index(q)]
        best = sorted((-int(s), i) for s, i in zip(scores, ids) if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard, fan_in", [(16384, 16), (20, 3)])
def test_top_k(vectors, monkeypatch, shard, fan_in):
    monkeypatch.setattr(grid, "SHARD_ROWS", shard)
    monkeypatch.setattr(grid, "FAN_IN", fan_in)
    rows = vectors.collect()
    ids = [r["vec_id"] for r in rows]
    x = np.array([r["embedding"] for r in rows], float)
    got = rows_of(exact_top_k(vectors.where("vec_id % 20 = 0"), vectors))
    assert got == plain_top(x, ids, [i for i in ids if i % 20 == 0], 20)


def test_recall(vectors):
    rows = vectors.collect()
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in rows}
    got = rows_of(nearest(vectors.where("vec_id % 10 = 0"), vectors))
    hits = total = 0
    for q in (i for i in x if i % 10 == 0):
        true = sorted((float(np.sqrt(((x[i] - x[q]) ** 2).sum())), i) for i in x if i != q)[:10]
        mine = [(s, i) for a, _, i, s in got if a == q]
        assert mine == sorted(mine) and len(mine) == 10
        assert all(abs(s - np.linalg.norm(x[i] - x[q])) < 1e-12 for s, i in mine)
        hits += len({i for _, i in true} & {i for _, i in mine})
        total += 10
    assert hits / total >= 0.9


SCHEMA = "vec_id long, embedding array<double>, score string, row string, v string"


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [0.0, 0.0]), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 5.0]),
            (10, [-1.0, 5.0]), (None, [1.0, 1.0]), (11, [1e300, 1e300]), (12, [-0.01, 0.0])]
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    top = rows_of(exact_top_k(table.where("vec_id in (1, 3, 9, 10)"), table, k=3))
    assert top == [(1, 1, 11, 2**63 - 1), (1, 2, 10, 64 * 64 * 9), (1, 3, 2, 64 * 64 * 5),
                   (10, 1, 11, 2**63 - 1), (10, 2, 1, 64 * 64 * 9), (10, 3, 2, 64 * 64 * 9)]
    near = rows_of(nearest(table.where("vec_id in (1, 8, 9, 10)"), table, k=2))
    assert [r[:3] for r in near] == [(1, 1, 2), (1, 2, 12), (10, 1, 1), (10, 2, 2)]
    assert near[0][3] == 0.0
    none = table.where("false")
    assert exact_top_k(none, table).count() == exact_top_k(table, none).count() == 0
    assert nearest(none, table).count() == nearest(table, none).count() == 0
