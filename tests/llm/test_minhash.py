"""Near duplicates against all pairs, and the parts of the sketch."""

import re

import numpy as np
import pytest

from broadsheet.llm import minhash
from broadsheet.llm.components import components
from broadsheet.llm.minhash import near_duplicates, one_of_each_group, sketches


def plain(texts, words):
    sets = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i:i + words]) for i in range(max(len(w) - words + 1, min(len(w), 1)))}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                a_root, b_root = sorted((root(a), root(b)))
                up[b_root] = a_root
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def texts_of(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}


@pytest.mark.parametrize("words", [2, 5])
def test_against_all_pairs(small_docs, words):
    assert found(near_duplicates(small_docs, words)) == plain(texts_of(small_docs), words)


@pytest.mark.parametrize("block, shingles", [(1024, 1_000_000), (5, 1_000_000), (1024, 300)])
def test_chains_and_groups(spark, monkeypatch, block, shingles):
    """Versions that drift apart: links make chains, and buckets hold several components."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    rng = np.random.default_rng(1)
    rows = []
    for group in range(6):
        text = [f"g{group}w{i}" for i in range(60)]
        for step in range(25):
            rows.append((len(rows), " ".join(text)))
            for i in rng.integers(0, 60, int(rng.integers(0, 5))):
                text[i] = f"n{rng.integers(10**6)}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(docs, 2)) == plain(texts_of(docs), 2)


@pytest.mark.parametrize("percent", [80, 50, 100])
@pytest.mark.parametrize("block, shingles", [(1024, 1_000_000), (3, 1_000_000), (1024, 400)])
def test_cells_lose_no_link_between_sizes(spark, monkeypatch, percent, block, shingles):
    """One bucket of nested sets of 20 to 180 shingles, each in a component of its own: every
    link between different sizes is found, those at exactly ``percent`` too."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    sets = {d: range(20 + 4 * d) for d in range(40)} | {100: range(20), 101: range(1000, 1100)}
    rows = [(d, np.sort(np.array(s, np.uint64)).tobytes()) for d, s in sets.items()]
    links = minhash._Links(spark.createDataFrame(rows, "doc_id long, shingles binary"), percent)
    links.links = spark.createDataFrame([], "a long, b long")
    links.confirm_apart(spark.createDataFrame(
        [(7, d, len(s), d) for d, s in sets.items()], "key long, doc_id long, n long, component long"))
    got = {(r["a"], r["b"]) for r in links.links.collect()}
    assert got == {(a, b) for a in sets for b in sets if a < b and
                   100 * len(set(sets[a]) & set(sets[b])) >= percent * len(set(sets[a]) | set(sets[b]))}


def test_odd_rows(odd_docs):
    result = near_duplicates(odd_docs, 2)
    assert result.count() == odd_docs.count()
    got = found(result)
    assert got.pop(None)[1:] == (None, True)
    assert got == plain(texts_of(odd_docs), 2)
    kept = one_of_each_group(odd_docs, 2)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 9]


def test_no_rows(no_docs):
    assert near_duplicates(no_docs).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 1100).astype(np.uint64)
    sets = [pool[:1000], pool[100:1100], pool[:1], pool[5:8], pool[:0]]
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    sketch = sketches(np.concatenate(sets), bounds, 392)
    assert (sketch[:4] != np.uint64(2**64 - 1)).all()
    assert abs((sketch[0] == sketch[1]).mean() - 900 / 1100) < 0.08
    again = sketches(np.concatenate(sets[2:]), np.array([0, 1, 4, 4]), 392)
    assert (again == sketch[2:]).all()


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
    links += [(500, int(x)) for x in rng.integers(501, 560, 200)] + [(300, 200), (250, 300)]
    got = {r["node"]: r["component"] for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 141))
    assert got[559] == got.get(501, 500) == 500 and got[300] == got[250] == 200 and 7 not in got
    assert minhash.STAR_ROUNDS >= 1


def test_words_that_polynomials_confuse(spark):
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [t for n in (1024, 2048) for t in (word[:n], word[:n].translate(str.maketrans("ab", "ba")))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r["kept"] for r in near_duplicates(docs, words=2, percent=80).collect())


def test_one_of_each_group_with_any_column(odd_docs):
    named = odd_docs.selectExpr("*", "1 kept", "2 _kept", "3 kept_")
    out = one_of_each_group(named)
    assert out.columns == named.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(
        str(r["doc_id"]) for r in one_of_each_group(odd_docs).collect())
