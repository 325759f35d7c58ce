"""Spelling variants against a plain loop over all pairs."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from broadsheet.llm import variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[i + 1:] == (b[i + 1:] if len(a) == len(b) else b[i:])


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def plain(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def found(docs, **options):
    rows = variants.variants(docs, **options).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(map(tuple, rows.collect()), key=repr)


@pytest.fixture(scope="module")
def spelled(spark):
    """Words, their misspellings, chains of forms, ties, repeated letters, long words."""
    rng = np.random.default_rng(5)
    texts = []
    for stem in ("although", "aaaaaaaa", "étrangerÿ", "b" * 40, "abcdefgh" * 30):
        for times, edits in ((120, 0), (11, 1), (10, 1), (2, 1), (2, 2), (1, 1)):
            for _ in range(3 if edits else 1):
                word = list(stem)
                for _ in range(edits):
                    at, kind = rng.integers(len(word)), rng.integers(3)
                    letter = "abné"[rng.integers(4)]
                    word[at:at + (kind > 0)] = [letter] if kind < 2 else []
                texts.append((" ".join(["".join(word)] * times)).title() + "1")
    for word, times in (("tomorrow", 2000), ("tomorrov", 60), ("tomorrqv", 2), ("tomorrqvv", 2)):
        texts += [f"{word} " * times] * 3
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, "Nothing nothing"), (3, None), (4, "×÷" * 5), (4, "×÷" * 5)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("symbols, cell_words", [(6, 64), (1, 10**6), (6, 0), (2, 3)])
def test_variants(spelled, symbols, cell_words):
    """Also where all words share a cell, where every cell is hot, and where some are."""
    words = plain_words([(r["doc_id"], r["text"]) for r in spelled.collect()])
    expected = plain(words)
    assert any(x[1] and x[1] != x[2] for x in expected)  # a chain
    assert found(spelled, symbols=symbols, cell_words=cell_words) == expected


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs) == plain(plain_words(rows))


def test_no_documents(no_docs):
    assert found(no_docs) == []


def test_neighbourhoods():
    """Every two words one edit apart meet in a key, from one of their ends."""
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abcd"), rng.integers(7, 10))) for _ in range(300)} | {"a" * 7, "a" * 8})
    batch = pa.record_batch({"word": words, "n": [1] * len(words)})
    cells = pa.Table.from_batches(variants._cell_rows(3)([batch]))
    batch = cells.combine_chunks().to_batches()[0]
    own = dict(zip(words, batch.column("cell").to_pylist()))
    keys = {(c, k) for b in variants._neighbour_rows(3)([batch])
            for c, k in zip(b.column("cell").to_pylist(), b.column("key").to_pylist())}
    for a in words:
        for b in words:
            if one_edit(a, b):
                x, y = own[a], own[b]
                assert x == y or (x, y) in keys or (y, x) in keys
