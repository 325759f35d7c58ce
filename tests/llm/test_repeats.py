"""Substring and suffix-array dedup against plain loops over all windows."""

import hashlib
import re

import numpy as np
import pytest

from broadsheet.llm import debruijn, repeats, suffixes
from broadsheet.llm.debruijn import compacted, node_degrees, remove_repeated_words, repeated_windows
from broadsheet.llm.suffixes import ColumnwiseIndex, removed_strings, without_repeated_strings


def plain_removed(units, width):
    """Per document, which of its units a window covers that also starts earlier."""
    seen, marks = {}, {}
    for doc_id in sorted(units):
        items = units[doc_id]
        mark = np.zeros(len(items), bool)
        for i in range(len(items) - width + 1):
            window = items[i:i + width] if isinstance(items, bytes) else tuple(items[i:i + width])
            if seen.setdefault(window, (doc_id, i)) != (doc_id, i):
                mark[i:i + width] = True
        marks[doc_id] = mark
    return marks


def texts_of(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect() if r["doc_id"] is not None}


def plain_words(texts):
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t) for d, t in texts.items()}
    out = {}
    for d, mark in plain_removed(words, 20).items():
        kept = " ".join(w for w, gone in zip(words[d], mark) if not gone)
        out[d] = (len(words[d]), int(mark.sum()), hashlib.sha256(kept.encode()).hexdigest())
    return out


def plain_bytes(texts):
    raw = {d: t.encode() for d, t in texts.items()}
    out = {}
    for d, mark in plain_removed(raw, 100).items():
        kept = bytes(b for b, gone in zip(raw[d], mark) if not gone)
        spans = int((np.diff(np.concatenate(([0], mark.astype(int)))) == 1).sum())
        out[d] = (len(raw[d]), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


WORDS = ("n_words", "n_removed", "kept_sha256")
BYTES = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_words_against_plain_loop(small_docs):
    assert by_id(remove_repeated_words(small_docs), *WORDS) == plain_words(texts_of(small_docs))


@pytest.mark.parametrize("room", [200_000, 1])
def test_bytes_against_plain_loop(small_docs, monkeypatch, room):
    """Also where every key is split until its strings are single windows."""
    monkeypatch.setattr(suffixes, "KEY_BYTES", room)
    assert by_id(removed_strings(small_docs), *BYTES) == plain_bytes(texts_of(small_docs))


def test_odd_rows(odd_docs):
    words = by_id(remove_repeated_words(odd_docs), *WORDS)
    strings = by_id(removed_strings(odd_docs), *BYTES)
    expected = texts_of(odd_docs)
    alone = "a row without an id " * 20
    assert words.pop(None) == (100, 0, hashlib.sha256(alone.strip().encode()).hexdigest())
    assert strings.pop(None)[:3] == (400, 0, 0)
    assert words == plain_words(expected)
    assert strings == plain_bytes(expected)
    assert removed_strings(odd_docs).count() == odd_docs.count()


def test_no_rows(no_docs):
    assert remove_repeated_words(no_docs).count() == 0
    assert removed_strings(no_docs).count() == 0


@pytest.mark.parametrize("room", [200_000, 700])
def test_many_overlaps(spark, monkeypatch, room):
    """Passages cut out of one text at many places: most minimizers branch."""
    rng = np.random.default_rng(3)
    base = " ".join("".join(rng.choice(list("abcd"), 3)) for _ in range(400))
    rows = []
    for i in range(60):
        a, b = sorted(rng.integers(0, len(base), 2))
        rows.append((i, f"{i} " * int(rng.integers(0, 9)) + base[a:b] + " end" * int(rng.integers(0, 30))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(suffixes, "KEY_BYTES", room)
    assert by_id(removed_strings(docs), *BYTES) == plain_bytes(texts_of(docs))
    assert by_id(remove_repeated_words(docs), *WORDS) == plain_words(texts_of(docs))


def test_a_hot_passage(spark, monkeypatch):
    """One line in many texts, between other text: its minimizers are hot, and are split."""
    rng = np.random.default_rng(7)
    line = "the same line of one hundred and thirty bytes, " * 2 + "abababababababababababababababababab"
    other = lambda: "".join(rng.choice(list("abcdefgh "), int(rng.integers(0, 130))))
    docs = spark.createDataFrame(
        [(i, other() + line + other()) for i in range(150)], "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffixes, "KEY_BYTES", 3000)
    assert by_id(removed_strings(docs), *BYTES) == plain_bytes(texts_of(docs))


def thue_morse(n):
    """A word of a and b, and the same with a and b swapped: alike to every polynomial modulo a
    power of two, from 1,024 letters on."""
    word = ["a"]
    while len(word) < n:
        word += ["b" if x == "a" else "a" for x in word]
    return word[:n], ["b" if x == "a" else "a" for x in word[:n]]


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_polynomials_confuse(spark, n):
    one, two = ("".join(w) for w in thue_morse(n))
    common = [f"w{i}" for i in range(19)]
    docs = spark.createDataFrame(
        [(0, " ".join([*common, one])), (1, " ".join([*common, two])), (2, " ".join([*common, two]))],
        "doc_id long, text string")
    found = by_id(remove_repeated_words(docs), "n_removed")
    assert found == {0: (0,), 1: (0,), 2: (20,)}
    a, b = (" ".join(w) for w in thue_morse(n))
    docs = spark.createDataFrame([(0, a), (1, b)], "doc_id long, text string")
    assert by_id(remove_repeated_words(docs), *WORDS) == plain_words(texts_of(docs))
    assert by_id(removed_strings(docs), *BYTES) == plain_bytes(texts_of(docs))


def test_columns_of_any_name(spark, odd_docs):
    named = odd_docs.selectExpr("*", "1 doc", "2 starts", "3 ends", "4 _doc", "5 _starts", "6 _ends", "7 kept")
    clean = without_repeated_strings(named)
    assert clean.columns == named.columns
    rows = {r["doc_id"]: r for r in clean.collect()}
    plain = {r["doc_id"]: r["text"] for r in without_repeated_strings(odd_docs).collect()}
    assert {d: r["text"] for d, r in rows.items()} == plain
    assert rows[8]["starts"] == 2 and rows[8]["_ends"] == 6


def test_a_text_of_five_megabytes(spark):
    """Longer than a slice: a passage of it repeats within it, and in another text."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(3000)]
    long = " ".join(rng.choice(words, 650_000))
    passage = long[1_000_000:1_000_400]
    docs = spark.createDataFrame([(1, long + "#" + passage), (2, "%" + passage)], "doc_id long, text string")
    found = by_id(removed_strings(docs), "n_bytes", "n_removed", "n_spans")
    assert found == {1: (len(long) + 401, 400, 1), 2: (401, 400, 1)}
    removed = by_id(remove_repeated_words(docs), "n_words", "n_removed")
    assert removed[2][1] == removed[1][1] >= 45


def test_texts_without_repeats_keep_their_columns(odd_docs):
    clean = without_repeated_strings(odd_docs)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count()
    rows = {r["doc_id"]: r for r in clean.collect()}
    assert rows[2]["text"] is None and rows[8]["text"] == "" and rows[8]["n_chars"] == 0
    assert rows[1]["text"] == "alpha beta gamma delta epsilon"


def test_index_of_columns():
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = rng.integers(1, 20, rng.integers(1, 12))
        strings = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in lengths]
        data = np.frombuffer(b"".join(strings), np.uint8)
        index = ColumnwiseIndex(data, np.concatenate(([0], np.cumsum(lengths))))
        found = [strings[s][len(strings[s]) - n:] for s, n in zip(*index.suffixes())]
        expected = sorted(((s[i:], j) for j, s in enumerate(strings) for i in range(len(s) + 1)))
        assert found == [s for s, _ in expected]
        for before, after, lcp in zip(found, found[1:], index.lcp[1:]):
            same = [x == y for x, y in zip(before, after)]
            assert lcp == (same + [False]).index(False)


def test_minimizers_find_every_window():
    assert repeats.WORDS.k < repeats.WORDS.width and repeats.BYTES.k < repeats.BYTES.width


def test_degrees_and_paths(spark):
    """1 -> 2 -> 3 -> 4 with a branch at 3, a path that goes on elsewhere, and a loop."""
    pieces = spark.createDataFrame([
        (1, 2, 0, 0, 5), (2, 3, 0, 5, 1), (3, 4, 0, 6, 2), (3, 5, 1, 9, 1), (5, 6, 1, 10, 1),
        (6, 7, 2, 11, 1), (8, 8, 3, 0, 1),
    ], "a long, b long, doc_id long, start int, n int")
    degrees = {r["node"]: (r["ins"], r["outs"]) for r in node_degrees(pieces).collect()}
    assert degrees == {1: (0, 1), 2: (1, 1), 3: (1, 2), 4: (1, 0), 5: (1, 1), 6: (1, 1), 7: (1, 0), 8: (1, 1)}
    paths = {(r["a"], r["b"]): (r["doc_id"], r["path"]) for r in compacted(pieces).collect()}
    assert paths == {(1, 2): (0, 0), (2, 3): (0, 0), (3, 4): (0, 6), (3, 5): (1, 9), (5, 6): (1, 9),
                     (6, 7): (2, 11), (8, 8): (3, 0)}


def test_spans_are_paths_with_their_source(spark):
    """A passage of 60 words in three texts, of which one goes on with a part of another text."""
    passage = " ".join(f"p{i}" for i in range(60))
    other = " ".join(f"o{i}" for i in range(40))
    docs = spark.createDataFrame([
        (1, f"x y {passage} z"), (2, f"{other} v {passage}"), (3, f"q {passage} {other}"),
    ], "doc_id long, text string")
    found = sorted(tuple(r) for r in repeated_windows(docs).select("doc_id", "start", "n", "of", "at").collect())
    assert found == [(2, 41, 41, 1, 2), (3, 1, 41, 1, 2), (3, 61, 21, 2, 0)]


@pytest.mark.parametrize("seeds", [(1, 2), (1,)])
def test_words_that_share_a_hash(spark, monkeypatch, seeds):
    """Where different words share a hash, other hash functions are taken, or spans stay."""
    whole = repeats.span_hashes

    def confused(view, starts, ends, seed=0):
        return whole(view, starts, starts + 1 if seed == 1 else ends, seed)

    monkeypatch.setattr(repeats, "span_hashes", confused)
    monkeypatch.setattr(debruijn, "SEEDS", seeds)
    words = [f"{c}{i}" for i, c in enumerate("abcdefghijklmnopqrstuvwxy")]
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join(w + "x" for w in words)), (3, " ".join(w + "x" for w in words))],
        "doc_id long, text string").coalesce(1)
    expected = {1: (0,), 2: (0,), 3: (25,)} if len(seeds) > 1 else {1: (0,), 2: (0,), 3: (0,)}
    assert by_id(remove_repeated_words(docs), "n_removed") == expected


def test_texts_that_share_an_id(spark):
    """The ids name places, so nothing is certain about such texts, but others are as ever."""
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame(
        [(1, "a b c"), (1, f"x {passage}"), (2, passage), (3, passage), (4, f"{passage} {passage}"), (4, "")],
        "doc_id long, text string")
    rows = remove_repeated_words(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 1, 2, 3, 4, 4]
    assert {r["n_words"] for r in rows if r["doc_id"] == 4} == {60, 0}
