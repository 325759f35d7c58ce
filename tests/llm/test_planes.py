"""Token ids in bit planes: files against the ids, and ids against the tokenizer."""

import io
import json
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from broadsheet.llm import planes
from broadsheet.llm.words import IdCache, distinct, pieces, same_spans, span_hashes

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("ids", [[], [0], [0, 0, 0], [2**32 - 1, 0, 7], list(range(1000))])
def test_planes_round_trip(ids, bits):
    ids = np.array(ids, np.uint32)
    found = planes.to_planes(ids, bits)
    assert len(found) == -(-int(ids.max(initial=0)).bit_length() // bits)
    assert planes.from_planes(found, len(ids), bits).tolist() == ids.tolist()


@pytest.mark.parametrize("bits", [1, 8])
def test_file_by_ranges(bits, monkeypatch):
    """Chunks of ten ids: documents within, across and over many chunks, empty ones, no id."""
    rng = np.random.default_rng(3)
    sizes = [0, 3, 7, 10, 0, 95, 1, 0]
    texts = [rng.integers(0, 50_000, n).astype(np.int32).tolist() for n in sizes]
    stream = io.BytesIO()
    out = planes.FileWriter(stream, 10, bits, 3)
    for part in (slice(0, 3), slice(3, 8)):
        out.add(pa.array([None, 5, 6, 7, 8, 9, 9, 9][part], pa.int64()), pa.array(texts[part], pa.list_(pa.int32())))
    assert out.close() == (8, sum(sizes))
    reader = planes.FileReader(stream, len(stream.getvalue()))
    every = [i for text in texts for i in text]
    assert reader.nulls.tolist() == [True] + [False] * 7
    assert reader.doc_ids[1:].tolist() == [5, 6, 7, 8, 9, 9, 9]
    for first in range(0, len(every), 7):
        for end in range(first, len(every) + 1, 11):
            assert reader.ids(first, end).tolist() == every[first:end]
    monkeypatch.setattr(planes, "BATCH_IDS", 12)
    found = [(a, b, begin, ids.tolist()) for a, b, begin, ids in reader.batches()]
    assert [i for *_, ids in found for i in ids] == every
    assert [a for a, *_ in found] == [0, *[b for _, b, *_ in found[:-1]]]


ODD_TEXTS = [
    "", " ", "Plain words, and 123 numbers 4x5.", "don't we'LL it's 's ''t o'clock", "ÀÉß÷×ÿ Ünder¿",
    "x<|endoftext|>y <|startoftext|> <|ENDOFTEXT|> <|", "é ́x İ ẞ Σς ﬁ 我们 ①", "a\x00b\x1cc\x85d\xa0e f",
    "K İstanbul", "z" * 3000 + " " + "!" * 500, "tab\tnew\nline\x0b\x0c\r end", "#hash_tag under_score a-b",
]


def test_ids_are_the_tokenizers(tokenizer):
    from broadsheet.llm.textarrays import text_slices

    words = planes.WordIds(PATH)
    for texts in (ODD_TEXTS, ODD_TEXTS[::-1]):
        for _, _, data, offsets in text_slices(pa.array(texts)):
            ids, bounds = words.ids(data, offsets)
            for text, a, b in zip(texts, bounds, bounds[1:]):
                assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def expected(docs, tokenizer):
    """Sets of results per id, and the sizes, by the plain loop."""
    out = {}
    for row in docs.collect():
        ids = [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        out.setdefault(row["doc_id"], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return {doc: sorted(found) for doc, found in out.items()}


@pytest.mark.parametrize("name", ["small_docs", "odd_docs"])
def test_documents(name, tokenizer, request):
    docs = request.getfixturevalue(name)
    rows = sorted(planes.encode_documents(docs, PATH).collect(), key=lambda r: r["start"])
    at, found = 0, {}
    for row in rows:
        assert row["start"] == at
        at += row["n_tokens"]
        found.setdefault(row["doc_id"], []).append((row["n_tokens"], row["ids_crc32"]))
    assert {doc: sorted(x) for doc, x in found.items()} == expected(docs, tokenizer)
    order = [-1 if row["doc_id"] is None else row["doc_id"] for row in rows]
    assert order == sorted(order)


def test_no_documents(no_docs):
    assert planes.encode_documents(no_docs, PATH).collect() == []


@pytest.mark.parametrize("kind", ["bits", "bytes"])
def test_written_files(spark, small_docs, tmp_path, tokenizer, kind):
    """Small chunks; only listed files are read; the ids come back as they are."""
    path = f"file://{tmp_path}/ids"
    planes.write_ids(small_docs, PATH, path, end=None, chunk=1000, planes=kind)
    listed = json.loads(Path(tmp_path, "ids", planes.LIST).read_text())
    assert listed["ids"] == sum(f["ids"] for f in listed["files"])
    Path(tmp_path, "ids", "part-000000-left-by-a-lost-task.planes").write_bytes(b"half a file")
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    rows = planes.read_ids(spark, path).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row["ids"] == tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids


def test_failed_write_lists_nothing(spark, tmp_path):
    path = f"{tmp_path}/ids"
    broken = spark.range(10).selectExpr(
        "id doc_id", "if(id = 9, array(int(raise_error('broken'))), array(1)) ids")
    spark.dataSource.register(planes.BitPlanes)
    with pytest.raises(Exception, match="broken"):
        broken.repartition(3).write.format("bitplanes").mode("append").save(path)
    assert not Path(path, planes.LIST).exists()


# Spans

def spans_of(words):
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return data, ends - [len(w) for w in words], ends


def test_spans_are_told_apart():
    """Also the words that are alike to a polynomial modulo a power of two, whatever its base."""
    swap = bytes.maketrans(b"ab", b"ba")
    word = b"a"
    while len(word) < 4096:
        word += word.translate(swap)
    words = [b"", b"a", b"a\0", b"a" * 8, b"a" * 9, b"a" * 300, b"a" * 301, *(
        w for n in (1024, 2048, 4096) for w in (word[:n], word[:n].translate(swap)))]
    data, starts, ends = spans_of(words * 2)
    view = pieces(data)
    assert len(set(span_hashes(view, starts, ends).tolist())) == len(words)
    example, number = distinct(view, starts, ends)
    assert len(example) == len(words) and number[:len(words)].tolist() == number[len(words):].tolist()
    # Also where every hash is the same.
    example, number = distinct(view, starts, ends, np.zeros(len(starts), np.uint64))
    assert len(example) == len(words) and number[:len(words)].tolist() == number[len(words):].tolist()
    assert same_spans(view, starts[:-1], view, starts[:-1], (ends - starts)[:-1]).all()


def test_cache_with_equal_hashes_and_little_room(monkeypatch):
    calls = []

    def encode(data, starts, ends):
        calls.append(len(starts))
        return data[np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)])].astype(np.int32), ends - starts

    cache = IdCache(encode, entries=50)
    rng = np.random.default_rng(1)
    for round_ in range(30):
        words = [bytes(rng.integers(97, 105, rng.integers(1, 4)).tolist()) for _ in range(200)]
        data, starts, ends = spans_of(words)
        ids, counts = cache.spans(data, starts, ends)
        assert bytes(ids.tolist()) == b"".join(words) and counts.tolist() == [len(w) for w in words]
    assert sum(calls) < 30 * 200
    monkeypatch.setattr("broadsheet.llm.words.span_hashes", lambda view, a, b, seed=0: np.full(len(a), 7, np.uint64))
    cache = IdCache(encode, entries=50)
    for _ in range(3):
        ids, counts = cache.spans(data, starts, ends)
        assert bytes(ids.tolist()) == b"".join(words)
