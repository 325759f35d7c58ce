"""Packing documents into token sequences by minimum bin slack.

A document is its token ids and an end mark; each full window of it is a sequence, and what
remains, shorter than a window, is to be packed. All remainders of one length are alike, so
the plan needs no more than the number of remainders of each length. It takes the longest
length left and finds, by subset sums on a bitset with bounded counts, the multiset of other
lengths that fills the window closest to capacity; that pattern is used as often as the
counts allow, and then the next one is sought. Each pattern uses up a length, so there are
few of them however large the corpus; each remainder finds its sequence from its number
among those of its length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.scratch import written
from broadsheet.llm.textarrays import ragged, text_slices
from broadsheet.llm.words import IdCache
from broadsheet.operators.indexing import number_rows

CAPACITY = 1024
END = 0

# Chunks of text whose ids a task remembers, and bytes that are tokenised in one call.
CACHE = 500_000
CALL_BYTES = 100_000


class _Chunks:
    """The ids of chunks of text by a tokenizer: many in one call where chunks end at cuts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        # Each character of a token stands for one byte.
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.size[i] = len(token)
        self.follows = np.zeros(256, bool)
        self.follows[0x21:0x7F] = True
        self.follows[0xC3] = True  # the letters from U+00C0 to U+00FF

    def cuts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        after = np.append(data, 0)
        return (data[at] == 0x20) & self.follows[after[at + 1]]

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks, one chunk after the other, and how many each has."""
        firm = self.cuts(data, starts)
        loose, firm = np.flatnonzero(~firm), np.flatnonzero(firm)
        counts = np.zeros(len(starts), np.int64)
        parts: list[np.ndarray] = []
        if len(loose):
            found = self.tokenizer.encode_batch_fast(
                [data[a:b].tobytes().decode() for a, b in zip(starts[loose], ends[loose])],
                add_special_tokens=False)
            counts[loose] = [len(e) for e in found]
            parts.append(np.array([i for e in found for i in e.ids], np.int32))
        sizes = (ends - starts)[firm]
        calls = np.searchsorted(np.cumsum(sizes), np.arange(
            CALL_BYTES, sizes.sum() + CALL_BYTES, CALL_BYTES), "left") + 1
        first = 0
        for last in np.unique(np.minimum(calls, len(firm))):
            part = firm[first:last]
            text = data[ragged(starts[part], (ends - starts)[part])].tobytes().decode()
            (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(found.ids, np.int32)
            edges = np.cumsum(self.size[ids])
            bounds = np.searchsorted(edges, np.cumsum((ends - starts)[part]), "left") + 1
            counts[part] = np.diff(bounds, prepend=0)
            parts.append(ids)
            first = last
        # Back into the order of the chunks.
        order = np.concatenate([loose, firm])
        begin = np.empty(len(starts), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        every = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return every[ragged(begin, counts)], counts


class ChunkTokenizer:
    """Token ids of many texts, each different chunk of text tokenised once.

    The tokenizer splits a text, before merging bytes within the pieces, in front of every
    space that is followed by a character other than white space. Texts are cut at those
    spaces where that can be told from the next byte, so ids do not depend on what stands
    around a chunk, and equal chunks have equal ids. Chunks are looked up by hash, and their
    bytes compared.

    With ``added_tokens`` ids are those of the tokenizer as loaded, which finds its added
    tokens in a text first: a text that holds one is tokenised as a whole. Without, special
    tokens in a text are text like any other.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        self.chunks = _Chunks(path)
        self.tokenizer = self.chunks.tokenizer
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()
                      ] if added_tokens else []
        self.cache = IdCache(self.chunks.encode, CACHE)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a slice, and the offset of each text in them."""
        marked = self._marked(data, offsets)
        if not marked.any():
            return self._chunk_ids(data, offsets)
        size = np.diff(offsets)
        rest = ~marked
        ids, bounds = self._chunk_ids(data[ragged(offsets[:-1][rest], size[rest])],
                                      np.concatenate(([0], np.cumsum(size[rest]))))
        length = np.zeros(len(size), np.int64)
        length[rest] = np.diff(bounds)
        self.tokenizer.encode_special_tokens = False  # as loaded
        whole = {i: self.tokenizer.encode(
            data[offsets[i]:offsets[i + 1]].tobytes().decode(), add_special_tokens=False).ids
            for i in np.flatnonzero(marked).tolist()}
        self.tokenizer.encode_special_tokens = True
        for i, own in whole.items():
            length[i] = len(own)
        edges = np.concatenate(([0], np.cumsum(length)))
        out = np.zeros(edges[-1], np.int32)
        out[ragged(edges[:-1][rest], length[rest])] = ids
        for i, own in whole.items():
            out[edges[i]:edges[i + 1]] = own
        return out, edges

    def _marked(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each text holds an added token."""
        marked = np.zeros(len(offsets) - 1, bool)
        raw = data.tobytes() if self.added else b""
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                inside = at + len(token) <= offsets[row + 1]
                marked[row] |= inside
                at = raw.find(token, int(offsets[row + 1]) if inside else at + 1)
        return marked

    def _chunk_ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of texts without added tokens, by chunks."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        cut[:-1] = (data == 0x20) & self.chunks.follows[np.append(data[1:], 0)]
        cut[offsets] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        ids, counts = self.cache.spans(data, starts, ends)
        return ids, np.concatenate(([0], np.cumsum(counts)))[np.searchsorted(starts, offsets)]


def _piece_rows(path: str, capacity: int, with_ids: bool, added_tokens: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ChunkTokenizer(path, added_tokens)
        for batch in batches:
            others = [c for c in batch.schema.names if c != "text"]
            for first, _, data, offsets in text_slices(batch.column("text")):
                ids, bounds = tokenizer.ids(data, offsets)
                size = np.diff(bounds) + 1
                ids = np.insert(ids, bounds[1:], END).astype("<i4")
                begins = np.cumsum(size) - size
                n = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), n)
                start = ragged(np.zeros(len(n), np.int64), n) * capacity
                length = np.minimum(size[row] - start, capacity)
                raw = memoryview(ids.tobytes())
                at = (begins[row] + start) * 4
                sums = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length * 4).tolist())]
                rest = [batch.column(c).take(pa.array(first + row)) for c in others]
                columns = [*rest, pa.array(start), pa.array(length), pa.array(sums, pa.int64()),
                           pa.array(size[row])]
                names = [*others, "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    edges = np.append(begins[row] + start, len(ids)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(ids)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def fill(counts: dict[int, int], seed: int, capacity: int) -> dict[int, int]:
    """The multiset of lengths, one ``seed`` among them, that leaves the least padding.

    A sequence of a power of two is not padded; of equal paddings the fullest is taken.
    """
    lengths = sorted((n for n in counts if counts[n] > (n == seed) and n <= capacity - seed),
                     reverse=True)
    whole = (1 << (capacity + 1)) - 1
    sums, layers = 1 << seed, []
    for n in lengths:
        layers.append(sums)
        left, copies = min(counts[n] - (n == seed), (capacity - seed) // n), 1
        while left:
            step = min(copies, left)
            sums |= sums << (n * step) & whole
            left -= step
            copies *= 2
        if sums >> capacity & 1:
            break
    reached = [s for s in range(seed, capacity + 1) if sums >> s & 1]
    total = min(reached, key=lambda s: (0 if s & (s - 1) == 0 else capacity - s, -s))
    chosen = {seed: 1}
    for n, before in zip(reversed(lengths[:len(layers)]), reversed(layers)):
        while not before >> total & 1:
            chosen[n] = chosen.get(n, 0) + 1
            total -= n
    return chosen


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY):
    """Rows ``(length, first, end, each, base, offset)``: the pieces of a length numbered from
    ``first`` to ``end`` go, ``each`` to a sequence, into the sequences from ``base`` on, the
    first of them at ``offset``."""
    left, used = dict(counts), dict.fromkeys(counts, 0)
    rows, base = [], 0
    while left:
        seed = max(left)
        pattern = fill(left, seed, capacity)
        times = min(left[n] // m for n, m in pattern.items())
        offset = 0
        for n, m in sorted(pattern.items(), reverse=True):
            rows.append((n, used[n], used[n] + m * times, m, base, offset))
            offset += n * m
            used[n] += m * times
            left[n] -= m * times
            if not left[n]:
                del left[n]
        base += times
    return rows


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False,
         order: Sequence[Column] = (), added_tokens: bool = False) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, a row per piece,
    and with ``with_ids`` its ``ids``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored, but for those in
    ``order``: pieces of one length are dealt to sequences in that order, then by id.
    ``tokenizer`` is the path of a byte-level tokenizer file that executors can read. With
    ``added_tokens`` its added tokens, such as an end mark, have their own ids where they stand
    in a text, as the tokenizer does it as loaded; without, special ones are plain text. A null
    text is empty and has the end mark alone. Ids may be null or repeat: every row is a
    document. An empty table gives no pieces. No text is cut short: a document has as many
    pieces as it fills windows.
    """
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    texts = docs.select(*columns, F.struct(F.lit(0), *order).alias("_order"))
    kept = texts.drop("text").schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema += ", start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    pieces = written(texts.mapInArrow(_piece_rows(tokenizer, capacity, with_ids, added_tokens), schema), "pieces")
    numbered = number_rows(
        pieces, [F.col("_order"), F.col("doc_id"), F.col("start"), F.col("ids_crc32")],
        "number", within="length")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count("*").alias("n")).collect()}
    plan = docs.sparkSession.createDataFrame(
        packing_plan(counts, capacity),
        "size long, first long, end long, each long, base long, place long")
    placed = numbered.join(
        F.broadcast(plan), (F.col("length") == F.col("size")) & (F.col("number") >= F.col("first"))
        & (F.col("number") < F.col("end")))
    since = F.col("number") - F.col("first")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("base") + F.expr("(number - first) div each")).alias("sequence_id"),
        (F.col("place") + F.pmod(since, F.col("each")) * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []))
