"""Token ids in binary files of compressed bit planes.

A file is a sequence of chunks of a fixed number of ids; only the last may be shorter. The ids
of a chunk are transposed: plane ``b`` holds bit ``b`` of every id, packed into bytes (or, with
``planes="bytes"``, byte ``b``), and every plane up to the highest that is not all zero is
compressed by zstandard on its own. Behind the chunks stand the documents (ids and sizes), the
index of the chunks (where each begins, how many ids it has, the size of each plane), and a
tail of fixed size that says where the two are. Any range of ids can be read by reading the
chunks it touches. The format is described field by field at ``FILE``.

Spark reads and writes such folders as the data source ``bitplanes``: each task writes one
file under a name of its own attempt, and the driver, when all are done, writes the list of
files, ``_files.json``, with the number of ids before each. Files that are not listed, left by
a lost executor, are never read.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from broadsheet.cluster import new_folder
from broadsheet.llm.scratch import file_system
from broadsheet.llm.textarrays import list_column, ragged, text_slices, word_spans
from broadsheet.llm.words import IdCache

# FILE, all numbers little-endian:
#   8 bytes    MAGIC
#   chunks     planes of a chunk, lowest first, one zstandard frame each
#   documents  a zstandard frame: ids (int64 each), sizes (int64 each), a byte each that is 1
#              where the id is null
#   index      a zstandard frame: per chunk its place in the file (int64), its number of ids
#              (int32) and 32 sizes of planes (int32, 0 for planes that are not there)
#   tail       TAIL: place of documents, place of index, documents, chunks, ids (int64 each),
#              ids of a chunk, bits of a plane (int32 each), MAGIC
MAGIC = b"BITPLANE"
TAIL = "<5q2i8s"
TAIL_BYTES = struct.calcsize(TAIL)
CHUNK = np.dtype([("place", "<i8"), ("n", "<i4"), ("sizes", "<i4", (32,))])
LIST = "_files.json"

CHUNK_IDS = 65_536
LEVEL = 3
END = 2

# Ids and documents handed on in one batch by the reader, at most (one document at least).
BATCH_IDS = 1_000_000
BATCH_DOCUMENTS = 4_096

READ = "doc_id long, start long, ids array<int>"
SUMS = "doc_id long, start long, n_tokens long, ids_crc32 long"


# Chunks

def to_planes(ids: np.ndarray, bits: int = 1) -> list[bytes]:
    """The planes of some ids, of ``bits`` (1 or 8) bits each, up to the last that is needed."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    planes = -(-int(ids.max(initial=0)).bit_length() // bits)
    if bits == 8:
        return [octets[:, b].tobytes() for b in range(planes)]
    every = np.unpackbits(octets, axis=1, bitorder="little", count=planes)
    return [row.tobytes() for row in np.packbits(every.T, axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int, bits: int = 1) -> np.ndarray:
    """The ``n`` ids of ``to_planes``."""
    octets = np.zeros((n, 4), np.uint8)
    if bits == 8:
        for b, plane in enumerate(planes):
            octets[:, b] = np.frombuffer(plane, np.uint8)
    elif planes:
        rows = np.stack([np.frombuffer(plane, np.uint8) for plane in planes])
        every = np.unpackbits(rows, axis=1, bitorder="little", count=n)
        packed = np.packbits(every.T, axis=1, bitorder="little")
        octets[:, :packed.shape[1]] = packed
    return octets.view("<u4").ravel()


class FileWriter:
    """One file, written front to back to a binary stream."""

    def __init__(self, stream, chunk: int, bits: int, level: int):
        import zstandard

        self.stream, self.chunk, self.bits = stream, chunk, bits
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.place = self.n_ids = self.held_ids = 0
        self.held: list[np.ndarray] = []
        self.chunks: list[tuple] = []
        self.doc_ids: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self._put(MAGIC)

    def _put(self, raw: bytes) -> int:
        self.stream.write(raw)
        self.place += len(raw)
        return len(raw)

    def _put_chunk(self, ids: np.ndarray) -> None:
        place, sizes = self.place, np.zeros(32, np.int32)
        for b, plane in enumerate(to_planes(ids, self.bits)):
            sizes[b] = self._put(self.compress(plane))
        self.chunks.append((place, len(ids), sizes))

    def add(self, doc_ids: pa.Array, ids: pa.ListArray) -> None:
        """Documents with their ids, as columns."""
        offsets = ids.offsets.to_numpy().astype(np.int64)
        self.nulls.append(doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        self.doc_ids.append(doc_ids.fill_null(0).to_numpy().astype("<i8"))
        self.sizes.append(np.diff(offsets).astype("<i8"))
        values = ids.values.to_numpy()[offsets[0]:offsets[-1]]
        self.n_ids += len(values)
        self.held.append(values)
        self.held_ids += len(values)
        if self.held_ids >= self.chunk:
            every = np.concatenate(self.held)
            whole = len(every) // self.chunk * self.chunk
            for at in range(0, whole, self.chunk):
                self._put_chunk(every[at:at + self.chunk])
            self.held, self.held_ids = [every[whole:]], len(every) - whole

    def close(self) -> tuple[int, int]:
        """Write what is left, documents, index and tail; the numbers of documents and ids."""
        if self.held_ids:
            self._put_chunk(np.concatenate(self.held))
        parts = [np.concatenate(x) if x else np.zeros(0, kind) for x, kind in (
            (self.doc_ids, "<i8"), (self.sizes, "<i8"), (self.nulls, np.uint8))]
        documents = self.place
        self._put(self.compress(b"".join(x.tobytes() for x in parts)))
        index = self.place
        self._put(self.compress(np.array(self.chunks, CHUNK).tobytes()))
        n = len(parts[0])
        self._put(struct.pack(TAIL, documents, index, n, len(self.chunks), self.n_ids, self.chunk, self.bits, MAGIC))
        return n, self.n_ids


class FileReader:
    """One file, read by ranges of ids from a stream that can seek."""

    def __init__(self, stream, size: int):
        import zstandard

        self.stream = stream
        self.decompress = zstandard.ZstdDecompressor().decompress
        tail = self._raw(size - TAIL_BYTES, size)
        documents, index, n, n_chunks, self.n_ids, self.chunk, self.bits, magic = struct.unpack(TAIL, tail)
        if magic != MAGIC or self._raw(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of bit planes")
        raw = self.decompress(self._raw(documents, index))
        self.doc_ids, self.sizes = np.frombuffer(raw, "<i8", 2 * n).reshape(2, n)
        self.nulls = np.frombuffer(raw, np.uint8, n, 16 * n).astype(bool)
        self.index = np.frombuffer(self.decompress(self._raw(index, size - TAIL_BYTES)), CHUNK, n_chunks)

    def _raw(self, start: int, end: int) -> bytes:
        self.stream.seek(start)
        return self.stream.read(end - start)

    def chunk_ids(self, i: int) -> np.ndarray:
        place, n, sizes = self.index[i]
        ends = np.cumsum(sizes)
        raw = self._raw(int(place), int(place) + int(ends[-1]))
        planes = [self.decompress(raw[end - size:end]) for end, size in zip(ends, sizes) if size]
        return from_planes(planes, int(n), self.bits)

    def ids(self, first: int, end: int) -> np.ndarray:
        """The ids from ``first`` to ``end``, by their places in the file."""
        chunks = range(first // self.chunk, -(-end // self.chunk))
        parts = [self.chunk_ids(i) for i in chunks]
        every = np.concatenate(parts) if parts else np.zeros(0, "<u4")
        skipped = first // self.chunk * self.chunk
        return every[first - skipped:end - skipped]

    def batches(self) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """``(first document, end document, first id, ids)`` of a bounded number of ids each,
        each chunk unpacked once. A document of more ids than that is a batch of its own."""
        ends = np.cumsum(self.sizes)
        first, held, held_from, chunk = 0, np.zeros(0, "<u4"), 0, 0
        while first < len(ends):
            begin = int(ends[first] - self.sizes[first])
            last = int(np.searchsorted(ends, begin + BATCH_IDS, "right"))
            last = min(max(last, first + 1), first + BATCH_DOCUMENTS, len(ends))
            end = int(ends[last - 1])
            parts = [held[begin - held_from:]]
            have = held_from + len(held)
            while have < end:
                parts.append(self.chunk_ids(chunk))
                have += len(parts[-1])
                chunk += 1
            held, held_from = np.concatenate(parts), begin
            yield first, last, begin, held[:end - begin]
            first = last


# The data source

@dataclass
class _Written(WriterCommitMessage):
    part: int
    name: str
    documents: int
    ids: int


@dataclass
class _File(InputPartition):
    name: str
    base: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.chunk = int(options.get("chunk", CHUNK_IDS))
        self.bits = {"bits": 1, "bytes": 8}[options.get("planes", "bits")]
        self.level = int(options.get("level", LEVEL))
        self.tokenizer = options.get("tokenizer")
        self.end = int(options["end"]) if "end" in options else None

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.planes"
        files, folder = file_system(self.path)
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/{name}") as stream:
            out = FileWriter(stream, self.chunk, self.bits, self.level)
            for batch in id_rows(iterator, self.tokenizer, self.end) if self.tokenizer else iterator:
                out.add(batch.column("doc_id"), batch.column("ids"))
            documents, ids = out.close()
        return _Written(part, name, documents, ids)

    def commit(self, messages: list) -> None:
        files, folder = file_system(self.path)
        files.create_dir(folder, recursive=True)
        listed, base = [], 0
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.part):
            listed.append({"name": m.name, "documents": m.documents, "ids": m.ids, "base": base})
            base += m.ids
        # Put in place in one step, after all else.
        with files.open_output_stream(f"{folder}/{LIST}.new") as stream:
            stream.write(json.dumps({"files": listed, "ids": base}).encode())
        files.move(f"{folder}/{LIST}.new", f"{folder}/{LIST}")

    def abort(self, messages: list) -> None:
        files, folder = file_system(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(f"{folder}/{m.name}")


class _Reader(DataSourceReader):
    def __init__(self, options: dict, sums: bool):
        self.path, self.sums = options["path"], sums

    def partitions(self) -> list[_File]:
        files, folder = file_system(self.path)
        with files.open_input_stream(f"{folder}/{LIST}") as stream:
            listed = json.loads(stream.read())["files"]
        return [_File(f["name"], f["base"]) for f in listed if f["documents"]]

    def read(self, partition: _File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # of an empty list
            return
        files, folder = file_system(self.path)
        path = f"{folder}/{partition.name}"
        with files.open_input_file(path) as stream:
            file = FileReader(stream, stream.size())
            for first, end, begin, ids in file.batches():
                sizes = file.sizes[first:end]
                edges = np.concatenate(([0], np.cumsum(sizes)))
                doc_ids = pa.array(file.doc_ids[first:end], pa.int64(), mask=file.nulls[first:end])
                start = pa.array(partition.base + begin + edges[:-1])
                if self.sums:
                    raw = memoryview(ids.tobytes())
                    sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(edges.tolist(), edges[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids, start, pa.array(sizes), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids, start, list_column(ids.view(np.int32), edges, pa.int32())],
                        names=["doc_id", "start", "ids"])


class BitPlanes(DataSource):
    """Folders of bit-plane files. They are written from ``(doc_id, ids)``, or, with the option
    ``tokenizer``, a path, from ``(doc_id, text)``: the tasks that write encode the texts, and add
    the id of the option ``end``. Further options of the writer: ``chunk``, the ids of a chunk,
    ``planes``, "bits" or "bytes", and ``level``, of the compression. Read with the option
    ``sums``, they give the number of ids and their CRC-32 in place of the ids."""

    @classmethod
    def name(cls) -> str:
        return "bitplanes"

    def schema(self) -> str:
        return SUMS if self.options.get("sums") == "true" else READ

    def reader(self, schema) -> _Reader:
        return _Reader(self.options, self.options.get("sums") == "true")

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options, overwrite)


# Texts to ids

# What a tokenizer does to a text before it merges letters, if its texts can be
# cut into simple pieces as `WordIds` does it.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
               {"type": "Lowercase"}]
PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# Pieces that are put into one text to be encoded.
JOINED = 1_000

_SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(5)


class _Encoder:
    """Pieces to ids: those of simple words by the model alone, others by the tokenizer."""

    def __init__(self, path: str):
        # A task has one core, and threads of the library would each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer.from_file(path)
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = form["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)
        split = (form["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        known = (bool(suffix) and (form["normalizer"] or {}).get("normalizers") == NORMALIZERS
                 and split[0].get("pattern") == {"Regex": PIECES})
        self.kinds = np.full(256, _ODD, np.uint8)
        self.lower = np.arange(256, dtype=np.uint8)
        if known:
            self.kinds[0x21:0x7F] = _MARK
            self.kinds[0x30:0x3A] = _DIGIT
            self.kinds[0x41:0x5B] = self.kinds[0x61:0x7B] = _LETTER
            self.kinds[0xC3] = _LETTER
            added = self.tokenizer.get_added_tokens_decoder().values()
            for mark in {"'", *(token.content[0] for token in added if token.content)}:
                self.kinds[mark.encode()[0]] = _ODD
            self.lower[0x41:0x5B] += 32

    def kinds_of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The kind of each byte, and which are second bytes of letters from U+00C0 to U+00FF."""
        second = np.zeros(len(data), bool)
        second[1:] = data[:-1] == 0xC3
        letter = second & (data != 0x97) & (data != 0xB7)  # two of them are signs
        kinds = self.kinds[data]
        kinds[letter] = _LETTER
        return kinds, letter

    def encode(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        kinds, _ = self.kinds_of(data)
        odd = np.concatenate(([0], np.cumsum(kinds == _ODD)))
        simple = odd[ends] == odd[starts]
        counts = np.zeros(len(texts), np.int64)
        parts: list[np.ndarray] = []
        chosen = np.flatnonzero(simple)
        if len(chosen):
            own = chosen.tolist()
            lines = [b" ".join([texts[i] for i in own[at:at + JOINED]]).decode()
                     for at in range(0, len(own), JOINED)]
            found = self.model.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.int32) for e in found])
            counts[chosen] = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            parts.append(ids)
        others = np.flatnonzero(~simple)
        if len(others):
            found = self.tokenizer.encode_batch_fast(
                [texts[i].decode() for i in others.tolist()], add_special_tokens=False)
            parts.append(np.array([i for e in found for i in e.ids], np.int32))
            counts[others] = [len(e) for e in found]
        if len(parts) < 2:
            return (parts or [np.zeros(0, np.int32)])[0], counts
        # Back into the order of the pieces.
        order = np.concatenate([chosen, others])
        begin = np.empty(len(texts), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(parts)[ragged(begin, counts)], counts


class WordIds:
    """Token ids of many texts by a tokenizer that drops white space, each piece encoded once.

    Such a tokenizer matches pieces that hold no white space, and its added tokens hold none
    either: the ids of a text are those of its words one after the other. A word of nothing but
    letters up to U+00FF, digits and marks is cut further, where the tokenizer cuts it: into
    runs of letters, in lower case, single digits, and runs of marks. Such pieces are already
    normal and whole, so the model alone encodes them, many in one text. Other words, those
    with an apostrophe, a letter beyond or a mark that may begin an added token, are left to
    the tokenizer as they are.
    """

    def __init__(self, path: str):
        self.encoder = _Encoder(path)
        self.cache = IdCache(self.encoder.encode)

    def _cut(self, data: np.ndarray, offsets: np.ndarray):
        """The bytes, simple words in lower case, the spans of the pieces, and the offset of
        each text in them."""
        starts, ends, bounds = word_spans(data, offsets)
        kinds, letter = self.encoder.kinds_of(data)
        odd = np.concatenate(([0], np.cumsum(kinds == _ODD)))
        # White space is odd too, but stands in no word.
        whole = odd[ends] > odd[starts]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts[whole]] += 1
        inside[ends[whole]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
        lower = self.encoder.lower[data]
        lower[letter & (data < 0x9F)] += 0x20
        lower = np.where(inside, data, lower)
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
        begins[:-1] &= ~inside
        begins[starts] = True
        in_word = np.zeros(len(data) + 1, np.int8)
        in_word[starts] += 1
        in_word[ends] -= 1
        in_word = np.cumsum(in_word, dtype=np.int8) > 0
        begins &= in_word
        first = np.flatnonzero(begins)
        stops = begins[1:] | ~in_word[1:]
        stops &= in_word[:-1]
        last = np.flatnonzero(stops) + 1
        return lower, first, last, np.searchsorted(first, offsets)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a slice, and the offset of each text in them."""
        lower, starts, ends, bounds = self._cut(data, offsets)
        ids, counts = self.cache.spans(lower, starts, ends)
        return ids, np.concatenate(([0], np.cumsum(counts)))[bounds]


def id_rows(batches: Iterator[pa.RecordBatch], tokenizer: str, end: int | None) -> Iterator[pa.RecordBatch]:
    """``(doc_id, ids)`` of ``(doc_id, text)``: the ids of each text, and then ``end``."""
    words = WordIds(tokenizer)
    for batch in batches:
        for first, last, data, offsets in text_slices(batch.column("text")):
            ids, bounds = words.ids(data, offsets)
            if end is not None:
                ids = np.insert(ids, bounds[1:], end)
                bounds = bounds + np.arange(len(bounds))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, last - first), list_column(ids, bounds, pa.int32())],
                names=["doc_id", "ids"])


def write_ids(docs: DataFrame, tokenizer: str, path: str, end: int | None = END,
              chunk: int = CHUNK_IDS, planes: str = "bits", level: int = LEVEL) -> None:
    """Encode whole texts and write their ids as bit planes, in the order of ``doc_id``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. ``tokenizer`` is the path
    of a tokenizer file, for executors, that drops white space. Each document's ids are
    followed by ``end``, unless that is None. A null text is an empty one. Rows are documents,
    also where ids repeat or are null: nulls come first, rows of one id in the order of a hash
    of their texts. An empty table makes a list of no files.

    Texts are range-partitioned by id and hash, so no id, however frequent, fills a partition,
    but for copies of one row.
    """
    spark = docs.sparkSession
    spark.dataSource.register(BitPlanes)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    options = {"chunk": chunk, "planes": planes, "level": level, "tokenizer": tokenizer}
    if end is not None:
        options["end"] = end
    texts.repartitionByRange(n, *order).sortWithinPartitions(*order).write.format("bitplanes").mode(
        "append").options(**options).save(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)`` of a folder of bit planes; ``start`` counts the ids of all
    documents before it."""
    spark.dataSource.register(BitPlanes)
    return spark.read.format("bitplanes").load(path)


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of a folder of bit planes: the number of ids of
    each document, and the unsigned CRC-32 of all of them as little-endian unsigned 32-bit
    numbers, as read back from the planes."""
    spark.dataSource.register(BitPlanes)
    return spark.read.format("bitplanes").option("sums", "true").load(path)


def encode_documents(docs: DataFrame, tokenizer: str, end: int | None = END) -> DataFrame:
    """Write the ids of all documents to a new folder in the shared one, and read them back:
    ``read_sums`` of the files. See ``write_ids`` for the rules."""
    path = new_folder(docs.sparkSession, "planes")
    write_ids(docs, tokenizer, path, end)
    return read_sums(docs.sparkSession, path)
