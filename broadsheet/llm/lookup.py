"""Tables of hashed keys that tasks look up whole arrays in, in shards of bounded size."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.cluster import new_folder
from broadsheet.llm.scratch import file_system

# Entries of a shard: some 100 MB. A larger table is used shard by shard, each with a pass
# of its own over what is looked up, and the parts are added up.
SHARD_ENTRIES = 4_000_000


class StoredTable:
    """A table in the shared folder, which tasks read as a whole: ``value`` is a dict of arrays,
    the columns, sorted by ``key`` as unsigned numbers; ``slots`` is for many look-ups in no order.
    It does not pass through the driver."""

    def __init__(self, path: str, key: str = "key"):
        self.path, self.key = path, key

    def columns(self) -> dict[str, np.ndarray]:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSelector

        files, folder = file_system(self.path)
        parts: dict[str, list[np.ndarray]] = {}
        # File by file, so that no more than the arrays are held.
        for info in files.get_file_info(FileSelector(folder, allow_not_found=True)):
            if info.base_name.endswith(".parquet"):
                with files.open_input_file(info.path) as source:
                    table = pq.ParquetFile(source).read(use_threads=False)
                for name in table.column_names:
                    parts.setdefault(name, []).append(np.array(table.column(name).to_numpy()))
                del table
        pa.default_memory_pool().release_unused()
        return {name: np.concatenate(parts.pop(name)) for name in list(parts)}

    @property
    def value(self) -> dict[str, np.ndarray]:
        columns = self.columns()
        columns[self.key] = columns[self.key].view(np.uint64)
        order = np.argsort(columns[self.key])
        return {name: columns.pop(name)[order] for name in list(columns)}

    def slots(self) -> tuple[Slots, dict[str, np.ndarray]]:
        """The keys in slots, and the other columns in their order."""
        columns = self.columns()
        slots, order = Slots.of(columns.pop(self.key).view(np.uint64))
        return slots, {name: columns.pop(name)[order] for name in list(columns)}


class Slots:
    """Different keys in the order of a multiple of them modulo 2**64, and where each of its leading
    bits begin: a look-up reads two or three places where a search by halves reads twenty."""

    _FACTOR = np.uint64(0x9E3779B97F4A7C15)
    # Keys that are dealt into slots at a time: a task holds a whole table, and little beside it.
    _STEP = 1 << 18

    def __init__(self, multiples: np.ndarray):
        """``multiples`` are sorted, with a last entry that is none and ends every search."""
        self.size, self.multiples = len(multiples) - 1, multiples
        bits = max(1, (2 * self.size).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.zeros((1 << bits) + 1, np.int32)
        for start in range(0, self.size, self._STEP):
            slot = (multiples[start:min(start + self._STEP, self.size)] >> self.shift).astype(np.int64)
            count = np.bincount(slot - slot[0]).astype(np.int32)
            self.first[slot[0] + 1:slot[0] + 1 + len(count)] += count
        np.cumsum(self.first, dtype=np.int32, out=self.first)

    @classmethod
    def of(cls, keys: np.ndarray) -> tuple[Slots, np.ndarray]:
        """The slots of keys, and the order in which they hold them."""
        multiples = np.full(len(keys) + 1, 2**64 - 1, np.uint64)
        own = multiples[:-1]
        np.multiply(keys, cls._FACTOR, out=own)
        order = np.argsort(own)
        own[:] = own[order]
        return cls(multiples), order

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the wanted keys, and which of them are there; a place is valid in any case
        unless there are no keys."""
        multiples = wanted * self._FACTOR
        at = self.first[(multiples >> self.shift).astype(np.int64)]
        rest = np.flatnonzero(self.multiples[at] < multiples)
        while len(rest):
            at[rest] += 1
            rest = rest[self.multiples[at[rest]] < multiples[rest]]
        there = (self.multiples[at] == multiples) & (at < self.size)
        return np.minimum(at, max(self.size - 1, 0)), there


def stored(table: DataFrame, name: str) -> str:
    """The path of a new folder in the shared one that a table has been written to."""
    path = new_folder(table.sparkSession, name)
    table.write.parquet(path)
    return path


def shards(table: DataFrame, key: str = "key", by: str | None = None,
           entries: int = SHARD_ENTRIES) -> Iterator[StoredTable]:
    """A table in shards, each with a part of the rows. ``by`` is what rows are dealt to shards
    by. The size is counted first, so that none is larger than the bound, about."""
    n = max(1, math.ceil(table.count() / entries))
    for i in range(n):
        part = table.where(F.pmod(F.xxhash64(by or key), F.lit(n)) == i) if n > 1 else table
        yield StoredTable(stored(part, "shard"), key)


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys in a sorted array, and which of them are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def text_key() -> Column:
    """``text_key``: a hash that no two different texts share. A null text is an empty one."""
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("text_key")


def added_up(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """The sums of the other columns over the parts, for every row of the input. Each part has
    one row per input row; rows alike in ``keys`` have equal values in each part, so their
    mean is that of any of them, and as many rows come out as went in."""
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    copies = F.expr(f"_rows div {len(parts)}")
    values = [f for f in every.schema.fields if f.name not in keys]
    sums = every.groupBy(*keys).agg(
        F.count("*").alias("_rows"), *[F.sum(f.name).alias(f.name) for f in values])
    means = sums.select(*keys, copies.alias("_copies"), *[
        (F.col(f.name) / copies).cast(f.dataType).alias(f.name) for f in values])
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return means.withColumn("_copy", copy).select(*every.columns)
