"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of their ids, make blocks. Of a source with weight
``w`` block ``j`` (from 0) is released at slot ``floor(j / w)`` and due by slot
``ceil((j + 1) / w)``; in every slot the released block with the earliest deadline goes
next. The weights sum to 1, so no deadline is missed, and at any point of the mix a source
is less than one block away from its share.

Releases and deadlines are taken from the exact weights, as ratios of whole numbers, so
nothing drifts however long the mix. The driver deals out the slots, one for each block, and
writes them to a table; each document finds its slot there from its number within its source.
When a source runs out, the weights of the others are scaled up and a new schedule starts;
every document has a place.

Where ``parts`` is given, weights are first rounded to so many parts, and the schedule repeats
after that many slots. The bound then holds against the rounded weights only.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from broadsheet.cluster import broadcast_if, is_small, new_folder
from broadsheet.operators.indexing import number_rows

# Documents of a block, and slots of a period. (There are at least ten per source.)
BLOCK = 8
PARTS = 1000

# Blocks of a source in one row of the table of slots, and slots written at a time.
PIECE = 4096
WRITE_SLOTS = 1_000_000

# Sources whose sizes decide the weights where none are given: n ** TEMPERATURE.
TEMPERATURE = 0.5

# A plan in parts has at most this many slot numbers; more sources than that allows are an error.
PLAN_SLOTS = 4_000_000


def quotas(weights: Mapping[str, float], parts: int) -> dict[str, int]:
    """Parts of a period for each source: its share to the nearest part, at least one."""
    total = sum(weights.values())
    exact = {s: max(w / total * parts, 1.0) for s, w in weights.items()}
    scale = parts / sum(exact.values())
    exact = {s: x * scale for s, x in exact.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (out[s] - exact[s], s))
    for s in by_rest[:max(0, parts - sum(out.values()))]:
        out[s] += 1
    while sum(out.values()) > parts:
        out[max(out, key=lambda s: (out[s], s))] -= 1
    return out


def period(quota: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks in one period, by earliest deadline first."""
    parts = sum(quota.values())
    slots: dict[str, list[int]] = {s: [] for s in quota}
    waiting = [(0, s) for s in sorted(quota)]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str]] = []
    for slot in range(parts):
        while waiting and waiting[0][0] <= slot:
            _, s = heapq.heappop(waiting)
            due = -(-(len(slots[s]) + 1) * parts // quota[s])
            heapq.heappush(ready, (due, -quota[s], s))
        _, _, s = heapq.heappop(ready)
        slots[s].append(slot)
        if len(slots[s]) < quota[s]:
            heapq.heappush(waiting, (len(slots[s]) * parts // quota[s], s))
    return slots


def schedule(blocks: Mapping[str, int], weights: Mapping[str, float], parts: int = PARTS):
    """Rows ``(source, first block, end block, first slot, parts, slots)``: from the first to
    the end block a source's blocks take these slots of each period of so many parts."""
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(left, 0)
    rows, base = [], 0
    while left:
        weighed = {s: weights.get(s, 0.0) for s in left if weights.get(s, 0.0) > 0}
        weighed = weighed or dict.fromkeys(left, 1.0)  # nobody asked for what is left
        size = max(parts, 10 * len(weighed))
        if size * len(weighed) > PLAN_SLOTS and sum(len(r[5]) for r in rows) > PLAN_SLOTS:
            raise ValueError(f"a mix of {len(blocks)} sources needs a plan of too many slots")
        slots = period(quotas(weighed, size))
        last = {s: (left[s] - 1) // len(own) * size + own[(left[s] - 1) % len(own)]
                for s, own in slots.items()}
        end = min(last.values()) + 1
        for s, own in slots.items():
            n = end // size * len(own) + sum(x < end % size for x in own)
            if n:
                rows.append((s, done[s], done[s] + n, base, size, own))
            done[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}
        base += end
    return rows


def turns(blocks: Mapping[str, int], weights: Mapping[str, float]) -> Iterator[str]:
    """The source of each slot, by earliest deadline first with exact weights."""
    left = {s: n for s, n in blocks.items() if n}
    exact = {s: Fraction(w) for s, w in weights.items() if s in left and w > 0}
    unit = math.lcm(*(w.denominator for w in exact.values()))
    while left:
        share = {s: int(w * unit) for s, w in exact.items() if s in left}
        share = share or dict.fromkeys(left, 1)  # nobody asked for what is left
        total, taken, slot = sum(share.values()), dict.fromkeys(share, 0), 0
        waiting = [(0, s) for s in sorted(share)]
        ready: list[tuple[int, int, str]] = []
        while True:
            while waiting and waiting[0][0] <= slot:
                _, s = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(taken[s] + 1) * total // share[s]), -share[s], s))
            s = heapq.heappop(ready)[2]
            yield s
            taken[s] += 1
            slot += 1
            if taken[s] == left[s]:
                break
            heapq.heappush(waiting, (taken[s] * total // share[s], s))
        left = {s: n - taken.get(s, 0) for s, n in left.items() if n > taken.get(s, 0)}


def _in_parts(blocks: Mapping[str, int], weights: Mapping[str, float], parts: int):
    """``(source, slot)`` of every block, in the order of each source, from ``schedule``."""
    for s, first, end, base, size, own in schedule(blocks, weights, parts):
        for n in range(end - first):
            yield s, base + n // len(own) * size + own[n % len(own)]


def _slot_table(spark: SparkSession, slots: Iterable[tuple[str, int]]) -> DataFrame:
    """``(plan_key, piece, slots)``, written: the slots of PIECE blocks of a source each."""
    path = new_folder(spark, "slots")
    full: list[tuple[str, int, array]] = []
    open_pieces: dict[str, tuple[int, array]] = {}
    types = [pa.string(), pa.int64(), pa.list_(pa.int64())]

    def write(rows: list[tuple[str, int, array]]) -> None:
        columns = list(zip(*rows)) or [[], [], []]
        table = pa.table([pa.array(list(c), t) for c, t in zip(columns, types)],
                         names=["plan_key", "piece", "slots"])
        spark.createDataFrame(table).write.mode("append").parquet(path)

    for s, slot in slots:
        piece, own = open_pieces.setdefault(s, (0, array("q")))
        own.append(slot)
        if len(own) == PIECE:
            full.append((s, piece, own))
            open_pieces[s] = piece + 1, array("q")
            if len(full) * PIECE >= WRITE_SLOTS:
                write(full)
                full = []
    write(full + [(s, piece, own) for s, (piece, own) in open_pieces.items() if own])
    return spark.read.schema("plan_key string, piece long, slots array<long>").parquet(path)


def _key(source: Column) -> Column:
    """Sources as keys without nulls."""
    return F.when(source.isNull(), F.lit("none")).otherwise(
        F.concat(F.lit("="), source.cast("string")))


def _placed(rows: DataFrame, weights: Mapping[str, float] | None, block: int, parts: int | None) -> DataFrame:
    """``rows(doc_id, source, key, tie)``, and whatever else they have, with ``block``, ``slot`` and
    ``place``: every row is numbered within its source."""
    kept = [c for c in rows.columns if c not in ("key", "tie")]
    numbered = number_rows(rows, [F.col("doc_id"), F.col("tie")], "number", within="key")
    sizes = {r["key"]: r["n"] for r in numbered.groupBy("key").agg(
        F.count("*").alias("n")).toLocalIterator()}
    wanted = ({s: n ** TEMPERATURE for s, n in sizes.items()} if weights is None
              else {f"={s}": float(w) for s, w in weights.items()})
    blocks = {s: -(-n // block) for s, n in sizes.items()}
    slots = (_in_parts(blocks, wanted, parts) if parts
             else ((s, slot) for slot, s in enumerate(turns(blocks, wanted))))
    plan = _slot_table(rows.sparkSession, slots)
    placed = numbered.withColumn("block", F.floor(F.col("number") / block).cast("long")).join(
        broadcast_if(plan, is_small(plan)),
        (F.col("key") == F.col("plan_key")) & (F.expr(f"block div {PIECE}") == F.col("piece")))
    slot = F.element_at("slots", (F.pmod("block", F.lit(PIECE)) + 1).cast("int"))
    return placed.select(*kept, "block", slot.alias("slot"),
                         F.pmod("number", F.lit(block)).cast("int").alias("place"))


def _rows(docs: DataFrame, *more: Column) -> DataFrame:
    """What ``_placed`` takes. Rows of one id are in the order of a hash of their other columns, so
    that an id, or none, that a third of the rows have does not fill a partition."""
    rest = [docs[f"`{f.name}`"] for f in docs.schema.fields
            if isinstance(f.dataType, (StringType, NumericType)) and f.name not in ("doc_id", "source")]
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
        _key(docs["source"]).alias("key"), F.xxhash64(F.lit(0), *rest).alias("tie"), *more)


def mix_order(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK,
              parts: int | None = None) -> DataFrame:
    """``(doc_id, source, block, slot, place)``: sorted by ``slot`` and ``place``, the
    documents are mixed. A slot is one block of one source; ``place`` is the place in it.

    ``docs`` has ``doc_id`` and ``source``; other columns only order rows of one id.
    ``weights`` gives the target weight of each source; sources it does not name come after
    all others have run out. By default the weight of a source is its number of documents to
    the power of TEMPERATURE. Every row has a place of its own, also where ids repeat or are
    null. A null source is a source of its own, a null id comes first in its source. An empty
    table gives no rows. Weights are kept exactly, unless ``parts`` says what to round them to.

    Only the number of documents of each source goes through the driver, which deals out one
    slot for each block and writes the slots as it goes.
    """
    return _placed(_rows(docs), weights, block, parts)


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK,
          parts: int | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whatever their names, in the order of the mix: sorted
    over partitions and within, so that files written from it hold the mix from the first to
    the last. See ``mix_order`` for the rules."""
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    placed = _placed(_rows(docs, whole), weights, block, parts)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartitionByRange(n, "slot", "place").sortWithinPartitions("slot", "place").select("row.*")
