"""Row numbers over whole tables, and even partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if, checkpointed, is_small

# monotonically_increasing_id() holds the partition above this bit, the row below it.
_ROW_BITS = 33


def number_rows(df: DataFrame, order: list[Column], out: str, within: str | None = None) -> DataFrame:
    """Add ``out``: the place of each row in the order, from 0, over the whole table or
    ``within`` each value of a column.

    The rows are sorted by ranges into many partitions and numbered there; each partition
    then adds the number of rows before it. No value of ``within`` has to fit one task,
    and the offsets are one row per partition and value in it. The sorted rows are
    checkpointed, so that both readings of them see the same partitions.
    """
    order = ([F.col(within)] if within else []) + order
    rows = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order))

    place = F.monotonically_increasing_id()
    rows = rows.withColumn("_part", F.shiftright(place, _ROW_BITS).cast("int")).withColumn(
        "_row", place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    group = ["_part"] + ([within] if within else [])
    sizes = rows.groupBy(*group).agg(
        F.count("*").alias("_size"), F.min("_row").alias("_first")
    )
    # One row per partition, so the window is small, also where it is one partition.
    before = Window.partitionBy(*(group[1:] or [F.lit(0)])).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offset = F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")
    offsets = checkpointed(sizes.select(*group, offset.alias("_offset")))
    return rows.join(broadcast_if(offsets, is_small(offsets)), group).select(
        *df.columns, (F.col("_row") + F.col("_offset")).alias(out)
    )


def article_index(articles: DataFrame) -> DataFrame:
    """Articles with a running index ``idx`` from 0, in the order of ``doc_id``."""
    return number_rows(articles, [F.col("doc_id")], "idx")


def index_partition(indexed: DataFrame, n: int) -> DataFrame:
    """Rows with the partition ``part`` that their index falls into, out of ``n``."""
    return indexed.withColumn("part", F.pmod("idx", F.lit(n)).cast("int"))


def spread(df: DataFrame, n: int) -> DataFrame:
    """The rows dealt out evenly over ``n`` partitions, with no regard to their values.

    For sources with fewer splits than the cluster has cores; others are best left alone.
    """
    return df.repartition(n)
