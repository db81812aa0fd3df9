"""Row numbers 1..n per group in a given order, without one task per group."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.operators.joins import BROADCAST_BYTES, measured_bytes
from tallyroll.session import settle

# monotonically_increasing_id() keeps the partition number above this many bits.
_SLICE_BITS = 33


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    name: str = "row_no",
    keep: Callable[[DataFrame, str], DataFrame] = settle,
) -> DataFrame:
    """Number the rows of each ``by`` group in ``order``, which has to be total.

    A window over ``by`` would sort a whole group in one task. Here the rows are
    range-partitioned by (group, order), so a large group is a run of partitions, and each row
    gets an id that grows in that order. Once these ids are written down, the number of a row
    is its offset in its partition plus the rows of the group in earlier partitions. The table
    of partitions has one row per partition and group in it: at most groups + partitions.
    ``keep`` writes rows down and reads them back.
    """
    placed = keep(
        df.repartitionByRange(*[F.col(c) for c in by], *order)
        .sortWithinPartitions(*by, *order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbering",
    ).withColumn("_slice", F.shiftright("_place", _SLICE_BITS))
    slices = placed.groupBy(*by, "_slice").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*by, "_slice"]
    starts = slices.select(
        *[F.col(key).alias(f"_of_{key}") for key in keys],
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    if measured_bytes(starts) <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys])
    return placed.join(starts, same).select(*df.columns, (F.col("_place") + F.col("_shift")).alias(name))
