"""Join of a large fact with a dimension of any size."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension up to this measured size is sent to every executor.
BROADCAST_BYTES = 64 << 20
# A key is hot if it has more rows than this many mean shuffle partitions.
HOT_FACTOR = 2.0
# It is cut into parts of a quarter of that mean, so that parts that meet in one partition do no harm.
PARTS_PER_MEAN = 4


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as counted, not estimated: text lengths plus 16 bytes per value."""
    width = F.lit(16 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def hot_keys(fact: DataFrame, on: Sequence[str], partitions: int, factor: float = HOT_FACTOR) -> DataFrame | None:
    """Keys (all columns of ``on``) with more than ``factor`` mean partitions of rows, and into how many
    ``_parts`` each should be cut; None if there are none.

    A first pass without a shuffle lists candidates by a hash of the key, every key with such a
    share among them; a second one counts just those. The candidates number at most
    ``partitions / factor`` and the keys that are confirmed at most that too, so both are safe on
    the driver whatever the data; all parts together are at most ``PARTS_PER_MEAN * partitions``
    plus the keys, which bounds the copies of dimension rows for each match.
    """
    share = min(1.0, factor / partitions)
    hashed = fact.select(*on, F.xxhash64(*on).alias("_key"))
    found = hashed.freqItems(["_key"], max(share, 1e-4)).first()
    if not found or not found[0]:
        return None
    hit = F.col("_key").isin(list(found[0]))
    counts = hashed.select(*(F.when(hit, F.col(c)).alias(c) for c in on), hit.alias("_hit")).groupBy(*on, "_hit").agg(F.count(F.lit(1)).alias("_rows")).collect()
    mean = sum(r["_rows"] for r in counts) / partitions
    rows = [(*(r[c] for c in on), math.ceil(PARTS_PER_MEAN * r["_rows"] / mean)) for r in counts if r["_hit"] and r["_rows"] > factor * mean]
    if not rows:
        return None
    schema = T.StructType([*(T.StructField(c, fact.schema[c].dataType) for c in on), T.StructField("_parts", T.IntegerType())])
    return fact.sparkSession.createDataFrame(rows, schema)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_factor: float | None = HOT_FACTOR,
    how: str = "left",
    profile: DataFrame | None = None,
) -> DataFrame:
    """``fact`` left (or inner) join ``dim`` on equally named columns; several matches multiply the row.

    A dimension within ``broadcast_bytes`` by measurement is broadcast, and the fact is not
    shuffled. A larger one is joined by shuffle, where the rows of a hot key would all go to
    one task: those rows are cut into parts of a fraction of a mean partition, by a salt taken from ``spread_by``, and the key's dimension rows are copied once
    for each part. Each fact row has one salt and meets every match exactly once, so the result
    does not depend on which keys are taken for hot. Keys are counted in ``profile`` where given:
    a frame with the same keys that is cheaper to read than ``fact``. Without a ``hot_factor`` they are not counted, for facts that have few rows of any key.
    """
    on = list(on)
    if measured_bytes(dim) <= broadcast_bytes:
        return fact.join(F.broadcast(dim), on, how)
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = None if hot_factor is None else hot_keys(fact if profile is None else profile, on, partitions, hot_factor)
    if hot is None:
        return fact.join(dim, on, how)
    renamed = F.broadcast(hot.select(*(F.col(c).alias(f"_hot_{c}") for c in on), "_parts"))

    def parts(df: DataFrame) -> DataFrame:
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in on])
        return df.join(renamed, same, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    salt = F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int")
    salted_fact = parts(fact).withColumn("_salt", salt).select(*fact.columns, "_salt")
    salted_dim = parts(dim).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select(*dim.columns, "_salt")
    return salted_fact.join(salted_dim, [*on, "_salt"], how).drop("_salt")
