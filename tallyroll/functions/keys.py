"""Row keys of the warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what stands for a NULL field in the hashed text. No field can look like it,
# because every other field starts with its length.
NULL_MARK = "-"


def position_key(day: Column, position: Column) -> Column:
    """``<day>_<n>``: the n-th row of a day."""
    return F.concat(day, F.lit("_"), position.cast("string"))


def content_key(columns: Sequence[str]) -> Column:
    """SHA-256 over the named fields in the given order.

    Each field goes in as ``<length>:<text>``, so no two different rows give the same text.
    """
    fields = []
    for name in columns:
        text = F.col(name).cast("string")
        fields.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK)))
    return F.sha2(F.concat_ws("|", *fields), 256)


def packed_key(key: Column) -> Column:
    """A row key in fewer bytes, for shuffles: the 64 hexadecimal digits that end a content key as 32 bytes. ``unpacked_key`` undoes it.

    Any other text is kept as it is; the first byte says which.
    """
    digits, rest = F.right(key, F.lit(64)), F.substring(key, F.lit(1), F.length(key) - F.lit(64))
    packed = F.concat(F.unhex(F.lit("01")), F.unhex(digits), F.encode(rest, "utf-8"))
    return F.when(key.rlike("_[0-9a-f]{64}$") & ~F.endswith(key, F.lit("\n")), packed).otherwise(F.concat(F.unhex(F.lit("00")), F.encode(key, "utf-8")))


def unpacked_key(packed: Column) -> Column:
    """The key behind ``packed_key``."""
    plain = F.decode(F.substring(packed, 2, 1 << 30), "utf-8")
    hashed = F.concat(F.decode(F.substring(packed, 34, 1 << 30), "utf-8"), F.lower(F.hex(F.substring(packed, 2, 32))))
    return F.when(F.substring(packed, 1, 1) == F.unhex(F.lit("01")), hashed).otherwise(plain)
