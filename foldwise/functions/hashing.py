"""Splits and samples drawn from a hash of the row id.

``rand`` and ``monotonically_increasing_id`` change with the partitioning, so a
lost executor could move a row to another fold. A hash of ``seed:id`` cannot.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def row_digest(seed: int, *ids: Column) -> Column:
    """Hex digest of the seed and the row id; its order is a random order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def hash32(seed: int, *ids: Column) -> Column:
    """Uniform integer in [0, 2**32)."""
    return F.conv(F.substring(row_digest(seed, *ids), 1, 8), 16, 10).cast("bigint")


def hash_bucket(seed: int, buckets: int, *ids: Column) -> Column:
    return hash32(seed, *ids) % F.lit(buckets)


def hash_below(seed: int, fraction: float, *ids: Column) -> Column:
    """True for about ``fraction`` of the rows."""
    return hash32(seed, *ids) < F.lit(int(fraction * HASH_RANGE))
