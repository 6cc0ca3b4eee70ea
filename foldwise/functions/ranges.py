"""Place an orderable value among sorted splitters."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_bucket(key: Column, splitters: Sequence[Column]) -> Column:
    """How many of the sorted splitters are ``<= key``.

    Works for any orderable type. Splitters sit in about ``sqrt(n)`` blocks, so a
    row is compared with ``2 * sqrt(n)`` of them, not with all.
    """
    if not splitters:
        return F.lit(0)
    width = max(1, isqrt(len(splitters)))
    blocks = [splitters[i:i + width] for i in range(0, len(splitters), width)]
    reached = F.size(F.filter(F.array(*[b[0] for b in blocks]), lambda s: s <= key))
    block = F.element_at(F.array(*[F.array(*b) for b in blocks]), F.greatest(reached, F.lit(1)))
    inside = F.size(F.filter(block, lambda s: s <= key))
    return F.when(reached == 0, F.lit(0)).otherwise((reached - 1) * width + inside)
