"""Repeatable pseudo-random columns.

``rand(seed)`` depends on partitioning and row order, so a recomputed task could
draw other values. These draws hash the row's own key: a retry, another cluster
size or another engine gives the same value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_RANGE = 2**32


def draw(key: Column, purpose: str, seed: int) -> Column:
    """Uniform whole number in [0, 2**32) from (key, purpose, seed)."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{purpose}:{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def chance(key: Column, purpose: str, seed: int, p: float) -> Column:
    """True with probability ``p``."""
    return draw(key, purpose, seed) < F.lit(int(p * DRAW_RANGE))
