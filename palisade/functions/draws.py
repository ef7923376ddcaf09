"""Repeatable pseudo-random draws that depend on the row and the seed only.

A draw derived from the row id gives the same answer after a lost executor, under any
partitioning, and on every re-run; ``rand()`` gives none of these.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 60


def hashed_draw(seed: int, *columns: Column) -> Column:
    """Uniform BIGINT in [0, 2**60)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 64 - DRAW_BITS)


def portable_draw(seed: int, row_id: Column) -> Column:
    """The same range from md5, for draws that another SQL engine has to reproduce."""
    text = F.concat(F.lit(f"{seed}:"), row_id.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("bigint")
