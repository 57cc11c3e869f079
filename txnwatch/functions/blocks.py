"""Cutting one key's time line into blocks, so that no window or join needs a whole key in one task.

A frame reaching ``before`` units back and ``after`` units ahead of a row in block *b* only sees rows
that lie in *b* or within that reach of its edges. Each row is therefore sent to its own block and to
every block that can see it; frames are evaluated per (key, block) and only a block's own rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .columns import floor_div


def spread_over_blocks(df: DataFrame, position: str, width: int, before: int = 0, after: int = 0) -> DataFrame:
    """Add ``block`` (one row per block that sees the row) and ``own`` (true in the row's home block)."""
    here = F.col(position)
    first = floor_div(here - F.lit(after), width)
    last = floor_div(here + F.lit(before), width)
    return (
        df.withColumn("block", F.explode(F.sequence(first, last)))
        .withColumn("own", F.col("block") == floor_div(here, width))
    )
