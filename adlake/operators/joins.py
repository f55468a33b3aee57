"""Join helpers: size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sized_broadcast(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows.

    The check counts at most ``max_rows + 1`` rows (a bounded job); past the
    bound the side is returned unchanged and the join shuffles (AQE may still
    convert it at runtime from measured sizes)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
