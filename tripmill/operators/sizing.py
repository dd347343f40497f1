"""Join-side sizing: broadcast only what has been shown to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 100_000
#: Bytes that the rows of a larger lookup may take where they are held, and bytes of a row beside its columns.
MAX_BROADCAST_BYTES, ROW_BYTES = 64 << 20, 40


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a lookup has at most ``max_rows`` rows, or takes at most ``max_bytes`` as held rows.

    Counts up to ``max_rows + 1`` rows of the lookup, never of the large side, and
    sums up the lengths of its texts if there are more.
    Larger lookups belong in a shuffle join, whose skewed keys the adaptive
    planner splits.
    """
    return df.limit(max_rows + 1).count() <= max_rows or held_bytes(df) <= max_bytes


def held_bytes(df: DataFrame) -> int:
    """About the bytes of the rows of a lookup in a hashed relation."""
    size = F.lit(ROW_BYTES + 8 * len(df.columns))
    for f in df.schema:
        if isinstance(f.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")) + 7, F.lit(0))
    return df.agg(F.sum(size.cast("long")).alias("bytes")).first()["bytes"] or 0
