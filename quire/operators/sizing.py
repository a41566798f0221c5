"""Broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Dimension-like tables (source catalogues, per-source stop points, offsets)
# are broadcast when they hold at most this many rows and bytes; beyond it the
# join is left to a shuffle join, where AQE's skew-join split handles hot keys.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 << 20
_VALUE_BYTES = 8


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows of ``max_bytes`` in all, else ``df``.

    The check counts ``limit(max_rows + 1)``, so it stops early on a large
    input instead of counting all of it.  Pass landed rows: they are read twice.
    """
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    size = sum(texts, F.lit(_VALUE_BYTES * len(df.columns))).cast("long")
    n, held = df.limit(max_rows + 1).select(size.alias("size")).agg(F.count("size"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and held <= max_bytes else df
