"""Size bounds that license broadcasts.

A broadcast hint is given only where the size is known from the domain; all
other joins are left to the optimizer and to adaptive execution, which decide
on real sizes.  Nothing is counted while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import is_fixed_width

# A broadcast side may take at most this many bytes.
BROADCAST_MAX_BYTES = 256 << 20


def row_bytes(df: DataFrame) -> int | None:
    """Bytes of an in-memory row, or None if a column has no fixed width."""
    if not all(is_fixed_width(f.dataType) for f in df.schema.fields):
        return None
    return 8 + 16 * len(df.columns)  # a null bitmap, and up to 16 bytes a value (decimals)


def broadcast_if_bounded(df: DataFrame, max_rows: int, limit: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast when ``max_rows`` rows of this schema are proven to fit ``limit`` bytes."""
    width = row_bytes(df)
    return F.broadcast(df) if width is not None and width * max_rows <= limit else df
