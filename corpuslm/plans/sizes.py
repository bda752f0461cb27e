"""Size checks. A side is broadcast, or rows brought to the driver, only behind one of these."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Most bytes a broadcast table may need in memory.
BROADCAST_BYTES = 64 << 20
# What a row needs in a broadcast table besides its strings, generously.
ROW_BYTES = 128
# Most classes that get one column each in the model table.
WIDE_CLASSES = 32
# Most rows of a per-class table that are broadcast or numbered by one task.
SMALL_ROWS = 10_000


def small_rows(df: DataFrame, limit: int) -> list[Row] | None:
    """All rows of df when it has at most `limit`, else None. Never brings more than limit + 1 rows."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def is_small(df: DataFrame, limit: int = SMALL_ROWS) -> bool:
    return df.limit(limit + 1).count() <= limit


def fits(df: DataFrame, strings: list[str], limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of df, measured by their count and the bytes of the given columns, may be broadcast."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in strings), F.lit(ROW_BYTES))
    return (df.agg(F.sum(size)).first()[0] or 0) <= limit
