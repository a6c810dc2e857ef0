"""Joins behind a check of the size of a side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

#: Bytes that a broadcast side may take.
BROADCAST_BYTES = 32 << 20


def measured(df: DataFrame) -> int:
    """Bytes of the rows of ``df``, flat columns: their file size proves no bound, since they compress well."""
    sizes = [F.coalesce(F.octet_length(c.name), F.lit(0)) + 16 if isinstance(c.dataType, StringType | BinaryType) else F.lit(8) for c in df.schema]
    return df.agg(F.sum(sum(sizes, F.lit(16)).cast("bigint"))).first()[0] or 0


def bounded(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A written table as a side of a join: broadcast if its rows take ``most`` bytes at most, else joined by sorting."""
    return F.broadcast(df) if measured(df) <= most else df.hint("merge")
