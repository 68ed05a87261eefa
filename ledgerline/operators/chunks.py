"""Write chunk plan: how many rows go into each append batch."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chunking constants of the original loader.
MIN_CHUNK = 5000
CHUNK_SHARE = 0.2
CHUNK_THRESHOLD = math.ceil(1.75 * MIN_CHUNK)  # 8750


def plan_chunks(n: int) -> list[int]:
    """Chunk sizes for ``n`` rows: one write up to 8,750 rows, else chunks of
    ``max(ceil(20% n), 5000)`` (so at most 5)."""
    if n <= CHUNK_THRESHOLD:
        return [n] if n > 0 else []
    size = max(math.ceil(CHUNK_SHARE * n), MIN_CHUNK)
    return [min(size, n - i) for i in range(0, n, size)]


def chunk_size_col(n: Column) -> Column:
    """Column form of the chunk size for a row count column ``n``."""
    big = F.greatest(F.ceil(n * F.lit(CHUNK_SHARE)), F.lit(MIN_CHUNK)).cast("bigint")
    return F.when(n > F.lit(CHUNK_THRESHOLD), big).otherwise(n.cast("bigint"))


def chunk_columns(n: Column) -> dict[str, Column]:
    size = chunk_size_col(n)
    count = F.when(n <= 0, F.lit(0)).otherwise(F.ceil(n / size)).cast("bigint")
    last = (n - (count - 1) * size).cast("bigint")
    return {"chunk_size": size, "n_chunks": count, "last_chunk": F.when(count > 0, last)}
