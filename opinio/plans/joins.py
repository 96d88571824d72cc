"""Join shapes shared by the operators.

``bounded_broadcast`` hints a broadcast of a table whose size isn't known beforehand (one-row
aggregates, literal parameter lists and top-k results are hinted where they are made). The hint is given
only after a cheap, distributed row count proves the side is below a bound; beyond the
bound the side is returned unhinted and Spark plans a shuffle join (AQE may still
convert it at runtime from real statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a broadcast side may hold. Lexicons, stop-word lists, phrase lists and top-k
# results sit far below it; anything that grows with the corpus does not.
DEFAULT_BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows (checked, not assumed)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
