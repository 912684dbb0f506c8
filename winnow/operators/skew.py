"""Per-key counts attached to every row, safe for hot keys.

A window ``count(*) over (partition by key)`` sends every row of a key to one
task; a single generic title can hold a third of all rows. Here instead the
counts come from a ``groupBy`` (map-side partial aggregation) and are joined
back on a 256-bit digest of the key: the count side has one row per key, so a
hot key is a skewed left side, which adaptive execution splits over as many
tasks as it needs. There is no list of hot keys and no limit on them. Digests
keep long text keys out of the shuffle and the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_digest(key: Column | str) -> Column:
    """256-bit digest of a text key; null for a null key."""
    return F.unhex(F.sha2(F.col(key) if isinstance(key, str) else key, 256))


def attach_key_counts(df: DataFrame, key: str, count_col: str) -> DataFrame:
    """Add ``count_col`` = number of rows of ``df`` sharing ``key``. Rows with a
    null key get a null count."""
    rows = df.withColumn("_kd", key_digest(key))
    counts = rows.groupBy("_kd").agg(F.count(F.lit(1)).alias(count_col)).filter(F.col("_kd").isNotNull())
    return rows.join(counts, "_kd", "left").drop("_kd")
