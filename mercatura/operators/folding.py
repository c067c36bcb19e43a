"""One row per key, on its way into a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_for_join(df: DataFrame, key: str, *sums: Column) -> DataFrame:
    """Aggregate ``df`` per ``key``, to be joined on it with rows that may hold a hot key.

    Grouped by the key alone, the result is partitioned for the join, which takes it as it is;
    but AQE splits a hot key only where both inputs come straight from a shuffle. Grouping by
    the key and its hash gives the same rows and one more shuffle of them, one row per key.
    """
    return df.groupBy(key, F.xxhash64(key).alias("_hash")).agg(*sums).drop("_hash")
