"""Global ranks over data that one task should not have to sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.session import checkpointed

# monotonically_increasing_id() is the partition number, shifted left, plus the row number.
_ID_SHIFT = 33
_ID_MASK = (1 << _ID_SHIFT) - 1


def partition_offsets(placed: DataFrame, size: Column) -> DataFrame:
    """Per sort partition (``_part``): ``_offset``, the size of all before it, and ``_all``."""
    sizes = placed.groupBy("_part").agg(size.alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(everything).alias("_all"),
    )


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 0-based position in the total order, and the number of rows as ``rank_total``.

    A range-partitioned sort places the rows; the result is checkpointed, so the positions
    stay put when an executor is lost. The partitions' sizes (one row each) then give every
    partition its offset. No task sees more than its own range, and equal leading keys are
    split as long as a later key differs. ``order`` should end in a unique key.
    """
    placed = checkpointed(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    ).withColumns(
        {
            "_part": F.shiftright("_at", _ID_SHIFT),
            "_row": F.col("_at").bitwiseAND(F.lit(_ID_MASK)),
        }
    )
    offsets = partition_offsets(placed, F.count(F.lit(1)))
    # One row per partition of the sort: never more than the shuffle has partitions.
    return placed.join(F.broadcast(offsets), "_part").select(
        *[F.col(c) for c in df.columns],
        (F.col("_offset") + F.col("_row")).alias(name),
        F.col("_all").alias("rank_total"),
    )


def tile_of(rank: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a 0-based rank: the first ``rows % tiles`` tiles get one row more."""
    size = F.floor(rows / F.lit(tiles))
    larger = rows % F.lit(tiles)
    in_larger = larger * (size + 1)
    return (
        F.when(rank < in_larger, F.floor(rank / (size + 1)) + 1)
        .otherwise(larger + F.floor((rank - in_larger) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def ntile(df: DataFrame, tiles: int, order: Sequence[Column], name: str) -> DataFrame:
    """NTILE over the whole frame, by the distributed rank whatever the number of rows."""
    ranked = global_rank(df, order, "_rank")
    return ranked.select(
        *[F.col(c) for c in df.columns],
        tile_of(F.col("_rank"), F.col("rank_total"), tiles).alias(name),
    )
