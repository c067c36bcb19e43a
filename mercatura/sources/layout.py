"""Physical layout that does the work indexes do elsewhere.

Orders, items and reviews meet on ``order_id``: bucketing them on it lets those joins run
without a shuffle.

Rows of one customer, product or seller are looked up by Bloom filters: each row group has one for each
of these columns (or a dictionary, where few values make it up), and a scan skips the groups whose
filter does not know the value.

Orders of a span of time are read from a copy that is clustered by time: its row groups cover short
spans, and a scan skips those outside by their least and greatest values. Parquet readers compare days
but no timestamps, so the copy carries the day beside the time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.plans.sales import PURCHASED
from mercatura.sources.tables import qualified

BUCKET_KEY = "order_id"
BUCKETED = ("orders", "order_items", "order_reviews")
LOOKUP_KEYS = {"orders": ("customer_id",), "order_items": ("product_id", "seller_id")}
TIME_KEY = PURCHASED
# What the name of a table's copy by time ends with.
BY_TIME = "_by_time"

# A bucket is one task and AQE cannot split it, so no bucket may be this many times the mean.
MAX_BUCKET_SKEW = 4.0


def bucket_skew(df: DataFrame, key: str, buckets: int) -> float:
    """Rows of the largest bucket over the mean. One pass; one number per bucket."""
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    sizes = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    largest, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    return 0.0 if not rows else largest * buckets / rows


# A writer keeps all sizes that a row group's filter was tried in, and its footer, until it closes the file.
# Where row groups are small, there are many of both, so filters get no larger than a quarter of the row
# group (every value of four bytes another one, ten bits each) and files hold no more rows than this.
FILE_ROWS = 1_000_000
MOST_FILTER_BYTES = 1 << 20


def lookup_options(keys: Iterable[str], row_group_bytes: int | None = None) -> dict[str, str]:
    """Writer options for Bloom filters as large as the values of a row group need.

    Smaller row groups are skipped more often, and cost more footer: ``row_group_bytes`` is Parquet's
    own size if it is not given.
    """
    options = {f"parquet.bloom.filter.enabled#{key}": "true" for key in keys}
    if options:
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
        options["parquet.bloom.filter.max.bytes"] = str(min(max(row_group_bytes // 4, 1024), MOST_FILTER_BYTES))
        options["maxRecordsPerFile"] = str(FILE_ROWS)
    return options


def day_column(by: str) -> str:
    return f"{by}_day"


def write_by_time(
    df: DataFrame,
    name: str,
    by: str = TIME_KEY,
    key: str = BUCKET_KEY,
    database: str | None = None,
    *,
    lookups: Iterable[str] = (),
    row_group_bytes: int | None = None,
) -> None:
    """Write a table clustered by the time ``by``, with the day beside it; read it with ``between``.

    Rows are dealt out by ranges of time and ``key``, so that a time that many rows share is spread over
    several files.
    """
    dated = df.withColumn(day_column(by), F.col(by).cast("date"))
    placed = dated.repartitionByRange(by, key).sortWithinPartitions(by, key)
    options = lookup_options(lookups, row_group_bytes)
    placed.write.mode("overwrite").format("parquet").options(**options).saveAsTable(qualified(name, database))


def between(df: DataFrame, start: datetime, end: datetime, by: str = TIME_KEY) -> DataFrame:
    """The rows of a table of ``write_by_time`` from ``start`` until before ``end``, without the day."""
    kind = df.schema[by].dataType
    first, last = (F.lit(t.isoformat(sep=" ")).cast(kind) for t in (start, end))
    at, day = F.col(by), F.col(day_column(by))
    days = (day >= F.lit(start.date())) & (day <= F.lit(end.date()))
    return df.where(days & (at >= first) & (at < last)).drop(day_column(by))


def write_layout(
    tables: Mapping[str, DataFrame],
    buckets: int,
    database: str | None = None,
    *,
    max_skew: float = MAX_BUCKET_SKEW,
    row_group_bytes: int | None = None,
    watch: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> dict[str, bool]:
    """Write every table; say for each whether it was bucketed. ``watch`` gets each as it is written.

    The tables that join on ``order_id`` are bucketed, and those of ``LOOKUP_KEYS`` get Bloom filters. If one of them is too skewed for that,
    nothing is written and the call raises: write it plainly (``replace_table``), so that its
    joins shuffle and are split at run time, or allow a larger ``max_skew``.
    """
    candidates = {name: df for name, df in tables.items() if name in BUCKETED}
    skews = {name: bucket_skew(df, BUCKET_KEY, buckets) for name, df in candidates.items()}
    if any(skew > max_skew for skew in skews.values()):
        raise ValueError(f"too skewed for buckets, largest bucket over mean: {skews}")
    done = {}
    for name, df in tables.items():
        target = qualified(name, database)
        bucketed = name in candidates
        # Without this, every task would write a file for every bucket.
        placed = df.repartition(buckets, BUCKET_KEY) if bucketed else df
        keys = [key for key in LOOKUP_KEYS.get(name, ()) if key in df.columns]
        options = lookup_options(keys, row_group_bytes)
        writer = watch(name, placed).write.mode("overwrite").format("parquet").options(**options)
        if bucketed:
            writer = writer.bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY)
        writer.saveAsTable(target)
        done[name] = bucketed
    return done
