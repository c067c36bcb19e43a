"""Sales from streams of order items and of orders.

Every micro-batch of items is folded to one row per order before it is written, and the folds are added
up when they are read. They meet the orders only then: items that come before their order, or before it is
delivered, wait in their fold, and a status that changes later changes the result. So the result is that
of the batch report over the items and orders that have come, in whatever order and batches they came.
What is kept grows with the orders, not with the items.

Orders may be a table, read as it is at each run, or a stream of their versions (``latest_orders``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.functions import month_of
from mercatura.plans.sales import PURCHASED, item_sums, refold_items, sales_of_folds
from mercatura.streaming.store import FAN_IN, FoldStore


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream the parquet files of a folder, or of what a path pattern matches."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_available(stream: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """Append everything there is to a parquet table, once each, and return that table.

    Run again with the same folders to take in what has come since: the checkpoint and the
    sink's log make a batch that is repeated after a failure count once.
    """
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(folder)


def fold_batches(
    stream: DataFrame,
    fold: Callable[[DataFrame, int], DataFrame],
    merge: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Fold everything there is, batch by batch, and return the folds of all batches added up.

    ``fold`` gets a batch and its number. Run again with the same folders to take in what has come
    since. A batch that is repeated after a failure counts once; see ``store`` for what is kept.
    """
    spark = stream.sparkSession
    schema = fold(spark.createDataFrame([], stream.schema), 0).schema
    store = FoldStore(spark, folder, schema, merge, fan_in)
    query = (
        stream.writeStream.foreachBatch(lambda batch, number: store.put(number, fold(batch, number)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.read()


def fold_items(item_stream: DataFrame, folder: str, checkpoint: str, fan_in: int = FAN_IN) -> DataFrame:
    """One row per order over all items that have come, whether or not the order has."""
    return fold_batches(item_stream, lambda batch, _: item_sums(batch), refold_items, folder, checkpoint, fan_in)


def latest_orders(
    order_stream: DataFrame, folder: str, checkpoint: str, version: str | None = None, fan_in: int = FAN_IN
) -> DataFrame:
    """Each order as it was last: with the greatest ``version``, or else as the last batch had it.

    Of rows that are equal in that, the greatest one stays, column by column, so that a repeated
    batch chooses the same.
    """
    columns = [c for c in order_stream.columns if c != "order_id"]

    def fold(batch: DataFrame, number: int) -> DataFrame:
        at = F.col(version) if version else F.lit(number).cast("long")
        rows = batch.select("order_id", F.struct(at.alias("_at"), *columns).alias("_last"))
        return last(rows)

    def last(rows: DataFrame) -> DataFrame:
        return rows.groupBy("order_id").agg(F.max("_last").alias("_last"))

    found = fold_batches(order_stream, fold, last, folder, checkpoint, fan_in)
    return found.select("order_id", *[F.col("_last")[c].alias(c) for c in columns])


def daily_sales(
    item_stream: DataFrame,
    orders: DataFrame,
    folder: str,
    checkpoint: str,
    delivered: str = "delivered",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Totals per day of purchase over all items that have come of the orders as they are now."""
    folds = fold_items(item_stream, folder, checkpoint, fan_in)
    bought = orders.where(F.col("order_status") == delivered).select("order_id", PURCHASED)
    day = F.col(PURCHASED).cast("date").cast("timestamp_ntz")
    return (
        folds.join(bought, "order_id")
        .groupBy(day.alias("day"))
        .agg(
            F.sum("price").alias("revenue"),
            F.sum("freight_value").alias("freight_cost"),
            F.sum("items").cast("long").alias("items"),
        )
    )


def order_sales_stream(
    item_stream: DataFrame,
    orders: DataFrame,
    folder: str,
    checkpoint: str,
    delivered: str = "delivered",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per order over all items that have come, as the monthly reports take them."""
    return sales_of_folds(orders, fold_items(item_stream, folder, checkpoint, fan_in), delivered)


def waiting_items(folds: DataFrame, orders: DataFrame) -> DataFrame:
    """The folds whose order has not come."""
    return folds.join(orders.select("order_id"), "order_id", "left_anti")


# Registers of a sketch, as a power of two. The estimate's standard error is 1.04 / sqrt(2 ** 12), 1.6 %;
# a few hundred customers are counted nearly exactly.
SKETCH_LOG = 12


def estimated_customers(
    order_stream: DataFrame, folder: str, checkpoint: str, fan_in: int = FAN_IN, log: int = SKETCH_LOG
) -> DataFrame:
    """Days of purchase with about how many customers bought then, and the standard error of that.

    For when exact counts (``latest_orders`` and a distinct count) cost too much: a day is one sketch of
    at most ``2 ** log`` bytes or so, whatever its orders, and sketches of batches are merged. Any
    order that has come counts, whatever became of it later, as nothing can be taken out of a sketch.
    """

    def fold(batch: DataFrame, _: int) -> DataFrame:
        day = F.col(PURCHASED).cast("date").alias("day")
        text = F.col("customer_id").cast("string")
        return batch.groupBy(day).agg(F.hll_sketch_agg(text, F.lit(log)).alias("sketch"))

    def merged(parts: DataFrame) -> DataFrame:
        return parts.groupBy("day").agg(F.hll_union_agg("sketch").alias("sketch"))

    found = fold_batches(order_stream, fold, merged, folder, checkpoint, fan_in)
    return found.select(
        "day",
        F.hll_sketch_estimate("sketch").alias("customers"),
        F.lit(1.04 / 2 ** (log / 2)).alias("standard_error"),
    )


def months_from_days(days: DataFrame) -> DataFrame:
    """Roll closed days up to months."""
    return days.groupBy(month_of("day").alias("month")).agg(
        F.sum("revenue").cast("double").alias("revenue"),
        F.sum("freight_cost").cast("double").alias("freight_cost"),
        F.sum("items").alias("items"),
    )
