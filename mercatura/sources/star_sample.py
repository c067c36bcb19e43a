"""The report inputs as views on a TPC-H-like star schema in parquet.

Plain projections, so filters and column pruning reach the scans. Delivery dates come from
the ship date and sit on the items; the status keeps its raw value, with "F" for delivered.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura.operators.folding import fold_for_join
from mercatura.schema import FREIGHT, PRICE

DELIVERED = "F"

# Line number without ship date, brand without category, types with a translation.
UNSHIPPED_LINE = 7
UNNAMED_BRAND = "Brand#13"
TRANSLATED_TYPES = ("PROMO", "SMALL")


def path_of(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path_of(sf_dir, name))


def orders(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def order_items(source: DataFrame) -> DataFrame:
    shipped = F.when(F.col("l_linenumber") != UNSHIPPED_LINE, F.col("l_shipdate"))
    return source.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").cast(PRICE).alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).cast(FREIGHT).alias("freight_value"),
        shipped.alias("order_delivered_carrier_date"),
        shipped.alias("order_delivered_customer_date"),
    )


def _raw_category() -> Column:
    return F.concat_ws(" ", "p_name", "p_brand")


class StarSample:
    """The report inputs, each read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark = spark
        self._dir = sf_dir

    def _read(self, name: str) -> DataFrame:
        return read(self._spark, self._dir, name)

    def _nation(self) -> DataFrame:
        return self._read("nation").select("n_nationkey", "n_name")

    @cached_property
    def customers(self) -> DataFrame:
        in_nation = F.col("c_nationkey") == F.col("n_nationkey")
        return (
            self._read("customer")
            .join(self._nation(), in_nation)
            .select(
                F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("customer_state")
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        return orders(self._read("orders"))

    @cached_property
    def order_items(self) -> DataFrame:
        return order_items(self._read("lineitem"))

    @cached_property
    def products(self) -> DataFrame:
        named = F.when(F.col("p_brand") != UNNAMED_BRAND, _raw_category())
        return self._read("part").select(
            F.col("p_partkey").alias("product_id"), named.alias("product_category_name")
        )

    @cached_property
    def sellers(self) -> DataFrame:
        in_nation = F.col("s_nationkey") == F.col("n_nationkey")
        return (
            self._read("supplier")
            .join(self._nation(), in_nation)
            .select(F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_state"))
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        return self._read("events").select(
            F.floor(F.col("event_id") / 2).alias("order_id"),
            (F.col("user_id") % 5 + 1).cast("int").alias("review_score"),
        )

    @cached_property
    def category_translation(self) -> DataFrame:
        named = self._read("part").where(F.col("p_type").isin(*TRANSLATED_TYPES))
        # Folded with a shuffle of its own to follow, so that AQE can split the join's hot keys.
        return fold_for_join(
            named.select(_raw_category().alias("product_category_name"), "p_name"),
            "product_category_name",
            F.min("p_name").alias("product_category_name_english"),
        )
