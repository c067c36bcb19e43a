"""Table names, input schemas and the bundle of DataFrames the reports take."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# pandas' default missing-value tokens, matched exactly and untrimmed.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

PRICE = T.DecimalType(12, 2)
FREIGHT = T.DecimalType(14, 4)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# Only the columns the reports use. A CSV may hold more; those are read as text.
SCHEMAS: dict[str, T.StructType] = {
    "customers": _struct(customer_id=T.StringType(), customer_state=T.StringType()),
    "orders": _struct(
        order_id=T.StringType(),
        customer_id=T.StringType(),
        order_status=T.StringType(),
        order_purchase_timestamp=T.TimestampNTZType(),
        order_delivered_carrier_date=T.TimestampNTZType(),
        order_delivered_customer_date=T.TimestampNTZType(),
    ),
    "order_items": _struct(
        order_id=T.StringType(),
        product_id=T.StringType(),
        seller_id=T.StringType(),
        price=PRICE,
        freight_value=FREIGHT,
    ),
    "products": _struct(product_id=T.StringType(), product_category_name=T.StringType()),
    "sellers": _struct(seller_id=T.StringType(), seller_state=T.StringType()),
    "order_reviews": _struct(order_id=T.StringType(), review_score=T.IntegerType()),
    "order_payments": _struct(order_id=T.StringType()),
    "category_translation": _struct(
        product_category_name=T.StringType(), product_category_name_english=T.StringType()
    ),
}


@dataclass(frozen=True)
class Tables:
    """The inputs of the reports. The last two may be absent."""

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    sellers: DataFrame
    order_reviews: DataFrame
    category_translation: DataFrame | None = None
    order_payments: DataFrame | None = None

    def present(self) -> dict[str, DataFrame]:
        """The tables there are, by name."""
        named = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in named.items() if df is not None}
