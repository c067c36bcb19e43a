from mercatura.streaming.sales import (
    append_available,
    daily_sales,
    estimated_customers,
    fold_batches,
    fold_items,
    latest_orders,
    months_from_days,
    order_sales_stream,
    stream_parquet,
    waiting_items,
)
from mercatura.streaming.store import FoldStore

__all__ = [
    "FoldStore",
    "append_available",
    "daily_sales",
    "estimated_customers",
    "fold_batches",
    "fold_items",
    "latest_orders",
    "months_from_days",
    "order_sales_stream",
    "stream_parquet",
    "waiting_items",
]
