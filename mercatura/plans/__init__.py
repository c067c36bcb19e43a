from mercatura.plans.customers import customer_behavior, customer_metrics
from mercatura.plans.products import category_analysis, product_performance
from mercatura.plans.sales import sales_patterns, time_metrics
from mercatura.plans.sellers import seller_metrics, seller_performance

__all__ = [
    "category_analysis",
    "customer_behavior",
    "customer_metrics",
    "product_performance",
    "sales_patterns",
    "seller_metrics",
    "seller_performance",
    "time_metrics",
]
