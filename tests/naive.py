"""The reports in their plain form, as Spark SQL with row-multiplying joins: test oracles."""

CATEGORIES = """
SELECT coalesce(t.product_category_name_english, p.product_category_name) AS category,
       count(DISTINCT p.product_id) AS product_count, count(DISTINCT i.order_id) AS order_count,
       CAST(sum(i.price) AS DOUBLE) AS total_revenue,
       CAST(sum(i.price) AS DOUBLE) / count(i.price) AS avg_price,
       CAST(sum(r.review_score) AS DOUBLE) / nullif(count(r.review_score), 0) AS avg_rating
FROM products p
LEFT JOIN category_translation t ON p.product_category_name = t.product_category_name
JOIN order_items i ON p.product_id = i.product_id
LEFT JOIN order_reviews r ON i.order_id = r.order_id
GROUP BY 1 HAVING count(DISTINCT i.order_id) > {more_than}
"""

SELLERS = """
SELECT s.seller_id, s.seller_state, count(DISTINCT i.order_id) AS total_orders,
       count(DISTINCT i.product_id) AS unique_products,
       CAST(sum(i.price) AS DOUBLE) AS revenue,
       CAST(sum(r.review_score) AS DOUBLE) / nullif(count(r.review_score), 0) AS avg_rating,
       CAST(sum(CAST(timestampdiff(MICROSECOND, o.order_purchase_timestamp,
                                   o.order_delivered_carrier_date) AS DECIMAL(20,0))) AS DOUBLE)
         / nullif(count(timestampdiff(MICROSECOND, o.order_purchase_timestamp,
                                      o.order_delivered_carrier_date)), 0)
         / 3600000000D AS avg_shipping_time
FROM sellers s JOIN order_items i ON s.seller_id = i.seller_id
JOIN orders o ON i.order_id = o.order_id
LEFT JOIN order_reviews r ON i.order_id = r.order_id
GROUP BY s.seller_id, s.seller_state
"""

MONTHS = """
SELECT CAST(trunc(o.order_purchase_timestamp, 'month') AS TIMESTAMP_NTZ) AS month,
       count(DISTINCT o.order_id) AS orders, count(DISTINCT o.customer_id) AS customers,
       CAST(sum(i.price) AS DOUBLE) AS revenue, CAST(sum(i.freight_value) AS DOUBLE) AS freight,
       CAST(sum(CAST(timestampdiff(MICROSECOND, o.order_purchase_timestamp,
                                   o.order_delivered_customer_date) AS DECIMAL(20,0))) AS DOUBLE)
         / nullif(count(timestampdiff(MICROSECOND, o.order_purchase_timestamp,
                                      o.order_delivered_customer_date)), 0)
         / 86400000000D AS delivery_days
FROM orders o JOIN order_items i ON o.order_id = i.order_id
WHERE o.order_status = 'delivered' GROUP BY 1
"""

CUSTOMERS = """
SELECT c.customer_id, c.customer_state, count(DISTINCT o.order_id) AS order_count,
       CAST(sum(i.price) AS DOUBLE) AS total_spend,
       CAST(sum(i.price) AS DOUBLE) / nullif(count(i.price), 0) AS avg_order_value,
       min(o.order_purchase_timestamp) AS first_order,
       max(o.order_purchase_timestamp) AS last_order
FROM customers c JOIN orders o ON c.customer_id = o.customer_id
JOIN order_items i ON o.order_id = i.order_id
GROUP BY c.customer_id, c.customer_state
"""
