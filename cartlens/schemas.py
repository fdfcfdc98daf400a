"""Explicit schemas of the commerce tables.

Money is double as it arrives; sums go through decimals (operators.aggregates.money_sum).
"""

from __future__ import annotations

from pyspark.sql import types as T


STRING, INT, DOUBLE, TIME = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _struct(columns: dict) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


ORDERS = _struct({
    "order_id": STRING,
    "customer_id": STRING,
    "order_status": STRING,
    "order_purchase_timestamp": TIME,
    "order_approved_at": TIME,
    "order_delivered_carrier_date": TIME,
    "order_delivered_customer_date": TIME,
    "order_estimated_delivery_date": TIME,
})

CUSTOMERS = _struct({
    "customer_id": STRING,
    "customer_unique_id": STRING,
    "customer_zip_code_prefix": INT,
    "customer_city": STRING,
    "customer_state": STRING,
})

ORDER_ITEMS = _struct({
    "order_id": STRING,
    "order_item_id": INT,
    "product_id": STRING,
    "seller_id": STRING,
    "shipping_limit_date": TIME,
    "price": DOUBLE,
    "freight_value": DOUBLE,
})

ORDER_PAYMENTS = _struct({
    "order_id": STRING,
    "payment_sequential": INT,
    "payment_type": STRING,
    "payment_installments": INT,
    "payment_value": DOUBLE,
})

ORDER_REVIEWS = _struct({
    "review_id": STRING,
    "order_id": STRING,
    "review_score": INT,
    "review_comment_title": STRING,
    "review_comment_message": STRING,
    "review_creation_date": STRING,
    "review_answer_timestamp": STRING,
})

SELLERS = _struct({
    "seller_id": STRING,
    "seller_zip_code_prefix": INT,
    "seller_city": STRING,
    "seller_state": STRING,
})

PRODUCTS = _struct({
    "product_id": STRING,
    "product_category_name": STRING,
    "product_name_lenght": DOUBLE,
    "product_description_lenght": DOUBLE,
    "product_photos_qty": DOUBLE,
    "product_weight_g": DOUBLE,
    "product_length_cm": DOUBLE,
    "product_height_cm": DOUBLE,
    "product_width_cm": DOUBLE,
})

CATEGORY_TRANSLATION = _struct({
    "product_category_name": STRING,
    "product_category_name_english": STRING,
})

GEOLOCATION = _struct({
    "geolocation_zip_code_prefix": INT,
    "geolocation_lat": DOUBLE,
    "geolocation_lng": DOUBLE,
    "geolocation_city": STRING,
    "geolocation_state": STRING,
})

TABLES = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
    "sellers": SELLERS,
    "products": PRODUCTS,
    "category_translation": CATEGORY_TRANSLATION,
    "geolocation": GEOLOCATION,
}
