"""Small hand-written tables."""

import datetime


def ts(text):
    return None if text is None else datetime.datetime.fromisoformat(text)


def make(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


ORDERS = """order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp TIMESTAMP,
  order_approved_at TIMESTAMP, order_delivered_carrier_date TIMESTAMP,
  order_delivered_customer_date TIMESTAMP, order_estimated_delivery_date TIMESTAMP"""
ITEMS = """order_id STRING, order_item_id INT, product_id STRING, seller_id STRING,
  shipping_limit_date TIMESTAMP, price DOUBLE, freight_value DOUBLE"""
PAYMENTS = """order_id STRING, payment_sequential INT, payment_type STRING,
  payment_installments INT, payment_value DOUBLE"""
REVIEWS = """review_id STRING, order_id STRING, review_score INT, review_comment_title STRING,
  review_comment_message STRING, review_creation_date TIMESTAMP, review_answer_timestamp TIMESTAMP"""
CUSTOMERS = """customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING,
  customer_city STRING, customer_state STRING"""
PRODUCTS = """product_id STRING, product_category_name STRING, product_name_lenght INT,
  product_description_lenght INT, product_photos_qty INT, product_weight_g INT,
  product_length_cm INT, product_height_cm INT, product_width_cm INT"""
TRANSLATION = "product_category_name STRING, product_category_name_english STRING"
SELLERS = "seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING, seller_state STRING"


def order(order_id, customer_id="c1", status="delivered", bought="2018-01-01 09:00:00",
          delivered="2018-01-05 10:00:00", promised="2018-01-10 00:00:00"):
    return (order_id, customer_id, status, ts(bought), None, None, ts(delivered), ts(promised))


def item(order_id, number=1, product="p1", seller="s1", price=10.0, freight=1.0):
    return (order_id, number, product, seller, None, price, freight)
