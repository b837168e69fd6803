"""The raw tables, derived from the star-schema test data.

One SQL text per table serves Spark and the DuckDB check. Every view is a plain
projection (two join the 25-row nation table, one is a fixed list), so the work and any skew that
the queries meet is that of the operators. Item and payment numbers are the
line number, which may repeat within an order.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tradeloom.functions.buckets import ValueGroups
from tradeloom.plans.dashboards import Settings

# {name} stands for a test table. Integer formulas stay far from overflow for
# any key below 1e15.
VIEWS = {
    "orders": (("orders",), """
SELECT o_orderkey AS order_id,
  CASE WHEN o_custkey % 10 = 9 THEN o_custkey - 1 ELSE o_custkey END AS customer_id,
  CASE WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'delivered' END AS order_status,
  CASE WHEN o_orderkey % 997 = 5 THEN NULL ELSE o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR END AS order_purchase_timestamp,
  o_orderdate + INTERVAL '1' DAY AS order_approved_at,
  o_orderdate + INTERVAL '2' DAY AS order_delivered_carrier_date,
  CASE WHEN o_orderkey % 10 = 9 THEN NULL ELSE o_orderdate + (o_orderkey * 7 % 33 - 1) * INTERVAL '1' DAY + INTERVAL '10' HOUR END AS order_delivered_customer_date,
  o_orderdate + (5 * CAST(substr(o_orderpriority, 1, 1) AS INT)) * INTERVAL '1' DAY AS order_estimated_delivery_date
FROM {orders}"""),
    "order_items": (("lineitem",), """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
  l_shipdate AS shipping_limit_date, l_extendedprice AS price,
  l_extendedprice * (l_tax + CAST(0.01 AS DOUBLE)) AS freight_value
FROM {lineitem}"""),
    "order_payments": (("lineitem",), """
SELECT CASE WHEN l_orderkey % 50 <> 7 THEN l_orderkey END AS order_id, l_linenumber AS payment_sequential,
  CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto' ELSE 'voucher' END AS payment_type,
  l_linenumber AS payment_installments, l_extendedprice AS payment_value
FROM {lineitem}"""),
    "order_reviews": (("events", "orders"), """
SELECT event_id AS review_id,
  (CASE WHEN event_id % 4 = 3 THEN event_id - 1 ELSE event_id END * 7919) % (SELECT count(*) FROM {orders}) AS order_id,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_type = 'error' THEN 1 WHEN event_type = 'signup' THEN 2
       WHEN event_type = 'click' THEN 3 WHEN event_type = 'view' THEN 4 ELSE 5 END AS review_score,
  CAST(NULL AS STRING) AS review_comment_title, props AS review_comment_message,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS review_creation_date, ts AS review_answer_timestamp
FROM {events}"""),
    "customers": (("customer", "nation"), """
SELECT c_custkey AS customer_id, c_custkey - c_custkey % 3 AS customer_unique_id,
  CAST(c_nationkey AS STRING) AS customer_zip_code_prefix,
  '  ' || lower(c_mktsegment) || ' TOWN ' AS customer_city, ' ' || lower(n_name) AS customer_state
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""),
    "products": (("part",), """
SELECT p_partkey AS product_id,
  CASE WHEN p_brand = 'Brand#25' THEN NULL ELSE lower(p_type) END AS product_category_name,
  CAST(length(p_name) AS INT) AS product_name_lenght, CAST(length(p_name) * 10 AS INT) AS product_description_lenght,
  CAST(p_partkey % 6 AS INT) AS product_photos_qty, p_size * 100 AS product_weight_g,
  CASE WHEN p_partkey % 101 = 3 THEN NULL ELSE p_size END AS product_length_cm,
  p_size + 1 AS product_height_cm, 10 AS product_width_cm
FROM {part}"""),
    "sellers": (("supplier", "nation"), """
SELECT s_suppkey AS seller_id, CAST(s_nationkey AS STRING) AS seller_zip_code_prefix,
  ' ' || lower(n_name) || ' port' AS seller_city, lower(n_name) || ' ' AS seller_state
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""),
    "category_translation": ((), """
SELECT * FROM (VALUES ('promo', 'promo_goods'), ('economy', 'economy_goods'), ('small', 'small_goods'),
  ('medium', 'medium_goods'), ('large', 'large_goods')) AS t(product_category_name, product_category_name_english)"""),
    "geolocation": (("nation",), """
SELECT CAST(n_nationkey AS STRING) AS geolocation_zip_code_prefix, CAST(n_nationkey * 1.5 AS DOUBLE) AS geolocation_lat,
  CAST(n_nationkey * -2.5 AS DOUBLE) AS geolocation_lng, lower(n_name) AS geolocation_city, lower(n_name) AS geolocation_state
FROM {nation}"""),
}

TEST_SETTINGS = Settings(
    categories=ValueGroups(
        {
            "promo_goods": "Promo",
            "economy_goods": "Economy",
            "small_goods": "Small",
            "medium_goods": "Medium",
            "large_goods": "Large",
        }
    ),
    states=tuple(f"NATION_{i}" for i in range(8)),
    months=("1997-01", "1998-08"),
)


@functools.lru_cache(maxsize=None)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def _read(spark: SparkSession, path: str) -> DataFrame:
    """The test files never change, so their footers are read once a session."""
    return spark.read.schema(_schema(spark, path)).parquet(path)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, text = VIEWS[name]
    return spark.sql(text, **{t: _read(spark, f"{sf_dir}/{t}.parquet") for t in tables})


def view_sql(name: str) -> str:
    """The same table as SQL over the registered test tables."""
    tables, text = VIEWS[name]
    return text.format(**{t: t for t in tables}).strip()
