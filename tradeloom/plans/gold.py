"""Gold tables: the reporting fact table and four aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.buckets import Bands
from tradeloom.functions.measures import exact_sum, item_avg, item_count, percent

# Columns and column order of the fact table.
FACT_COLUMNS = (
    "order_id", "order_item_id", "customer_id", "customer_unique_id", "product_id",
    "seller_id", "order_status", "order_purchase_date", "order_purchase_timestamp",
    "order_delivered_customer_date", "order_estimated_delivery_date", "item_price",
    "freight_value", "total_payment_value", "payment_type", "payment_installments",
    "review_score", "customer_city", "customer_state", "category_english",
    "product_category_name", "product_weight_g", "seller_city", "seller_state",
    "delivery_days", "estimated_days", "delivery_delay_days", "is_late_delivery",
    "purchase_year", "purchase_month", "purchase_quarter", "year_month",
)

# Delivery speed bands of the delivery report. Deliveries dated
# before the purchase have no band.
REPORT_BANDS = Bands(
    (
        ("1-3 days", 3),
        ("4-7 days", 7),
        ("8-14 days", 14),
        ("15-21 days", 21),
        ("22+ days", None),
    ),
    floor=0,
)


def _delivered() -> Column:
    return F.col("order_status") == "delivered"


def _on_time() -> Column:
    return _delivered() & ~F.col("is_late_delivery")


def fact_orders(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


def monthly_revenue(enriched: DataFrame, weight: str | None = None) -> DataFrame:
    """Orders, items, revenue and delivery counts per purchase month.

    ``on_time_deliveries`` and ``delivered_orders`` count items. ``weight`` names
    the number of items per row of a frame with one row per order, whose orders
    are then rows.
    """
    revenue = exact_sum("item_price")
    orders = F.countDistinct("order_id") if weight is None else F.count("*")
    return (
        enriched.where(F.col("purchase_year").isNotNull())
        .groupBy(
            F.col("purchase_year").alias("year"),
            F.col("purchase_month").alias("month"),
            "year_month",
        )
        .agg(
            orders.alias("total_orders"),
            item_count(weight=weight).alias("total_items"),
            F.round(revenue, 2).alias("total_revenue"),
            F.round(exact_sum("freight_value"), 2).alias("total_freight"),
            F.round(revenue / orders, 2).alias("avg_order_value"),
            F.countDistinct("customer_unique_id").alias("unique_customers"),
            item_avg("review_score", 3, weight).alias("avg_review_score"),
            item_count(_on_time(), weight).alias("on_time_deliveries"),
            item_count(_delivered(), weight).alias("delivered_orders"),
        )
    )


def seller_performance(enriched: DataFrame, sellers: DataFrame) -> DataFrame:
    """Sales, delivery and review figures per seller, with the place names of
    the seller table.

    ``avg_order_value`` is the average item price, as the column has always
    been defined, not revenue per order. Items are added up per seller and order
    first, which makes orders rows, and customers too, as an order has one.
    """
    sold = enriched.where(F.col("seller_id").isNotNull())
    by_order = sold.groupBy("seller_id", "order_id").agg(
        F.count("*").alias("_items"),
        F.count("item_price").alias("_priced"),
        exact_sum("item_price").alias("item_price"),
        F.max("customer_unique_id").alias("customer_unique_id"),
        *[f(c).alias(f"_{name}_{c}") for c in ("delivery_days", "review_score")
          for name, f in (("sum", F.sum), ("n", F.count))],
        F.count_if(_on_time()).alias("_on_time"),
        F.count_if(_delivered()).alias("_delivered"),
        F.min("order_purchase_date").alias("_first"),
        F.max("order_purchase_date").alias("_last"),
    )
    revenue = exact_sum("item_price")
    on_time, delivered = F.sum("_on_time"), F.sum("_delivered")

    def average(name: str, digits: int) -> Column:
        total = F.sum(f"_sum_{name}").cast("double")
        return F.round(F.try_divide(total, F.sum(f"_n_{name}")), digits)

    by_seller = by_order.groupBy("seller_id").agg(
        F.count("*").alias("total_orders"),
        F.sum("_items").alias("total_items"),
        F.round(revenue, 2).alias("total_revenue"),
        F.round(F.try_divide(revenue, F.sum("_priced")), 2).alias("avg_order_value"),
        F.countDistinct("customer_unique_id").alias("unique_customers"),
        average("delivery_days", 2).alias("avg_delivery_days"),
        average("review_score", 3).alias("avg_review_score"),
        on_time.alias("on_time_deliveries"),
        delivered.alias("delivered_orders"),
        percent(on_time, delivered, 1).alias("on_time_pct"),
        F.min("_first").alias("first_order_date"),
        F.max("_last").alias("last_order_date"),
    )
    categories = sold.select("seller_id", "category_english").distinct().groupBy("seller_id").agg(
        F.count("category_english").alias("distinct_categories"))
    places = sellers.select("seller_id", "seller_city", "seller_state")
    return by_seller.join(categories, "seller_id").join(places, "seller_id", "left").select(
        "seller_id", "seller_city", "seller_state", "total_orders", "total_items", "total_revenue",
        "avg_order_value", "distinct_categories", "unique_customers", "avg_delivery_days",
        "avg_review_score", "on_time_deliveries", "delivered_orders", "on_time_pct",
        "first_order_date", "last_order_date",
    )


def product_category(enriched: DataFrame) -> DataFrame:
    """Sales, share of revenue and averages per category.

    The share's denominator is the revenue of all items, those without category
    included, so shares need not add up to 100. It is added up over the finished
    categories, one row each.
    """
    revenue, orders = exact_sum("item_price"), F.countDistinct("order_id")
    by_category = enriched.groupBy("category_english", "product_category_name").agg(
        orders.alias("total_orders"),
        F.count("*").alias("total_items"),
        revenue.alias("_revenue"),
        F.round(revenue / orders, 2).alias("avg_order_value"),
        F.countDistinct("seller_id").alias("distinct_sellers"),
        item_avg("review_score", 3).alias("avg_review_score"),
        item_avg("delivery_days", 1).alias("avg_delivery_days"),
        item_avg("product_weight_g", 0).alias("avg_weight_g"),
    )
    every = Window.partitionBy()
    total = F.sum(F.col("_revenue").cast("decimal(38,18)")).over(every).cast("double")
    share = F.try_divide(F.col("_revenue") * 100.0, F.col("_total"))
    return by_category.withColumn("_total", total).where("category_english is not null").select(
        "category_english",
        "product_category_name",
        "total_orders",
        "total_items",
        F.round("_revenue", 2).alias("total_revenue"),
        F.round(share, 2).alias("revenue_share_pct"),
        "avg_order_value",
        "distinct_sellers",
        "avg_review_score",
        "avg_delivery_days",
        "avg_weight_g",
    )


def delivery_performance(
    enriched: DataFrame, weight: str | None = None, bands: Bands = REPORT_BANDS
) -> DataFrame:
    """Distinct delivered orders, their share and review average per speed band.

    Orders without a band count in the denominator but get no row. An order is
    in one band, so the denominator is the sum over all bands.
    """
    days = F.col("delivery_days")
    by_band = (
        enriched.where(_delivered() & days.isNotNull())
        .groupBy(
            bands.label(days).alias("delivery_bucket"), bands.ordinal(days).alias("bucket_order")
        )
        .agg(
            (F.countDistinct("order_id") if weight is None else F.count("*")).alias("order_count"),
            item_avg("review_score", 2, weight).alias("avg_review_score"),
        )
    )
    every = F.sum("order_count").over(Window.partitionBy())
    return by_band.withColumn("_all", every).where("delivery_bucket is not null").select(
        "delivery_bucket",
        "bucket_order",
        "order_count",
        percent(F.col("order_count"), F.col("_all"), 1).alias("pct_of_delivered"),
        "avg_review_score",
    )
