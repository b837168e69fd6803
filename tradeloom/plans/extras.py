"""Figures that the reporting documents name besides the built tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.measures import exact_sum, item_count, percent
from tradeloom.operators.history import year_over_year
from tradeloom.plans.gold import _delivered, _on_time


def revenue_yoy(monthly: DataFrame) -> DataFrame:
    """Monthly revenue with last year's value and the change in percent."""
    return year_over_year(
        monthly.select("year", "month", "year_month", "total_revenue"), "total_revenue"
    )


def monthly_on_time(enriched: DataFrame, weight: str | None = None) -> DataFrame:
    """Late and on-time items and freight per order by purchase month."""
    on_time = item_count(_on_time(), weight)
    delivered = item_count(_delivered(), weight)
    late = item_count(_delivered() & F.col("is_late_delivery"), weight)
    freight = exact_sum("freight_value") / F.countDistinct("order_id")
    return enriched.groupBy(
        F.col("purchase_year").alias("year"), F.col("purchase_month").alias("month"), "year_month"
    ).agg(
        on_time.alias("on_time_deliveries"),
        late.alias("late_deliveries"),
        percent(on_time, delivered, 1).alias("on_time_pct"),
        F.round(freight, 2).alias("avg_freight_value"),
    )


def order_level_kpis(enriched: DataFrame) -> DataFrame:
    """The delivery figures counted per order instead of per item."""
    orders = enriched.groupBy("order_id").agg(
        F.bool_or(_delivered()).alias("delivered"),
        F.bool_or("is_late_delivery").alias("late"),
        F.max("total_payment_value").alias("paid"),
    )
    late = F.count_if("late")
    delivered = F.count_if("delivered")
    return orders.agg(
        F.count("*").alias("total_orders"),
        delivered.alias("delivered_orders"),
        late.alias("late_orders"),
        percent(F.count_if(F.col("late") & F.col("delivered")), delivered, 1).alias("late_order_pct"),
        F.round(exact_sum("paid"), 0).alias("order_gmv"),
    )


def seller_products(enriched: DataFrame) -> DataFrame:
    """Distinct products each seller has sold."""
    return (
        enriched.where(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(F.countDistinct("product_id").alias("total_products"))
    )


def category_photos(enriched: DataFrame) -> DataFrame:
    """Average number of product photos per sold item of a category."""
    return (
        enriched.where(F.col("category_english").isNotNull())
        .groupBy("category_english")
        .agg(F.round(F.avg("product_photos_qty"), 2).alias("avg_product_photos"))
    )
