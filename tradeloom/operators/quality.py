"""Row counts, reconciliation and summary profiles."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.measures import exact_avg, exact_sum, item_avg, item_count, percent


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table, in one query."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile_counts(expected: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Compare row counts with ``expected`` (table_name, expected).

    Reports PASS or MISMATCH per table and does not fail.
    """
    actual = row_counts(tables).withColumnRenamed("row_count", "actual")
    matches = F.col("actual").eqNullSafe(F.col("expected"))
    return expected.join(actual, "table_name", "left").select(
        "table_name",
        "expected",
        "actual",
        F.when(matches, "PASS").otherwise("MISMATCH").alias("status"),
    )


def verdict(report: DataFrame, name: str = "all tables") -> DataFrame:
    """One more row for a report: how many tables were expected and passed."""
    passed = F.count_if(F.col("status") == "PASS")
    return report.agg(F.count("*").alias("expected"), passed.alias("actual")).select(
        F.lit(name).alias("table_name"), "expected", "actual",
        F.when(F.col("actual") == F.col("expected"), "PASS").otherwise("MISMATCH").alias("status"))


def all_passed(report: DataFrame) -> bool:
    return report.where(F.col("status") != "PASS").isEmpty()


def expected_counts(spark, counts: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(
        list(counts.items()), "table_name STRING, expected LONG"
    )


def delivered_profile(enriched: DataFrame) -> DataFrame:
    """One-row profile of the delivered items.

    ``total_gmv_brl`` adds the order's payment once per item, so an order with
    several items counts several times: it is a check figure, not revenue.
    """
    rows = enriched.where(F.col("order_status") == "delivered")
    sums = rows.agg(
        F.count("*").alias("total_rows"),
        F.round(exact_sum("total_payment_value"), 0).alias("total_gmv_brl"),
        F.round(exact_avg("item_price"), 2).alias("avg_item_price"),
        item_avg("review_score", 2).alias("avg_review_score"),
        item_avg("delivery_days", 1).alias("avg_delivery_days"),
        F.count_if("is_late_delivery").alias("late_deliveries"),
        F.min("order_purchase_date").alias("earliest_order"),
        F.max("order_purchase_date").alias("latest_order"),
    )
    counted = {
        "distinct_orders": "order_id",
        "distinct_customers": "customer_unique_id",
        "distinct_sellers": "seller_id",
        "distinct_categories": "category_english",
    }
    # One kind of value at a time: several in one aggregation would copy every item.
    distinct = {
        name: rows.select(column).distinct().agg(F.count(column)).scalar().alias(name)
        for name, column in counted.items()
    }
    return sums.select(
        "total_rows", *distinct.values(), *[c for c in sums.columns if c != "total_rows"])


def fact_kpis(fact: DataFrame, weight: str | None = None) -> DataFrame:
    """One-row summary of all items.

    The late share divides late items of any status by delivered items.
    """
    revenue, orders = exact_sum("item_price"), F.countDistinct("order_id")
    late = item_count(F.col("is_late_delivery"), weight)
    delivered = item_count(F.col("order_status") == "delivered", weight)
    return fact.agg(
        orders.alias("total_orders"),
        F.countDistinct("customer_unique_id").alias("unique_customers"),
        F.round(revenue, 0).alias("total_gmv_brl"),
        F.round(F.try_divide(revenue, orders), 2).alias("aov"),
        item_avg("review_score", 2, weight).alias("avg_review_score"),
        item_avg("delivery_days", 1, weight).alias("avg_delivery_days"),
        percent(late, delivered, 1).alias("late_delivery_pct"),
    )
