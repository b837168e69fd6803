"""Build every table in dependency order from the raw tables.

Each step reads tables that the steps before it have written, so nothing is
computed twice and a failed run can resume at any layer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tradeloom.operators.quality import row_counts
from tradeloom.plans import dashboards, gold, silver
from tradeloom.sources.tables import materialize

SILVER_COMMENTS = {
    "dim_customers": "Customers with tidy place names and validity dates",
    "dim_products": "Products with English category and volume",
    "dim_sellers": "Sellers with tidy place names",
    "order_reviews_deduped": "Newest review of each order",
    "order_payments_agg": "Payments summed per order, with the largest part's type",
    "orders_enriched": "Order items with all dimensions and delivery measures",
    "orders_added_up": "Items added up per order, with order measures",
}
GOLD_COMMENTS = {
    "fact_orders": "Order items for reporting",
    "agg_monthly_revenue": "Revenue, orders and delivery counts per month",
    "agg_seller_performance": "Sales, delivery and review figures per seller",
    "agg_product_category": "Sales and share of revenue per category",
    "agg_delivery_performance": "Orders and reviews per delivery speed band",
}
CUBE = "item_count_cube"
# Items added up per order, for aggregates that need no single item.
BY_ORDER = "orders_added_up"
ORDER_COLUMNS = (
    "order_id", "order_status", "purchase_year", "purchase_month", "year_month", "item_price",
    "freight_value", "customer_unique_id", "review_score", "delivery_days", "is_late_delivery",
)


@dataclass(frozen=True)
class Layers:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"


def _write_all(
    spark: SparkSession,
    steps: Mapping[str, Callable[[], DataFrame]],
    layer: str,
    comments: Mapping[str, str],
    at_once: int,
    **options,
) -> dict[str, int]:
    """Write independent tables, ``at_once`` jobs side by side.

    Small tables then fill the cluster while a large one finishes its tail.
    """
    def write(name: str) -> int:
        return materialize(
            steps[name](), f"{layer}.{name}", comment=comments.get(name), **options
        )

    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(in_session(write), name) for name in steps}
        return {name: job.result() for name, job in running.items()}


def build_silver(
    spark: SparkSession, layers: Layers = Layers(), fmt: str = "parquet", at_once: int = 4
) -> dict[str, int]:
    def raw(name: str) -> DataFrame:
        return spark.table(f"{layers.bronze}.{name}")

    def clean(name: str) -> DataFrame:
        return spark.table(f"{layers.silver}.{name}")

    lookups = {
        "dim_customers": lambda: silver.dim_customers(raw("customers"), raw("orders")),
        "dim_products": lambda: silver.dim_products(raw("products"), raw("category_translation")),
        "dim_sellers": lambda: silver.dim_sellers(raw("sellers")),
        "order_reviews_deduped": lambda: silver.reviews_latest(raw("order_reviews")),
        "order_payments_agg": lambda: silver.payments_by_order(raw("order_payments")),
    }
    def enriched(keep, per_order: bool) -> DataFrame:
        tables = {
            "payments": "order_payments_agg",
            "reviews": "order_reviews_deduped",
            "customers": "dim_customers",
            "products": "dim_products",
            "sellers": "dim_sellers",
        }
        found = {name: clean(tables[name]) for name in silver.lookups_for(keep)}
        return silver.enrich_orders(raw("orders"), raw("order_items"), found, keep, per_order)

    wide = {
        "orders_enriched": lambda: enriched(silver.ENRICHED_COLUMNS, False),
        BY_ORDER: lambda: enriched(ORDER_COLUMNS, True),
    }
    options = {"fmt": fmt, "stamp": True}
    counts = _write_all(spark, lookups, layers.silver, SILVER_COMMENTS, at_once, **options)
    return counts | _write_all(spark, wide, layers.silver, SILVER_COMMENTS, at_once, **options)


def build_gold(
    spark: SparkSession,
    layers: Layers = Layers(),
    fmt: str = "parquet",
    at_once: int = 4,
    fact_partitions: tuple[str, ...] = (),
    fact_order: tuple[str, ...] = (),
) -> dict[str, int]:
    """``fact_partitions=("year_month",)`` lets month filters skip files, and
    ``fact_order`` files and row groups without a folder for each month."""
    enriched = spark.table(f"{layers.silver}.orders_enriched")
    by_order = spark.table(f"{layers.silver}.{BY_ORDER}")
    sellers = spark.table(f"{layers.silver}.dim_sellers")
    fact = {"fact_orders": lambda: gold.fact_orders(enriched)}
    aggregates = {
        "agg_monthly_revenue": lambda: gold.monthly_revenue(by_order, silver.ITEMS),
        "agg_seller_performance": lambda: gold.seller_performance(enriched, sellers),
        "agg_product_category": lambda: gold.product_category(enriched),
        "agg_delivery_performance": lambda: gold.delivery_performance(by_order, silver.ITEMS),
    }
    options = {"fmt": fmt, "stamp": True}
    if not fact_partitions and not fact_order:
        both = {**fact, **aggregates}
        return _write_all(spark, both, layers.gold, GOLD_COMMENTS, at_once, **options)
    counts = _write_all(
        spark, fact, layers.gold, GOLD_COMMENTS, at_once,
        partition_by=fact_partitions, order_by=fact_order, **options
    )
    return counts | _write_all(spark, aggregates, layers.gold, GOLD_COMMENTS, at_once, **options)


def build_dashboards(
    spark: SparkSession,
    layers: Layers = Layers(),
    settings: dashboards.Settings = dashboards.Settings(),
    fmt: str = "parquet",
    at_once: int = 4,
    from_cube: bool = True,
) -> dict[str, int]:
    """Write the fifteen cross-tabs.

    By default the fact table is read once for a small cube that gives the
    twelve additive tables, and once more for each of the three KPI tables.
    """
    fact = spark.table(f"{layers.gold}.fact_orders")
    cube = None
    if from_cube:
        materialize(dashboards.count_cube(fact, settings), f"{layers.gold}.{CUBE}", fmt=fmt)
        cube = spark.table(f"{layers.gold}.{CUBE}")
    additive = dashboards.from_cube_tables()

    def table(name: str) -> DataFrame:
        if cube is not None and name in additive:
            return dashboards.cross_tab_from_cube(name, cube, settings)
        return dashboards.cross_tab(name, fact, settings)

    prefix = "cross_tab_"
    comments = {prefix + name: text for name, text in dashboards.comments().items()}
    steps = {prefix + name: partial(table, name) for name in dashboards.CROSS_TABS}
    return _write_all(spark, steps, layers.gold, comments, at_once, fmt=fmt)


def build_all(
    spark: SparkSession,
    layers: Layers = Layers(),
    settings: dashboards.Settings = dashboards.Settings(),
    fmt: str = "parquet",
    at_once: int = 4,
) -> dict[str, int]:
    return {
        **build_silver(spark, layers, fmt, at_once),
        **build_gold(spark, layers, fmt, at_once),
        **build_dashboards(spark, layers, settings, fmt, at_once),
    }


def layer_counts(spark: SparkSession, layer: str, names: Iterable[str]) -> DataFrame:
    return row_counts({name: spark.table(f"{layer}.{name}") for name in names})
