"""Silver tables: cleaned dimensions, one review and payment row per order, and
the wide order-item table."""

from __future__ import annotations

import datetime
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import (
    calendar_parts,
    days_between,
    is_late,
    tidy_city,
    tidy_state,
    volume,
)
from tradeloom.functions.measures import exact_sum
from tradeloom.operators.joins import SLOT, SPREAD, fk_join, hot_keys, with_slot, with_spread
from tradeloom.operators.ranking import dominant_by, latest_by

# Fixed value: start of validity of a customer without any order.
NO_ORDER_VALID_FROM = datetime.date(2016, 1, 1)

# Columns and column order of the wide order-item table.
ENRICHED_COLUMNS = (
    "order_id", "order_item_id", "customer_id", "customer_unique_id", "product_id",
    "seller_id", "order_status", "order_purchase_date", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "item_price", "freight_value", "total_payment_value", "payment_type",
    "payment_installments", "review_score", "review_comment_message",
    "customer_city", "customer_state", "customer_zip_code_prefix",
    "customer_valid_from", "category_english", "product_category_name",
    "product_photos_qty", "product_weight_g", "volume_cm3", "seller_city",
    "seller_state", "delivery_days", "estimated_days", "delivery_delay_days",
    "is_late_delivery", "purchase_year", "purchase_month", "purchase_quarter",
    "year_month",
)


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with tidy place names and validity columns.

    A version is valid from the customer's first order. All rows of a snapshot
    are current; ``operators.history.apply_changes`` adds later versions.
    """
    first_orders = (
        orders.where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy("customer_id")
        .agg(F.min(F.to_date("order_purchase_timestamp")).alias("_first_order"))
    )
    return customers.join(first_orders, "customer_id", "left").select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        tidy_city("customer_city").alias("customer_city"),
        tidy_state("customer_state").alias("customer_state"),
        F.coalesce("_first_order", F.lit(NO_ORDER_VALID_FROM)).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_products(products: DataFrame, category_translation: DataFrame) -> DataFrame:
    """Products with corrected column names, English category and volume.

    A category without translation keeps its own name.
    """
    key = "product_category_name"
    return fk_join(products, category_translation, key).select(
        "product_id",
        key,
        F.coalesce("product_category_name_english", key).alias("category_english"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        volume("product_length_cm", "product_height_cm", "product_width_cm").alias("volume_cm3"),
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        "seller_zip_code_prefix",
        tidy_city("seller_city").alias("seller_city"),
        tidy_state("seller_state").alias("seller_state"),
    )


def reviews_latest(order_reviews: DataFrame) -> DataFrame:
    """The newest review per order: by answer time, creation date, then id."""
    keyed = order_reviews.where(
        F.col("review_id").isNotNull() & F.col("order_id").isNotNull()
    ).select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    )
    return latest_by(
        keyed, ["order_id"], ["review_answer_timestamp", "review_creation_date", "review_id"]
    )


def payments_by_order(order_payments: DataFrame) -> DataFrame:
    """One row per order: total paid, number of parts, and type and instalments
    of the largest part (the earliest one if several are equal)."""
    return dominant_by(
        order_payments.where(F.col("order_id").isNotNull()),
        ["order_id"],
        "payment_value",
        {"dominant_payment_type": "payment_type", "installments": "payment_installments"},
        total="total_payment_value",
        parts="payment_parts",
        first=["payment_sequential"],
    )


# Which columns each lookup table gives the wide table, under which name.
LOOKUP_COLUMNS = {
    "payments": {
        "total_payment_value": "total_payment_value",
        "payment_type": "dominant_payment_type",
        "payment_installments": "installments",
    },
    "reviews": {
        "review_score": "review_score",
        "review_comment_message": "review_comment_message",
    },
    "customers": {
        "customer_unique_id": "customer_unique_id",
        "customer_city": "customer_city",
        "customer_state": "customer_state",
        "customer_zip_code_prefix": "customer_zip_code_prefix",
        "customer_valid_from": "valid_from",
    },
    "products": {
        "category_english": "category_english",
        "product_category_name": "product_category_name",
        "product_photos_qty": "product_photos_qty",
        "product_weight_g": "product_weight_g",
        "volume_cm3": "volume_cm3",
    },
    "sellers": {"seller_city": "seller_city", "seller_state": "seller_state"},
}


_SINGLE_ITEM_COLUMNS = {
    "order_item_id", "product_id", "seller_id", *LOOKUP_COLUMNS["products"], *LOOKUP_COLUMNS["sellers"],
}


# Number of items per row of a frame with one row per order.
ITEMS = "items"


def lookups_for(keep: Collection[str]) -> list[str]:
    """The lookup tables that ``enrich_orders`` needs for these columns."""
    kept = set(keep)
    return [name for name, columns in LOOKUP_COLUMNS.items() if kept & set(columns)]


def enrich_orders(
    orders: DataFrame,
    order_items: DataFrame,
    lookups: Mapping[str, DataFrame],
    keep: Collection[str] = ENRICHED_COLUMNS,
    per_order: bool = False,
) -> DataFrame:
    """One row per order item with everything known about it.

    ``orders`` and ``order_items`` are raw tables. ``lookups`` holds the silver
    tables under the names of ``LOOKUP_COLUMNS``, each with one (current) row
    per key. Orders without items drop out, as do orders without id or purchase
    time.

    ``keep`` limits the columns; a lookup none of whose columns is kept is left
    out, as it neither adds nor removes rows. Order lookups are joined at order
    level and item lookups at item level, so each row is widened before the one
    join that brings the two together on ``order_id``.

    ``per_order`` gives one row per order instead, with the number of its
    ``items`` and their summed price and freight. Counts, sums and averages over
    items follow from it, and items are added up before they are shuffled, so it
    serves aggregates best; columns of single items cannot be kept.
    """
    single = set(keep) & _SINGLE_ITEM_COLUMNS
    if per_order and single:
        raise ValueError(f"not known for several items together: {sorted(single)}")
    kept = set(keep)
    keep = [c for c in ENRICHED_COLUMNS if c in kept]
    chosen = {
        name: [
            F.col(source).alias(column)
            for column, source in LOOKUP_COLUMNS[name].items()
            if column in kept
        ]
        for name in lookups_for(keep)
    }

    def lookup(name: str, key: str, table: DataFrame | None = None) -> dict[str, DataFrame]:
        if name not in chosen:
            return {}
        table = lookups[name] if table is None else table
        return {key: table.select(key, *chosen[name])}

    # Worked out after the last join where their sources are kept anyway: less to shuffle.
    late = {
        c: value for c, (value, sources) in _derived().items()
        if c in kept and kept.issuperset(sources) and not per_order
    }
    order_level = _order_level(
        orders,
        lookup(
            "customers",
            "customer_id",
            lookups["customers"].where("is_current") if "customers" in chosen else None,
        ),
        [*lookup("payments", "order_id").values(), *lookup("reviews", "order_id").values()],
        [c for c in keep if c not in late],
    )
    item_lookups = {**lookup("products", "product_id"), **lookup("sellers", "seller_id")}
    if per_order:
        money = {"item_price": "price", "freight_value": "freight_value"}
        sums = [exact_sum(money[c]).alias(c) for c in keep if c in money]
        added_up = order_items.groupBy("order_id").agg(F.count("*").alias(ITEMS), *sums)
        return added_up.join(order_level, "order_id").select(*keep, ITEMS)
    # Orders come partitioned by the joins below, so adaptive execution cannot split them.
    hot = hot_keys(order_items, "order_id")
    item_level = with_slot(with_spread(order_items), "order_id", hot).drop(SPREAD)
    for key, table in item_lookups.items():
        item_level = fk_join(item_level, table, key)
    item_level = item_level.withColumnRenamed("price", "item_price")
    item_columns = [c for c in keep if c in item_level.columns and c != "order_id"]
    item_level = item_level.select("order_id", *item_columns, SLOT)
    joined = fk_join(item_level, order_level, "order_id", "inner", hot)
    return joined.select(*[late[c].alias(c) if c in late else c for c in keep])


def _derived() -> dict[str, tuple[Column, set[str]]]:
    """Columns derived from an order's own, and what they are derived from."""
    purchase, delivered, promised = (
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return {
        "order_purchase_date": (F.to_date(purchase), {purchase}),
        "delivery_days": (days_between(delivered, purchase), {delivered, purchase}),
        "estimated_days": (days_between(promised, purchase), {promised, purchase}),
        "delivery_delay_days": (days_between(delivered, promised), {delivered, promised}),
        "is_late_delivery": (is_late(delivered, promised), {delivered, promised}),
        **{c: (value, {purchase}) for c, value in calendar_parts(purchase, "purchase").items()},
    }


def _order_level(
    orders: DataFrame,
    by_customer: Mapping[str, DataFrame],
    by_order: Sequence[DataFrame],
    keep: Sequence[str],
) -> DataFrame:
    """Orders with their lookups and derived columns, cut down to ``keep``."""
    usable = orders.where(
        F.col("order_id").isNotNull() & F.col("order_purchase_timestamp").isNotNull()
    )
    # Customers first: the order_id joins that follow share one exchange.
    for key, table in by_customer.items():
        usable = fk_join(usable, table, key)
    for table in by_order:
        usable = usable.join(table, "order_id", "left")
    derived = {c: value for c, (value, _) in _derived().items()}
    present = set(usable.columns) - {"order_id"}
    return usable.select(
        "order_id",
        *[
            derived[c].alias(c) if c in derived else F.col(c)
            for c in keep
            if c in derived or c in present
        ],
    )
