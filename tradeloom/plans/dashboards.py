"""The fifteen dashboard cross-tabs, described as data over three families."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.buckets import Bands, ValueGroups
from tradeloom.functions.measures import exact_sum, item_avg, item_count
from tradeloom.operators.crosstab import kpi_by, monthly_by, share_of_parent, share_within

# Speed bands of the dashboard. Unlike the delivery report the
# first one also takes negative days.
DASHBOARD_BANDS = Bands(
    (("1-3d", 3), ("4-7d", 7), ("8-14d", 14), ("15-21d", 21), ("22+d", None))
)

# The five categories shown by name and their display labels.
TOP_CATEGORIES = ValueGroups(
    {
        "health_beauty": "Health & Beauty",
        "watches_gifts": "Watches & Gifts",
        "bed_bath_table": "Bed & Bath",
        "sports_leisure": "Sports & Leisure",
        "computers_accessories": "Computers",
    }
)

# The states shown, and the first and last month.
TOP_STATES = ("SP", "RJ", "MG", "RS", "PR", "SC", "BA", "DF")
MONTHS = ("2017-01", "2018-08")


@dataclass(frozen=True)
class Settings:
    """What the dashboard shows; defaults are the published dashboard's."""

    bands: Bands = DASHBOARD_BANDS
    categories: ValueGroups = field(default_factory=lambda: TOP_CATEGORIES)
    states: tuple[str, ...] = TOP_STATES
    months: tuple[str, str] = MONTHS


@dataclass(frozen=True)
class Dimension:
    """A cross-tab axis: its column, the fact columns it needs and who has it.

    ``where`` says which rows count when the axis filters. ``always`` axes
    filter as a child too; the category axis only filters where it leads.
    """

    name: str
    source: str
    column: Callable[[Settings], Column]
    where: Callable[[Settings], Column]
    always: bool = True


DIMENSIONS = {
    "delivery": Dimension(
        "delivery_bucket",
        "delivery_days",
        lambda s: s.bands.label(F.col("delivery_days")),
        lambda s: F.col("delivery_days").isNotNull(),
    ),
    "review": Dimension(
        "review_score",
        "review_score",
        lambda s: F.col("review_score"),
        lambda s: F.col("review_score").isNotNull(),
    ),
    "category": Dimension(
        "cat_group",
        "category_english",
        lambda s: s.categories.label(F.col("category_english")),
        lambda s: s.categories.contains(F.col("category_english")),
        always=False,
    ),
    "state": Dimension(
        "customer_state",
        "customer_state",
        lambda s: F.col("customer_state"),
        lambda s: F.col("customer_state").isin(*s.states),
    ),
}

# KPI tables: axis -> averages shown besides orders, revenue and order value.
KPI_TABLES = {
    "delivery": ("avg_review", "avg_delivery_days"),
    "review": ("avg_delivery_days",),
    "category": ("avg_review", "avg_delivery_days"),
}
MONTHLY_TABLES = ("delivery", "review", "category")
# Share tables, named child_by_parent -> (parent, child).
SHARE_TABLES = {
    "category_by_delivery": ("delivery", "category"),
    "category_by_review": ("review", "category"),
    "state_by_delivery": ("delivery", "state"),
    "state_by_review": ("review", "state"),
    "state_by_category": ("category", "state"),
    "review_by_delivery": ("delivery", "review"),
    "delivery_by_review": ("review", "delivery"),
    "delivery_by_category": ("category", "delivery"),
    "review_by_category": ("category", "review"),
}
_AVERAGES = {
    "avg_review": ("review_score", 2),
    "avg_delivery_days": ("delivery_days", 1),
}
# Display order of each table when read.
SORT_KEYS = {
    "kpi_by_delivery": ("sort_order",),
    "kpi_by_review": ("review_score",),
    "kpi_by_category": ("gmv desc",),
    "monthly_by_delivery": ("year_month", "bucket_sort"),
    "monthly_by_review": ("year_month", "review_score"),
    "monthly_by_category": ("year_month", "cat_group"),
    "category_by_delivery": ("delivery_bucket", "pct desc"),
    "category_by_review": ("review_score", "pct desc"),
    "state_by_delivery": ("delivery_bucket", "pct desc"),
    "state_by_review": ("review_score", "pct desc"),
    "state_by_category": ("cat_group", "pct desc"),
    "review_by_delivery": ("delivery_bucket", "review_score desc"),
    "delivery_by_review": ("review_score", "bucket_sort"),
    "delivery_by_category": ("cat_group", "bucket_sort"),
    "review_by_category": ("cat_group", "review_score desc"),
}
CROSS_TABS = tuple(SORT_KEYS)


def columns_for(name: str) -> set[str]:
    """The fact columns a cross-tab reads."""
    if name in SHARE_TABLES:
        return {DIMENSIONS[d].source for d in SHARE_TABLES[name]}
    family, axis = name.split("_by_")
    needed = {DIMENSIONS[axis].source, "item_price"}
    if family == "monthly":
        return needed | {"year_month"}
    return needed | {"order_id"} | {_AVERAGES[a][0] for a in KPI_TABLES[axis]}


def _axis(name: str, settings: Settings) -> Column:
    dimension = DIMENSIONS[name]
    return dimension.column(settings).alias(dimension.name)


def _with_band_order(df: DataFrame, settings: Settings, name: str) -> DataFrame:
    return df.withColumn(name, settings.bands.ordinal_of(F.col("delivery_bucket")))


def _share_filter(parent: str, child: str, settings: Settings) -> Column:
    condition = DIMENSIONS[parent].where(settings)
    if DIMENSIONS[child].always:
        condition = condition & DIMENSIONS[child].where(settings)
    return condition


def cross_tab(
    name: str, fact: DataFrame, settings: Settings = Settings(), weight: str | None = None
) -> DataFrame:
    """One of ``CROSS_TABS`` computed from the fact table, rows in no order."""
    if name in SHARE_TABLES:
        parent, child = SHARE_TABLES[name]
        result = share_within(
            fact,
            _axis(parent, settings),
            _axis(child, settings),
            _share_filter(parent, child, settings),
            weight,
        )
        return _with_band_order(result, settings, "bucket_sort") if child == "delivery" else result
    family, axis = name.split("_by_")
    where = DIMENSIONS[axis].where(settings)
    if family == "monthly":
        where = where if DIMENSIONS[axis].always else None
        result = monthly_by(fact, _axis(axis, settings), settings.months, where)
        return _with_band_order(result, settings, "bucket_sort") if axis == "delivery" else result
    averages = [item_avg(*_AVERAGES[a], weight).alias(a) for a in KPI_TABLES[axis]]
    result = kpi_by(fact, _axis(axis, settings), averages, where)
    return _with_band_order(result, settings, "sort_order") if axis == "delivery" else result


def in_display_order(name: str, df: DataFrame) -> DataFrame:
    """Sorted for display. Stored tables keep no order, so sort when reading."""
    keys = [key.split() for key in SORT_KEYS[name]]
    return df.orderBy(
        *[F.col(k[0]).desc() if k[1:] == ["desc"] else F.col(k[0]) for k in keys]
    )


CUBE_COUNT = "items"


def count_cube(fact: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Item count and revenue per combination of all axes and month.

    One pass over the fact table from which the twelve monthly and share tables
    follow. Its size is bounded by the labels (states outside the list fold
    into NULL), so write it out and derive from it. The KPI tables count
    distinct orders, which do not add up, and need the fact table itself.
    """
    known_days = F.col("delivery_days").isNotNull()
    shown_state = F.col("customer_state").isin(*settings.states)
    return fact.groupBy(
        F.when(known_days, settings.bands.label(F.col("delivery_days"))).alias("delivery_bucket"),
        "review_score",
        _axis("category", settings),
        settings.categories.contains(F.col("category_english")).alias("_named"),
        F.when(shown_state, F.col("customer_state")).alias("customer_state"),
        "year_month",
    ).agg(item_count().alias(CUBE_COUNT), exact_sum("item_price").alias("item_price"))


def cross_tab_from_cube(name: str, cube: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A monthly or share table derived from ``count_cube``."""
    present = {
        "delivery": F.col("delivery_bucket").isNotNull(),
        "review": F.col("review_score").isNotNull(),
        "category": F.col("_named"),
        "state": F.col("customer_state").isNotNull(),
    }
    if name in SHARE_TABLES:
        parent, child = SHARE_TABLES[name]
        where = present[parent]
        if DIMENSIONS[child].always:
            where = where & present[child]
        parent_name, child_name = DIMENSIONS[parent].name, DIMENSIONS[child].name
        pairs = cube.where(where).groupBy(parent_name, child_name).agg(F.sum(CUBE_COUNT).alias("_n"))
        result = share_of_parent(pairs, parent_name, child_name, "_n")
        return _with_band_order(result, settings, "bucket_sort") if child == "delivery" else result
    axis = name.split("_by_")[1]
    where = present[axis] if DIMENSIONS[axis].always else None
    result = monthly_by(cube, F.col(DIMENSIONS[axis].name), settings.months, where)
    return _with_band_order(result, settings, "bucket_sort") if axis == "delivery" else result


def from_cube_tables() -> list[str]:
    return [n for n in CROSS_TABS if not n.startswith("kpi_")]


def comments() -> Mapping[str, str]:
    texts = {}
    for name in CROSS_TABS:
        what, axis = name.split("_by_")
        lead = {"kpi": "Key figures", "monthly": "Monthly revenue"}.get(
            what, f"Share of each {what}"
        )
        texts[name] = f"{lead} by {axis}, from the fact table"
    return texts
