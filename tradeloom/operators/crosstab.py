"""Three families of cross-tabs over order items, one or several per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.measures import exact_sum, item_count, percent


def kpi_by(
    fact: DataFrame, dim: Column, extras: Sequence[Column] = (), where: Column | None = None
) -> DataFrame:
    """Distinct orders, rounded revenue and revenue per order for each ``dim``.

    ``extras`` are further aliased aggregates. The distinct count is planned on
    (dim, order) first, so the few dim values do not limit the parallelism.
    """
    rows = fact if where is None else fact.where(where)
    revenue, orders = exact_sum("item_price"), F.countDistinct("order_id")
    return rows.groupBy(dim).agg(
        orders.alias("orders"),
        F.round(revenue, 0).alias("gmv"),
        F.round(revenue / orders, 2).alias("aov"),
        *extras,
    )


def monthly_by(
    fact: DataFrame, dim: Column, months: tuple[str, str], where: Column | None = None
) -> DataFrame:
    """Rounded revenue per month and ``dim``, both months inclusive."""
    rows = fact.where(F.col("year_month").between(*months))
    if where is not None:
        rows = rows.where(where)
    return rows.groupBy("year_month", dim).agg(
        F.round(exact_sum("item_price"), 0).alias("gmv")
    )


def share_of_parent(pairs: DataFrame, parent: str, child: str, count: str) -> DataFrame:
    """Percentage of each pair's ``count`` in its parent's total.

    Totals are added up with map-side combine and joined, so that a parent with
    any number of children stays in as many tasks as its pairs are in.
    """
    totals = pairs.groupBy(F.col(parent).alias("_parent")).agg(F.sum(count).alias("_total"))
    in_parent = F.col("_total")
    joined = pairs.join(totals, F.col(parent).eqNullSafe(F.col("_parent")))
    return joined.select(
        parent,
        child,
        F.col(count).alias("order_count"),
        percent(F.col(count), in_parent, 2).alias("pct"),
    )


def share_within(
    fact: DataFrame,
    parent: Column,
    child: Column,
    where: Column | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Item count of each (parent, child) pair and its share within the parent."""
    rows = fact if where is None else fact.where(where)
    pairs = rows.groupBy(parent, child).agg(item_count(weight=weight).alias("_n"))
    return share_of_parent(pairs, pairs.columns[0], pairs.columns[1], "_n")
