"""Gold and dashboard tables on hand-written items."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.frames import make
from tradeloom.operators.crosstab import share_within
from tradeloom.operators.export import nest_by, write_json
from tradeloom.operators.history import year_over_year
from tradeloom.operators.quality import delivered_profile, fact_kpis, row_counts
from tradeloom.operators.ranking import top_values
from tradeloom.plans import dashboards, gold
from tradeloom.plans.extras import order_level_kpis
from tradeloom.functions.buckets import ValueGroups

DDL = """order_id STRING, customer_unique_id STRING, seller_id STRING, seller_city STRING, seller_state STRING,
 order_status STRING, item_price DOUBLE, freight_value DOUBLE, total_payment_value DOUBLE, review_score INT,
 category_english STRING, product_category_name STRING, product_weight_g INT, customer_state STRING,
 delivery_days INT, is_late_delivery BOOLEAN, purchase_year INT, purchase_month INT, year_month STRING,
 order_purchase_date DATE"""


def row(order_id, *, seller="s1", status="delivered", price=10.0, score=5, category="toys", days=2,
        late=False, month=(2018, 1), state="SP", paid=20.0, person="u1", weight=100):
    return (order_id, person, seller, "City", "ST", status, price, 1.0, paid, score, category,
            category and "src_" + category, weight, state, days, late, month[0], month[1],
            f"{month[0]}-{month[1]:02d}", None)


def items(spark, *rows):
    return make(spark, DDL, *rows)


def sellers(spark):
    return make(spark, "seller_id STRING, seller_city STRING, seller_state STRING", ("s1", "City", "ST"))


def test_seller_without_delivered_rows_has_no_percentage(spark):
    df = items(spark, row("o1", status="shipped", days=None), row("o1", status="shipped", days=None))
    got = gold.seller_performance(df, sellers(spark)).first()
    assert (got.total_orders, got.total_items, got.delivered_orders, got.on_time_pct) == (1, 2, 0, None)
    assert got.avg_order_value == 10.0 and got.avg_delivery_days is None


def test_seller_average_is_per_item_and_rate_counts_items(spark):
    df = items(spark, row("o1", price=1.0), row("o1", price=2.0, late=True), row("o2", price=6.0))
    got = gold.seller_performance(df, sellers(spark)).first()
    assert (got.total_orders, got.avg_order_value, got.on_time_pct) == (2, 3.0, 66.7)


def test_category_share_counts_items_without_category_in_the_total(spark):
    df = items(spark, row("o1", price=25.0), row("o2", price=75.0, category=None))
    got = gold.product_category(df).collect()
    assert [(r.category_english, r.revenue_share_pct) for r in got] == [("toys", 25.0)]


def test_delivery_share_counts_negative_days_in_the_total(spark):
    df = items(spark, row("o1", days=0), row("o1", days=0), row("o2", days=-1), row("o3", days=30),
               row("o4", days=None), row("o5", status="shipped", days=3))
    got = {r.delivery_bucket: (r.bucket_order, r.order_count, r.pct_of_delivered)
           for r in gold.delivery_performance(df).collect()}
    assert got == {"1-3 days": (1, 1, 33.3), "22+ days": (5, 1, 33.3)}


def test_monthly_on_time_counts_items(spark):
    df = items(spark, row("o1"), row("o1"), row("o2", late=True), row("o3", status="shipped"))
    got = gold.monthly_revenue(df).first()
    assert (got.total_orders, got.total_items, got.on_time_deliveries, got.delivered_orders) == (3, 4, 2, 3)
    assert (got.total_revenue, got.avg_order_value, got.unique_customers) == (40.0, 13.33, 1)


def test_profile_repeats_payment_per_item_and_order_level_does_not(spark):
    df = items(spark, row("o1"), row("o1"), row("o2", late=True), row("o3", status="shipped"))
    assert delivered_profile(df).first().total_gmv_brl == 60.0
    by_order = order_level_kpis(df).first()
    assert (by_order.total_orders, by_order.delivered_orders, by_order.late_orders,
            by_order.late_order_pct, by_order.order_gmv) == (3, 2, 1, 50.0, 60.0)


def test_kpis_of_nothing_are_null(spark):
    got = fact_kpis(items(spark, row("o1")).where("false")).first()
    assert (got.total_orders, got.total_gmv_brl, got.aov, got.late_delivery_pct) == (0, None, None, None)
    assert fact_kpis(items(spark, row("o1", status="shipped", late=True))).first().late_delivery_pct is None


SETTINGS = dashboards.Settings(
    categories=ValueGroups({"toys": "Toys", "books": "Books"}), states=("SP", "RJ"),
    months=("2018-01", "2018-02"))


def varied(spark):
    rows = []
    for i in range(240):
        rows.append(row(
            f"o{i // 2}", price=round(0.5 + i * 0.25, 2), score=None if i % 7 == 0 else i % 5 + 1,
            category=[None, "toys", "books", "food"][i % 4], days=None if i % 11 == 0 else i % 30 - 2,
            state=[None, "SP", "RJ", "MG"][i // 3 % 4], month=(2018, i % 3 + 1)))
    return items(spark, *rows)


def as_set(df):
    return sorted(map(str, df.collect()))


def test_cross_tabs_from_cube_equal_those_from_the_fact_table(spark):
    fact = varied(spark)
    cube = dashboards.count_cube(fact, SETTINGS)
    assert len(dashboards.from_cube_tables()) == 12 and len(dashboards.CROSS_TABS) == 15
    for name in dashboards.from_cube_tables():
        direct = dashboards.cross_tab(name, fact, SETTINGS)
        derived = dashboards.cross_tab_from_cube(name, cube, SETTINGS)
        assert direct.columns == derived.columns
        assert as_set(direct) == as_set(derived) != [], name


def test_shares_add_up_per_parent(spark):
    fact = varied(spark)
    for name, (parent, _) in dashboards.SHARE_TABLES.items():
        table = dashboards.cross_tab(name, fact, SETTINGS)
        sums = table.groupBy(dashboards.DIMENSIONS[parent].name).agg(F.sum("pct")).collect()
        assert all(abs(r[1] - 100) < 0.05 for r in sums) and sums


def test_other_includes_null_category_and_state_share_is_of_shown_states(spark):
    df = items(spark, row("o1", category=None, state="MG"), row("o2"), row("o3", category="food"))
    got = {r.cat_group: r.pct for r in
           dashboards.cross_tab("category_by_delivery", df, SETTINGS).collect()}
    assert got == {"Other": 66.67, "Toys": 33.33}
    states = dashboards.cross_tab("state_by_delivery", df, SETTINGS).collect()
    assert [(r.customer_state, r.order_count, r.pct) for r in states] == [("SP", 2, 100.0)]


def test_columns_for_is_enough(spark):
    fact = varied(spark)
    for name in dashboards.CROSS_TABS:
        narrow = fact.select(*dashboards.columns_for(name))
        assert dashboards.cross_tab(name, narrow, SETTINGS).count() > 0


def test_display_order(spark):
    fact = varied(spark)
    bands = [r.delivery_bucket for r in dashboards.in_display_order(
        "kpi_by_delivery", dashboards.cross_tab("kpi_by_delivery", fact, SETTINGS)).collect()]
    assert bands == ["1-3d", "4-7d", "8-14d", "15-21d", "22+d"]
    gmv = [r.gmv for r in dashboards.in_display_order(
        "kpi_by_category", dashboards.cross_tab("kpi_by_category", fact, SETTINGS)).collect()]
    assert gmv == sorted(gmv, reverse=True)


def test_default_settings_cover_five_categories_and_eight_states():
    settings = dashboards.Settings()
    assert len(settings.categories.labels) == 5 and len(settings.states) == 8


def test_year_over_year_needs_the_same_month(spark):
    df = make(spark, "year INT, month INT, r DOUBLE", (2017, 1, 10.0), (2018, 1, 15.0),
              (2018, 2, 7.0), (2020, 2, 9.0), (2019, 1, None), (2020, 1, 3.0))
    got = {(r.year, r.month): (r.r_previous_year, r.r_yoy_pct)
           for r in year_over_year(df, "r").collect()}
    assert got == {(2017, 1): (None, None), (2018, 1): (10.0, 50.0), (2018, 2): (None, None),
                   (2020, 2): (None, None), (2019, 1): (15.0, None), (2020, 1): (None, None)}


def test_top_values(spark):
    df = make(spark, "c STRING, m DOUBLE", ("a", 1.0), ("a", 5.0), ("b", 6.0), ("c", 7.0), (None, 99.0))
    assert [tuple(r) for r in top_values(df, "c", "m", 2, "t").collect()] == [("c", 7.0), ("a", 6.0)]


def test_share_within_on_any_columns(spark):
    df = make(spark, "p INT, c INT", (1, 1), (1, 1), (1, 2), (2, 1))
    got = {(r.p, r.c): (r.order_count, r.pct)
           for r in share_within(df, F.col("p"), F.col("c")).collect()}
    assert got == {(1, 1): (2, 66.67), (1, 2): (1, 33.33), (2, 1): (1, 100.0)}


def test_column_names_do_not_change_counts(spark):
    df = make(spark, "p INT, c INT, items INT", (1, 1, 5), (1, 2, 1))
    assert {r.order_count for r in share_within(df, F.col("p"), F.col("c")).collect()} == {1}
    weighted = share_within(df, F.col("p"), F.col("c"), weight="items").collect()
    assert {(r.c, r.order_count) for r in weighted} == {(1, 5), (2, 1)}
    fact = varied(spark)
    odd = fact.withColumn("items", F.lit(7))
    for build in (gold.monthly_revenue, gold.delivery_performance, gold.product_category, fact_kpis):
        assert as_set(build(fact)) == as_set(build(odd))


def test_a_frame_per_order_gives_the_same_figures(spark):
    """Order columns of ``varied`` are made equal within each order."""
    fact = varied(spark).where("pmod(cast(substr(order_id, 2) as int), 2) = 0").withColumns({
        c: F.first(c, ignorenulls=True).over(Window.partitionBy("order_id").orderBy("item_price").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))
        for c in ("review_score", "delivery_days", "purchase_month", "year_month")})
    keys = [c for c in fact.columns if c not in (
        "item_price", "freight_value", "category_english", "product_category_name", "customer_state")]
    by_order = fact.groupBy(*keys).agg(
        F.count("*").alias("items"), F.sum("item_price").alias("item_price"),
        F.sum("freight_value").alias("freight_value"))
    for build in (gold.monthly_revenue, gold.delivery_performance, fact_kpis):
        assert as_set(build(fact)) == as_set(build(by_order, "items"))


def test_nested_null_is_one_value(spark):
    one = make(spark, "k STRING, n INT", ("a", 1), (None, 2))
    two = make(spark, "k STRING, m INT", (None, 3), (None, 4))
    got = {r.k: (r.one, r.two) for r in nest_by("k", {"one": one, "two": two}).collect()}
    assert set(got) == {"a", None} and got["a"][1] is None
    assert [x.m for x in got[None][1]] == [3, 4] and [x.n for x in got[None][0]] == [2]


def test_row_counts(spark):
    got = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(map(tuple, got.collect())) == [("a", 3), ("b", 0)]


def test_nested_export(spark, tmp_path):
    fact = varied(spark)
    nested = nest_by("review_score", {
        "kpi": dashboards.cross_tab("kpi_by_review", fact, SETTINGS),
        "states": dashboards.cross_tab("state_by_review", fact, SETTINGS)})
    path = str(tmp_path / "report")
    write_json(nested, path)
    text = spark.read.text(path).collect()
    docs = [json.loads(r.value) for r in text]
    assert {d["review_score"] for d in docs} == {1, 2, 3, 4, 5}
    assert all(len(d["kpi"]) == 1 and len(d["states"]) == 2 for d in docs)
