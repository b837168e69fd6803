"""The whole run: CSV files in, all tables out."""

import pytest
from pyspark.sql import functions as F

from fixtures.registry import Shop, _write_csv, queries
from fixtures.views import TEST_SETTINGS, VIEWS
from tests.compare import spark_rows
from tradeloom.plans import build, dashboards
from tradeloom.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    landing = tmp_path_factory.mktemp("landing")
    shop = Shop(spark, SF)
    for name in VIEWS:
        _write_csv(shop.raw(name), str(landing / name))
    tables.create_layers(spark, "run_")
    loaded = tables.ingest_all(spark, str(landing), {n: f"{n}/" for n in VIEWS}, layer="run_bronze")
    layers = build.Layers("run_bronze", "run_silver", "run_gold")
    return loaded, build.build_all(spark, layers, TEST_SETTINGS), layers


def test_row_counts_and_invariants(spark, built):
    loaded, counts, layers = built
    assert len(loaded) == 9 and len(counts) == 27  # and the items added up per order
    assert loaded["order_items"] == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    joined = spark.sql(
        "SELECT count(*) FROM run_bronze.orders o JOIN run_bronze.order_items i USING (order_id) "
        "WHERE order_purchase_timestamp IS NOT NULL").first()[0]
    assert counts["orders_enriched"] == counts["fact_orders"] == joined
    for table in ("order_reviews_deduped", "order_payments_agg"):
        df = spark.table(f"run_silver.{table}")
        assert df.select("order_id").distinct().count() == df.count() == counts[table]
    revenue = spark.sql("SELECT sum(total_revenue) FROM run_gold.agg_monthly_revenue").first()[0]
    prices = spark.sql("SELECT sum(item_price) FROM run_gold.fact_orders").first()[0]
    assert abs(revenue - prices) < 0.01
    report = build.layer_counts(spark, "run_gold", {k: v for k, v in counts.items() if "agg" in k and "pay" not in k})
    assert {r.table_name: r.row_count for r in report.collect()}["agg_monthly_revenue"] == counts["agg_monthly_revenue"]


def test_tables_have_comments_and_stamps(spark, built):
    listed = tables.list_tables(spark, "run_gold", "cross_tab_*").collect()
    assert len(listed) == 15 and all(r.comment for r in listed)
    assert spark.table("run_gold.fact_orders").columns[-1] == "_updated_ts"
    assert all(r.comment for r in tables.list_tables(spark, "run_silver").collect())


@pytest.mark.parametrize("table,query", [
    ("silver.dim_customers", "dim_customers"), ("silver.dim_products", "dim_products"),
    ("silver.dim_sellers", "dim_sellers"), ("silver.order_reviews_deduped", "reviews_latest"),
    ("silver.order_payments_agg", "payments_dominant"), ("silver.orders_enriched", "orders_enriched"),
    ("gold.fact_orders", "fact_orders"), ("gold.agg_monthly_revenue", "monthly_revenue"),
    ("gold.agg_seller_performance", "seller_performance"),
    ("gold.agg_product_category", "product_category"),
    ("gold.agg_delivery_performance", "delivery_performance"),
    *[(f"gold.cross_tab_{n}", n) for n in dashboards.CROSS_TABS]])
def test_tables_equal_registered_queries(spark, built, table, query):
    """Ids were written to CSV and are text in the tables, numbers in the queries."""
    def texts(df):
        df = df.drop("_updated_ts")
        ids = [c for c in df.columns if c.endswith("_id") or c == "customer_unique_id"]
        times = [c for c, kind in df.dtypes if kind.startswith("timestamp")]  # CSV holds seconds
        return spark_rows(df.withColumns(
            {c: F.col(c).cast("string") for c in ids}
            | {c: F.date_trunc("second", F.col(c)) for c in times}))

    assert texts(spark.table(f"run_{table}")) == texts(queries()[query](spark, SF))
