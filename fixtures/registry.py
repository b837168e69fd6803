"""The registered queries: each builds its result from the test tables."""

from __future__ import annotations

import datetime
import functools
import uuid
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.views import TEST_SETTINGS, VIEWS, raw_table
from tradeloom.functions.measures import exact_sum
from tradeloom.operators import quality
from tradeloom.operators.export import nest_by
from tradeloom.operators.history import apply_changes
from tradeloom.operators.ranking import top_values
from tradeloom.plans import dashboards, extras, gold, silver
from tradeloom.schemas import RAW_SCHEMAS
from tradeloom.sources import tables
from tradeloom.sources.csv_files import read_csv, split_bad_rows, with_audit_columns
from tradeloom.sources.dimensions import store_dimension, update_dimension

Query = Callable[[SparkSession, str], DataFrame]


class Shop:
    """The raw and silver tables of one test data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = functools.cache(functools.partial(raw_table, spark, sf_dir))

    def customers(self) -> DataFrame:
        return silver.dim_customers(self.raw("customers"), self.raw("orders"))

    def products(self) -> DataFrame:
        return silver.dim_products(self.raw("products"), self.raw("category_translation"))

    def sellers(self) -> DataFrame:
        return silver.dim_sellers(self.raw("sellers"))

    def reviews(self) -> DataFrame:
        return silver.reviews_latest(self.raw("order_reviews"))

    def payments(self) -> DataFrame:
        return silver.payments_by_order(self.raw("order_payments"))

    def enriched(
        self, keep: Collection[str] = silver.ENRICHED_COLUMNS, per_order: bool = False
    ) -> DataFrame:
        lookups = {name: getattr(self, name)() for name in silver.lookups_for(keep)}
        return silver.enrich_orders(
            self.raw("orders"), self.raw("order_items"), lookups, keep, per_order
        )

    def by_order(self, keep: Collection[str]) -> DataFrame:
        return self.enriched(keep, per_order=True)


# Columns each aggregate reads, so that unused lookups are not joined. Aggregates
# that need no column of a single item work on items added up per order.
_MONTHLY = {
    "order_id", "purchase_year", "purchase_month", "year_month", "item_price",
    "freight_value", "customer_unique_id", "review_score", "is_late_delivery", "order_status",
}
_SELLER = {
    "seller_id", "order_id", "item_price", "category_english", "customer_unique_id",
    "delivery_days", "review_score", "is_late_delivery", "order_status",
    "order_purchase_date",
}
_CATEGORY = {
    "category_english", "product_category_name", "order_id", "item_price", "seller_id",
    "review_score", "delivery_days", "product_weight_g",
}
_DELIVERY = {"order_status", "delivery_days", "order_id", "review_score"}
_PROFILE = {
    "order_status", "order_id", "customer_unique_id", "seller_id", "category_english",
    "total_payment_value", "item_price", "review_score", "delivery_days", "is_late_delivery",
    "order_purchase_date",
}
_KPIS = {
    "order_id", "customer_unique_id", "item_price", "review_score", "delivery_days",
    "is_late_delivery", "order_status",
}


def _on_shop(build: Callable[[Shop], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Shop(spark, sf_dir))


def _monthly(shop: Shop) -> DataFrame:
    return gold.monthly_revenue(shop.by_order(_MONTHLY), silver.ITEMS)


def _from_shop(shop: Shop, name: str) -> DataFrame:
    """A cross-tab from items, or from items added up per order where it needs no single item."""
    keep = dashboards.columns_for(name)
    per_order = "category_english" not in keep
    return dashboards.cross_tab(
        name, shop.enriched(keep, per_order), TEST_SETTINGS, silver.ITEMS if per_order else None)


def _cross_tab(name: str) -> Query:
    return _on_shop(lambda shop: _from_shop(shop, name))


def _tables(shop: Shop) -> dict[str, DataFrame]:
    """All 35 tables by layer and name."""
    found = {f"bronze.{name}": shop.raw(name) for name in VIEWS}
    found["silver.dim_customers"] = shop.customers()
    found["silver.dim_products"] = shop.products()
    found["silver.dim_sellers"] = shop.sellers()
    found["silver.order_reviews_deduped"] = shop.reviews()
    found["silver.order_payments_agg"] = shop.payments()
    enriched = written(shop.enriched())
    found["silver.orders_enriched"] = enriched
    found["gold.fact_orders"] = gold.fact_orders(enriched)
    found["gold.agg_monthly_revenue"] = gold.monthly_revenue(enriched)
    found["gold.agg_seller_performance"] = gold.seller_performance(enriched, shop.sellers())
    found["gold.agg_product_category"] = gold.product_category(enriched)
    found["gold.agg_delivery_performance"] = gold.delivery_performance(enriched)
    cube = written(dashboards.count_cube(enriched, TEST_SETTINGS))
    for name in dashboards.CROSS_TABS:
        from_cube = name in dashboards.from_cube_tables()
        found[f"gold.cross_tab_{name}"] = (
            dashboards.cross_tab_from_cube(name, cube, TEST_SETTINGS) if from_cube
            else dashboards.cross_tab(name, enriched, TEST_SETTINGS))
    return found


def _layer_counts(shop: Shop) -> DataFrame:
    return quality.row_counts(_tables(shop))


def _reconcile_counts(shop: Shop) -> DataFrame:
    """All nine raw tables and a last row for all of them together."""
    sources = {
        "orders": "orders",
        "order_items": "lineitem",
        "order_payments": "lineitem",
        "order_reviews": "events",
        "customers": "customer",
        "products": "part",
        "sellers": "supplier",
        "geolocation": "nation",
    }
    counted = quality.row_counts(
        {view: shop.spark.read.parquet(f"{shop.sf_dir}/{t}.parquet") for view, t in sources.items()}
    ).withColumnRenamed("row_count", "expected")
    fixed = quality.expected_counts(shop.spark, {"category_translation": 5})
    report = quality.reconcile_counts(
        counted.unionByName(fixed), {view: shop.raw(view) for view in [*sources, "category_translation"]})
    return report.unionByName(quality.verdict(report))


def _top_categories(shop: Shop) -> DataFrame:
    sold = shop.enriched({"category_english", "item_price"})
    top = top_values(sold, "category_english", "item_price", 5, "total_revenue")
    return top.withColumn("total_revenue", F.round("total_revenue", 2))


def _money_sums(shop: Shop) -> DataFrame:
    """Exact sums of values with eight places, of 1e-30, 1e-7, thirds, 9e14 and 1e22, with NULL and NaN."""
    line = F.col("l_linenumber").cast("double")
    rows = shop.spark.read.parquet(f"{shop.sf_dir}/lineitem.parquet").select(
        F.col("l_returnflag").alias("kind"),
        ((line + 100000049) / 1e8).alias("eight_places"),
        (line / 1e7).alias("tiny"),
        (line + 9e14).alias("huge"),
        (line * 1e22).alias("astronomic"),
        (line * 1e-30).alias("minute"),
        (line / 3e-6).alias("thirds"),
        F.when(line % 3 > 0, -line / 1e2).alias("negative_or_null"),
        F.when(line == 1, F.lit(float("nan"))).otherwise(line).alias("not_a_number"),
    )
    names = [c for c in rows.columns if c not in ("kind", "not_a_number")]
    return rows.groupBy("kind").agg(
        F.count("*").alias("n"), *[exact_sum(c).alias(c) for c in names],
        F.isnan(exact_sum("not_a_number")).alias("not_a_number"))


def _scd2_inputs(shop: Shop) -> tuple[DataFrame, DataFrame]:
    """The customers known before and a later snapshot: every key divisible by 5
    is new, by 7 has moved and by 11 is gone; every key divisible by 6 also has
    an older, closed version."""
    customers = shop.customers()
    key = F.col("customer_id")
    city = F.when(key % 7 == 0, F.concat("customer_city", F.lit(" Moved"))).otherwise(
        F.col("customer_city"))
    closed = customers.where(key % 6 == 0).withColumns({
        "customer_city": F.lit("Old Town"),
        "valid_from": F.lit(datetime.date(1990, 1, 1)),
        "valid_to": F.lit(datetime.date(1991, 1, 1)),
        "is_current": F.lit(False),
    })
    return (customers.where(key % 5 != 0).unionByName(closed),
            customers.where(key % 11 != 0).withColumn("customer_city", city))


_SCD2 = ("customer_id", ["customer_city", "customer_state", "customer_zip_code_prefix"], datetime.date(2020, 1, 1))


def _scd2(shop: Shop) -> DataFrame:
    return apply_changes(*_scd2_inputs(shop), *_SCD2)


def _scd2_stored(shop: Shop) -> DataFrame:
    """The same by way of a stored dimension whose closed versions stay as they are, updated twice."""
    layer = f"scd2_{uuid.uuid4().hex}"
    shop.spark.sql(f"CREATE SCHEMA {layer}")
    known, snapshot = _scd2_inputs(shop)
    store_dimension(known, f"{layer}.customers")
    for _ in range(2):
        update_dimension(shop.spark, f"{layer}.customers", snapshot, *_SCD2)
    return shop.spark.table(f"{layer}.customers")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared scratch folder."""
    path = f"{scratch_dir(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the place that all executors share: the session's
    checkpoint folder, or its warehouse if it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/tradeloom-{uuid.uuid4().hex}"


def _write_csv(df: DataFrame, path: str, **options: str) -> None:
    fmt = "yyyy-MM-dd HH:mm:ss"
    (
        df.write.options(header=True, **options)
        .option("timestampFormat", fmt)
        .option("timestampNTZFormat", fmt)
        .csv(path)
    )


def _csv_ingest_items(shop: Shop) -> DataFrame:
    """Order items written as CSV, loaded back through the raw contract."""
    path = f"{scratch_dir(shop.spark)}/order_items"
    items = shop.raw("order_items")
    _write_csv(items, path)
    loaded = with_audit_columns(read_csv(shop.spark, path, RAW_SCHEMAS["order_items"]))
    checked = loaded.where(F.col("_ingestion_ts").isNotNull() & F.col("_source_file").isNotNull())
    ids = ("order_id", "product_id", "seller_id")
    return checked.select(
        *[F.col(c).cast("long").alias(c) if c in ids else F.col(c) for c in items.columns]
    )


def _ingest_tables(shop: Shop) -> DataFrame:
    """All nine raw tables written as CSV and ingested: rows, rows with both
    audit columns, and the reviews once more with a line break in each message,
    read with quoted line breaks (whole files and byte ranges) and without."""
    spark, home = shop.spark, scratch_dir(shop.spark)
    layer = f"ingest_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {layer}")
    broken = F.concat(F.lit('"say, '), "review_comment_message", F.lit('",\nsecond line'))
    reviews = shop.raw("order_reviews").withColumn("review_comment_message", broken)
    tables.side_by_side(spark, [
        *[functools.partial(_write_csv, shop.raw(name), f"{home}/{name}") for name in VIEWS],
        functools.partial(_write_csv, reviews, f"{home}/broken", escape='"'),  # quotes are doubled
    ])
    tables.ingest_all(spark, home, {name: f"{name}/" for name in VIEWS}, layer=layer)
    extra = {"reviews_multiline": (True, False), "reviews_split": (True, True), "reviews_by_line": (False, False)}
    tables.side_by_side(spark, [
        functools.partial(tables.ingest, spark, f"{home}/broken", RAW_SCHEMAS["order_reviews"], f"{layer}.{name}",
                          multiline=multiline, split=split)
        for name, (multiline, split) in extra.items()
    ])
    audited = F.count_if(F.col("_ingestion_ts").isNotNull() & F.col("_source_file").isNotNull())
    counts = [
        spark.table(f"{layer}.{name}").agg(F.count("*").alias("row_count"), audited.alias("audited"))
        .select(F.lit(name).alias("table_name"), "row_count", "audited")
        for name in [*VIEWS, *extra]
    ]
    for name in ("multiline", "split"):
        whole = spark.table(f"{layer}.reviews_{name}").where(
            F.col("review_comment_message").endswith("\nsecond line")
            & F.col("review_comment_message").startswith('"say, ') & F.col("review_answer_timestamp").isNotNull())
        counts.append(whole.agg(F.count("*").alias("row_count")).select(
            F.lit(f"whole_messages_{name}").alias("table_name"), "row_count", F.col("row_count").alias("audited")))
    return functools.reduce(DataFrame.unionByName, counts)


CATALOG_DIMS = ("dim_customers", "dim_products", "dim_sellers")
CATALOG_TABS = ("kpi_by_delivery", "kpi_by_review", "review_by_delivery")


def _catalog_report(shop: Shop) -> DataFrame:
    """What the catalog calls say of three dimensions and three cross-tabs that
    are written here: catalogs, layers with their comments and table counts,
    commented tables found by pattern with the row counts of their writes, rows
    of a sample that are in the table, a scalar, and a cross-tab in display order."""
    spark, prefix = shop.spark, f"catalog_{uuid.uuid4().hex}_"
    before = spark.catalog.currentDatabase()
    tables.create_layers(spark, prefix)
    found, counts = [], {}
    steps = {f"silver.{name}": (getattr(shop, name[4:])(), None) for name in CATALOG_DIMS}
    fact = shop.enriched(set().union(*map(dashboards.columns_for, CATALOG_TABS)))
    for name in CATALOG_TABS:
        tab = dashboards.cross_tab(name, fact, TEST_SETTINGS)
        steps[f"gold.cross_tab_{name}"] = (tab, dashboards.comments()[name])
    for name, (df, comment) in steps.items():
        counts[name] = tables.materialize(df, prefix + name, comment=comment, stamp=True)
    for row in tables.list_catalogs(spark, "catalog LIKE 'spark%'").collect():
        found.append(("catalog", row.catalog, None, 1))
    for row in tables.list_layers(spark, f"{prefix}*").collect():
        found.append(("layer", row.name.removeprefix(prefix), row.comment, tables.list_tables(spark, row.name).count()))
    for row in tables.list_tables(spark, f"{prefix}gold", "cross_tab_*").collect():
        found.append(("table", row.table_name, row.comment, counts[f"gold.{row.table_name}"]))
    try:
        tables.use_layer(spark, f"{prefix}silver")
        for name in CATALOG_DIMS:
            table, key = spark.table(name), f"{name[4:-1]}_id"
            sample = tables.sample_rows(table, [key], 5)
            found.append(("sample", name, key, sample.join(table, key, "left_semi").count()))
            found.append(("scalar", name, "rows", tables.scalar(table.agg(F.count("*")))))
            found.append(("written", name, "rows", counts[f"silver.{name}"]))
    finally:
        tables.use_layer(spark, before)
    shown = dashboards.in_display_order("review_by_delivery", spark.table(f"{prefix}gold.cross_tab_review_by_delivery"))
    for place, row in enumerate(shown.collect()):
        found.append(("display", row.delivery_bucket, str(row.review_score), place))
    return spark.createDataFrame(found, "section STRING, name STRING, detail STRING, number BIGINT")


def _cross_tabs_from_cube(shop: Shop) -> DataFrame:
    """The twelve additive cross-tabs from one written cube, as text rows."""
    fact = shop.enriched(
        {"delivery_days", "review_score", "category_english", "customer_state", "year_month", "item_price"})
    cube = written(dashboards.count_cube(fact, TEST_SETTINGS))
    rows = []
    for name in dashboards.from_cube_tables():
        table = dashboards.cross_tab_from_cube(name, cube, TEST_SETTINGS)
        dims = [c for c in table.columns if c not in ("gmv", "order_count", "pct", "bucket_sort")]
        measure = "gmv" if "gmv" in table.columns else "order_count"
        rows.append(table.select(
            F.lit(name).alias("table_name"), F.col(dims[0]).cast("string").alias("first_label"),
            F.col(dims[1]).cast("string").alias("second_label"),
            F.col(measure).cast("double").alias("value")))
    return functools.reduce(DataFrame.unionByName, rows)


def _bad_rows(shop: Shop) -> DataFrame:
    """Reviews written as CSV with a timestamp in every ninth score field: the
    lines that do not parse in full, with the fields that do."""
    path = f"{scratch_dir(shop.spark)}/order_reviews"
    reviews = shop.raw("order_reviews")
    broken = F.col("review_id") % 9 == 0
    score = F.when(broken, F.lit("2018-01-01 00:00:00")).otherwise(
        F.col("review_score").cast("string")
    )
    _write_csv(reviews.withColumn("review_score", score), path)
    _, bad = split_bad_rows(shop.spark, path, RAW_SCHEMAS["order_reviews"])
    return bad.select(
        F.col("review_id").cast("long").alias("review_id"),
        F.col("order_id").cast("long").alias("order_id"),
        "review_score",
        "review_comment_message",
        F.col("_corrupt_record").contains("2018-01-01 00:00:00").alias("raw_line_kept"),
    )


# Axis -> its column and the cross-tabs that the report nests under its values.
REPORT = {
    "delivery": ("delivery_bucket", (
        "kpi_by_delivery", "monthly_by_delivery", "category_by_delivery", "state_by_delivery",
        "review_by_delivery")),
    "review": ("review_score", (
        "kpi_by_review", "monthly_by_review", "category_by_review", "state_by_review",
        "delivery_by_review")),
    "category": ("cat_group", (
        "kpi_by_category", "monthly_by_category", "state_by_category", "delivery_by_category",
        "review_by_category")),
}


def report_sections(shop: Shop, axis: str, cube: DataFrame) -> DataFrame:
    """One row per value of an axis with all that the report shows for it, nested."""
    dim, names = REPORT[axis]
    sections = {names[0]: _from_shop(shop, names[0])}
    for name in names[1:]:
        sections[name] = dashboards.cross_tab_from_cube(name, cube, TEST_SETTINGS)
    return nest_by(dim, sections)


def _report_export(shop: Shop) -> DataFrame:
    """The nested report of all three axes, opened again: number of entries and
    their revenue or count for each value and section."""
    axes = {"delivery_days", "review_score", "category_english", "customer_state"}
    fact = shop.enriched(axes | {"year_month", "item_price"})
    cube = written(dashboards.count_cube(fact, TEST_SETTINGS))
    opened = None
    for axis, (dim, names) in REPORT.items():
        nested = written(report_sections(shop, axis, cube))  # opened once for each section
        for name in names:
            measure = "gmv" if name.startswith(("kpi", "monthly")) else "order_count"
            rows = nested.select(F.col(dim).cast("string").alias("value"), F.explode(name).alias("row"))
            rows = rows.select("value", F.col(f"row.{measure}").cast("double").alias("m")).groupBy("value").agg(
                F.count("*").alias("entries"), F.round(F.sum("m"), 2).alias("total"))
            rows = rows.select(F.lit(axis).alias("axis"), "value", F.lit(name).alias("section"), "entries", "total")
            opened = rows if opened is None else opened.unionByName(rows)
    return opened


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "monthly_revenue": _on_shop(_monthly),
        "dim_customers": _on_shop(Shop.customers),
        "dim_products": _on_shop(Shop.products),
        "dim_sellers": _on_shop(Shop.sellers),
        "reviews_latest": _on_shop(Shop.reviews),
        "payments_dominant": _on_shop(Shop.payments),
        "orders_enriched": _on_shop(Shop.enriched),
        "fact_orders": _on_shop(lambda s: gold.fact_orders(s.enriched(gold.FACT_COLUMNS))),
        "seller_performance": _on_shop(lambda s: gold.seller_performance(
            written(s.enriched(_SELLER)), s.sellers())),
        "product_category": _on_shop(lambda s: gold.product_category(s.enriched(_CATEGORY))),
        "delivery_performance": _on_shop(
            lambda s: gold.delivery_performance(s.by_order(_DELIVERY), silver.ITEMS)),
        **{name: _cross_tab(name) for name in dashboards.CROSS_TABS},
        "silver_profile": _on_shop(lambda s: quality.delivered_profile(written(s.enriched(_PROFILE)))),
        "gold_kpis": _on_shop(lambda s: quality.fact_kpis(s.by_order(_KPIS), silver.ITEMS)),
        "layer_counts": _on_shop(_layer_counts),
        "reconcile_counts": _on_shop(_reconcile_counts),
        "csv_ingest_items": _on_shop(_csv_ingest_items),
        "top_categories": _on_shop(_top_categories),
        "order_level_kpis": _on_shop(lambda s: extras.order_level_kpis(
            s.by_order({"order_id", "order_status", "is_late_delivery", "total_payment_value"}))),
        "scd2_apply": _on_shop(_scd2),
        "scd2_stored": _on_shop(_scd2_stored),
        "money_sums": _on_shop(_money_sums),
        "revenue_yoy": _on_shop(
            lambda s: extras.revenue_yoy(_monthly(s))),
        "monthly_on_time": _on_shop(lambda s: extras.monthly_on_time(s.by_order(_MONTHLY), silver.ITEMS)),
        "seller_products": _on_shop(
            lambda s: extras.seller_products(s.enriched({"seller_id", "product_id"}))),
        "category_photos": _on_shop(
            lambda s: extras.category_photos(
                s.enriched({"category_english", "product_photos_qty"}))),
        "ingest_tables": _on_shop(_ingest_tables),
        "catalog_report": _on_shop(_catalog_report),
        "cross_tabs_from_cube": _on_shop(_cross_tabs_from_cube),
        "bad_rows": _on_shop(_bad_rows),
        "report_export": _on_shop(_report_export),
    }
    return registered
