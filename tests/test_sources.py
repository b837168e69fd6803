import threading

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import quality
from tradeloom.schemas import RAW_SCHEMAS
from tradeloom.sources import tables
from tradeloom.sources.csv_files import read_csv, split_bad_rows, with_audit_columns

REVIEWS = '''review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,,plain,2018-01-01 00:00:00,2018-01-02 03:04:05
r2,o2,2018-01-01 00:00:00,,score is a time,2018-01-01 00:00:00,2018-01-02 03:04:05
r3,o3,4
r4,o4,3,,"line one
line ""two"" end",2018-01-01 00:00:00,2018-01-02 03:04:05
'''


@pytest.fixture
def reviews_csv(tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(REVIEWS)
    return str(path)


def test_bad_field_and_short_row_become_null(spark, reviews_csv):
    rows = {r.review_id: r for r in read_csv(spark, reviews_csv, RAW_SCHEMAS["order_reviews"]).collect()}
    assert rows["r2"].review_score is None and rows["r2"].review_comment_message == "score is a time"
    assert rows["r3"].review_score == 4 and rows["r3"].review_answer_timestamp is None
    assert str(rows["r1"].review_answer_timestamp) == "2018-01-02 03:04:05"


def test_quoted_line_break_by_default_and_with_multiline(spark, reviews_csv):
    schema = RAW_SCHEMAS["order_reviews"]
    assert read_csv(spark, reviews_csv, schema).count() == 5
    whole = read_csv(spark, reviews_csv, schema, multiline=True)
    assert whole.count() == 4
    text = whole.where("review_id = 'r4'").first().review_comment_message
    assert text == 'line one\nline "two" end'


def test_bad_rows_are_split_off_with_their_raw_line(spark, reviews_csv):
    good, bad = split_bad_rows(spark, reviews_csv, RAW_SCHEMAS["order_reviews"], multiline=True)
    assert {r.review_id for r in good.collect()} == {"r1", "r4"}
    kept = {r.review_id: r._corrupt_record for r in bad.collect()}
    assert set(kept) == {"r2", "r3"} and kept["r3"].strip() == "r3,o3,4"


def test_ingest_writes_audit_columns_and_quarantine(spark, reviews_csv, tmp_path):
    tables.create_layers(spark, "t1_")
    n = tables.ingest(spark, reviews_csv, RAW_SCHEMAS["order_reviews"], "t1_bronze.order_reviews",
                      source_name="reviews.csv", multiline=True, quarantine="t1_bronze.bad_reviews")
    assert n == 4
    table = spark.table("t1_bronze.order_reviews")
    assert table.where("_ingestion_ts is null or _source_file <> 'reviews.csv'").count() == 0
    assert spark.table("t1_bronze.bad_reviews").count() == 2
    # A second run replaces the table, also with another schema.
    assert tables.materialize(spark.range(3).toDF("only"), "t1_bronze.order_reviews") == 3
    assert spark.table("t1_bronze.order_reviews").columns == ["only"]


def test_ingest_all_directory_takes_file_names(spark, tmp_path):
    folder = tmp_path / "sellers"
    folder.mkdir()
    for n in (1, 2):
        (folder / f"part{n}.csv").write_text(
            "seller_id,seller_zip_code_prefix,seller_city,seller_state\n" f"s{n},01,x,y\n")
    (tmp_path / "names.csv").write_text(
        "product_category_name,product_category_name_english\na,A\n")
    tables.create_layers(spark, "t2_")
    counts = tables.ingest_all(
        spark, str(tmp_path), {"sellers": "sellers/", "category_translation": "names.csv"},
        layer="t2_bronze")
    assert counts == {"sellers": 2, "category_translation": 1}
    files = {r._source_file for r in spark.table("t2_bronze.sellers").collect()}
    assert files == {"part1.csv", "part2.csv"}
    report = quality.reconcile_counts(
        quality.expected_counts(spark, {"sellers": 2, "category_translation": 9, "absent": 1}),
        {name: spark.table(f"t2_bronze.{name}") for name in counts})
    assert {r.table_name: r.status for r in report.collect()} == {
        "sellers": "PASS", "category_translation": "MISMATCH", "absent": "MISMATCH"}
    assert not quality.all_passed(report)


def test_layers_tables_and_samples(spark):
    names = tables.create_layers(spark, "t3_")
    assert tables.create_layers(spark, "t3_") == names
    assert [r.name for r in tables.list_layers(spark, "t3_*").collect()] == sorted(names)
    tables.materialize(spark.range(7), "t3_gold.cross_tab_b", comment="it's a \\ test")
    tables.materialize(spark.range(7), "t3_gold.cross_tab_a", stamp=True)
    tables.materialize(spark.range(7), "t3_gold.other")
    listed = tables.list_tables(spark, "t3_gold", "cross_tab_*").collect()
    assert [r.table_name for r in listed] == ["cross_tab_a", "cross_tab_b"]
    assert listed[1].comment == "it's a \\ test"
    tables.use_layer(spark, "t3_gold")
    assert spark.table("cross_tab_a").columns == ["id", "_updated_ts"]
    tables.use_layer(spark, "default")
    sample = tables.sample_rows(spark.table("t3_gold.other"), ["id"])
    assert sample.count() == 5
    assert tables.scalar(spark.table("t3_gold.other").agg(F.count("*"))) == 7
    assert tables.list_catalogs(spark, "catalog = 'spark_catalog'").count() == 1


def test_partitioned_table(spark):
    tables.create_layers(spark, "t4_")
    df = spark.range(100).select("id", (F.col("id") % 3).alias("m"))
    assert tables.materialize(df, "t4_gold.p", partition_by=["m"]) == 100
    plan = spark.table("t4_gold.p").where("m = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    files = spark.table("t4_gold.p").inputFiles()
    assert len(files) == 3


def test_append_mode(spark):
    tables.create_layers(spark, "t5_")
    tables.materialize(spark.range(2), "t5_gold.a")
    assert tables.materialize(spark.range(3), "t5_gold.a", mode="append") == 5


def test_audit_column_from_single_name(spark):
    row = with_audit_columns(spark.range(1), "f.csv").first()
    assert row._source_file == "f.csv" and row._ingestion_ts is not None


def test_a_write_that_fails_leaves_the_old_rows(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS t6_gold")
    tables.materialize(spark.range(5), "t6_gold.a", comment="first")
    half = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") > 900, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.materialize(half, "t6_gold.a")
    assert sorted(r.id for r in spark.table("t6_gold.a").collect()) == list(range(5))
    assert [t.name for t in spark.catalog.listTables("t6_gold")] == ["a"]


def test_a_replaced_table_may_read_itself_and_change_its_columns(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS t7_gold")
    tables.materialize(spark.range(5), "t7_gold.a", comment="first")
    doubled = spark.table("t7_gold.a").selectExpr("id * 2 AS twice", "IF(id = 3, NULL, concat('a b/', id % 2)) AS m")
    assert tables.materialize(doubled, "t7_gold.a", comment="second", partition_by=["m"]) == 5
    rows = {r.twice: r.m for r in spark.table("t7_gold.a").collect()}
    assert rows == {0: "a b/0", 2: "a b/1", 4: "a b/0", 6: None, 8: "a b/0"}
    again = spark.table("t7_gold.a").where("twice > 2")
    assert tables.materialize(again, "t7_gold.a", comment="second", partition_by=["m"]) == 3
    assert sorted(r.twice for r in spark.table("t7_gold.a").collect()) == [4, 6, 8]
    found = tables.list_tables(spark, "t7_gold").collect()
    assert [(r.table_name, r.comment) for r in found] == [("a", "second")]
    assert tables.materialize(spark.range(0), "t7_gold.a") == 0
    assert spark.table("t7_gold.a").columns == ["id"] and spark.table("t7_gold.a").count() == 0


def test_an_exchange_that_fails_is_undone(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS t8_gold")
    tables.materialize(spark.range(5), "t8_gold.a")
    tables.materialize(spark.range(3), "t8_gold.b")
    with pytest.raises(Exception):
        tables._take_place(spark, "t8_gold.missing", "t8_gold.a")
    assert spark.table("t8_gold.a").count() == 5
    assert sorted(t.name for t in spark.catalog.listTables("t8_gold")) == ["a", "b"]


def test_rows_are_counted_by_the_write(spark):
    """One job writes and counts; no second scan."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS t9_gold")
    jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
    before = jobs()
    assert tables.materialize(spark.range(0, 1000, 1, 4), "t9_gold.a") == 1000
    assert jobs() - before == 1


def test_tables_are_loaded_side_by_side(spark, monkeypatch):
    """One load waits for the other, which it could not if they came one after the other."""
    both = threading.Barrier(2, timeout=30)

    def load(spark, path, schema, table, **options):
        both.wait()
        return len(table)

    monkeypatch.setattr(tables, "ingest", load)
    files = {"orders": "orders/", "sellers": "sellers.csv"}
    assert tables.ingest_all(spark, "/landing", files, layer="l") == {"orders": 8, "sellers": 9}


def test_first_failure_of_loads_side_by_side(spark):
    def fails():
        raise ValueError("second")

    with pytest.raises(ValueError, match="second"):
        tables.side_by_side(spark, [lambda: 1, fails, lambda: 3], at_once=2)
    assert tables.side_by_side(spark, [lambda: 1, lambda: 2]) == [1, 2]
