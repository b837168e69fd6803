"""Stored order and stored versions: what is read and written again."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tradeloom.sources import tables
from tradeloom.sources.dimensions import store_dimension, update_dimension


def _rows_scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


@pytest.fixture
def all_partitions(spark):
    """Test tables are so small that adaptive execution would write one file."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_month_filter_skips_rows_of_an_ordered_table(spark, all_partitions):
    spark.sql("CREATE SCHEMA IF NOT EXISTS s1_gold")
    months = spark.range(0, 24000, 1, 8).select("id", F.format_string("2017-%02d", F.col("id") % 12 + 1).alias("m"))
    tables.materialize(months, "s1_gold.plain")
    assert tables.materialize(months, "s1_gold.ordered", order_by=["m"]) == 24000

    def two(name):
        return spark.table(f"s1_gold.{name}").where("m BETWEEN '2017-03' AND '2017-04'").select("id")

    assert sorted(two("ordered").collect()) == sorted(two("plain").collect())
    assert _rows_scanned(two("plain")) == 24000
    assert _rows_scanned(two("ordered")) <= 9000


def test_hot_value_becomes_several_files(spark, all_partitions):
    spark.sql("CREATE SCHEMA IF NOT EXISTS s2_gold")
    one = spark.range(0, 8000, 1, 8).select("id", F.lit("2017-01").alias("m"))
    tables.materialize(one, "s2_gold.hot", order_by=["m"], stamp=True)
    sizes = [r["count"] for r in spark.table("s2_gold.hot").groupBy("_metadata.file_name").count().collect()]
    assert sum(sizes) == 8000 and len(sizes) == 8 and max(sizes) < 2000


DAY = datetime.date


def _stored(spark, name):
    spark.sql("CREATE SCHEMA IF NOT EXISTS s3_silver")
    rows = [(1, "a", DAY(2018, 1, 1), None, True), (2, "b", DAY(2018, 1, 1), None, True),
            (2, "old", DAY(2017, 1, 1), DAY(2018, 1, 1), False), (3, None, DAY(2018, 1, 1), None, True)]
    df = spark.createDataFrame(rows, "id INT, city STRING, valid_from DATE, valid_to DATE, is_current BOOLEAN")
    assert store_dimension(df, f"s3_silver.{name}") == 4
    return f"s3_silver.{name}"


def _files(spark, table, where):
    found = spark.table(table).where(where).select("_metadata.file_path").distinct().collect()
    return {(r.file_path, os.path.getmtime(r.file_path.removeprefix("file:"))) for r in found}


def _versions(spark, table):
    columns = ("id", "city", "valid_from", "valid_to", "is_current")
    return sorted((tuple(r) for r in spark.table(table).select(*columns).collect()), key=repr)


def test_closed_versions_keep_their_files(spark):
    table = _stored(spark, "d1")
    before = _files(spark, table, "NOT is_current")
    snapshot = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "id INT, city STRING")
    update = (snapshot, "id", ["city"], DAY(2019, 1, 1))
    assert update_dimension(spark, table, *update) == 5
    assert _files(spark, table, "valid_to = DATE '2018-01-01'") == before
    expected = [
        (1, "a", DAY(2018, 1, 1), None, True), (2, "B", DAY(2019, 1, 1), None, True),
        (2, "b", DAY(2018, 1, 1), DAY(2019, 1, 1), False), (2, "old", DAY(2017, 1, 1), DAY(2018, 1, 1), False),
        (3, None, DAY(2018, 1, 1), None, True), (4, "d", DAY(2019, 1, 1), None, True)]
    assert _versions(spark, table) == sorted(expected, key=repr)
    # The same update again, as after a run that was cut off.
    update_dimension(spark, table, *update)
    assert _versions(spark, table) == sorted(expected, key=repr)
    # A later day leaves the versions closed so far alone.
    closed = _files(spark, table, "NOT is_current")
    later = spark.createDataFrame([(1, "A"), (2, "B")], "id INT, city STRING")
    update_dimension(spark, table, later, "id", ["city"], DAY(2020, 1, 1))
    assert closed <= _files(spark, table, "NOT is_current")
    assert len(_versions(spark, table)) == 7


def test_only_open_versions_are_read(spark):
    table = _stored(spark, "d2")
    plan = spark.table(table).where(F.col("valid_to").isNull() | (F.col("valid_to") == DAY(2019, 1, 1)))
    assert len(plan.inputFiles()) >= 1 and plan.where("city = 'old'").count() == 0
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(valid_to" in text


def test_empty_snapshot_and_a_failing_update_change_nothing(spark):
    table = _stored(spark, "d3")
    before = _versions(spark, table)
    empty = spark.createDataFrame([], "id INT, city STRING")
    update_dimension(spark, table, empty, "id", ["city"], DAY(2019, 1, 1))
    assert _versions(spark, table) == before
    early = spark.createDataFrame([(1, "x")], "id INT, city STRING")
    with pytest.raises(Exception, match="as_of is before"):
        update_dimension(spark, table, early, "id", ["city"], DAY(2000, 1, 1))
    spark.catalog.refreshTable(table)
    assert _versions(spark, table) == before
