"""Writing tables, layer namespaces and table listings."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradeloom.schemas import RAW_SCHEMAS
from tradeloom.sources.csv_files import read_csv, split_bad_rows, with_audit_columns

LAYERS = {
    "landing_zone": "Raw files as delivered",
    "bronze": "Raw files as typed tables with audit columns",
    "silver": "Cleaned, deduplicated and joined tables",
    "gold": "Aggregates and cross-tabs for reporting",
}

#: Loads that run side by side: the cores that the last tasks of one leave idle take those of the next.
AT_ONCE = 4

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_layers(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create one schema per layer where absent; returns their names."""
    names = [prefix + layer for layer in LAYERS]
    for name, comment in zip(names, LAYERS.values()):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT {_sql_text(comment)}")
    return names


def use_layer(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def list_layers(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    found = [(d.name, d.description) for d in spark.catalog.listDatabases(pattern)]
    return spark.createDataFrame(found, "name STRING, comment STRING").orderBy("name")


def list_catalogs(spark: SparkSession, condition: str | None = None) -> DataFrame:
    """Catalogs known to the session, optionally narrowed by a SQL condition."""
    catalogs = spark.sql("SHOW CATALOGS")
    return catalogs if condition is None else catalogs.filter(condition)


def list_tables(spark: SparkSession, layer: str, pattern: str | None = None) -> DataFrame:
    """(table_name, comment) of the tables whose name matches, in name order."""
    found = [
        (t.name, t.description)
        for t in spark.catalog.listTables(layer, pattern)
        if not t.isTemporary
    ]
    return spark.createDataFrame(
        found, "table_name STRING, comment STRING"
    ).orderBy("table_name")


def materialize(
    df: DataFrame,
    table: str,
    *,
    mode: str = "overwrite",
    fmt: str = "parquet",
    comment: str | None = None,
    stamp: bool = False,
    partition_by: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> int:
    """Write ``df`` as a managed table and return the row count of the table.

    A table that is replaced stays as it is until the new one is complete: rows
    are written under another name, and names are exchanged afterwards. A write
    that fails leaves the old rows in place, and ``df`` may read ``table``
    itself. Delta replaces in one commit of its own. The rows of a new table are
    counted by the write, not by another scan.

    ``stamp`` adds ``_updated_ts``. With ``partition_by`` the rows are
    rebalanced on those columns first: AQE then cuts a partition that is too
    large into several files and joins small ones, whatever the skew.

    With ``order_by`` files hold ranges of those columns and are sorted by them,
    so that filters on them skip files and row groups. Rows with the same values
    are told apart by a hash of the whole row, so that a value with very many
    rows becomes several files.
    """
    spark = df.sparkSession
    if stamp:
        df = df.withColumn("_updated_ts", F.current_timestamp())
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if order_by:
        df = df.repartitionByRange(*order_by, F.xxhash64(*[c for c in df.columns if c != "_updated_ts"]))
        df = df.sortWithinPartitions(*partition_by, *order_by)
    staged = mode == "overwrite" and fmt != "delta" and spark.catalog.tableExists(table)
    target = f"{table}__{uuid.uuid4().hex}" if staged else table
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(target)
        if comment:
            spark.sql(f"COMMENT ON TABLE {target} IS {_sql_text(comment)}")
    except BaseException:
        if staged:
            spark.sql(f"DROP TABLE IF EXISTS {target}")
        raise
    if staged:
        _take_place(spark, target, table)
    return counted.get["rows"] if mode == "overwrite" else spark.table(table).count()


def insert_over(df: DataFrame, table: str, partition_by: Sequence[str]) -> int:
    """Replace the partitions of ``table`` that ``df`` has rows for, and no others;
    returns the number of rows written. ``df`` may read ``table`` itself.

    The session replaces only such partitions while this runs; inserts take the
    mode from there.
    """
    spark, counted = df.sparkSession, Observation()
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    rows = df.hint("rebalance", *partition_by).observe(counted, F.count(F.lit(1)).alias("rows"))
    spark.conf.set(name, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(name, before)
    return counted.get["rows"]


def _take_place(spark: SparkSession, new: str, table: str) -> None:
    """Give ``new`` the name of ``table``, which is dropped; undone if the exchange fails."""
    old = f"{table}__{uuid.uuid4().hex}"
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except BaseException:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    _find_partitions(spark, table)
    spark.sql(f"DROP TABLE {old}")


def _find_partitions(spark: SparkSession, table: str) -> None:
    """Point the partitions of a renamed table to where its files are now; some
    catalogs move the files and keep the partitions' old places."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "# Partition Information" not in facts:
        return
    for (path,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        pairs = [part.split("=", 1) for part in path.split("/")]
        spec = ", ".join(
            f"`{unquote(name)}` = {'NULL' if value == _NULL_PARTITION else _sql_text(unquote(value))}"
            for name, value in pairs)
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {_sql_text(facts['Location'] + '/' + path)}")
    spark.catalog.refreshTable(table)


def ingest(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    table: str,
    *,
    source_name: str | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    multiline: bool = False,
    split: bool = False,
    quarantine: str | None = None,
) -> int:
    """Load CSV files into ``table`` with audit columns; returns its row count.

    Rows with bad fields stay in the table with those fields NULL. Name a
    ``quarantine`` table to also keep their raw lines there. ``multiline`` and
    ``split`` are those of ``read_csv``.
    """
    rows = read_csv(spark, path, schema, multiline=multiline, split=split)
    if quarantine is not None:
        _, bad = split_bad_rows(spark, path, schema, multiline=multiline, split=split)
        materialize(with_audit_columns(bad, source_name), quarantine, mode=mode, fmt=fmt)
    return materialize(with_audit_columns(rows, source_name), table, mode=mode, fmt=fmt)


def side_by_side(spark: SparkSession, calls: Sequence[Callable[[], object]], at_once: int = AT_ONCE) -> list:
    """Results of independent calls, in order; their jobs share the cluster. The
    first failure in order is raised once the calls that have begun are over;
    calls that have not begun by then are left out."""
    with ThreadPoolExecutor(at_once) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
        try:
            return [each.result() for each in begun]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def ingest_all(
    spark: SparkSession,
    landing: str,
    files: Mapping[str, str],
    layer: str = "bronze",
    **options,
) -> dict[str, int]:
    """Load every ``{table: file name}`` under ``landing``; {table: row count}.

    A value may also be a directory or glob of files with the same layout. Tables
    are loaded side by side, but one after the other where they share a quarantine.
    """
    def load(table: str, file: str) -> int:
        literal = None if any(c in file for c in "*?[{") or file.endswith("/") else file
        return ingest(
            spark,
            f"{landing.rstrip('/')}/{file}",
            RAW_SCHEMAS[table],
            f"{layer}.{table}",
            source_name=literal,
            **options,
        )

    loads = [functools.partial(load, table, file) for table, file in files.items()]
    at_once = AT_ONCE if options.get("quarantine") is None else 1
    return dict(zip(files, side_by_side(spark, loads, at_once)))


def sample_rows(df: DataFrame, columns: Sequence[str] = ("*",), n: int = 5) -> DataFrame:
    """The first ``n`` rows of a few columns, for a look at the data."""
    return df.select(*columns).limit(n)


def scalar(df: DataFrame):
    """The single value of a one-row, one-column result."""
    row = df.first()
    return None if row is None else row[0]
