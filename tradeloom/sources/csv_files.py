"""CSV scans with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.schemas import RAW_TIMESTAMP_FORMAT
from tradeloom.sources.csv_records import read_records

CORRUPT_COLUMN = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    *,
    multiline: bool = False,
    split: bool = False,
    timestamp_format: str = RAW_TIMESTAMP_FORMAT,
) -> DataFrame:
    """Scan headered CSV files; a field that does not parse becomes NULL.

    By default each physical line is a record, so large files are split over
    many tasks. ``multiline`` keeps quoted line breaks and doubled quotes
    intact, at the price of one task per file. With ``split`` as well large
    files are split all the same (see ``read_records`` for its demands on the
    files), and rows carry the name of their file in ``_source_file``.
    """
    if multiline and split:
        options = {"mode": "PERMISSIVE", "timestampFormat": timestamp_format, "escape": '"'}
        parsed = F.from_csv("_record", schema, options).alias("_parsed")
        return read_records(spark, path).select(parsed, "_source_file").select("_parsed.*", "_source_file")
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("timestampFormat", timestamp_format)
    )
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    return reader.csv(path)


def with_audit_columns(df: DataFrame, source_name: str | None = None) -> DataFrame:
    """Add ``_ingestion_ts`` and ``_source_file``.

    Without ``source_name`` each row carries the name of the file it came from,
    which is what a directory of many files needs.
    """
    if source_name is not None:
        source = F.lit(source_name)
    elif "_source_file" in df.columns:
        source = F.col("_source_file")
    else:
        source = F.col("_metadata.file_name")
    others = [c for c in df.columns if c != "_source_file"]
    return df.select(
        *others, F.current_timestamp().alias("_ingestion_ts"), source.alias("_source_file"))


def split_bad_rows(
    spark: SparkSession, path: str | list[str], schema: str, **options
) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed in full, rows with at least one bad field).

    The second frame keeps the raw line in ``_corrupt_record``. Spark refuses
    to read that column on its own, so write the bad rows out before counting.
    """
    rows = read_csv(spark, path, f"{schema}, {CORRUPT_COLUMN} STRING", **options)
    is_bad = F.col(CORRUPT_COLUMN).isNotNull()
    return rows.where(~is_bad).drop(CORRUPT_COLUMN), rows.where(is_bad)
