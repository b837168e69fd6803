"""Keep or describe one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.measures import exact_sum


def latest_by(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The row with the greatest ``newest`` columns per key, NULLs last.

    List enough columns to make the order total. Catalyst turns the ``= 1``
    filter into a group limit that runs before the shuffle, so each task sends
    at most one row per key and a key with very many rows stays harmless.
    """
    order = [F.col(c).desc_nulls_last() for c in newest]
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def dominant_by(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    carry: Mapping[str, str],
    *,
    total: str,
    parts: str,
    first: Sequence[str] = (),
) -> DataFrame:
    """Per key: sum of ``measure``, row count and columns of its largest row.

    ``carry`` maps output names to columns of the row with the greatest
    measure (NULL counts as smallest). Ties go to the smallest of the numeric
    ``first`` columns. One aggregation with map-side combine, so a key with very
    many rows costs one row per task. As the picked columns hold text, Spark
    aggregates by sorting each task's rows first.
    """
    tie_break = [(-F.col(c)).alias(f"_tie_{c}") for c in first]
    payload = [F.col(source).alias(out) for out, source in carry.items()]
    largest = F.max(F.struct(F.col(measure), *tie_break, *payload))
    grouped = df.groupBy(*keys).agg(
        exact_sum(measure).alias(total),
        F.count("*").alias(parts),
        largest.alias("_largest"),
    )
    return grouped.select(
        *keys, total, parts, *[F.col(f"_largest.{out}").alias(out) for out in carry]
    )


def top_values(df: DataFrame, column: str, measure: str, k: int, total: str) -> DataFrame:
    """The ``k`` values of ``column`` with the greatest sum of the measure, which
    is returned as ``total``, unrounded. Ties go to the smaller value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(exact_sum(measure).alias(total))
        .orderBy(F.col(total).desc_nulls_last(), F.col(column))
        .limit(k)
    )
