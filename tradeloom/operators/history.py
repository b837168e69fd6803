"""Versioned dimensions and comparisons with the year before."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _differs(columns: Sequence[str], left: str, right: str) -> Column:
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return changed


def apply_changes(
    dimension: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: datetime.date | Column,
) -> DataFrame:
    """Bring a versioned dimension up to date with a snapshot of its source.

    ``dimension`` has the snapshot's columns plus ``valid_from``, ``valid_to``
    and ``is_current``, with at most one current version per key; ``snapshot``
    has one row per key. Where a tracked column differs (NULLs compared as
    values) the current version is closed on ``as_of`` and a new one opened; new
    keys get a first version. Keys missing from the snapshot stay as they are.
    An ``as_of`` before the start of a version to close raises an error.
    Returns the whole new dimension; write it to another place than the old one.
    """
    day = F.lit(as_of) if isinstance(as_of, datetime.date) else as_of
    early = F.raise_error(F.lit("as_of is before the start of a version that it would close"))
    day_after = F.when(day >= F.col("old.valid_from"), day).otherwise(early.cast("date"))
    attributes = [c for c in dimension.columns if c not in ("valid_from", "valid_to", "is_current")]
    closed = dimension.where(~F.col("is_current"))
    old = dimension.where(F.col("is_current")).withColumn("_here", F.lit(True)).alias("old")
    new = snapshot.select(*attributes, F.lit(True).alias("_here")).alias("new")
    # One joined row becomes one or two versions, so neither side is read twice.
    is_new = F.col("old._here").isNull()
    is_gone = F.col("new._here").isNull()
    changed = ~is_new & ~is_gone & _differs(tracked, "old", "new")
    old_version = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in attributes],
        F.col("old.valid_from").alias("valid_from"),
        F.when(changed, day_after).otherwise(F.col("old.valid_to")).alias("valid_to"),
        (~changed).alias("is_current"),
    )
    new_version = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in attributes],
        day.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    versions = F.array_compact(
        F.array(F.when(~is_new, old_version), F.when(is_new | changed, new_version))
    )
    joined = old.join(new, F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}")), "full")
    current = joined.select(F.explode(versions).alias("v")).select("v.*")
    return closed.select(*dimension.columns).unionByName(current.select(*dimension.columns))


def year_over_year(monthly: DataFrame, measure: str) -> DataFrame:
    """Add the same month's value of the year before and the change in percent.

    Compares by calendar, so a missing month gives NULL rather than a shift.
    """
    year_before = Window.partitionBy("month").orderBy("year").rangeBetween(-1, -1)
    previous = F.max(measure).over(year_before)
    change = F.try_divide((F.col(measure) - F.col("_previous")) * 100.0, F.col("_previous"))
    return (
        monthly.withColumn("_previous", previous)
        .withColumn(f"{measure}_yoy_pct", F.round(change, 2))
        .withColumnRenamed("_previous", f"{measure}_previous_year")
    )
