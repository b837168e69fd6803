"""Stored versioned dimensions."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators.history import apply_changes
from tradeloom.sources.tables import insert_over, materialize

END = "valid_to"


def store_dimension(dimension: DataFrame, table: str, **options) -> int:
    """Write a versioned dimension so that ``update_dimension`` can bring it up to
    date: one partition of open versions, one for each day on which versions were
    closed. Returns its row count."""
    return materialize(dimension, table, partition_by=[END], **options)


def update_dimension(
    spark: SparkSession,
    table: str,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: datetime.date,
) -> int:
    """``apply_changes`` on a stored dimension; returns how many rows were written.

    Only open versions and those closed on ``as_of`` are read and written again.
    Partitions of versions closed on other days are neither opened nor changed,
    so the cost follows the number of keys, not the length of the history. All
    partitions are staged and put in place when the job is complete. Running the
    same update again changes nothing, so one that was cut off between two
    partitions can be repeated. An open version must have no ``valid_to``.
    """
    stored = spark.table(table)
    touched = stored.where(F.col(END).isNull() | (F.col(END) == F.lit(as_of)))
    after = apply_changes(touched, snapshot, key, tracked, as_of)
    return insert_over(after.select(*stored.columns), table, [END])
