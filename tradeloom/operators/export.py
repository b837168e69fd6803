"""Nested export of cross-tabs for a report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nest_by(dim: str, sections: Mapping[str, DataFrame]) -> DataFrame:
    """One row per value of ``dim`` with an array of structs per section.

    For finished cross-tabs, which hold a few rows per value. A value missing
    from a section has NULL there.
    """
    rows = [
        df.select(dim, *[
            (F.struct(*[c for c in df.columns if c != dim]) if other == name else F.lit(None)).alias(other)
            for other in sections
        ])
        for name, df in sections.items()
    ]
    # One aggregation over the stacked sections, so that NULL is one value like others.
    stacked = reduce(DataFrame.unionByName, rows)
    nested = [F.array_sort(F.collect_list(name)) for name in sections]
    return stacked.groupBy(dim).agg(*[
        F.when(F.size(array) > 0, array).alias(name) for name, array in zip(sections, nested)
    ])


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
