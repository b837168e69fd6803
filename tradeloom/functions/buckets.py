"""Labels for ranges of numbers and for groups of values."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Consecutive ranges ``(label, upper bound)``, bounds inclusive.

    The last band has no upper bound. ``floor`` is the lowest value that gets a
    label. Without a floor the first band also takes everything below, and the
    last band also takes NULL (it is the ELSE branch): filter NULLs out first.
    """

    steps: tuple[tuple[str, int | None], ...]
    floor: int | None = None

    def _pick(self, value: Column, results: list) -> Column:
        branch = F
        if self.floor is not None:
            branch = branch.when(value < self.floor, F.lit(None))
        for (_, upper), result in zip(self.steps[:-1], results):
            branch = branch.when(value <= upper, F.lit(result))
        if self.floor is not None:
            return branch.when(value.isNotNull(), F.lit(results[-1]))
        return branch.otherwise(F.lit(results[-1]))

    def label(self, value: Column) -> Column:
        return self._pick(value, [label for label, _ in self.steps])

    def ordinal(self, value: Column) -> Column:
        """Position of the value's band, from 1."""
        return self._pick(value, list(range(1, len(self.steps) + 1)))

    def ordinal_of(self, label: Column) -> Column:
        """Position of an already computed label; unknown labels count as last."""
        branch = F
        for position, (name, _) in enumerate(self.steps[:-1], start=1):
            branch = branch.when(label == name, F.lit(position))
        return branch.otherwise(F.lit(len(self.steps)))


@dataclass(frozen=True)
class ValueGroups:
    """Display label per value; every other value, NULL included, is ``other``."""

    labels: Mapping[str, str]
    other: str = "Other"

    def label(self, value: Column) -> Column:
        branch = F
        for source, display in self.labels.items():
            branch = branch.when(value == source, F.lit(display))
        return branch.otherwise(F.lit(self.other))

    def contains(self, value: Column) -> Column:
        return value.isin(*self.labels)
