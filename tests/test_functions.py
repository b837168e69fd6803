import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.frames import make
from tradeloom.functions.buckets import ValueGroups
from tradeloom.functions.columns import days_between, is_late, tidy_city, tidy_state, volume
from tradeloom.functions.measures import exact_avg, exact_sum, percent
from tradeloom.plans.dashboards import DASHBOARD_BANDS
from tradeloom.plans.gold import REPORT_BANDS

DAYS = [-1, 0, 3, 4, 7, 8, 14, 15, 21, 22, None]


def values(df):
    return [r[0] for r in df.collect()]


def test_report_bands_leave_negative_and_unknown_days_out(spark):
    df = make(spark, "d INT", *[(d,) for d in DAYS]).coalesce(1)
    assert values(df.select(REPORT_BANDS.ordinal(F.col("d")))) == [
        None, 1, 1, 2, 2, 3, 3, 4, 4, 5, None]
    assert values(df.select(REPORT_BANDS.label(F.col("d"))))[:3] == [None, "1-3 days", "1-3 days"]


def test_dashboard_bands_take_negative_days_and_have_an_else(spark):
    df = make(spark, "d INT", *[(d,) for d in DAYS]).coalesce(1)
    assert values(df.select(DASHBOARD_BANDS.ordinal(F.col("d")))) == [
        1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    labels = df.select(DASHBOARD_BANDS.label(F.col("d")).alias("b"))
    assert values(labels) == ["1-3d"] * 3 + ["4-7d"] * 2 + ["8-14d"] * 2 + ["15-21d"] * 2 + [
        "22+d"] * 2
    assert values(labels.select(DASHBOARD_BANDS.ordinal_of(F.col("b")))) == [
        1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_value_groups_put_null_under_other(spark):
    groups = ValueGroups({"a": "A label"})
    df = make(spark, "v STRING", ("a",), ("b",), (None,)).coalesce(1)
    assert values(df.select(groups.label(F.col("v")))) == ["A label", "Other", "Other"]
    assert df.where(groups.contains(F.col("v"))).count() == 1


def test_tidy_names(spark):
    df = make(spark, "c STRING, s STRING", ("  santa barbara d'oeste-mg ", " sp "))
    assert df.select(tidy_city("c"), tidy_state("s")).first() == ("Santa Barbara D'oeste-mg", "SP")


@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ"])
def test_same_day_late_and_undelivered(spark, kind):
    df = make(spark, "d STRING, p STRING", ("2018-01-05 10:00:00", "2018-01-05 00:00:00"),
              ("2018-01-05 00:00:00", "2018-01-05 00:00:00"), (None, "2018-01-05 00:00:00")
              ).select(F.col("d").cast(kind).alias("d"), F.col("p").cast(kind).alias("p"))
    rows = df.coalesce(1).select(is_late("d", "p"), days_between("d", "p")).collect()
    assert [tuple(r) for r in rows] == [(True, 0), (False, 0), (False, None)]


def test_volume_is_long_and_null_safe(spark):
    df = make(spark, "a INT, b INT, c INT", (2000, 2000, 2000), (1, None, 3)).coalesce(1)
    assert values(df.select(volume("a", "b", "c"))) == [8_000_000_000, None]


def test_percent_of_zero_is_null_and_halves_round_up(spark):
    df = make(spark, "n LONG, d LONG", (1, 0), (12345, 100000), (1, 3), (0, 5)).coalesce(1)
    assert values(df.select(percent(F.col("n"), F.col("d"), 2))) == [None, 12.35, 33.33, 0.0]
    assert dict(df.select(percent(F.col("n"), F.col("d"), 2).alias("p")).dtypes) == {"p": "double"}


def test_exact_sum_does_not_depend_on_order_or_partitioning(spark):
    prices = [round(0.07 * i + 0.01 * (i % 3), 2) for i in range(20_000)]
    expected = float(sum(Decimal(str(p)) for p in prices))
    forward = spark.createDataFrame([(p,) for p in prices], "x DOUBLE")
    for df in (forward, forward.repartition(7), forward.orderBy(F.desc("x")).coalesce(1)):
        assert df.agg(exact_sum("x")).first()[0] == expected


def test_other_values_are_summed_exactly_and_rounded_once(spark):
    """Groups of every kind against Python's exact sum; cancelling, mixed, tiny and large values."""
    pick = random.Random(1)
    kinds = [
        lambda: pick.random() * 1e9, lambda: -pick.random(), lambda: pick.choice([1e22, -1e22, 1e-30, 1 / 3e6, 1 / 3e-6]),
        lambda: pick.choice([1e21, 1 / 3, -1e-7, 1e-19, 2.0**60 + 2.0**10]),
        lambda: pick.choice([1, -1]) * pick.random() * 2.0 ** pick.randrange(-110, 80),
        lambda: pick.choice([1e22, -1e22]), lambda: 1e-30, lambda: 2.0**50 * pick.choice([1, 2, -3]) + 0.25,
    ]
    groups = {g: [kinds[g % len(kinds)]() for _ in range(pick.choice([1, 2, 3, 50, 300]))] for g in range(180)}
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    pick.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double").repartition(5)
    found = dict(tuple(r) for r in df.groupBy("g").agg(exact_sum("x")).collect())
    assert found == {g: math.fsum(xs) for g, xs in groups.items()}


def test_exact_sum_edges(spark):
    def total(*xs):
        return make(spark, "`x y` DOUBLE", *[(x,) for x in xs]).agg(exact_sum("x y")).first()[0]

    assert total(None, None) is None
    assert total(None, 0.1, 0.2) == 0.3
    assert total(*[0.0000004] * 1000) == math.fsum([0.0000004] * 1000)  # seven places
    assert total(*[0.01] * 5, 1e-30) == 0.05
    assert total(*[99_999_999.99] * 200) == 19_999_999_998.0
    assert total(0.0, -0.0) == 0.0 and total(2e15, 0.5) == 2e15 + 0.5
    assert total(-1.25, -0.5) == -1.75
    assert total(*[9.0e14] * 20_000) == 1.8e19
    assert total(9e14, 1e-7, -9e14) == 1e-7
    assert total(1e300, 1.0) == 1e300 and total(1e-300) == 0.0  # beyond the exact range
    assert math.isnan(total(1.0, float("nan"))) and math.isnan(total(float("inf"), float("-inf")))
    assert total(1.0, float("inf")) == float("inf")
    assert total(float("inf")) == float("inf")


def test_exact_avg_skips_nulls_and_empty_groups(spark):
    df = make(spark, "k INT, x DOUBLE", (1, 1.0), (1, None), (1, 2.0), (2, None))
    got = dict(df.groupBy("k").agg(exact_avg("x")).collect())
    assert got == {1: 1.5, 2: None}
