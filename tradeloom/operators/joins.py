"""Foreign-key joins that stay balanced when a few keys hold most rows.

A join with an exchange of its own on both sides is left to adaptive execution,
which splits its skewed partitions. That cannot be done where one side keeps the
partitioning of the joins below it. ``fk_join`` splits hot keys there itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPREAD = "_spread"
SLOT = "_slot"

# Slots per fair share of a partition: small slots even out where hashing puts
# several of them into one partition.
_SLOTS_PER_SHARE = 4

# Counters of the summary of frequent keys, and how many Spark's summary takes.
_COUNTERS_PER_PARTITION = 16
_MOST_COUNTERS = 1_000_000
_SUMMARISED = (T.IntegralType, T.StringType, T.DecimalType, T.DateType, T.TimestampType)


def with_spread(df: DataFrame) -> DataFrame:
    """Add a number that differs from row to row, used to split hot keys.

    Add it right on a scan: there the row order, and so the number, is the same
    when a lost task is run again. Identical rows still get different numbers.
    """
    return df.withColumn(SPREAD, F.monotonically_increasing_id())


def hot_keys(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """(_hot_key, _ways): every value, NULL too, that holds more than the fair
    share of one of ``partitions`` (the session's shuffle partitions), and the
    number of ways to split it. A part of the plan that uses it.

    Fewer values than ``partitions`` can hold more than that share. A summary of
    frequent values, kept by each task and merged, names twice as many
    candidates; only their rows are then counted, exactly, so that no other key
    is shuffled. The summary's counters number sixteen to a partition: a count
    is off by at most 3.5 rows in as many as there are counters, so no value
    above the share can be missing from it. Keys of types without such a summary
    and more partitions than its counters allow are counted in full.
    """
    if partitions is None:
        partitions = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    name = F.col(key).alias("_hot_key")
    counters = max(1024, _COUNTERS_PER_PARTITION * partitions)
    if counters <= _MOST_COUNTERS and isinstance(df.schema[key].dataType, _SUMMARISED):
        quoted = "`{}`".format(key.replace("`", "``"))
        frequent = F.expr(f"approx_top_k({quoted}, {2 * partitions}, {counters})")
        named = df.agg(F.count("*").alias("_total"), frequent.alias("_top")).select(
            "_total", F.explode("_top.item").alias("_candidate"))
        rows = df.select(name).join(F.broadcast(named), F.col("_hot_key").eqNullSafe(F.col("_candidate")))
        total = F.max("_total")
    else:
        rows, total = df.select(name), df.agg(F.count("*")).scalar()
    shares = F.col("_n") * F.lit(partitions) / F.col("_total")
    counts = rows.groupBy("_hot_key").agg(F.count("*").alias("_n"), total.alias("_total"))
    return counts.where(shares > 1).select(
        "_hot_key", F.ceil(shares * _SLOTS_PER_SHARE).cast("int").alias("_ways"))


def fk_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join rows to the one ``right`` row of their key ("left" or "inner").

    Without hot keys this is an ordinary join and Catalyst picks broadcast or
    sort-merge. ``left`` may have its ``with_slot`` already. With ``hot_keys``, the left rows of a hot key go to several
    partitions by their ``_spread`` number, and its single right row is copied
    to each of them. All copies together number about four times the shuffle
    partitions. Rows whose key is NULL are split the same way in a left join.
    """
    if hot is None:
        return left.join(right, key, how)
    if SLOT not in left.columns:
        left = with_slot(left, key, hot)
    marks = F.broadcast(hot)  # fewer rows than partitions
    right_copies = right.join(marks, right[key] == F.col("_hot_key"), "left").withColumn(
        SLOT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ways"), F.lit(1)) - 1))
    )
    return left.join(right_copies.drop("_hot_key", "_ways"), [key, SLOT], how).drop(SLOT)


def with_slot(left: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Add the slot of each row, 0 for all but hot keys and where there are none.

    Where other joins shuffle the rows before, it goes along for next to nothing,
    unlike the ``_spread`` number it is made from.
    """
    if hot is None:
        return left.withColumn(SLOT, F.lit(0))
    slot = F.pmod(F.xxhash64(SPREAD), F.col("_ways")).cast("int")
    return left.join(F.broadcast(hot), left[key].eqNullSafe(F.col("_hot_key")), "left").withColumn(
        SLOT, F.coalesce(slot, F.lit(0))).drop("_hot_key", "_ways")
