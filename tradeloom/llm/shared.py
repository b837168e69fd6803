"""Helpers of the corpus operators: written tables, ranks, components, local names, memory of workers."""

from __future__ import annotations

import ctypes
import inspect
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# ASCII white space that parts words in every contract here.
WORDS = "[^\\x20\\x09-\\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's checkpoint folder, or a
    folder in its warehouse where none is set."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: computed
    once, and still there when an executor is lost."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def give_back() -> None:
    """Return memory that Arrow and the C library hold unused to the system. Workers
    live on after a task, so that an executor would keep the most that each ever took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, others may not
    if trim is not None:
        trim(0)


def lean(function: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``function`` of one or two groups, whose working memory goes back after each call."""
    def after(found: pa.Table) -> pa.Table:
        give_back()
        return found

    if len(inspect.signature(function).parameters) == 1:  # Spark counts the parameters too
        return lambda table: after(function(table))
    return lambda one, other: after(function(one, other))


def byte_length(text: Column) -> Column:
    """Length in UTF-8 bytes, 0 for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_groups(docs: DataFrame, group_bytes: int, least: int = 48) -> int:
    """Number of groups of about ``group_bytes`` of text that the documents make."""
    total = docs.agg(F.sum(byte_length(F.col("text")))).first()[0] or 0
    return int(max(least, -(-total // group_bytes)))


def gapless_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, buckets: int
) -> DataFrame:
    """Number the rows of each key from 0 without gaps.

    Rows of a key are dealt over ``buckets`` by a hash of ``order``; each bucket
    is numbered by itself and moved up by the rows in the buckets before it, so
    that a key with any share of the rows is never numbered in one task.
    """
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = spread.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    starts = counts.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_bucket").alias("_key_bucket"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    same = F.col("_bucket") == F.col("_key_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return (
        spread.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(starts, same)
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("long"))
        .select(*df.columns, name)
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b: longs): equal roots where
    a path of edges joins two nodes.

    Every node is merged into the least node next to it and the edges are
    redrawn between the merged nodes, until none is left. Least means smallest
    in even rounds, which folds a star at once, and smallest by a new hash in
    odd rounds, which halves any chain on average. Rounds are written tables.
    """
    edges = written(edges.where("a <> b").select("a", "b").distinct())
    merged = []
    while not edges.isEmpty():
        salt = F.lit(len(merged))
        weight = (lambda c: c) if len(merged) % 2 == 0 else (lambda c: F.xxhash64(c, salt))
        both = edges.union(edges.select("b", "a"))
        to = F.min(F.struct(weight(F.col("b")).alias("w"), F.col("b").alias("node")))
        own = F.struct(weight(F.col("a")).alias("w"), F.col("a").alias("node"))
        step = written(
            both.groupBy("a").agg(to.alias("to"))
            .select(F.col("a").alias("node"), F.least("to", own)["node"].alias("parent"))
        )
        merged.append(step)
        left = step.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = step.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = written(
            edges.join(left, "a").join(right, "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
    if not merged:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    root = merged.pop().withColumnRenamed("parent", "root")
    while merged:
        higher = root.select(F.col("node").alias("parent"), "root")
        root = merged.pop().join(higher, "parent", "left").select(
            "node", F.coalesce("root", "parent").alias("root")
        )
    return root
