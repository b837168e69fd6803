"""Benchmark items inside documents: size-partitioned MinHash containment search.

An item is found in a document when at least ``share`` of its distinct 5-word
shingles occur there. Jaccard sketches say little about that, since documents
are far longer than items, so the sketch is one-sided: of each item the
shingles with the smallest hashes are kept and looked up among all shingles of
the documents. An item of n shingles that is contained to ``share`` lacks at
most (1 - share) * n of them, so a sketch of one more cannot miss it. Items are
partitioned by size, and each partition's sketches are as long as its largest
item needs. Hits are verified on the shingles themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.shared import let, written

WIDTH = 5
SHARE = 0.8
# Rows of (hash, item) or (shingle, item) that may be broadcast: below 64 MB with their texts.
BROADCAST_ROWS = 250_000
_PARTED = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    """Words of the lower-cased text; none for NULL."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), _PARTED)
    return F.filter(parts, lambda w: w != "")


def _joined(words: Column, width: int) -> Column:
    """All runs of ``width`` words as texts."""
    def runs(w: Column) -> Column:
        last = F.size(w) - width
        each = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(
            " ", *[F.get(w, i + k) for k in range(width)]))
        return F.when(last >= 0, each).otherwise(F.array().cast("array<string>"))

    return let(words, runs)


def _hashed(words: Column, width: int) -> Column:
    """64-bit hashes of all runs of ``width`` words, made from hashes of the words."""
    def runs(h: Column) -> Column:
        last = F.size(h) - width
        each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
            *[F.get(h, i + k) for k in range(width)]))
        return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for the smaller side of a join: broadcast only up to a number of rows."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def item_shingles(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, width, shingle, hash, n_shingles): distinct shingles of each item.
    Items shorter than ``width`` words have all their words as one shingle;
    items without words have none."""
    words = items.select(F.col("item_id").cast("long").alias("item_id"), _words(F.col("text")).alias("w"))
    by_width = None
    for k in range(1, width + 1):
        mine = words.where(F.size("w") == k) if k < width else words.where(F.size("w") >= k)
        rows = mine.select(
            "item_id", F.lit(k).alias("width"),
            F.explode(F.arrays_zip(_joined(F.col("w"), k).alias("shingle"),
                                   _hashed(F.col("w"), k).alias("hash"))).alias("s"))
        rows = rows.select("item_id", "width", "s.shingle", "s.hash").distinct()
        by_width = rows if by_width is None else by_width.unionByName(rows)
    sizes = by_width.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    return by_width.join(sizes, by_width["item_id"].eqNullSafe(sizes["item_id"])).drop(
        sizes["item_id"])


def sketches(shingles: DataFrame, share: float = SHARE) -> DataFrame:
    """(width, hash): per item the smallest hashes, as many as the largest size
    of its partition (sizes between two powers of two) needs."""
    top = F.pow(F.lit(2.0), F.ceil(F.log2("n_shingles")))
    needed = F.floor(top * (1 - share) + 1e-9) + 1
    order = Window.partitionBy("item_id").orderBy("hash")
    ranked = shingles.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= needed).select("width", "hash").distinct()


def contained_items(
    docs: DataFrame, items: DataFrame, share: float = SHARE, width: int = WIDTH
) -> DataFrame:
    """(doc_id, item_id, shared, n_shingles, containment) for every document that
    holds at least ``share`` of an item's distinct shingles.

    Texts are lower-cased and words are parted by white space. NULL and empty
    texts hold nothing. Rows with equal doc_id count as one document; rows
    without doc_id as one more. Items without words are never found.
    """
    wanted = written(item_shingles(items, width))
    sketch = written(sketches(wanted, share))
    n_wanted, n_sketch = wanted.count(), sketch.count()
    widths = [r[0] for r in wanted.select("width").distinct().collect()]  # at most `width` values
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = _words(F.col("text"))

    def rows(frame: DataFrame, shingles, name: str, k: int) -> DataFrame:
        return frame.select(
            "doc_id", F.lit(k).alias("width"), F.explode(shingles(words, k)).alias(name))

    hits = None
    for k in widths:
        found = rows(texts, _hashed, "hash", k).join(
            _small(sketch.where(F.col("width") == k), n_sketch), ["width", "hash"], "left_semi"
        ).select("doc_id").distinct()
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = texts.select("doc_id").limit(0)
    hits = written(hits.distinct().withColumnRenamed("doc_id", "_hit"))
    near = texts.join(_small(hits, hits.count()), F.col("doc_id").eqNullSafe(F.col("_hit")), "left_semi")
    pairs = None
    for k in widths or [width]:
        mine = rows(near, _joined, "shingle", k).join(
            _small(wanted.where(F.col("width") == k).drop("hash", "width"), n_wanted), "shingle")
        pairs = mine if pairs is None else pairs.unionByName(mine)
    # One row for each shingle of a pair and task; repeats within a document fall away here.
    distinct = pairs.select("doc_id", "item_id", "n_shingles", "shingle").distinct()
    return (
        distinct.groupBy("doc_id", "item_id", "n_shingles").agg(F.count("*").alias("shared"))
        .withColumn("containment", F.col("shared") / F.col("n_shingles"))
        .where(F.col("containment") >= share)
        .select("doc_id", "item_id", "shared", "n_shingles", "containment")
    )


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item. Rows without doc_id share one
    verdict."""
    found = written(contained_items(docs, items).select(F.col("doc_id").alias("_found")).distinct())
    return docs.join(
        _small(found, found.count()), docs["doc_id"].eqNullSafe(F.col("_found")), "left_anti")


def contained_sql() -> str:
    """The same pairs in DuckDB SQL, by joining all shingles."""
    def shingles(table: str, key: str) -> str:
        split = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
        return f"""SELECT DISTINCT {key}, unnest([array_to_string(w[i:i+4], ' ')
            FOR i IN range(1, len(w) - 3)]) AS s FROM (SELECT {key}, {split} AS w FROM {table})"""
    return f"""
    WITH d AS ({shingles('documents', 'doc_id')}), b AS ({shingles('benchmark', 'item_id')}),
    n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
    SELECT doc_id, item_id, count(*) AS shared, n_shingles, count(*) / n_shingles AS containment
    FROM d JOIN b USING (s) JOIN n USING (item_id)
    GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= {SHARE} * n_shingles"""
