"""SpotSigs document fingerprints, in DataFrame functions only.

A signature is a common word (the anchor) with the next content words after it,
so that texts are told apart by their prose and not by menus or tables. The
fingerprint of a document is the set of its signatures. Sets are compared by
Jaccard, which needs similar sizes: candidates are looked for only in the same
or the next partition by set length, and only under a set's rarest signatures,
of which two similar sets must share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.shared import let, text_groups

CHAIN = 2
# An anchor's content words are looked for among this many words after it.
REACH = 10
SIMILAR = 0.8
BUCKET_BYTES = 8 << 20
_QUANTILES = 100
# Buckets whose first ids (16 bytes each) may be broadcast; with more they are joined by shuffle.
BROADCAST_BUCKETS = 250_000
# The commonest words of English, German, French and Spanish.
ANCHORS = tuple("""
    the of and to in a is that it was for on are as with his they at be this from or one had by
    der die und das den von zu mit ist ein eine im nicht des dem auf sich für als auch sie es an
    le la les de du et en un une que qui est dans pour au par sur pas plus ne se ce il avec son
    el los las y por con para del al lo como más o pero sus no su
""".split())
_PARTED = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def signatures(text: Column) -> Column:
    """Sorted distinct 32-bit signatures of a text, never empty: a text without
    any has one of all its words."""
    words = F.filter(F.split(F.lower(text), _PARTED), lambda w: w != "")

    def chain(w: Column, anchor: Column, at: Column) -> Column:
        content = F.filter(F.slice(w, at + 2, F.lit(REACH)), lambda x: ~x.isin(*ANCHORS))
        return let(content, lambda c: F.when(
            F.size(c) >= CHAIN, F.hash(anchor, *[F.get(c, k) for k in range(CHAIN)])))

    def spotted(w: Column) -> Column:
        found = F.transform(w, lambda x, i: F.when(x.isin(*ANCHORS), chain(w, x, i)))
        distinct = F.array_sort(F.array_distinct(F.array_compact(found)))
        return let(distinct, lambda s: F.when(F.size(s) > 0, s).otherwise(
            F.array(F.hash(F.array_join(w, " ")))))

    return let(words, spotted)


def as_text(found: Column) -> Column:
    """A set of signatures as a string: equal for equal sets."""
    return F.array_join(F.transform(found, lambda s: F.lpad(
        F.lower(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def jaccard(one: Column, other: Column) -> Column:
    return let(F.size(F.array_intersect(one, other)), lambda both: both / (
        F.size(one) + F.size(other) - both))


def _in_order(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents with ``bucket``, which grows with doc_id, -1 without one, and
    the greatest number of buckets.

    Quantiles of the ids bound a hundred ranges, each of which is cut evenly.
    """
    cuts = max(1, text_groups(docs, BUCKET_BYTES) // _QUANTILES)
    shares = [k / _QUANTILES for k in range(1, _QUANTILES)]
    low, high, found = docs.agg(
        F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", shares, 10_000)).first()
    if low is None:
        return docs.withColumn("bucket", F.lit(-1).cast("long")), 1
    bounds = sorted({*found, high})
    lows = [low, *[b + 1 for b in bounds[:-1]]]
    steps = [(b - a) // cuts + 1 for a, b in zip(lows, bounds)]
    table = [F.array(*[F.lit(x).cast("long") for x in xs]) for xs in (bounds, lows, steps)]
    which = F.size(F.filter(table[0], lambda b: b < F.col("doc_id")))
    bucket = let(which, lambda k: (k * cuts + F.floor(
        (F.col("doc_id") - F.get(table[1], k)) / F.get(table[2], k))).cast("long"))
    bucketed = docs.withColumn(
        "bucket", F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long")).otherwise(bucket))
    return bucketed, 1 + len(bounds) * cuts


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, found, next_text, next_found): each document with its
    signatures and those of the next one by descending doc_id, ties by text,
    rows without doc_id at the end; after the last comes the first.

    Rows move once. Each bucket of neighbouring ids also gets the first document
    of the bucket after it.
    """
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows, buckets = _in_order(named)
    first = rows.groupBy("bucket").agg(F.max("doc_id").alias("first"))
    # One row per bucket from here on.
    before = Window.orderBy(F.col("bucket").desc())
    linked = first.select(
        F.col("bucket").alias("of"), F.coalesce(F.lag("bucket").over(before), F.min(
            "bucket").over(Window.partitionBy())).alias("to"))
    firsts = first.withColumnRenamed("bucket", "of")
    firsts = F.broadcast(firsts) if buckets <= BROADCAST_BUCKETS else firsts
    heads = rows.join(firsts, (F.col("bucket") == F.col("of"))
                      & F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("of").agg(
        F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
    ghosts = heads.join(linked, "of").select(
        "doc_id", "text", F.col("to").alias("bucket"), F.lit(1).alias("ghost"))
    every = rows.withColumn("ghost", F.lit(0)).unionByName(ghosts).withColumn(
        "found", signatures(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "text")
    return every.select(
        "doc_id", "text", "found", "ghost", F.lead("text").over(order).alias("next_text"),
        F.lead("found").over(order).alias("next_found")).where("ghost = 0").drop("ghost")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) per document; NULL texts count as empty.

    The edited text has its last half replaced by as much of the beginning of
    the next document. Likeness is the Jaccard similarity of signature sets.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    rows = rows.select("doc_id", "n_chars", "found", "next_found", edited.alias("edited"))
    rows = rows.select(
        "doc_id", "n_chars", "found", "next_found", F.sha2("edited", 256).alias("edited_sha256"),
        signatures(F.col("edited")).alias("edited_found"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("found")).alias("fingerprint"),
        as_text(F.col("edited_found")).alias("edited_fingerprint"),
        jaccard(F.col("found"), F.col("edited_found")).alias("near_edited"),
        jaccard(F.col("found"), F.col("next_found")).alias("near_next"))


def similar_classes(docs: DataFrame, share: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, class_id) and pairs (class_a, class_b, likeness) of
    classes at least ``share`` alike. A class holds the documents with equal
    signature sets and has the smallest of their ids, so copies cost no pairs.
    Documents without doc_id are left out.
    """
    named = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        signatures(F.coalesce("text", F.lit(""))).alias("found"))
    classes = named.groupBy("found").agg(F.min("doc_id").alias("class_id"))
    members = named.join(classes, "found").select("doc_id", "class_id")
    sized = classes.withColumn("n", F.size("found"))
    rows = sized.select("class_id", "n", F.explode("found").alias("s"))
    counts = rows.groupBy("s").agg(F.count("*").alias("df"))
    rarest = Window.partitionBy("class_id").orderBy("df", "s")
    prefix = F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1
    keys = rows.join(counts, "s").withColumn("_r", F.row_number().over(rarest)).where(
        F.col("_r") <= prefix).where("df > 1")
    part = F.floor(F.log("n") / F.log(F.lit(1 / share))).cast("int")
    one = keys.select("s", part.alias("part"), F.col("class_id").alias("class_a"), F.col("n").alias("n_a"))
    other = keys.select("s", F.explode(F.array(part - 1, part, part + 1)).alias("part"),
                        F.col("class_id").alias("class_b"), F.col("n").alias("n_b"))
    near = one.join(other, ["s", "part"]).where(
        (F.col("class_a") < F.col("class_b")) & (F.col("n_b") >= share * F.col("n_a"))
        & (F.col("n_a") >= share * F.col("n_b"))).select("class_a", "class_b").distinct()
    sets = sized.select("class_id", "found")
    pairs = near.join(sets.toDF("class_a", "found_a"), "class_a").join(
        sets.toDF("class_b", "found_b"), "class_b")
    alike = pairs.select("class_a", "class_b", jaccard(
        F.col("found_a"), F.col("found_b")).alias("likeness")).where(F.col("likeness") >= share)
    return members, alike
