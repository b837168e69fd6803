"""Shards of near-equal bytes from a k-d tree over document metadata.

The tree splits all documents, then each part again, along the metadata
dimension in which the part is widest, at the weighted quantile that leaves
each side the bytes of its number of shards, until every leaf is one shard. Quantiles are found
by histograms: a job counts the bytes of each part in 4,096 ranges, the range
that holds the quantile is cut into 4,096 again, and so on to a single value.
The driver sees histograms of at most 4,096 ranges per part, never documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.shared import byte_length, gapless_rank, written

SHARDS = 40
OVERHEAD = 16
BITS = 12
TIE_BITS = 36
# Copies stay together unless they outweigh this part of a shard.
TOGETHER = 1 / 8
_RANK_ROWS = 20_000
_CODES = 4096


@dataclass
class _Part:
    """A part of the documents that makes the shards from ``first`` on."""

    first: int
    shards: int
    cut: tuple[str, int, int] | None = None  # left: (dimension, tie) below (value, tie)
    sides: list["_Part"] = field(default_factory=list)
    # Of the search for the cut:
    weight: int = 0
    dimension: str = ""
    low: int = 0
    bits: int = 0
    on_tie: bool = False
    value: int = 0
    rest: float = 0.0

    def leaves(self) -> list["_Part"]:
        return [x for side in self.sides for x in side.leaves()] if self.sides else [self]

    def number(self) -> Column:
        """First shard of the part that a document is in."""
        if not self.sides:
            return F.lit(self.first)
        name, value, tie = self.cut
        left = (F.col(name) < value) | ((F.col(name) == value) & (F.col("tie") < tie))
        return F.when(left, self.sides[0].number()).otherwise(self.sides[1].number())


def metadata(docs: DataFrame, overhead: int = OVERHEAD) -> DataFrame:
    """(doc_id, size, text_crc32, same) per document: size in UTF-8 bytes plus
    ``overhead``; equal ``same`` with equal size and checksum are equal texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    known = {c.lower() for c in docs.columns}
    codes = [
        (F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(_CODES)) if c in known else F.lit(0))
        .cast("long").alias(f"d_{c}")
        for c in ("lang", "source")
    ]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (byte_length(F.col("text")) + overhead).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("same"),
        *codes,
    )


def _with_dimensions(meta: DataFrame, heaviest: float) -> DataFrame:
    """Add the tree's dimensions. Copies share all of them, and so every cut,
    unless they weigh more than ``heaviest`` together."""
    keys = ["same", "text_crc32", "size"]
    groups = meta.groupBy(*keys).agg(
        (F.count("*") * F.first("size")).alias("_weight"),
        *[F.min(c).alias(f"_{c}") for c in ("doc_id", "d_lang", "d_source")],
    )
    joined = meta.join(groups, keys)
    together = F.col("_weight") <= heaviest

    def own(c: str) -> Column:
        return F.when(together, F.col(f"_{c}")).otherwise(F.col(c))

    # Dimensions are counted from 0; a missing id counts as the smallest.
    least = meta.agg(F.min("doc_id")).first()[0] or 0
    tie = F.xxhash64("same", "text_crc32", F.when(~together, F.col("doc_id")))
    return joined.select(
        "doc_id", "size", "text_crc32",
        F.coalesce(own("doc_id") - least, F.lit(0)).alias("d_id"),
        F.col("size").alias("d_size"),
        own("d_lang").alias("d_lang"), own("d_source").alias("d_source"),
        F.shiftrightunsigned(tie, 64 - TIE_BITS).alias("tie"),
    )


DIMENSIONS = ("d_id", "d_size", "d_lang", "d_source")


def _pick(parts: list[_Part], value) -> Column:
    """``value(part)`` for the part that a row is in, else NULL."""
    chosen = None
    for part in parts:
        here = F.col("part") == part.first
        chosen = F.when(here, value(part)) if chosen is None else chosen.when(here, value(part))
    return chosen


def _range(part: _Part) -> Column:
    """Which range of the part's current histogram a row falls into."""
    column = F.col("tie") if part.on_tie else F.col(part.dimension)
    shift = max(part.bits - BITS, 0)
    inside = (column >= part.low) & (column < part.low + (1 << part.bits))
    if part.on_tie:
        inside = inside & (F.col(part.dimension) == part.value)
    return F.when(inside, F.shiftright(column - part.low, shift))


def _search(rows: DataFrame, parts: list[_Part]) -> None:
    """Narrow the cut of each part until it is exact."""
    active = parts
    while active:
        counts = rows.withColumn("range", _pick(active, _range)).where("range is not null").groupBy(
            "part", "range").agg(F.sum("size").alias("w")).collect()
        for part in active:
            bins = sorted((r["range"], r["w"]) for r in counts if r["part"] == part.first)
            shift = max(part.bits - BITS, 0)
            before = 0
            for number, weight in bins:
                if before + weight >= part.rest or number == bins[-1][0]:
                    break
                before += weight
            low = part.low + (number << shift)
            if shift:
                part.low, part.bits, part.rest = low, shift, part.rest - before
            elif not part.on_tie:
                part.value, part.rest = low, part.rest - before
                part.on_tie, part.low, part.bits = True, 0, TIE_BITS
            else:  # one value and tie: whole to the side that it unbalances less
                right = part.rest - before < weight / 2
                part.cut = (part.dimension, part.value, low if right else low + 1)
        active = [p for p in active if p.cut is None]


def tree(rows: DataFrame, shards: int) -> _Part:
    """The k-d tree that deals ``rows`` (size, dimensions, tie) into ``shards``."""
    root = _Part(0, shards)
    spans: dict[str, int] = {}
    while any(p.shards > 1 for p in root.leaves()):
        parts = [p for p in root.leaves() if p.shards > 1]
        dealt = rows.withColumn("part", root.number())
        stats = {
            r["part"]: r
            for r in dealt.groupBy("part").agg(
                F.sum("size").alias("w"),
                *[f(d).alias(f"{n}_{d}") for d in DIMENSIONS
                  for n, f in (("min", F.min), ("max", F.max))],
            ).collect()  # a row per part
        }
        searched = []
        for part in parts:
            row = stats.get(part.first)
            if row is None:  # no rows: any cut will do
                part.cut = (DIMENSIONS[0], 0, 0)
                continue
            width = {d: row[f"max_{d}"] - row[f"min_{d}"] for d in DIMENSIONS}
            spans = spans or {d: max(n, 1) for d, n in width.items()}
            part.dimension = max(DIMENSIONS, key=lambda d: width[d] / spans[d])
            part.low = row[f"min_{part.dimension}"]
            part.bits = (width[part.dimension]).bit_length()
            part.rest = row["w"] * (part.shards // 2) / part.shards
            searched.append(part)
        _search(dealt, searched)
        for part in parts:
            half = part.shards // 2
            part.sides = [_Part(part.first, half), _Part(part.first + half, part.shards - half)]
    return root


def shards(docs: DataFrame, n: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per document.

    The law is ``bytes``: shards are equal but for about one document or group
    of copies at each cut. Equal texts share a shard unless together they
    outweigh an eighth of one. NULL text has no bytes and the checksum of an
    empty one. ``slot`` numbers a shard's documents without gaps. Fewer
    documents than shards leave shards empty. ``grown_shard`` is NULL under
    this law.
    """
    meta = written(metadata(docs, overhead))
    total, count = meta.agg(F.sum("size"), F.count("*")).first()
    rows = written(_with_dimensions(meta, (total or 0) / n * TOGETHER))
    dealt = rows.select(
        "doc_id", "size", "text_crc32", tree(rows, n).number().cast("int").alias("shard"))
    buckets = max(8, count // (n * _RANK_ROWS))
    ranked = gapless_rank(dealt, ["shard"], ["doc_id", "text_crc32", "size"], "slot", buckets)
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
