"""Vector code compression: product codes from dual-tree Lloyd rounds on integers.

Vectors become integers and are cut into parts; each part position has a
codebook of its own. A round puts one tree over a block's parts and one over the
codebook's entries and walks both at once. Distance bounds between two nodes
drop entry nodes that no part of the other node can be nearest to; a node that
has one entry left goes to it as a whole, with the sums kept for it; what is
still open at the leaves is settled by integer distances. All bounds are
integers too, so that ties are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.shared import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LEAF = 32
#: Rows that a task holds and puts one tree over.
BLOCK_ROWS = 16_384
_LONG = 2**63 - 1
_LIMB = 32

Codebooks = list[list[list[int]]]  # by part, entry, position within the part


def part_bounds(size: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin and end; equal parts if the size allows."""
    return [i * size // parts for i in range(parts + 1)]


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) of the rows whose vector and components are known and finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"), "label",
    ).where(F.col("embedding").isNotNull() & finite)


def _integers(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); Python integers where a long does not hold them."""
    with np.errstate(over="ignore"):
        scaled = np.floor(rows * scale)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    exact = [math.floor(Fraction(x) * scale) for x in rows.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(rows.shape)


class Tree:
    """A balanced box tree: nodes of a level are halved at the median of their widest side.

    Level ``k`` has ``2**k`` nodes; node ``i`` of the last level holds the rows
    ``order[i]``. Unused places repeat a row and count for nothing.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        n = len(points)
        self.depth = max(0, math.ceil(math.log2(max(1, n / leaf))))
        size = -(-n // 2**self.depth) * 2**self.depth
        order = np.r_[np.arange(n), np.full(size - n, n - 1)]
        used = np.arange(size) < n
        self.low, self.high = [], []
        for level in range(self.depth + 1):
            shaped = points[order].reshape(2**level, -1, points.shape[1])
            low, high = shaped.min(axis=1), shaped.max(axis=1)
            self.low.append(low)
            self.high.append(high)
            if level < self.depth:
                widest = np.argmax(high - low, axis=1)
                side = np.take_along_axis(shaped, widest[:, None, None], axis=2)[..., 0]
                by = np.argpartition(side, side.shape[1] // 2, axis=1)
                by += np.arange(2**level)[:, None] * side.shape[1]
                order, used = order[by.ravel()], used[by.ravel()]
        self.order = order.reshape(2**self.depth, -1)
        self.used = used.reshape(self.order.shape)
        sums = np.where(self.used[..., None], points[self.order], 0).sum(axis=1)
        counts = self.used.sum(axis=1)
        self.sums, self.counts = [sums], [counts]
        for _ in range(self.depth):
            sums, counts = sums[::2] + sums[1::2], counts[::2] + counts[1::2]
            self.sums.insert(0, sums)
            self.counts.insert(0, counts)


def _near_far(a: Tree, level: int, i: np.ndarray, b: Tree, deep: int, j: np.ndarray):
    """Squared distances that pairs of points of two nodes have at least and at most."""
    up, down = b.high[deep][j] - a.low[level][i], a.high[level][i] - b.low[deep][j]
    gap = np.maximum(np.maximum(-up, -down), 0)
    span = np.maximum(np.abs(up), np.abs(down))
    return (gap * gap).sum(axis=1), (span * span).sum(axis=1)


def dual_assign(
    points: np.ndarray, book: np.ndarray, leaf: int = LEAF
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each point the nearest entry, lower index first, and by entry the
    sum and number of its points."""
    codes = np.zeros(len(points), dtype=np.int64)
    sums, counts = np.zeros_like(book), np.zeros(len(book), dtype=np.int64)
    # Of equal entries the first takes all, so the tree needs no other.
    _, first = np.unique(book, axis=0, return_index=True)
    first.sort()
    entries = book[first]
    parts, tree = Tree(points, leaf), Tree(entries, 1)
    i = j = np.zeros(1, dtype=np.int64)
    level = deep = 0
    while True:
        near, far = _near_far(parts, level, i, tree, deep, j)
        at = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        least = np.minimum.reduceat(far, at)
        runs = np.diff(np.r_[at, len(i)])
        open_ = near <= np.repeat(least, runs)
        i, j = i[open_], j[open_]
        if deep == tree.depth:
            # A node with one entry left is settled as a whole.
            single = np.r_[True, i[1:] != i[:-1]] & np.r_[i[1:] != i[:-1], True]
            node, entry = i[single], first[tree.order[j[single], 0]]
            np.add.at(sums, entry, parts.sums[level][node])
            np.add.at(counts, entry, parts.counts[level][node])
            below = parts.order.reshape(2**level, -1)[node]
            codes[below] = entry[:, None]
            i, j = i[~single], j[~single]
            if not len(i) or level == parts.depth:
                break
        if level < parts.depth:
            i, j = (np.repeat(i, 2) * 2 + np.tile([0, 1], len(i))), np.repeat(j, 2)
            level += 1
        if deep < tree.depth:
            i, j = np.repeat(i, 2), (np.repeat(j, 2) * 2 + np.tile([0, 1], len(j)))
            deep += 1
        by = np.lexsort((j, i))
        i, j = i[by], j[by]
        # Padding of the entry tree repeats an entry: one node of it is enough.
        if deep == tree.depth:
            entry = tree.order[j, 0]
            by = np.lexsort((entry, i))
            i, j, entry = i[by], j[by], entry[by]
            new = np.r_[True, (i[1:] != i[:-1]) | (entry[1:] != entry[:-1])]
            i, j = i[new], j[new]
    if len(i):
        entry = first[tree.order[j, 0]]
        by = np.lexsort((entry, i))
        i, entry = i[by], entry[by]
        away = points[parts.order[i]] - book[entry][:, None, :]
        squares = (away * away).sum(axis=2)
        at = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        least = np.minimum.reduceat(squares, at, axis=0)
        runs = np.diff(np.r_[at, len(i)])
        # The first entry of a node's run that has the least distance, per place.
        place = np.where(squares == np.repeat(least, runs, axis=0), np.arange(len(i))[:, None], len(i))
        best = entry[np.minimum.reduceat(place, at, axis=0)]
        rows, used = parts.order[i[at]], parts.used[i[at]]
        codes[rows[used]] = best[used]
        np.add.at(sums, best[used], points[rows[used]])
        np.add.at(counts, best[used], 1)
    return codes, sums, counts


def _plain_assign(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``dual_assign``, for Python integers: all points are open to the end."""
    codes = np.zeros(len(points), dtype=np.int64)
    sums, counts = np.zeros(book.shape, dtype=object), np.zeros(len(book), dtype=np.int64)
    for row, point in enumerate(points):
        away = book.astype(object) - point
        squares = (away * away).sum(axis=1).tolist()
        code = codes[row] = squares.index(min(squares))
        sums[code] += point
        counts[code] += 1
    return codes, sums, counts


def _assign(points: np.ndarray, book: np.ndarray):
    """Codes, squared distances, sums and counts. Rows whose distances a long may not hold go apart."""
    width = max(1, points.shape[1])
    most = math.isqrt(2**60 // width)
    small = np.array([all(abs(x) < most for x in row) for row in points.tolist()], dtype=bool) \
        if points.dtype == object else (np.abs(points) < most).all(axis=1)
    if not all(abs(x) < most for x in book.ravel().tolist()):
        small[:] = False
    if not points.shape[1]:
        return (np.zeros(len(points), np.int64), np.zeros(len(points), np.int64),
                np.zeros(book.shape, np.int64), np.r_[len(points), np.zeros(len(book) - 1, np.int64)])
    if small.all():
        points, book = points.astype(np.int64), book.astype(np.int64)
        codes, sums, counts = dual_assign(points, book)
        away = points - book[codes]
        return codes, (away * away).sum(axis=1), sums, counts
    codes = np.zeros(len(points), dtype=np.int64)
    squares = np.zeros(len(points), dtype=object)
    sums, counts = np.zeros(book.shape, dtype=object), np.zeros(len(book), dtype=np.int64)
    for mine, kind in ((small, np.int64), (~small, object)):
        if mine.any():
            some, entries = points[mine].astype(kind), book.astype(kind)
            own, s, c = (dual_assign if kind is np.int64 else _plain_assign)(some, entries)
            away = some - entries[own]
            codes[mine], squares[mine] = own, (away * away).sum(axis=1)
            sums, counts = sums + s, counts + c
    return codes, squares, sums, counts


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Table, np.ndarray | None]]:
    """Arrow rows by the block, with their vectors. Rows with vectors of another
    size than ``size`` stand in blocks of their own, without vectors."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= BLOCK_ROWS:
            yield from _settled(pa.Table.from_batches(held), size)
            held = []
    if held:
        yield from _settled(pa.Table.from_batches(held), size)


def _settled(table: pa.Table, size: int) -> Iterator[tuple[pa.Table, np.ndarray | None]]:
    import pyarrow.compute as pc

    fits = pc.equal(pc.list_value_length(table.column("embedding")), size)
    mine = table.filter(fits)
    if len(mine):
        flat = mine.column("embedding").combine_chunks().flatten()
        yield mine, flat.to_numpy(zero_copy_only=False).reshape(len(mine), size)
    other = table.filter(pc.invert(fits))
    if len(other):
        yield other, None


def _round(vectors: DataFrame, books: Codebooks, size: int, scale: int) -> Codebooks:
    """The codebooks after all parts are assigned and entries replaced by their means.

    Sums travel in pieces of 32 bits, which Spark adds as longs; what comes to
    the driver has the size of the codebooks.
    """
    parts, entries = len(books), len(books[0])
    bounds = part_bounds(size, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((entries, b - a), dtype=object) for a, b in zip(bounds, bounds[1:])]
        counts = np.zeros((parts, entries), dtype=np.int64)
        for _, rows in _blocks(batches, size):
            if rows is None:
                continue
            whole = _integers(rows, scale)
            for p, (a, b) in enumerate(zip(bounds, bounds[1:])):
                _, _, s, c = _assign(whole[:, a:b], np.array(books[p], dtype=object).reshape(entries, b - a))
                totals[p] += s.astype(object)
                counts[p] += c
        out = []
        for p in range(parts):
            for e in np.flatnonzero(counts[p]).tolist():
                out.append((p, e, -1, 0, int(counts[p][e])))
                for place, total in enumerate(totals[p][e].tolist()):
                    limb = 0
                    while total not in (0, -1) or limb == 0:
                        out.append((p, e, place, limb, total & (2**_LIMB - 1)))
                        total >>= _LIMB
                        limb += 1
                    if total:
                        out.append((p, e, place, limb, total))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)],
            names=["part", "entry", "place", "limb", "value"])

    added = vectors.select("embedding").mapInArrow(
        run, "part int, entry int, place int, limb int, value long"
    ).groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value"))
    totals: dict[tuple[int, int, int], int] = {}
    for r in added.collect():  # the codebooks' size, whatever the number of vectors
        key = (r.part, r.entry, r.place)
        totals[key] = totals.get(key, 0) + (r.value << (_LIMB * r.limb))
    return [
        [[totals[p, e, d] // totals[p, e, -1] for d in range(len(entry))] if (p, e, -1) in totals else entry
         for e, entry in enumerate(book)]
        for p, book in enumerate(books)
    ]


def first_codebooks(vectors: DataFrame, parts: int, entries: int, scale: int) -> tuple[Codebooks, int]:
    """The parts of the vectors with the smallest ids, and the size of vectors:
    that of the first of them. Ties of ids are broken by the components."""
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    top = vectors.select("vec_id", "embedding").orderBy(*order).limit(1).collect()
    if not top:
        return [], 0
    size = len(top[0].embedding)
    rows = vectors.where(F.size("embedding") == size).select("vec_id", "embedding").orderBy(*order).limit(entries)
    whole = [[math.floor(Fraction(x) * scale) for x in r.embedding] for r in rows.collect()]
    bounds = part_bounds(size, parts)
    return [[row[a:b] for row in whole] for a, b in zip(bounds, bounds[1:])], size


def codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[Codebooks, int]:
    """Codebooks of kept vectors after ``rounds`` Lloyd rounds, and the vectors' size."""
    books, size = first_codebooks(vectors, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = _round(vectors, books, size, scale)
    return books, size


def digest(books: Codebooks) -> str:
    """SHA-256 of all components as decimals, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


def encoded(vectors: DataFrame, books: Codebooks, size: int, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error) of kept vectors; code and error are NULL for
    vectors of another size, and an error beyond a long is the largest long."""
    parts = len(books)
    bounds = part_bounds(size, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, rows in _blocks(batches, size):
            if rows is None:
                codes: list = [None] * len(table)
                errors: list = [None] * len(table)
            else:
                whole = _integers(rows, scale)
                found = np.zeros((len(rows), parts), dtype=np.uint8)
                total = np.zeros(len(rows), dtype=object)
                for p, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    own, squares, _, _ = _assign(
                        whole[:, a:b], np.array(books[p], dtype=object).reshape(len(books[p]), b - a))
                    found[:, p] = own
                    total += squares.astype(object)
                text = found.tobytes().hex()
                codes = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                errors = [min(t, _LONG) for t in total.tolist()]
            yield pa.RecordBatch.from_arrays(
                [table.column("vec_id").combine_chunks(), table.column("label").combine_chunks(),
                 pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.select("vec_id", "label", "embedding").mapInArrow(
        run, f"vec_id long, label {label}, code string, error long")


def product_codes(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per kept vector.

    Vectors that are NULL or hold an unknown or non-finite component give no
    row. Vectors of another size than the one with the smallest vec_id take no
    part in the codebooks and have no code and no error. Sizes that ``parts``
    does not divide are cut as evenly as can be. With fewer vectors than
    ``entries`` the codebooks are shorter. Repeated rows count and come back as
    often as they occur. ``label_error`` adds up the errors of a label, of all
    rows without one together, and stops at the largest long. At most 256
    entries. An empty table gives no row.
    """
    rows = kept(vectors)
    books, size = codebooks(rows, parts, entries, rounds, scale)
    if not books:
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    found = written(encoded(rows, books, size, scale))
    total = F.sum(F.col("error").cast("decimal(20,0)"))
    sums = written(found.groupBy(F.col("label").alias("_label")).agg(
        F.when(total > F.lit(_LONG).cast("decimal(30,0)"), F.lit(_LONG)).otherwise(total.cast("long"))
        .alias("label_error"), F.count("*").alias("_n")))
    # Fewer than a thousand labels have over a thousandth of all rows each: those are
    # broadcast, so that no label that many rows share is joined by shuffle.
    share = found.count() // 1000
    often, rest = sums.where(F.col("_n") > share), sums.where(F.col("_n") <= share)
    same = F.col("label").eqNullSafe(F.col("_label"))
    near = found.join(F.broadcast(often), same, "left")
    settled = near.where("_n is not null").select("vec_id", "code", "error", "label_error")
    open_ = near.where("_n is null").drop("_label", "label_error", "_n")
    more = open_.join(rest, same).select("vec_id", "code", "error", "label_error")
    return settled.unionByName(more).withColumn("codebooks_sha256", F.lit(digest(books)))


def product_codes_sql(rounds: int = ROUNDS) -> str:
    """The same rows in DuckDB's SQL, for vectors of one size that 16 divides."""
    steps = []
    for step in range(rounds + 1):
        steps.append(f"""
assigned{step} AS (
  SELECT vec_id, part, arg_min(entry, dist * 1000 + entry) AS entry, min(dist) AS dist, any_value(v) AS v
  FROM (SELECT p.vec_id, p.part, p.v, b.entry,
          list_sum(list_transform(list_zip(p.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS dist
        FROM pieces p JOIN book{step} b USING (part))
  GROUP BY vec_id, part)""")
        if step < rounds:
            steps.append(f"""
sums{step} AS (
  SELECT part, entry, i, sum(v[i]) AS s, count(*) AS n
  FROM (SELECT part, entry, v, unnest(range(1, len(v) + 1)) AS i FROM assigned{step})
  GROUP BY part, entry, i),
means{step} AS (
  SELECT part, entry, list((((s - ((s % n + n) % n)) // n)::BIGINT) ORDER BY i) AS c
  FROM sums{step} GROUP BY part, entry),
book{step + 1} AS (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c
  FROM book{step} b LEFT JOIN means{step} m USING (part, entry))""")
    return f"""
WITH vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT unnest(range({PARTS})) AS part),
pieces AS (
  SELECT vec_id, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS v
  FROM vectors CROSS JOIN parts),
book0 AS (
  SELECT part, entry, v AS c FROM pieces JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM vectors
    ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id)),{",".join(steps)},
codes AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
  FROM assigned{rounds} GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN vectors USING (vec_id) CROSS JOIN digest
"""
