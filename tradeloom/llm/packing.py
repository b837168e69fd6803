"""Best-fit packing of tokenised documents, planned on a histogram of lengths.

How documents of equal length are told apart does not matter to a packing, so
the plan is made over (length, count) pairs: at most one per length up to the
capacity, whatever the number of documents. A plan row says that the pieces of
one length with ranks from ``first`` on go, ``per`` at a time, at ``place`` into
the sequences from ``sequence`` on. Pieces then find their slot by their rank
within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.shared import gapless_rank, give_back, written
from tradeloom.llm.tokens import TOKENIZER, slices, tokens_of

CAPACITY = 1024
END = 2
_RANK_ROWS = 20_000
_ENCODED = 4_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Documents as token ids with an end token, cut where longer than ``capacity``:
    the first piece takes what is left over. NULL texts count as empty. The strings
    of special tokens in a text have their special ids, the library's default."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            docs_, texts, rows = batch.column(0).to_pylist(), batch.column(1), []
            for first, last in slices(texts, _ENCODED):
                found, cuts = tokens.encode(texts.slice(first, last - first))
                for doc, a, b in zip(docs_[first:last], cuts.tolist(), cuts[1:].tolist()):
                    ids = found[a:b].astype("<u4").tobytes() + end
                    n = b - a + 1
                    stop = (n - 1) % capacity + 1
                    start = piece = 0
                    while start < n:
                        crc = zlib.crc32(ids[4 * start : 4 * stop])
                        rows.append((doc, piece, start, stop - start, crc))
                        piece, start, stop = piece + 1, stop, stop + capacity
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, PIECES)


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Best-fit decreasing over a histogram: rows (length, first, stop, per,
    sequence, place).

    Longest first, each piece goes into the fullest sequence that still takes
    it. Equal sequences are kept as ranges, so the work depends on the number
    of different lengths and not on the number of pieces.
    """
    rows, sequences = [], 0
    rooms: list[int] = []  # sorted; open[room] holds ranges (first sequence, count)
    open_: dict[int, list[tuple[int, int]]] = {}

    def put(room: int, first: int, n: int) -> None:
        if not room or not n:
            return
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
                new = False
            else:
                room, first, n, new = capacity, sequences, left, True
            per = room // length
            full = min(n, left // per)
            used = full
            if full:
                rows.append((length, rank, rank + full * per, per, first, capacity - room))
                put(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if left and full < n:
                rows.append((length, rank, rank + left, left, first + full, capacity - room))
                put(room - left * length, first + full, 1)
                rank, left, used = rank + left, 0, full + 1
            if new:
                sequences += used
            else:
                put(room, first + used, n - used)
    return rows


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    ``start`` counts the ids of the document before the piece, ``offset`` those
    of the sequence. An empty or NULL text is one piece of one id. Repeated
    rows are packed as often as they occur.
    """
    cut = written(pieces(docs, capacity))
    counts = cut.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most `capacity` rows
    rows = plan({r["length"]: r["n"] for r in counts}, capacity)
    total = sum(r["n"] for r in counts)
    ranked = gapless_rank(
        cut, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", max(64, total // _RANK_ROWS))
    # An Arrow table needs no Python workers, as a list of rows would.
    names = ("length", "first", "stop", "per", "sequence", "place")
    columns = zip(*rows) if rows else [()] * len(names)
    slots = docs.sparkSession.createDataFrame(
        pa.table([pa.array(c, pa.int64()) for c in columns], names=names))
    # A plan has at most a few rows for each pair of a length and a room, so `capacity`
    # bounds its size. Without any it would have no rows to join.
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop"))
    seat = F.col("rank") - F.col("first")
    return (
        ranked.join(F.broadcast(slots).withColumnRenamed("length", "_length"),
                    (F.col("length") == F.col("_length")) & inside)
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            (F.col("sequence") + F.floor(seat / F.col("per"))).cast("long").alias("sequence_id"),
            (F.col("place") + seat % F.col("per") * F.col("length")).cast("long").alias("offset"),
        )
    )
