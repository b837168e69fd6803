"""CSV records with quoted line breaks, read from files that still split."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Each task reads at most one range that fills it and one rest of a file that begins within one, so
#: this many ranges inside quotes mean half as many tasks, 12 TB of text at 128 MB a task.
BROADCAST_RANGES = 200_000

_BLOCK = ("_file", "_block")
_PIECES = "_file string, _block long, _whole boolean, _starts boolean, _first boolean, _text string"


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of headered CSV files: (``_source_file``, ``_record``).

    Line breaks inside quotes belong to the record, and yet files are read in
    byte ranges by many tasks: whether a range begins inside quotes follows from
    the number of quotes in the ranges before it. A first pass counts quotes per
    range, a second one puts lines together. Only records that cross the border
    of a range are shuffled. The ranges that begin inside quotes are broadcast
    where there can be no more than ``BROADCAST_RANGES`` of them; beyond that
    lines are joined with them by a shuffle.

    Files follow RFC 4180: quotes are doubled inside quotes and do not occur in
    fields without quotes. The first record of every file is its header and is
    left out, as are empty records. A quote that is never closed makes the rest
    of its file one record. An empty file has no records.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("value").alias("_line"),
    )
    placed = lines.withColumn("_place", F.monotonically_increasing_id())
    opened = _open_blocks(lines)
    if 2 * lines.rdd.getNumPartitions() <= BROADCAST_RANGES:
        opened = F.broadcast(opened)
    marked = (
        placed.join(opened, [*_BLOCK], "left")
        .sortWithinPartitions(*_BLOCK, "_place")
        .select(*_BLOCK, F.col("_open").isNotNull().alias("_open"), "_line")
    )
    whole = marked.mapInArrow(_put_together(False), _PIECES).select("_file", "_block", "_first", "_text")
    # Parts of records that cross borders: the number of starts so far tells records apart.
    so_far = Window.partitionBy("_file").orderBy("_block", "_starts")
    crossing = (
        marked.mapInArrow(_put_together(True), _PIECES)
        .withColumn("_nth", F.count_if("_starts").over(so_far))
        .groupBy("_file", "_nth")
        .agg(
            F.bool_or("_first").alias("_first"),
            F.array_sort(F.collect_list(F.struct("_block", "_starts", "_text"))).alias("_parts"),
        )
        .select("_file", F.col("_parts")[0]["_block"].alias("_block"), "_first",
                F.array_join(F.col("_parts")["_text"], "\n").alias("_text"))
    )
    record = F.regexp_replace("_text", r"\r$", "")
    found = whole.unionByName(crossing).where(~(F.col("_first") & (F.col("_block") == 0)))
    return found.select(
        F.substring_index("_file", "/", -1).alias("_source_file"), record.alias("_record"),
    ).where(F.length("_record") > 0)


def _open_blocks(lines: DataFrame) -> DataFrame:
    """The byte ranges that begin inside quotes."""
    quotes = F.length("_line") - F.length(F.replace("_line", F.lit('"'), F.lit("")))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        lines.groupBy(*_BLOCK)
        .agg((F.sum(quotes) % 2).alias("_odd"))
        .withColumn("_open", F.sum("_odd").over(before) % 2)
        .where("_open = 1")
        .select(*_BLOCK, "_open")
    )


def _put_together(parts: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines of byte ranges, in order, to whole records or, with ``parts``, to parts of records.

    Per range there is at most one part that goes on from the range before and
    one that goes on in the next range; the state between batches is the record
    that is not closed yet. Lines are joined many records at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, waiting, starts, first = None, [], True, False

        def left() -> Iterator[pa.RecordBatch]:
            # What is left at the end of a range: a part, unless nothing is left.
            if parts and waiting:
                yield _pieces(block, False, starts, [starts and first], _joined(waiting))

        for batch in batches:
            files, blocks, opened, lines = (batch.column(n) for n in range(4))
            odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
            places = blocks.to_numpy(zero_copy_only=False)
            names = files.dictionary_encode()
            codes = names.indices.to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((places[1:] != places[:-1]) | (codes[1:] != codes[:-1])) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lines)]):
                if begin == end:
                    continue
                here = (names.dictionary[int(codes[begin])].as_py(), int(places[begin]))
                if here != block:
                    yield from left()
                    block, waiting = here, []
                    inside, begun = bool(opened[begin].as_py()), False
                    starts = not inside
                inside_after = (inside + np.cumsum(odd[begin:end])) % 2
                ends = begin + 1 + np.flatnonzero(inside_after == 0)
                at = begin
                if waiting or inside:  # the record that is not closed yet
                    at = int(ends[0]) if len(ends) else end
                    waiting.append(lines.slice(begin, at - begin))
                    if len(ends):
                        # A part from the range before ends here; all others are whole.
                        if starts != parts:
                            yield _pieces(block, starts, starts, [starts and first], _joined(waiting))
                        waiting, ends = [], ends[1:]
                if len(ends):
                    bounds = pa.array(np.r_[at, ends], pa.int32())
                    starts = True
                    if not parts:
                        texts = pc.binary_join(pa.ListArray.from_arrays(bounds, lines), "\n")
                        yield _pieces(block, True, True, [not begun] + [False] * (len(ends) - 1), texts)
                    begun, at = True, int(ends[-1])
                if at < end:
                    starts, first, begun, waiting = True, not begun, True, [lines.slice(at, end - at)]
                inside = bool(inside_after[-1])
        if block is not None:
            yield from left()

    return run


def _joined(lines: list[pa.Array]) -> pa.Array:
    """Lines that may come from several batches, as one text."""
    return pa.array(["\n".join(text for some in lines for text in some.to_pylist())], pa.string())


def _pieces(block: tuple[str, int], whole: bool, starts: bool, first: list[bool], texts: pa.Array) -> pa.RecordBatch:
    columns = [pa.repeat(pa.scalar(x, t), len(texts)) for x, t in zip(
        (*block, whole, starts), (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))]
    names = ["_file", "_block", "_whole", "_starts", "_first", "_text"]
    return pa.RecordBatch.from_arrays([*columns, pa.array(first, pa.bool_()), texts], names=names)
