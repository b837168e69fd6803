"""Near-duplicate documents by 64-bit SimHash, found through deletion variants.

Two fingerprints at most four bits apart, cut into three segments, have a
segment in which at most one bit differs. Each segment is indexed with one bit
taken out, once per bit, so such a pair meets under at least one of the 64
signatures of a fingerprint. Pairs that meet are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tradeloom.llm.shared import components, fresh, written

BITS = 4
SHINGLE = 4
SEED = 42
# (first bit, width) of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# A signature shared by more fingerprints than this is compared block by block in several tasks.
RUN = 8192
_CHUNK = 8192
_SMALL = 12


def fingerprint(text: str | None) -> int:
    """Unsigned SimHash of the lower-cased (A-Z) words' 4-shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles: Iterable = [words]
    else:
        shingles = zip(*(words[i:] for i in range(SHINGLE)))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), _CHUNK):
        rows = hashes[start : start + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


@F.arrow_udf(LongType())
def _fingerprint_of(texts: pa.Array) -> pa.Array:
    # One text at a time, as lists of texts stay in a worker's memory next to those of other stages.
    return pa.array(np.array([fingerprint(t.as_py()) for t in texts], dtype=np.uint64).view(np.int64))


# Else a join's filter of NULLs is pushed below the call and calls it once more, in further workers.
_fingerprint_of = _fingerprint_of.asNondeterministic()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of whole texts; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))],
                names=["doc_id", "fp"],
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return columns.mapInArrow(run, "doc_id long, fp long")


def signatures() -> list:
    """The 64 signatures of ``fp``: a segment without one of its bits, numbered."""
    out = []
    for number, (first, width) in enumerate(SEGMENTS):
        segment = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            low = segment.bitwiseAND(F.lit((1 << bit) - 1))
            high = F.shiftleft(F.shiftright(segment, bit + 1), bit)
            tag = (number * 32 + bit) << 32
            out.append(low.bitwiseOR(high).bitwiseOR(F.lit(tag).cast("long")))
    return out


def _near(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ other) <= BITS


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join whatever is joined by links among ``fps``, fewer than there are rows."""
    ones, others = [], []
    rest = np.unique(fps)
    while len(rest) > 1:
        front = [rest[0]]
        rest = rest[1:]
        while front and len(rest):
            seed = front.pop()
            near = _near(rest, seed)
            if near.any():
                found = rest[near]
                ones.append(np.full(len(found), seed))
                others.append(found)
                front.extend(found)
                rest = rest[~near]
    if not ones:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(ones), np.concatenate(others)


def _link_runs(most: int | None):
    """Over rows (key, fp) sorted by key: (0, a, b) for links, spanning each
    group, and (1, key, fp) for the rows of keys with more than ``most`` rows.
    No more than ``most`` rows and one batch are held at a time."""

    def emit(kind: int, one, other) -> pa.RecordBatch:
        one, other = (np.asarray(x, dtype=np.uint64).view(np.int64) for x in (one, other))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(one), kind, dtype=np.int32)), pa.array(one), pa.array(other)],
            names=["kind", "a", "b"],
        )

    def links(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole runs only."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        small = np.repeat(sizes <= _SMALL, sizes)
        for step in range(1, _SMALL):
            same = (keys[step:] == keys[:-step]) & small[step:]
            at = np.flatnonzero(same)
            if not len(at):
                break
            at = at[_near(fps[at], fps[at + step])]
            at = at[fps[at] != fps[at + step]]
            if len(at):
                yield emit(0, fps[at], fps[at + step])
        for start, size in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL]):
            one, other = _forest(fps[start : start + size])
            if len(one):
                yield emit(0, one, other)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = fps = np.empty(0, np.uint64)
        over = None  # the key whose rows go on as they are
        for batch in batches:
            new_keys, new_fps = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            if over is not None:
                mine = new_keys == over
                if mine.any():
                    yield emit(1, new_keys[mine], new_fps[mine])
                    new_keys, new_fps = new_keys[~mine], new_fps[~mine]
                if not len(new_keys):
                    continue
                over = None
            keys, fps = np.concatenate([keys, new_keys]), np.concatenate([fps, new_fps])
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if most is not None and len(keys) - last > most:
                over = keys[-1]
                yield emit(1, keys[last:], fps[last:])
                keys, fps = keys[:last], fps[:last]
                last = len(keys)
            if last:
                yield from links(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
        if len(keys):
            yield from links(keys, fps)

    return run


def links(fps: DataFrame, run: int = RUN) -> DataFrame:
    """Links (a, b) between the distinct ``fp`` values, enough to join every
    group that is joined by pairs at most four bits apart.

    A signature with more than ``run`` fingerprints is cut into blocks by a
    hash and each pair of blocks is compared in a task of its own, so nothing
    is left out and no task holds the whole run.
    """
    # Adaptive execution would merge the few bytes of fingerprints into few tasks, each of
    # which makes 64 rows of every fingerprint: they are dealt over all tasks first.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = fps.select("fp").distinct().repartition(tasks)
    keyed = distinct.select(F.explode(F.array(*signatures())).alias("key"), "fp")
    schema = "kind int, a long, b long"
    found = written(
        keyed.repartition("key").sortWithinPartitions("key")
        .mapInArrow(_link_runs(run), schema)
    )
    large = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    blocks = large.groupBy("key").agg(F.ceil(F.count("*") / run).cast("int").alias("blocks"))
    dealt = large.join(blocks, "key").select(
        "key", "fp", F.pmod(F.xxhash64("fp"), "blocks").cast("int").alias("mine"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    pair = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))
    more = (
        dealt.select(pair.alias("key"), "fp").repartition("key").sortWithinPartitions("key")
        .mapInArrow(_link_runs(None), schema)
    )
    return found.where("kind = 0").select("a", "b").unionByName(more.select("a", "b"))


def near_duplicates(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document.

    Fingerprints at most four bits apart are linked; ``component_id`` is the
    smallest doc_id that links reach. Empty and NULL texts have fingerprint
    zero and are linked like any other. Repeated rows come back repeated. Rows
    without doc_id get their group's smallest known one, NULL if there is none.
    """
    fps = written(fingerprints(docs))
    roots = components(links(fps, run)).withColumnRenamed("node", "fp")
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    member = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(member, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, run: int = RUN) -> DataFrame:
    """The documents without near copies: of each group of linked rows the one with
    the smallest doc_id stays, once if that id is repeated, and one without doc_id
    if no row of the group has one. Empty and NULL texts are one group. All columns
    come back as they were, whatever their names.
    """
    keys = [fresh(docs, name) for name in ("fp", "known", "id")]
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = F.col("doc_id").cast("long")
    values = (_fingerprint_of("text"), own.isNotNull(), F.coalesce(own, F.lit(0)))
    marked = docs.select(*columns, *[v.alias(k) for k, v in zip(keys, values)])
    fp, known, doc = map(F.col, keys)
    first = F.min(F.struct((~known).alias("unknown"), doc.alias("doc"), fp.alias("own"))).alias("first")
    members = written(marked.groupBy(fp.alias("fp")).agg(first))
    roots = components(links(members, run)).withColumnRenamed("node", "fp")
    kept = (
        members.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.own").alias(keys[0]), (~F.col("first.unknown")).alias(keys[1]),
                F.col("first.doc").alias(keys[2]))
    )
    # Rows of one id and fingerprint are cut to one by each task, so that no key is hot in
    # the exchange, which the join then needs no second time.
    return marked.dropDuplicates(keys).join(kept, keys, "left_semi").select(*columns)
