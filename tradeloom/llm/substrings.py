"""Exact removal of word sequences that repeat an earlier document.

A window is 13 consecutive words. Hashing every window of the corpus would
shuffle every word, so first only anchors are hashed: 7 words starting at the
positions of a document that lie in the difference cover {0, 1, 3} modulo 7.
Any two positions have an offset below 7 that takes both into the cover, so two
equal windows always hold a common aligned anchor. Only windows around anchors
that occur in several documents are hashed whole, and each is traced to the
smallest document that has it.

Documents are dealt into groups of a few MB and hashes into buckets. A group
sends each bucket its distinct hashes as one packed block and gets a bit per
hash back, so a passage in any number of documents costs one hash per group,
and no pair of documents is ever built.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.shared import lean, text_groups

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
GROUP_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
_CHUNK = 1 << 18
_NO_ID = np.iinfo(np.int64).max

_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64, endpoint=False)
_P, _Q, _R, _M = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M
    return x ^ (x >> np.uint64(29))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _P, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and first byte of each word in a buffer that ends in white space."""
    hashes, firsts = [], []
    start = 0
    while start < len(buffer):
        stop = min(start + _CHUNK, len(buffer))
        spaces = _SPACE[buffer[start:stop]]
        while not spaces.any() or not spaces[-1]:
            last = np.flatnonzero(spaces)
            if len(last):  # cut after the last white space
                stop = start + int(last[-1]) + 1
            else:  # a word longer than the chunk
                stop = min(stop + _CHUNK, len(buffer))
            spaces = _SPACE[buffer[start:stop]]
        part = buffer[start:stop]
        begins = np.flatnonzero(~spaces & np.r_[True, spaces[:-1]])
        if len(begins):
            ends = np.flatnonzero(spaces & np.r_[False, ~spaces[:-1]])
            at = _offsets(begins, len(part))
            longest = int((ends - begins).max())
            weights = _powers(longest + 1)[np.minimum(at, longest)]
            weights[spaces] = 0
            sums = np.add.reduceat(_BYTE[part] * weights, begins)
            hashes.append(_mixed(sums))
            firsts.append(begins + start)
        start = stop
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts)


def _offsets(begins: np.ndarray, n: int) -> np.ndarray:
    """Place of each byte within its word."""
    at = np.zeros(n, dtype=np.int64)
    at[begins[0] :] = np.arange(begins[0], n) - np.repeat(begins, np.diff(np.r_[begins, n]))
    return at


def _rolled(words: np.ndarray, width: int, factor: np.uint64) -> np.ndarray:
    n = len(words) - width + 1
    total = np.zeros(max(n, 0), dtype=np.uint64)
    for step in range(width if n > 0 else 0):
        total = total * factor + words[step : step + n]
    return _mixed(total)


class _Group:
    """The words of a group of documents, one after the other."""

    def __init__(self, table: pa.Table):
        self.texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        self.ids = pc.fill_null(table.column("doc_id"), _NO_ID).to_numpy()
        buffer = np.frombuffer(b"\n".join([*self.texts, b""]), dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in self.texts], dtype=np.int64)
        self.words, firsts = word_hashes(buffer)
        self.doc = np.searchsorted(ends, firsts, side="right")
        self.counts = np.bincount(self.doc, minlength=len(self.texts))
        self.starts = np.cumsum(self.counts) - self.counts
        self.at = np.arange(len(self.words)) - self.starts[self.doc]
        self.left = self.counts[self.doc] - self.at

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the anchors and their hashes."""
        where = np.flatnonzero(np.isin(self.at % PERIOD, COVER) & (self.left >= ANCHOR))
        return where, _rolled(self.words, ANCHOR, _Q)[where]

    def candidates(self, where: np.ndarray, hashes: np.ndarray, elsewhere: np.ndarray):
        """Starts of windows around anchors of several documents. ``elsewhere``
        tells for each distinct hash, in order, if another group has it."""
        distinct, which = np.unique(hashes, return_inverse=True)
        docs = self.doc[where]
        first = np.full(len(distinct), len(self.texts))
        last = np.full(len(distinct), -1)
        np.minimum.at(first, which, docs)
        np.maximum.at(last, which, docs)
        marked = np.zeros(len(self.words) + PERIOD, dtype=bool)
        marked[where[(elsewhere | (first < last))[which]]] = True
        near = np.zeros(len(self.words), dtype=bool)
        for step in range(PERIOD):
            near |= marked[step : step + len(self.words)]
        return np.flatnonzero(near & (self.left >= WINDOW))

    def windows(self, starts: np.ndarray):
        """Distinct windows (96 bits, in order), the smallest document of each, and
        which window each start has."""
        high = _rolled(self.words, WINDOW, _Q)[starts]
        low = (_rolled(self.words, WINDOW, _R)[starts] >> np.uint64(32)).astype(np.uint32)
        ids = self.ids[self.doc[starts]]
        order = np.lexsort((ids, low, high))
        h, w = high[order], low[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (w[1:] != w[:-1])] if len(h) else np.empty(0, bool)
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        return h[new], w[new], ids[order][new], which


def _cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets, equal ranges of hash values, end in sorted ``hashes``."""
    edges = [(i << 64) // buckets for i in range(1, buckets)]
    return np.searchsorted(hashes, np.array(edges, dtype=np.uint64))


def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: small numbers then compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    rows = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(rows.T).view(kind).ravel()


_BLOCK = "g int, b int, high binary, low binary, ids binary"
_BITS = "g int, kind int, b int, bits binary"
_BLOCK_ARROW = pa.schema([("g", pa.int32()), ("b", pa.int32()), ("high", pa.binary()),
                          ("low", pa.binary()), ("ids", pa.binary())])
_BITS_ARROW = pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("b", pa.int32()),
                         ("bits", pa.binary())])


def _blocks(g: int, buckets: int, high: np.ndarray, low=None, ids=None) -> pa.Table:
    rows = []
    bounds = [0, *_cuts(high, buckets), len(high)]
    for b, (i, j) in enumerate(zip(bounds[:-1], bounds[1:])):
        if i < j:
            rest = (None, None) if low is None else (low[i:j].tobytes(), _planes(ids[i:j]))
            rows.append((g, b, high[i:j].tobytes(), *rest))
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, _BLOCK_ARROW.types)],
                    schema=_BLOCK_ARROW)


def _flags(bits: list[dict], kind: int, high: np.ndarray, buckets: int) -> np.ndarray:
    """The bits that the buckets sent back, for each of the sorted hashes."""
    out = np.zeros(len(high), dtype=bool)
    bounds = [0, *_cuts(high, buckets), len(high)]
    for row in bits:
        if row["kind"] == kind:
            i, j = bounds[row["b"]], bounds[row["b"] + 1]
            out[i:j] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=j - i)
    return out


def _answers(kind: int, table: pa.Table, lengths: Iterable[int], flags: np.ndarray) -> pa.Table:
    ends = np.cumsum(list(lengths))
    bits = [np.packbits(f).tobytes() for f in np.split(flags, ends[:-1])]
    return pa.table([table.column("g"), pa.array([kind] * len(bits), pa.int32()),
                     table.column("b"), pa.array(bits, pa.binary())], schema=_BITS_ARROW)


def _shared_anchors(table: pa.Table) -> pa.Table:
    """For each hash of each block: does another group have it?"""
    blocks = [np.frombuffer(x, np.uint64) for x in table.column("high").to_pylist()]
    hashes = np.concatenate(blocks)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    flags = np.empty(len(hashes), dtype=bool)
    flags[order] = np.r_[False, same] | np.r_[same, False]
    return _answers(0, table, map(len, blocks), flags)


def _earlier_windows(table: pa.Table) -> pa.Table:
    """For each window of each block: does another group have it in a smaller document?"""
    blocks = [np.frombuffer(x, np.uint64) for x in table.column("high").to_pylist()]
    high = np.concatenate(blocks)
    low = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("low").to_pylist()])
    ids = np.concatenate([_unplanes(x, np.int64) for x in table.column("ids").to_pylist()])
    order = np.lexsort((ids, low, high))
    h, w, i = high[order], low[order], ids[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (w[1:] != w[:-1])]
    flags = np.empty(len(high), dtype=bool)
    flags[order] = i > i[new][np.cumsum(new) - 1]
    return _answers(1, table, map(len, blocks), flags)


def remove_repeats(
    docs: DataFrame,
    carry: list[str] | tuple[str, ...] = (),
    normalise: bool = True,
    group_bytes: int = GROUP_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, carried) per document.

    Each word is removed that is covered by a window which also starts in a
    document with a smaller doc_id; windows are judged on the input. ``kept``
    holds the other words joined by one space; without ``normalise`` a text
    that loses nothing is kept as it is, NULL too. ``carried`` is a struct of the
    ``carry`` columns, NULL without any.

    A NULL text has no words. A row without doc_id counts as later than all
    others. Rows with equal doc_id do not touch each other.
    """
    groups = text_groups(docs, group_bytes)
    buckets = text_groups(docs, 2 * bucket_bytes)  # anchors make about 0.6 bytes per byte of text
    carried = F.struct(*[docs[c] for c in carry]) if carry else F.lit(None).cast("int")
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", carried.alias("carried"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("g"),
    )
    kept_schema = "doc_id long, n_words long, n_removed long, kept string, carried " + (
        dealt.schema["carried"].dataType.simpleString())

    def send_anchors(table: pa.Table) -> pa.Table:
        _, hashes = _Group(table).anchors()
        return _blocks(table.column("g")[0].as_py(), buckets, np.unique(hashes))

    def found(table: pa.Table, bits: pa.Table):
        group, rows = _Group(table), bits.to_pylist()
        where, hashes = group.anchors()
        starts = group.candidates(where, hashes, _flags(rows, 0, np.unique(hashes), buckets))
        return group, rows, starts, *group.windows(starts)

    def send_windows(table: pa.Table, bits: pa.Table) -> pa.Table:
        _, _, _, high, low, ids, _ = found(table, bits)
        return _blocks(table.column("g")[0].as_py(), buckets, high, low, ids)

    def cut(table: pa.Table, bits: pa.Table) -> pa.Table:
        group, rows, starts, high, _, first, which = found(table, bits)
        earlier = _flags(rows, 1, high, buckets)
        gone = starts[earlier[which] | (group.ids[group.doc[starts]] > first[which])]
        edges = np.zeros(len(group.words) + 1, dtype=np.int64)
        np.add.at(edges, gone, 1)
        np.add.at(edges, gone + WINDOW, -1)
        keep = np.cumsum(edges[:-1]) == 0
        removed = np.bincount(group.doc[~keep], minlength=len(group.texts))
        kept = []
        missing = table.column("text").is_null().to_pylist()
        for text, null, n, lost, start in zip(
            group.texts, missing, group.counts, removed, group.starts
        ):
            if null and not normalise:
                text = None
            elif lost:
                words = text.split()
                text = b" ".join([words[i] for i in np.flatnonzero(keep[start : start + n])])
            elif normalise:
                text = b" ".join(text.split())
            kept.append(text)
        return pa.table({
            "doc_id": table.column("doc_id"), "n_words": pa.array(group.counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            "carried": table.column("carried"),
        })

    by_group = dealt.groupBy("g")
    anchors = by_group.applyInArrow(lean(send_anchors), _BLOCK).groupBy("b").applyInArrow(
        lean(_shared_anchors), _BITS)
    windows = by_group.cogroup(anchors.groupBy("g")).applyInArrow(lean(send_windows), _BLOCK).groupBy(
        "b").applyInArrow(lean(_earlier_windows), _BITS)
    bits = anchors.unionByName(windows)
    return by_group.cogroup(bits.groupBy("g")).applyInArrow(lean(cut), kept_schema)


def digests(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per document."""
    return remove_repeats(docs, **settings).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated words taken out of their texts, other columns
    as they are but for ``n_chars``, which follows the text. Texts that lose
    nothing stay as they are; documents that lose every word are dropped."""
    rest = [c for c in docs.columns if c != "text"]
    cut = remove_repeats(docs, carry=rest, normalise=False).where(
        "n_removed = 0 or n_removed < n_words")
    text = F.col("kept").alias("text")
    columns = {c: F.col("carried")[c].alias(c) for c in rest} | {"text": text}
    if "n_chars" in rest:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(
            F.col("carried")["n_chars"]).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return cut.select(*[columns[c] for c in docs.columns])
