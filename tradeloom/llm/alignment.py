"""Tokens of two tokenizers aligned by the bytes that they cover.

Both token rows of a text are laid over its bytes. All tokens are sorted by
start and the largest end so far runs along; a token that starts where that end
is reached opens a new group, so that groups are the smallest spans at whose
ends tokens of both rows end. Tokens of one group are linked. How many documents
hold a pair of ids linked is counted over the corpus: a chunk of documents names
each of its pairs once, with the documents that hold it, and gets one answer for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.shared import written
from tradeloom.llm.tokens import TOKENIZER, Encoded, Memory, bounds_of, slices, splice, together, tokens_of

PIECES = "piece_bpe_32k.model"
#: Text bytes aligned at once, and whose pairs are named together.
ALIGNED_BYTES = 2_000_000
CHUNK_BYTES = 8_000_000
#: Pairs expanded at once.
PAIRS = 2_000_000
# In groups with more links than this equal ids are put together before they are paired.
_LARGE = 256
_SPACE = "▁"


class Pieces:
    """Ids of texts by a sentencepiece model, which puts a space before each text.

    No piece of the model holds a space but at its start, so single spaces part
    a text into words whose ids do not depend on each other.
    """

    def __init__(self, model: str = PIECES):
        import public_tokenizers
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        self.bytes = np.array([
            bytes([int(n[3:-1], 16)]) if self.library.is_byte(i) else n.replace(_SPACE, " ").encode()
            for i, n in enumerate(names)], dtype=object)
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.apart = not any(_SPACE in n.lstrip(_SPACE) for n in names)
        self.words = Memory(lambda words: self._words(words.to_pylist()))

    def _whole(self, texts: list[str]) -> Encoded:
        return together(self.library.encode(texts, num_threads=1) if texts else [])

    def _words(self, words: list[str]) -> Encoded:
        """Words that the model does not give back byte for byte have no ids here."""
        ids, bounds = self._whole(words)
        plain = [b" " + w.encode() for w in words]
        sizes = np.diff(np.r_[0, np.cumsum(self.lengths[ids])][bounds])
        if (sizes == [len(p) for p in plain]).all() and b"".join(self.bytes[ids]) == b"".join(plain):
            return ids, bounds
        cuts = bounds.tolist()
        rows = [ids[a:b] if b"".join(self.bytes[ids[a:b]]) == p else ids[:0]
                for a, b, p in zip(cuts, cuts[1:], plain)]
        return together(rows)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the bounds of each text's, and which texts are known to be
        given back byte for byte."""
        texts = texts.cast(pa.large_string()).fill_null("")
        slow = pc.or_(pc.or_(pc.equal(texts, ""), pc.match_substring(texts, "  ")),
                      pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
        fast = ~slow.to_numpy(zero_copy_only=False) & self.apart
        some = texts.filter(pa.array(fast))
        words = pc.split_pattern(some, " ")
        ids, bounds = self.words.expand(self.words.look(words.flatten()))
        lists = words.offsets.to_numpy() if len(some) else np.zeros(1, np.int64)
        lists = lists - lists[0]
        strange = np.diff(np.r_[0, np.cumsum(np.diff(bounds) == 0)][lists]) > 0
        found = ids, bounds[lists]
        if strange.any():
            keep = np.repeat(~strange, np.diff(found[1]))
            found = ids[keep], bounds_of(np.diff(found[1])[~strange])
            fast[np.flatnonzero(fast)[strange]] = False
        rest = self._whole(texts.filter(pa.array(~fast)).to_pylist())
        return *splice(fast, found, rest), fast


@lru_cache(maxsize=2)
def pieces_of(model: str = PIECES) -> Pieces:
    """The model of this process: a worker keeps it, and its words, from task to task."""
    return Pieces(model)


@lru_cache(maxsize=2)
def _piece_bytes(tokenizer: str) -> np.ndarray:
    from tokenizers.pre_tokenizers import ByteLevel

    own = tokens_of(tokenizer, True, True)
    # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    assert set(letters) == set(ByteLevel.alphabet())
    out = np.empty(len(own.lengths), dtype=object)
    for piece, number in own.library.get_vocab().items():
        known = all(c in letters for c in piece)
        out[number] = bytes(letters[c] for c in piece) if known else piece.encode()
    return out


@dataclass
class Aligned:
    """Texts aligned: ids of both sides, the group of each token, and bounds by text.

    Texts without tokens have empty bounds. Groups are numbered through all texts.
    """

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_bounds: np.ndarray  # by text
    ends: np.ndarray  # byte offset at which each group ends, in its text with the leading space


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of two rows that cover the same bytes."""
    ends = np.concatenate([np.cumsum(a_sizes), np.cumsum(b_sizes)])
    starts = ends - np.concatenate([a_sizes, b_sizes])
    order = np.lexsort((np.arange(len(ends)) >= len(a_sizes), starts))
    reached = np.maximum.accumulate(ends[order])
    opens = np.zeros(len(ends), dtype=np.int64)
    opens[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(ends), dtype=np.int64)
    group[order] = np.cumsum(opens)
    return group[: len(a_sizes)], group[len(a_sizes) :]


def align(texts: pa.Array, tokenizer: str = TOKENIZER, model: str = PIECES) -> Aligned:
    """Both token rows of each text, with a space before it, and their groups."""
    one, other = tokens_of(tokenizer, True, True), pieces_of(model)
    a, a_bounds = one.encode(texts)
    b, b_bounds, same = other.encode(texts)
    plain = texts.cast(pa.large_string()).fill_null("")
    good = same.copy()
    a_bytes = _piece_bytes(tokenizer)
    for i in np.flatnonzero(~same).tolist():
        text = plain[i].as_py()
        wanted = b" " + text.encode()
        good[i] = bool(text) and wanted == b"".join(a_bytes[a[a_bounds[i] : a_bounds[i + 1]]]) \
            and wanted == b"".join(other.bytes[b[b_bounds[i] : b_bounds[i + 1]]])
    if not good.all():
        n_a, n_b = np.diff(a_bounds), np.diff(b_bounds)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        a_bounds, b_bounds = bounds_of(np.where(good, n_a, 0)), bounds_of(np.where(good, n_b, 0))
    a_sizes, b_sizes = one.lengths[a], other.lengths[b]
    a_group, b_group = coalesce(a_sizes, b_sizes)
    groups = int(a_group[-1]) + 1 if len(a) else 0
    first = np.r_[a_group, groups][a_bounds[:-1]]
    starts = np.r_[0, np.cumsum(a_sizes)]
    last = np.flatnonzero(np.r_[a_group[1:] != a_group[:-1], True]) if groups else np.empty(0, np.int64)
    sizes = np.diff(np.r_[first, groups])
    ends = starts[last + 1] - np.repeat(starts[a_bounds[:-1]], sizes)
    return Aligned(a, b, a_bounds, b_bounds, a_group, b_group, bounds_of(sizes), ends)


@lru_cache(maxsize=1)
def _marked(most: int) -> np.ndarray:
    """Every id below ``most`` as a decimal, followed by each mark."""
    return np.array([f"{i}{mark}".encode() for i in range(most) for mark in (",", "|", ";", "")])


def group_texts(found: Aligned) -> list[bytes]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
    groups = int(found.group_bounds[-1])
    if not groups:
        return [b""] * (len(found.group_bounds) - 1)
    n_a, n_b = np.bincount(found.a_group, minlength=groups), np.bincount(found.b_group, minlength=groups)
    place_a = np.arange(len(found.a)) + (np.cumsum(n_b) - n_b)[found.a_group]
    place_b = np.arange(len(found.b)) + np.cumsum(n_a)[found.b_group]
    ids = np.empty(len(found.a) + len(found.b), dtype=np.int64)
    ids[place_a], ids[place_b] = found.a, found.b
    mark = np.zeros(len(ids), dtype=np.int64)  # , after most; | after the last A; ; after the last B
    ends = np.cumsum(n_a + n_b)
    mark[ends - 1] = 2
    mark[ends - n_b - 1] = 1
    cuts = found.a_bounds + found.b_bounds
    mark[cuts[1:][np.diff(cuts) > 0] - 1] = 3
    text = _marked(1 << int(ids.max()).bit_length())[ids * 4 + mark]
    bounds = cuts.tolist()
    return [text[x:y].tobytes().replace(b"\0", b"") for x, y in zip(bounds, bounds[1:])]


def _rows_by_id(group: np.ndarray, ids: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, occurrences) in group order; equal ids of large groups in one row."""
    heavy = large[group]
    if not heavy.any():
        return group, ids.astype(np.int64), np.ones(len(ids), dtype=np.int64)
    keys, n = np.unique(group[heavy] << 32 | ids[heavy], return_counts=True)
    g = np.concatenate([group[~heavy], keys >> 32])
    i = np.concatenate([ids[~heavy].astype(np.int64), keys & (1 << 32) - 1])
    weight = np.concatenate([np.ones((~heavy).sum(), np.int64), n])
    order = np.argsort(g, kind="stable")
    return g[order], i[order], weight[order]


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[at], np.add.reduceat(weights[order], at)


def linked_pairs(found: Aligned, width: int, most: int = PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, a * width + b, links) of all distinct linked id pairs, in text and pair order."""
    groups = int(found.group_bounds[-1])
    text = np.repeat(np.arange(len(found.group_bounds) - 1), np.diff(found.group_bounds))
    n_a, n_b = np.bincount(found.a_group, minlength=groups), np.bincount(found.b_group, minlength=groups)
    large = n_a * n_b > _LARGE
    ga, a, wa = _rows_by_id(found.a_group, found.a, large)
    gb, b, wb = _rows_by_id(found.b_group, found.b, large)
    low = np.searchsorted(gb, np.arange(groups + 1))
    reach = low[ga + 1] - low[ga]  # rows of B that each row of A meets
    ends = np.cumsum(reach)
    top = int(found.a.max()) + 1 if len(found.a) else 1
    keys, links, at = [], [], 0
    while at < len(a):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        n = reach[at:stop]
        i = np.repeat(np.arange(at, stop), n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + low[ga[i]]
        key, weight = _added((text[ga[i]] * top + a[i]) * width + b[j], wa[i] * wb[j])
        keys.append(key)
        links.append(weight)
        at = stop
    if not keys:
        none = np.empty(0, np.int64)
        return none, none, none
    key, weight = (keys[0], links[0]) if len(keys) == 1 else _added(np.concatenate(keys), np.concatenate(links))
    return key // (top * width), key % (top * width), weight


_ROW = ("g long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "at array<int>, links array<long>, pairs array<long>, docs array<long>")


def _chunks(docs: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """A row per document, with its pairs as places in its chunk's list, and a
    row per chunk with that list and the documents that hold each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        width = pieces_of(model).library.get_piece_size()
        kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3]
        names = [part.split()[0] for part in _ROW.split(", ")]
        g = TaskContext.get().partitionId() << 32

        def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))

        for batch in batches:
            for first, last in slices(batch.column(1), CHUNK_BYTES):
                g += 1
                texts = batch.column(1).slice(first, last - first)
                n = [np.zeros(len(texts), dtype=np.int64) for _ in range(4)]
                digests: list[str] = []
                of, pair, links = [], [], []
                for x, y in slices(texts, ALIGNED_BYTES):
                    found = align(texts.slice(x, y - x), tokenizer, model)
                    groups = int(found.group_bounds[-1])
                    n_a, n_b = np.diff(found.a_bounds), np.diff(found.b_bounds)
                    each = np.bincount(found.a_group, minlength=groups) * np.bincount(found.b_group, minlength=groups)
                    n[0][x:y], n[1][x:y], n[2][x:y] = n_a, n_b, np.diff(found.group_bounds)
                    n[3][x:y] = np.diff(np.r_[0, np.cumsum(each)][found.group_bounds])
                    digests += [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(found)]
                    t, p, w = linked_pairs(found, width)
                    of.append(t + x)
                    pair.append(p)
                    links.append(w)
                owner, pair_, links_ = np.concatenate(of), np.concatenate(pair), np.concatenate(links)
                known, at, held = np.unique(pair_, return_inverse=True, return_counts=True)
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
                rows = len(texts)
                none = pa.nulls(rows, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(rows, g)), batch.column(0).slice(first, rows), *map(pa.array, n),
                    pa.array(digests, pa.string()), lists(at.reshape(-1), bounds, pa.int32()),
                    lists(links_, bounds, pa.int64()), none, none], names=names)
                if len(known):
                    whole = np.array([0, len(known)])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([g]), *[pa.nulls(1, k) for k in kinds[1:9]],
                        lists(known, whole, pa.int64()), lists(held, whole, pa.int64())], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ROW)


def _digest(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a chunk with the sums over their links."""
    left = left.combine_chunks()
    answers = np.zeros(len(right), dtype=np.int64)
    answers[right.column("at").to_numpy()] = right.column("answer").to_numpy()
    best = np.zeros(len(left), dtype=np.int64)
    total = np.zeros(len(left), dtype=np.int64)
    if len(right):
        at = pc.list_flatten(left.column("at")).to_numpy()
        links = pc.list_flatten(left.column("links")).to_numpy()
        bounds = bounds_of(pc.list_value_length(left.column("at")).to_numpy())
        mine = answers[at]
        total = np.diff(np.r_[0, np.cumsum(links * (mine >> 1))][bounds])
        best = np.diff(np.r_[0, np.cumsum(links * (mine & 1))][bounds])
    out = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return out.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(total)).append_column(
        "groups_sha256", left.column("groups_sha256"))


def alignments(docs: DataFrame, tokenizer: str = TOKENIZER, model: str = PIECES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per document.

    A pair's count is the number of documents that hold its two ids linked;
    ``n_best`` adds up the links whose count is the highest that their A id has
    anywhere, ``count_sum`` the counts of all links. Texts that are NULL, empty
    or not given back byte for byte by both tokenizers have no tokens. Repeated
    rows are documents of their own.
    """
    width = F.lit(_vocabulary(model))
    rows = written(_chunks(docs, tokenizer, model))
    asked = rows.where("pairs is not null").select(
        "g", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "p")
    ).select("g", "at", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = asked.groupBy("pair").agg(F.sum("docs").alias("count"))
    # An A id has at most as many pairs as the model has pieces.
    highest = F.max("count").over(Window.partitionBy(F.floor(F.col("pair") / width)))
    known = written(counts.select(
        "pair", (F.col("count") * 2 + (F.col("count") == highest).cast("long")).alias("answer")))
    answers = asked.select("g", "at", "pair").join(known, "pair").select(
        F.col("g").alias("chunk"), "at", "answer")
    own = rows.where("pairs is null").drop("pairs", "docs")
    return own.groupBy("g").cogroup(answers.groupBy("chunk")).applyInArrow(
        _digest, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                 "groups_sha256 string")


@lru_cache(maxsize=2)
def _vocabulary(model: str) -> int:
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model)).get_piece_size()


def groups(docs: DataFrame, tokenizer: str = TOKENIZER, model: str = PIECES) -> DataFrame:
    """(doc_id, a_ids, b_ids, ends, n_a, n_b): both token rows of each text with a
    space before it, and for each group the byte at which it ends and how many
    tokens of each row it takes. Texts without tokens have empty lists."""
    schema = "doc_id long, a_ids array<int>, b_ids array<int>, ends array<long>, n_a array<int>, n_b array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in slices(batch.column(1), ALIGNED_BYTES):
                found = align(batch.column(1).slice(x, y - x), tokenizer, model)
                total = int(found.group_bounds[-1])

                def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
                    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))

                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(x, y - x),
                    lists(found.a, found.a_bounds, pa.int32()), lists(found.b, found.b_bounds, pa.int32()),
                    lists(found.ends, found.group_bounds, pa.int64()),
                    lists(np.bincount(found.a_group, minlength=total), found.group_bounds, pa.int32()),
                    lists(np.bincount(found.b_group, minlength=total), found.group_bounds, pa.int32()),
                ], names=["doc_id", "a_ids", "b_ids", "ends", "n_a", "n_b"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
