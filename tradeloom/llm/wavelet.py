"""Token ids in compressed files, each a wavelet matrix that is searched without being read whole.

A file numbers the ids that occur in it from 0 and keeps those numbers bit by
bit: one plane per bit, highest first, where the bits of a plane stand in the
order that a stable sort by all higher bits, read backwards, gives. Planes are
cut into blocks, each compressed by itself, with the ones before each block in
a directory. Access, counting and occurrence lookup then touch a block or two
per plane.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.shared import shared_folder, text_groups, written
from tradeloom.llm.tokens import TOKENIZER, slices, tokens_of

END = 2
MAGIC = b"WMAT0001"
BLOCK_BITS = 1 << 16
#: Tokens in a file; a document may go on in the next file of its shard.
FILE_TOKENS = 1 << 22
#: Text bytes in a shard, which one task writes and one task reads.
SHARD_BYTES = 24_000_000
_ENCODED = 4_000_000
_KEPT_BLOCKS = 64


def _code_type(names: int) -> type:
    return np.uint16 if names <= 1 << 16 else np.uint32


def build(ids: np.ndarray, starts: Sequence[tuple[int | None, int]] = (), carried: int = 0) -> bytes:
    """The file of ``ids``.

    ``starts`` names the documents whose first id is in it, with the number of
    all their ids; the first ``carried`` ids belong to a document begun earlier.
    """
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3).compress
    codes: np.ndarray
    if len(ids) and ids.max() < 1 << 22:
        seen = np.bincount(ids) > 0
        names = np.flatnonzero(seen)
        codes = (np.cumsum(seen) - 1).astype(_code_type(len(names)))[ids]
    else:
        names, codes = np.unique(ids, return_inverse=True)
        codes = codes.astype(_code_type(len(names))).reshape(-1)
    planes = max(1, int(len(names) - 1).bit_length())
    body, zeros, ranks, sizes = [], [], [], []
    for plane in range(planes):
        bits = (codes >> (planes - 1 - plane)) & 1 == 1
        padded = np.zeros(-(-max(len(bits), 1) // BLOCK_BITS) * BLOCK_BITS, dtype=bool)
        padded[: len(bits)] = bits
        blocks = np.packbits(padded).reshape(-1, BLOCK_BITS // 8)
        ones = np.cumsum(np.bitwise_count(blocks).sum(axis=1, dtype=np.int64))
        ranks.append(np.r_[0, ones])
        packed = [squeeze(b.tobytes()) for b in blocks]
        sizes.append([len(b) for b in packed])
        body += packed
        zeros.append(len(bits) - int(ones[-1]))
        codes = np.concatenate([codes[~bits], codes[bits]])
    parts = {
        "names": names.astype("<u4"),
        "zeros": np.array(zeros, dtype="<i8"),
        "ranks": np.array(ranks, dtype="<i8"),
        "sizes": np.array(sizes, dtype="<i8"),
        "doc_known": np.array([d is not None for d, _ in starts], dtype=np.uint8),
        "doc_ids": np.array([d or 0 for d, _ in starts], dtype="<i8"),
        "doc_lengths": np.array([n for _, n in starts], dtype="<i8"),
    }
    packed = {name: squeeze(part.tobytes()) for name, part in parts.items()}
    head = json.dumps({
        "tokens": len(ids), "planes": planes, "block_bits": BLOCK_BITS, "carried": carried,
        "parts": [[name, part.dtype.str, len(packed[name])] for name, part in parts.items()],
    }).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *packed.values(), *body])


class TokenFile:
    """Read access to one file; ``source`` has ``seek`` and ``read``."""

    def __init__(self, source):
        import zstandard

        self._open = zstandard.ZstdDecompressor().decompress
        self._source = source
        self._blocks: OrderedDict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = OrderedDict()
        source.seek(0)
        magic, size = struct.unpack("<8sI", source.read(12))
        if magic != MAGIC:
            raise ValueError("not a token file")
        head = json.loads(source.read(size))
        part = {n: np.frombuffer(self._open(source.read(s)), dtype=d) for n, d, s in head["parts"]}
        self.tokens, self.planes, self.carried = head["tokens"], head["planes"], head["carried"]
        self._bits = head["block_bits"]
        self.names, self._zeros = part["names"], part["zeros"]
        self._ranks = part["ranks"].reshape(self.planes, -1)
        sizes = part["sizes"].reshape(self.planes, -1)
        at = 12 + size + sum(s for *_, s in head["parts"])
        self._sizes = sizes
        self._places = at + np.r_[0, np.cumsum(sizes.ravel())[:-1]].reshape(sizes.shape)
        ids = part["doc_ids"].tolist()
        self.documents = [
            (d if known else None, n)
            for d, known, n in zip(ids, part["doc_known"].tolist(), part["doc_lengths"].tolist())
        ]

    def _block(self, plane: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a block and the ones before each of them in the plane."""
        key = (plane, number)
        if key not in self._blocks:
            self._source.seek(int(self._places[plane, number]))
            raw = self._open(self._source.read(int(self._sizes[plane, number])))
            bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8))
            before = np.cumsum(bits, dtype=np.int64) - bits + self._ranks[plane, number]
            self._blocks[key] = bits, before
            if len(self._blocks) > _KEPT_BLOCKS:
                self._blocks.popitem(last=False)
        self._blocks.move_to_end(key)
        return self._blocks[key]

    def _look(self, plane: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bit at, and ones before, each position; positions up to the length."""
        bit, ones = np.empty(len(at), dtype=np.uint8), np.empty(len(at), dtype=np.int64)
        ended = at >= self.tokens
        bit[ended], ones[ended] = 0, self._ranks[plane, -1]
        number = at // self._bits
        for block in np.unique(number[~ended]):
            mine = (number == block) & ~ended
            bits, before = self._block(plane, int(block))
            inside = at[mine] - block * self._bits
            bit[mine], ones[mine] = bits[inside], before[inside]
        return bit, ones

    def _select(self, plane: int, bit: int, ranks: np.ndarray) -> np.ndarray:
        """Positions of the bits with these numbers among the equal bits of the plane."""
        ones = self._ranks[plane]
        before = ones if bit else np.arange(len(ones)) * self._bits - ones
        number = np.searchsorted(before, ranks, "right") - 1
        out = np.empty(len(ranks), dtype=np.int64)
        for block in np.unique(number):
            mine = number == block
            same = np.flatnonzero(self._block(plane, int(block))[0] == bit)
            out[mine] = same[ranks[mine] - before[block]] + block * self._bits
        return out

    def access(self, positions: Sequence[int]) -> np.ndarray:
        """The ids at ``positions``."""
        at = np.asarray(positions, dtype=np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.tokens):
            raise IndexError("position outside the file")
        code = np.zeros(len(at), dtype=np.int64)
        for plane in range(self.planes):
            bit, ones = self._look(plane, at)
            code = code * 2 + bit
            at = np.where(bit == 1, self._zeros[plane] + ones, at - ones)
        return self.names[code]

    def _span(self, token: int, start: int, stop: int) -> tuple[int, int, int]:
        """Code of ``token`` and where its occurrences in [start, stop) end up in the last order."""
        code = int(np.searchsorted(self.names, token))
        if code == len(self.names) or self.names[code] != token:
            return -1, 0, 0
        ends = np.array([max(start, 0), max(min(stop, self.tokens), start, 0)], dtype=np.int64)
        for plane in range(self.planes):
            _, ones = self._look(plane, ends)
            if code >> (self.planes - 1 - plane) & 1:
                ends = self._zeros[plane] + ones
            else:
                ends = ends - ones
        return code, int(ends[0]), int(ends[1])

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often ``token`` stands in [start, stop)."""
        _, low, high = self._span(token, start, self.tokens if stop is None else stop)
        return high - low

    def occurrences(self, token: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Positions of ``token`` in [start, stop), ascending."""
        code, low, high = self._span(token, start, self.tokens if stop is None else stop)
        at = np.arange(low, high)
        for plane in range(self.planes - 1, -1, -1):
            bit = code >> (self.planes - 1 - plane) & 1
            at = self._select(plane, bit, at - self._zeros[plane] if bit else at)
        return at

    def all(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        codes = np.zeros(self.tokens, dtype=_code_type(len(self.names)))
        for plane in range(self.planes - 1, -1, -1):
            self._source.seek(int(self._places[plane, 0]))
            raw = self._source.read(int(self._sizes[plane].sum()))
            cuts = np.r_[0, np.cumsum(self._sizes[plane])].tolist()
            plain = b"".join(self._open(raw[a:b]) for a, b in zip(cuts, cuts[1:]))
            bits = np.unpackbits(np.frombuffer(plain, dtype=np.uint8))[: self.tokens].view(bool)
            back, zeros = np.empty_like(codes), int(self._zeros[plane])
            back[~bits], back[bits] = codes[:zeros], codes[zeros:]
            back |= bits.astype(codes.dtype) << (self.planes - 1 - plane)
            codes = back
        return self.names[codes]


def file_system(folder: str):
    """The pyarrow file system of a folder and the folder's path in it."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def write_files(
    docs: DataFrame, folder: str | None = None, tokenizer: str = TOKENIZER,
    file_tokens: int = FILE_TOKENS, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write the ids of all texts, each with an end id, and list the files:
    (shard, number, path, tokens).

    Shards follow each other in ascending doc_id order, unknown ids last, and
    so do the files of a shard. Rows of one doc_id are ordered by their text's
    hash and their place in the input, so that an id with any share of the rows
    is cut into shards like others. NULL texts count as empty. A task that is
    run again writes files under new names; only listed files count.
    """
    folder = folder or f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        tokens = tokens_of(tokenizer)
        shard = TaskContext.get().partitionId()
        end = np.array([END], dtype="<u4").tobytes()
        made = []
        waiting, starts = bytearray(), []
        left = 0  # ids still to come of the document that the last file cut

        def flush(most: int) -> None:
            nonlocal starts, left
            ids = np.frombuffer(bytes(waiting[: 4 * most]), dtype="<u4")
            name = f"{path}/{shard:07d}-{len(made):05d}-{uuid.uuid4().hex}.wm"
            carried = min(left, len(ids))
            mine, place = 0, carried
            while mine < len(starts) and place < len(ids):
                place += starts[mine][1]
                mine += 1
            with system.open_output_stream(name) as out:
                out.write(build(ids, starts[:mine], carried))
            left = left - carried if not mine else place - len(ids)
            made.append((shard, len(made), name, len(ids)))
            starts = starts[mine:]
            del waiting[: 4 * most]

        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in slices(texts, _ENCODED):
                ids, cuts = tokens.encode(texts.slice(a, b - a))
                for doc, start, stop in zip(docs[a:b], cuts.tolist(), cuts[1:].tolist()):
                    starts.append((doc, stop - start + 1))
                    waiting += ids[start:stop].tobytes() + end
                    while len(waiting) >= 4 * file_tokens:
                        flush(file_tokens)
        if waiting:
            flush(len(waiting) // 4)
        columns = list(zip(*made)) if made else [[]] * 4
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "number", "path", "tokens"])

    keys = ["doc_id", "_hash", "_place"]
    order = [F.col("doc_id").asc_nulls_last(), "_hash", "_place"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        *["doc_id", "text"], F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_place"))
    shards = text_groups(docs, shard_bytes, least=8)
    dealt = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    return written(dealt.drop(*keys[1:]).mapInArrow(run, "shard int, number int, path string, tokens long"))


def read_files(files: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the listed files.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is the
    unsigned CRC-32 of its ids as little-endian unsigned 32-bit integers. Each
    task reads the files of a shard one after the other; ``folder`` names the
    file system where it is not the local one.
    """

    folder = folder or shared_folder(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(folder)

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

        for batch in batches:
            for row in batch.to_pylist():
                start, doc, length, left, crc = row["start"], None, 0, 0, 0
                for file in row["files"]:
                    rows = []
                    with system.open_input_file(file["path"]) as source:
                        found = TokenFile(source)
                        raw = found.all().astype("<u4").tobytes()
                    place = min(left, found.tokens) * 4
                    crc = zlib.crc32(raw[:place], crc)
                    left -= place // 4
                    if length and not left:
                        rows.append((doc, start, length, crc))
                        start, length = start + length, 0
                    for doc, length in found.documents:
                        stop = min(place + 4 * length, len(raw))
                        crc = zlib.crc32(raw[place:stop])
                        left = length - (stop - place) // 4
                        place = stop
                        if not left:
                            rows.append((doc, start, length, crc))
                            start, length = start + length, 0
                    yield emit(rows)

    # One row per shard: their number is the number of tasks that wrote them.
    shards = files.groupBy("shard").agg(
        F.sort_array(F.collect_list(F.struct("number", "path"))).alias("files"), F.sum("tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = written(shards.select("shard", "files", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    return placed.repartition(max(1, placed.count())).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the texts' ids to files and read them back, see ``write_files`` and ``read_files``.

    Repeated rows are documents of their own. An empty table gives no row.
    """
    return read_files(write_files(docs, file_tokens=file_tokens))
