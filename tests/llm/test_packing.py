import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.frames import SCHEMA, awkward, awkward_rows, with_clashes
from tradeloom.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def ids(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")


def test_pieces_and_places(spark, tokenizer):
    docs = with_clashes(awkward(spark), "piece", "length", "offset", "sequence_id")
    rows = packing.pack(docs, 64).collect()
    wanted = []
    for r in awkward_rows():
        own = ids(tokenizer, r[1])
        bounds = [0, *range((len(own) - 1) % 64 + 1, len(own) + 1, 64)]
        wanted += [(r[0], k, a, b - a, zlib.crc32(own[a:b].tobytes()))
                   for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    key = lambda r: (r[0] is not None, *[x if x is not None else 0 for x in r])
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(wanted, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def plain_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            best = min(fits, key=lambda i: rooms[i])
            rooms[best] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80))
def test_plan_is_best_fit(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    rows = packing.plan(counts, 20)
    filled, ranks = {}, {}
    for length, first, stop, per, sequence, place in rows:
        for rank in range(first, stop):
            ranks.setdefault(length, []).append(rank)
            seat = rank - first
            filled.setdefault(sequence + seat // per, []).append((place + seat % per * length, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for parts in filled.values():
        parts.sort()
        assert [p for p, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 20
    assert len(filled) == plain_best_fit(lengths, 20)


def test_long_runs_and_special_strings(spark, tokenizer):
    texts = [" " * 2_000_000, "\n" * 2_000_000, "a" * 1_000_000, "<|endoftext|>", "a<|endoftext|> b <|endoftext|>"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    found = {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in packing.pieces(docs).collect()}
    for i, text in enumerate(texts):
        own = ids(tokenizer, text)
        bounds = [0, *range((len(own) - 1) % 1024 + 1, len(own) + 1, 1024)]
        for a, b in zip(bounds, bounds[1:]):
            assert found.pop((i, a)) == (b - a, zlib.crc32(own[a:b].tobytes()))
    assert not found
    assert ids(tokenizer, "<|endoftext|>").tolist() == [50256, 2]


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []
