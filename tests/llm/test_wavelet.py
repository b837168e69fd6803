import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.frames import SCHEMA, awkward, awkward_rows, with_clashes
from tradeloom.llm import tokens, wavelet


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60) | st.integers(0, 2**32 - 1), max_size=300), st.data())
def test_file_answers_as_an_array_does(ids, data):
    array = np.array(ids, dtype="<u4")
    file = wavelet.TokenFile(io.BytesIO(wavelet.build(array, [(7, 3), (None, 2)], 1)))
    assert file.all().tolist() == ids and file.documents == [(7, 3), (None, 2)] and file.carried == 1
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(ids)), st.integers(0, len(ids)))))
    assert file.access(range(a, b)).tolist() == ids[a:b]
    for token in {*ids[:5], 61, 2**32 - 1}:
        assert file.count(token, a, b) == ids[a:b].count(token)
        assert file.occurrences(token, a, b).tolist() == [i for i in range(a, b) if ids[i] == token]


def test_many_blocks():
    pick = np.random.default_rng(3)
    ids = (pick.zipf(1.3, 300_000) % 50_000).astype("<u4")
    raw = wavelet.build(ids)
    assert len(raw) < ids.nbytes / 2
    file = wavelet.TokenFile(io.BytesIO(raw))
    assert (file.all() == ids).all()
    some = pick.integers(0, len(ids), 2000)
    assert (file.access(some) == ids[some]).all()
    for token in (1, 2, 17, 4000):
        where = np.flatnonzero(ids == token)
        assert (file.occurrences(token) == where).all() and file.count(token, 70_000, 210_000) == (
            (where >= 70_000) & (where < 210_000)).sum()
    with pytest.raises(IndexError):
        file.access([len(ids)])
    with pytest.raises(ValueError):
        wavelet.TokenFile(io.BytesIO(b"x" * 100))


def wanted(rows):
    """Ids by the library's plain call; repeated ids in any order."""
    library = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    return [(r[0], np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes())
            for r in rows]


@pytest.mark.parametrize("file_tokens", [64, wavelet.FILE_TOKENS])
def test_equals_plain_encoding(spark, file_tokens):
    """Files of 64 ids cut most documents, one of them over a hundred times."""
    extra = [(200, "a <|endoftext|> b<|endoftext|>", "en", "s", 1), (201, "x \t \n y  ", "en", "s", 1)]
    docs = with_clashes(awkward(spark).unionByName(spark.createDataFrame(extra, SCHEMA)), "start", "number", "path")
    found = wavelet.token_files(docs, file_tokens).collect()
    plain = wanted(awkward_rows() + extra)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=key) == sorted(
        ((d, len(i) // 4, zlib.crc32(i)) for d, i in plain), key=key)
    by_start = sorted(found, key=lambda r: r.start)
    at = 0
    for row in by_start:
        assert row.start == at
        at += row.n_tokens
    order = [r.doc_id for r in by_start]
    known = [d for d in order if d is not None]
    assert known == sorted(known) and order[: len(known)] == known


def test_files_are_searched(spark):
    docs = spark.createDataFrame([(i, f"river {i} river stone", None, None, None) for i in range(50)], SCHEMA)
    files = wavelet.write_files(docs).collect()
    library = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    river = library.encode(" river").ids[0]
    seen = 0
    for row in files:
        with open(row.path, "rb") as source:
            file = wavelet.TokenFile(source)
            assert (file.access(file.occurrences(river)) == river).all()
            seen += file.count(river)
    assert seen == 50  # the first word of a text has no space before it


def test_empty(spark):
    assert wavelet.token_files(spark.createDataFrame([], SCHEMA)).collect() == []
