import hashlib
import re

import numpy as np
import pytest

from tests.llm.frames import SCHEMA, awkward, awkward_rows, prose, rows_of, with_clashes
from tradeloom.llm import substrings

PASSAGE = prose(77, 60)


def plain(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    key = [float("inf") if r[0] is None else r[0] for r in rows]
    first = {}
    for k, w in zip(key, words):
        for i in range(len(w) - 12):
            t = tuple(w[i:i + 13])
            first[t] = min(first.get(t, k), k)
    out = []
    for r, k, w in zip(rows, key, words):
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < k:
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def shifted_rows():
    """One passage at every alignment, exactly 13 and 12 shared words, a chain of overlaps."""
    rows = awkward_rows()
    for k in range(9):
        rows.append((200 + k, f"{prose(300 + k, k)} {PASSAGE}\n{prose(400 + k, 9)}".strip(), "en", "s", 1))
    thirteen, twelve = prose(501, 13), prose(502, 12)
    for k in range(4):
        rows.append((300 + k, f"{prose(600 + k, 5 + k)} {thirteen} {prose(700 + k, 4)}", "en", "s", 1))
        rows.append((310 + k, f"{prose(800 + k, 5 + k)} {twelve} {prose(900 + k, 4)}", "en", "s", 1))
    long = prose(503, 90).split()
    rows += [(320 + k, " ".join(long[20 * k:20 * k + 40]), "en", "s", 1) for k in range(3)]
    rows.append((330, f"{PASSAGE} between {PASSAGE}", "en", "s", 1))
    return rows


@pytest.mark.parametrize("group_bytes", [1000, substrings.GROUP_BYTES])
def test_equals_brute_force(spark, group_bytes):
    rows = shifted_rows()
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA), "n_words", "kept", "b", "bits")
    found = substrings.digests(docs, group_bytes=group_bytes, bucket_bytes=group_bytes)
    assert rows_of(found) == plain(rows)


def test_without_repeats_keeps_columns_and_clean_texts(spark):
    docs = spark.createDataFrame(shifted_rows(), SCHEMA)
    out = {r.doc_id: r for r in substrings.without_repeats(docs).collect()}
    assert substrings.without_repeats(docs).columns == docs.columns
    original = {r[0]: r for r in shifted_rows()}
    assert out[200].text == original[200][1] and out[200].source == "s"
    assert PASSAGE not in out[204].text and out[204].n_chars == len(out[204].text)
    assert 101 not in out and out[102].text == "" and out[103].text is None


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substrings.digests(none).collect() == []
    assert substrings.without_repeats(none).collect() == []


def test_cover_meets_every_pair_of_alignments():
    for i in range(7):
        for j in range(7):
            assert any((i + k) % 7 in substrings.COVER and (j + k) % 7 in substrings.COVER for k in range(7))


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    text = ("alpha beta\tgamma\n" * 50 + "x" * 300 + " alpha ").encode()
    whole, at = substrings.word_hashes(np.frombuffer(text, np.uint8))
    monkeypatch.setattr(substrings, "_CHUNK", 64)
    parts, at2 = substrings.word_hashes(np.frombuffer(text, np.uint8))
    assert (whole == parts).all() and (at == at2).all()
    assert len(whole) == 152 and len(set(whole.tolist())) == 4 and whole[0] == whole[-1]
