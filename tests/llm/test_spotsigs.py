import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm.frames import SCHEMA, awkward, awkward_rows, prose, with_clashes
from tradeloom.llm import spotsigs


def parts(fingerprint):
    return {fingerprint[i:i + 8] for i in range(0, len(fingerprint), 8)}


@pytest.mark.parametrize("bucket_bytes", [300, spotsigs.BUCKET_BYTES])
def test_edited_texts_and_likeness(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr(spotsigs, "BUCKET_BYTES", bucket_bytes)
    monkeypatch.setattr(spotsigs, "BROADCAST_BUCKETS", 0 if bucket_bytes == 300 else 250_000)
    docs = with_clashes(awkward(spark), "bucket", "ghost", "next_text", "fingerprint", "n")
    rows = {}
    for r in spotsigs.fingerprints(docs).collect():
        rows.setdefault(r.doc_id, []).append(r)
    source = sorted(awkward_rows(), key=lambda r: r[1] or "")
    source.sort(key=lambda r: -10**9 if r[0] is None else r[0], reverse=True)
    groups = {}
    for k, r in enumerate(source):
        groups.setdefault(r[0], []).append(k)
    for ks in groups.values():  # ties go by text
        for k, r in zip(ks, sorted((source[k] for k in ks), key=lambda r: r[1] or "")):
            source[k] = r
    prints = {}
    for rs in rows.values():
        for r in rs:
            prints.setdefault(r.edited_sha256, r)
    assert sum(map(len, rows.values())) == len(source)
    for k, r in enumerate(source):
        text, other = r[1] or "", source[(k + 1) % len(source)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        found = [x for x in rows[r[0]] if x.edited_sha256 == digest and x.n_chars == len(text)]
        assert found, r[0]
        a, b = parts(found[0].fingerprint), parts(found[0].edited_fingerprint)
        assert found[0].near_edited == pytest.approx(len(a & b) / len(a | b))
        assert 0 <= found[0].near_next <= 1


def test_equal_texts_have_equal_fingerprints(spark):
    prints = {}
    texts = {}
    for r in awkward_rows():
        texts.setdefault(r[0], set()).add(r[1] or "")
    for r in spotsigs.fingerprints(awkward(spark)).collect():
        if r.doc_id is not None:
            prints.setdefault(next(iter(texts[r.doc_id])), set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert all(p and min(p) for p in prints.values())


def test_similar_classes_equal_all_pairs(spark):
    base = [prose(i, 120) for i in range(25)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(base)]
    rows += [(100 + i, t + " the new ending of it", "en", "s", 1) for i, t in enumerate(base[:12])]
    rows += [(200 + i, t, "en", "s", 1) for i, t in enumerate(base[:5])]
    rows += [(300 + i, " ".join(t.split()[:70]), "en", "s", 1) for i, t in enumerate(base[:8])]
    rows = [(1000 + r[0], *r[1:]) for r in rows]
    docs = spark.createDataFrame(rows + awkward_rows(), SCHEMA)
    members, pairs = spotsigs.similar_classes(docs)
    sets = {r.doc_id: frozenset(r.found) for r in docs.where("doc_id is not null").select(
        "doc_id", spotsigs.signatures(F.coalesce("text", F.lit(""))).alias("found")).collect()}
    of = {r.doc_id: r.class_id for r in members.collect()}
    for d, s in sets.items():
        assert of[d] == min(x for x, y in sets.items() if y == s)
    classes = {c: sets[c] for c in of.values()}
    wanted = {(a, b) for a in classes for b in classes if a < b
              and len(classes[a] & classes[b]) >= 0.8 * len(classes[a] | classes[b])}
    assert {(r.class_a, r.class_b) for r in pairs.collect()} == wanted and wanted


def test_one_document_and_none(spark):
    one = spark.createDataFrame([(9, "the river of the town and the road", "en", "s", 1)], SCHEMA)
    row = spotsigs.fingerprints(one).first()
    assert row.near_next == 1.0
    assert spotsigs.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
