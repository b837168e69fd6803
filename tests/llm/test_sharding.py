import collections
import zlib

from tests.llm.frames import SCHEMA, awkward, awkward_rows, prose, with_clashes
from tradeloom.llm import sharding


def test_rows_and_slots(spark):
    rows = sharding.shards(with_clashes(awkward(spark), "size", "slot", "same", "tie"), 5).collect()
    wanted = collections.Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in awkward_rows())
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == wanted
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 5
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_near_equal_bytes_and_copies_together(spark):
    rows = [(i, prose(i, 20 + i % 50), ("en", "de")[i % 2], f"s{i % 7}", 1) for i in range(3000)]
    rows += [(5000 + i, prose(1, 21), "en", "s1", 1) for i in range(6)]
    rows += [(6000 + i, prose(99999, 60), "en", "s1", 1) for i in range(1500)]  # a third in one group
    out = sharding.shards(spark.createDataFrame(rows, SCHEMA), 8).collect()
    total = collections.Counter()
    for r in out:
        total[r.shard] += r["size"]
    mean = sum(total.values()) / 8
    assert len(total) == 8 and all(abs(t - mean) < 0.02 * mean for t in total.values())
    assert len({r.shard for r in out if r.doc_id == 1 or 5000 <= r.doc_id < 5006}) == 1


def test_few_documents_and_none(spark):
    few = sharding.shards(awkward(spark).where("doc_id in (2, 3, 4)"), 40).collect()
    assert len(few) == 3 and len({r.shard for r in few}) == 3
    assert sharding.shards(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(1, "a b", "en", "s", 1)] * 30, SCHEMA)
    out = sharding.shards(same, 4).collect()
    assert len(out) == 30


def test_only_ids_and_texts(spark):
    out = sharding.shards(awkward(spark).select("doc_id", "text"), 3)
    assert out.count() == len(awkward_rows())
