import re

import pytest
import xxhash

from tests.llm.frames import SCHEMA, awkward, awkward_rows, prose, rows_of, with_clashes
from tradeloom.llm import shared, simhash


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """rows: (doc_id, fingerprint); component as the smallest id reachable."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [least.get(root(i)) for i in range(len(rows))]


def test_equals_brute_force(spark):
    prints = [(r[0], plain_fingerprint(r[1])) for r in awkward_rows()]
    wanted = [(d, f"{f:016x}", c) for (d, f), c in zip(prints, plain_components(prints))]
    found = rows_of(simhash.near_duplicates(with_clashes(awkward(spark), "fp", "fingerprint", "component_id")))
    assert found == sorted(wanted, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("run", [4, 8192])
def test_links_join_what_near_pairs_join(spark, run):
    """Chains, dense balls and far values; also where signatures overflow."""
    import random

    pick = random.Random(3)
    values = [pick.getrandbits(64) for _ in range(30)]
    for center in values[:3]:
        values += [center ^ sum(1 << b for b in pick.sample(range(64), 3)) for _ in range(25)]
    chain = pick.getrandbits(64)
    for bit in range(0, 40, 4):
        chain ^= 0b1111 << bit
        values.append(chain)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = [(r.a, r.b) for r in simhash.links(frame, run).collect()]
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= 4 for a, b in links)
    roots = {r.node: r.root for r in shared.components(simhash.links(frame, run)).collect()}
    wanted = plain_components(list(enumerate(values)))
    for i in range(len(values)):
        for j in range(i):
            same = roots.get(signed[i], signed[i]) == roots.get(signed[j], signed[j])
            assert same == (wanted[i] == wanted[j])


def test_every_near_pair_shares_a_signature(spark):
    import random

    pick = random.Random(5)
    pairs = []
    for _ in range(200):
        a = pick.getrandbits(64)
        b = a ^ sum(1 << x for x in pick.sample(range(64), 4))
        pairs.append(tuple(v - (1 << 64) if v >> 63 else v for v in (a, b)))
    keys = spark.createDataFrame(pairs, "a long, b long")
    from pyspark.sql import functions as F

    signed = lambda c: keys.select("a", "b", F.col(c).alias("fp")).select(
        "a", "b", F.array(*simhash.signatures()).alias(f"k{c}"))
    met = signed("a").join(signed("b"), ["a", "b"]).where(F.arrays_overlap("ka", "kb"))
    assert met.count() == len(set(pairs))


def test_one_per_group(spark):
    docs = with_clashes(awkward(spark), "fp", "row", "root", "first")
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {r.fp for r in rows} == {"clash"}
    group = dict(zip(range(len(awkward_rows())), plain_groups()))
    members = {}
    for at, r in enumerate(awkward_rows()):
        members.setdefault(group[at], []).append(r)
    wanted = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in members.values()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in rows], key=key) == sorted([r[:2] for r in wanted], key=key)
    ids = [r.doc_id for r in rows]
    assert 5 in ids and 110 not in ids and 112 not in ids
    assert 102 in ids and 103 not in ids  # empty texts are one group


def plain_groups():
    """The group of each awkward row, known id or not."""
    prints = [(i, plain_fingerprint(r[1])) for i, r in enumerate(awkward_rows())]
    return plain_components(prints)


def test_one_per_group_of_repeated_and_unknown_ids(spark):
    """Unlike texts under one id both stay; copies without any id leave one row."""
    a, b, c = prose(50, 200), prose(51, 200), prose(52, 200)
    rows = [(7, a), (7, b), (None, c), (None, c), (7, b), (9, b.upper())]
    kept = simhash.one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in kept) == sorted([a, b, c])


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.one_per_group(none).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    roots = {r.node: r.root for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({roots[i] for i in range(61)}) == 1
    assert len({roots[1000 + i] for i in range(50)}) == 1 and roots[0] != roots[1000]


def test_long_text_is_one_of_many_chunks(spark):
    text = prose(9, 40_000)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_one_per_group_makes_fingerprints_in_one_place(spark):
    """A filter pushed below the call would fingerprint every text twice, in two workers a task."""
    plan = simhash.one_per_group(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
