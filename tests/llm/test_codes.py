import hashlib
import math
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeloom.llm import codes, registry

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """The contract, one vector at a time; rows: (vec_id, embedding, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(order[0][1])
    fits = [r for r in order if len(r[1]) == size]
    bounds = [i * size // parts for i in range(parts + 1)]
    cut = lambda v: [[math.floor(Fraction(x) * 256) for x in v[a:b]] for a, b in zip(bounds, bounds[1:])]
    vectors = [cut(r[1]) for r in fits]
    books = [[v[p] for v in vectors[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (away(v[p], books[p][e]), e)) for p in range(parts)]
                for v in vectors]

    for _ in range(rounds):
        own = assign()
        new = [[list(e) for e in book] for book in books]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for v, o in zip(vectors, own) if o[p] == e]
                if mine:
                    new[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most, out, sums = 2**63 - 1, [], {}
    for r, v, o in zip(fits, vectors, assign()):
        error = min(most, sum(away(v[p], books[p][o[p]]) for p in range(parts)))
        sums[r[2]] = sums.get(r[2], 0) + error
        out.append((r[0], bytes(o).hex(), error, r[2]))
    out += [(r[0], None, None, r[2]) for r in order if len(r[1]) != size]
    return [(i, c, e, min(most, sums[lab]) if lab in sums else None, digest) for i, c, e, lab in out]


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as code", "1 as error", "2 as part", "3 as _n")
    found = sorted((tuple(r) for r in codes.product_codes(frame, **options).collect()), key=key)
    assert found == sorted(plain(rows, **options), key=key)


def test_equals_brute_force(spark):
    pick = random.Random(4)
    rows = [(i, [pick.gauss(0, 0.2) for _ in range(32)], pick.choice([0, 0, 1, None])) for i in range(400)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(60)] + [rows[5], rows[5]]  # copies and repeated rows
    rows += [(2000, None, 1), (2001, [0.0] * 31 + [None], 1), (2002, [0.0] * 31 + [math.nan], 1),
             (2003, [0.0] * 31 + [-math.inf], 1), (None, [0.1] * 32, None), (2004, [0.5] * 7, 1), (2005, [], 9),
             (2006, [-1 / 256] * 32, 2)]
    pick.shuffle(rows)
    check(spark, rows)


def test_huge_components_and_odd_sizes(spark):
    """Beyond what a long holds; sizes that 16 does not divide; fewer vectors than entries."""
    pick = random.Random(5)
    huge = [(i, [pick.choice([1e300, -1e18, 3e9, 0.25, 1.0]) * pick.random() for _ in range(19)], i % 2) for i in range(40)]
    check(spark, huge, entries=8)
    check(spark, [(i, [pick.random() for _ in range(5)], None) for i in range(30)])
    check(spark, [(7, [], 1), (8, [], 1)])


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 300), st.integers(1, 70), st.integers(1, 5), st.sampled_from([1, 3, 50, 10**6]), st.integers(0, 99))
def test_dual_tree_assigns_as_brute_force(n, k, d, spread, seed):
    pick = np.random.default_rng(seed)
    points, book = pick.integers(-spread, spread + 1, (n, d)), pick.integers(-spread, spread + 1, (k, d))
    found, sums, counts = codes.dual_assign(points, book, leaf=4)
    wanted = ((points[:, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (found == wanted).all() and (counts == np.bincount(wanted, minlength=k)).all()
    totals = np.zeros_like(book)
    np.add.at(totals, wanted, points)
    assert (sums == totals).all()


def test_whole_nodes_are_assigned_without_leaves(monkeypatch):
    """Far clusters: no distance of a single point is needed."""
    pick = np.random.default_rng(2)
    centers = np.array([[0, 0], [10**6, 0], [0, 10**6], [10**6, 10**6]])
    points = np.repeat(centers, 256, axis=0) + pick.integers(-5, 6, (1024, 2))
    whole = codes.Tree(points, codes.LEAF)
    found, _, counts = codes.dual_assign(points, centers)
    assert counts.tolist() == [256] * 4 and whole.depth == 5
    assert (found == np.repeat(np.arange(4), 256)).all()


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS FROM '{folder}/embeddings.parquet'")
        answer = db.execute(codes.product_codes_sql())
        names = [c[0] for c in answer.description]
        wanted = sorted(answer.fetchall())
    found = registry.queries()["op13_codes"](spark, folder).select(*names)
    assert sorted(tuple(r) for r in found.collect()) == wanted


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert codes.product_codes(none).collect() == []
    assert codes.product_codes(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
