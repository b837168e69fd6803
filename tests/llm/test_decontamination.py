from tests.llm.frames import SCHEMA, awkward, awkward_rows, prose, rows_of, with_clashes
from tradeloom.llm import decontamination


def items(spark):
    passage = prose(2000, 40)
    rows = [(1, passage), (2, prose(2001, 12)), (3, "two words"), (4, ""), (5, None), (6, "one " * 8),
            (7, prose(2002, 300)), (7, prose(2002, 300)), (8, prose(4, 30).upper()), (None, prose(2003, 20))]
    return spark.createDataFrame(rows, "item_id long, text string"), rows


def documents(spark, rows):
    passage = rows[0][1].split()
    more = [
        (500, f"{prose(3000, 900)} {rows[0][1]} {prose(3001, 900)}", "en", "s", 1),
        (501, f"{prose(3002, 9)} {' '.join(passage[:34])} {prose(3003, 9)}", "en", "s", 1),
        (502, f"{prose(3004, 9)} {' '.join(passage[:32])} {prose(3005, 9)}", "en", "s", 1),
        (503, rows[1][1].title(), "en", "s", 1), (504, f"x {rows[6][1]}", "en", "s", 1),
        (505, "here are two words of it", "en", "s", 1), (506, "one one one one one one", "en", "s", 1),
        (507, rows[9][1], "en", "s", 1),
    ]
    return spark.createDataFrame(awkward_rows() + more, SCHEMA), awkward_rows() + more


def plain(docs, items):
    def words(t):
        return (t or "").lower().split()

    def shingles(w, k):
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}

    wanted = {}
    for item, text in items:
        w = words(text)
        if w:
            wanted.setdefault(item, set()).update(shingles(w, min(5, len(w))))
    out = set()
    for doc in {d[0] for d in docs}:
        own = {k: set().union(*[shingles(words(d[1]), k) for d in docs if d[0] == doc]) for k in range(1, 6)}
        for item, s in wanted.items():
            n = sum(x in own[len(x)] for x in s)
            if n >= 0.8 * len(s):
                out.add((doc, item, n, len(s)))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def test_equals_brute_force(spark, monkeypatch):
    benchmark, rows = items(spark)
    docs, doc_rows = documents(spark, rows)
    docs = with_clashes(docs, "item_id", "hash", "width", "shingle", "w")
    wanted = plain(doc_rows, rows)
    assert {(500, 1), (501, 1), (503, 2), (504, 7), (505, 3), (506, 6)} <= {r[:2] for r in wanted}
    found = lambda: rows_of(decontamination.contained_items(docs, benchmark),
                            "doc_id", "item_id", "shared", "n_shingles")
    assert found() == wanted
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    assert found() == wanted


def test_without_items(spark):
    benchmark, rows = items(spark)
    docs, _ = documents(spark, rows)
    kept = decontamination.without_items(docs, benchmark)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns
    assert not {500, 501, 503, 504, 505, 506} & set(ids)
    assert 502 in ids and 103 in ids and ids.count(None) == 2


def test_empty(spark):
    benchmark, _ = items(spark)
    none = spark.createDataFrame([], SCHEMA)
    assert decontamination.contained_items(none, benchmark).collect() == []
    assert decontamination.contained_items(awkward(spark), benchmark.limit(0)).collect() == []
    assert decontamination.without_items(awkward(spark), benchmark.limit(0)).count() == len(awkward_rows())
