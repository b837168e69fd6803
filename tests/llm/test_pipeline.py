"""The stages in order, each against what its operator promises."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.frames import SCHEMA, awkward_rows, prose

SF = "/root/testdata/sf0.001"


def test_stages_are_registered_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "simhash near-dedup", "substring dedup",
                     "benchmark decontamination", "best-fit packing"]
    queries = contract.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean documents and one kind of each that the stages take out."""
    home = tmp_path_factory.mktemp("corpus")
    passage, item = prose(7000, 70), prose(7001, 40)
    clean = [(i, prose(i, 80 + i % 60), "en", "s", 1) for i in range(300)]
    noise = [(1000 + i, "".join(chr(33 + (11 * i + 17 * k) % 90) for k in range(300)), "en", "s", 1) for i in range(5)]
    copies = [(2000 + i, clean[i][1], "en", "s", 1) for i in range(5)]
    near = [(2100 + i, clean[10 + i][1].upper(), "en", "s", 1) for i in range(5)]
    shared = [(3000 + i, f"{prose(8000 + i, 90)} {passage} {prose(9000 + i, 90)}", "en", "s", 1) for i in range(5)]
    leaks = [(4000 + i, f"{prose(8100 + i, 90)} {item if i == 0 else item.upper()} {prose(9100 + i, 90)}", "en", "s", 1)
             for i in range(2)]
    rows = clean + noise + copies + near + shared + leaks
    write = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(str(home / f"{name}.parquet"))
    write("documents", rows, SCHEMA)
    write("labels", [(r[0], 1, 0) for r in clean], "doc_id long, quality int, toxic int")
    write("benchmark", [(1, item)], "item_id long, text string")
    return str(home), {r[0]: r for r in rows}, passage


def test_planted_cases(spark, planted):
    home, rows, passage = planted
    docs = spark.read.parquet(f"{home}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, home)
        assert out.columns == docs.columns
        docs = corpus_pipeline.shared.written(out)
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    kept = seen["quality classifier"]
    assert not any(1000 <= i < 1010 for i in kept) and sum(i < 300 for i in kept) >= 0.95 * 300
    kept = seen["simhash near-dedup"]
    assert not any(2000 <= i < 2010 for i in kept)
    kept = seen["substring dedup"]
    assert sum(passage in (t or "") for t in kept.values()) == 1
    assert all(kept[i] == rows[i][1] for i in kept if i < 300)
    kept = seen["benchmark decontamination"]
    assert 4000 not in kept and 4001 not in kept and sum(i < 300 for i in kept) >= 0.95 * 300
    packed = corpus_pipeline.packed(spark, docs, home).collect()
    assert {r.doc_id for r in packed} == set(kept)


def test_run_over_the_smallest_tables(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(0 <= r.offset and r.offset + r.length <= 1024 for r in rows)


def test_stages_take_awkward_rows_and_none(spark, tmp_path):
    home = str(tmp_path)
    spark.createDataFrame([(2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{home}/benchmark.parquet")
    for rows in (awkward_rows(), []):
        docs = spark.createDataFrame(rows, SCHEMA)
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.shared.written(stage(spark, docs, home))
        assert bool(docs.count()) == bool(rows)
