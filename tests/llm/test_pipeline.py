"""The corpus pipeline against brute force, stage by stage on what the one before kept."""

import pytest

import corpus_pipeline
from checks.compare import compare, connect
from tallygrove.llm.queries import ORACLE, QUERIES
from tests.conftest import SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Per stage: the rows it got and the rows it returned."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        result = stage(spark, docs, SMALL)
        if name != "mixing":
            assert result.columns == columns
        result.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out[name] = (before.collect(), docs.collect())
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_dedup", "decontaminate", "mixing"]


def test_quality_stage_keeps_what_the_query_accepts(spark, stages):
    before, after = stages["quality_classifier"]
    accepted = {r.doc_id for r in QUERIES["op5_quality_classifier"](spark, SMALL).filter("predicted = 1").collect()}
    assert ids(after) == sorted(accepted)
    assert {r.doc_id: r.text for r in after}.items() <= {r.doc_id: r.text for r in before}.items()


def test_line_stage(stages):
    before, after = stages["line_dedup"]
    wanted = brute.line_dedup([(r.doc_id, r.text) for r in before], 50)
    left = {i: t for i, (t, n) in wanted.items() if not n or brute.words(t)}
    assert {r.doc_id: r.text for r in after} == left
    assert all(r.n_chars == len(r.text) for r in after)


def test_near_duplicate_stage(stages):
    before, after = stages["simhash_dedup"]
    root = brute.linked({r.doc_id: brute.simhash(r.text) for r in before})
    assert ids(after) == sorted(set(root.values()))


def test_decontamination_stage(spark, stages):
    before, after = stages["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = brute.contamination([(r.doc_id, r.text) for r in before], items)
    assert ids(after) == sorted(i for i, row in found.items() if not row[-1])


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    sizes = {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
    taken = dict.fromkeys(sizes, 0)
    texts = {r.doc_id: r.text for r in before}
    for r in after:
        assert r.text == texts[r.doc_id] and 0 < r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= 1


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in stages["mixing"][1])


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_duckdb(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) == []
