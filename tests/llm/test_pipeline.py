"""The corpus pipeline stage by stage, and the registered queries."""

import corpus_pipeline
import pytest
from oracle_check import compare, connect
from tickermill.llm import registry
from tickermill.session import stored
from .test_pair_operators import brute_groups
from .test_text_operators import SECRET, base_spans

SF = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    docs = documents
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), name)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert set(kept[name]) <= set(before)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "near_duplicates":
            _, label = brute_groups({i: r.text for i, r in before.items()})
            assert set(kept[name]) == {i for i, c in label.items() if i == c}
        if name == "secrets":
            assert set(kept[name]) == set(before)
            secret = {i for i, r in before.items() if base_spans(r.text, SECRET)}
            assert {i for i, r in kept[name].items() if "[SECRET]" in r.text} == secret
            assert all(r.n_chars == len(r.text) for r in kept[name].values())
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = kept["near_duplicates"], kept["decontamination"]
    leaking = {i for i, r in before.items() if any(t in r.text for t in items)}
    assert leaking and not leaking & set(after)
    assert sum(r.n_tokens for r in kept["bpe"].values()) > 0
    assert all(len(r.ids) == r.n_tokens for r in kept["bpe"].values())


def test_stages_take_odd_rows(spark, odd, empty):
    for df in (odd, empty):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs.select(*(c for c in docs.columns)), SF), name)
        assert docs.count() <= df.count()


def test_a_task_holds_one_python_worker(spark, documents):
    """No stage asks twice for the same UDF, nor for the other set of workers that RDDs of Python rows need."""
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") <= 1, name
        assert "ExistingRDD" not in plan, name
        docs = stored(out, name)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, name):
    diff, _, _, rows, _ = compare(spark, connect(SF), SF, name, registry.QUERIES[name], registry.ORACLE[name])
    assert diff == [] and rows > 0


def test_registered_names():
    assert [int(n[2:].split("_")[0]) for n in registry.QUERIES] == list(range(1, 14))
